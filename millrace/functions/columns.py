"""Scalar functions as column expressions; none needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_to_frame(ms: Column, fps: float = 30.0) -> Column:
    """Frame of a time in milliseconds; halves go to the even frame."""
    return F.rint(ms / F.lit(1000.0) * F.lit(float(fps))).cast("int")


def frame_range(start: Column, end: Column) -> Column:
    """Frames ``start .. end - 1``; none where the end isn't later (``sequence`` alone would count down)."""
    return F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<int>"))


def slice_frames(start_ms: Column, end_ms: Column, fps: float) -> tuple[Column, Column]:
    """First frame and the frame after the last one of an interval whose end frame counts."""
    return ms_to_frame(start_ms, fps), ms_to_frame(end_ms, fps) + 1


def clamp_window(start: Column, end: Column, last: Column) -> tuple[Column, Column]:
    """A frame window inside ``0 .. last``: one that starts later moves back at its length, one that ends later is cut."""
    late = start > last
    return F.when(late, last - (end - start - 1)).otherwise(start), F.when(late, last).otherwise(F.least(end, last))


def url_quote(text: Column) -> Column:
    """Percent-encoding with ``/`` kept and blanks as ``%20``."""
    out = F.url_encode(text)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def first_part(text: Column, sep: str) -> Column:
    return F.substring_index(text, sep, 1)


def last_part(text: Column, sep: str) -> Column:
    return F.substring_index(text, sep, -1)


def joined_lines(text: Column) -> Column:
    """Lines stripped of blanks and concatenated."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), "")


def first_int(text: Column) -> Column:
    """First run of digits as an integer, else -1."""
    return F.coalesce(F.regexp_extract(text, r"([0-9]+)", 1).try_cast("int"), F.lit(-1))


def unwrap_bytes(text: Column) -> Column:
    """``b'...'`` without its wrapping."""
    return F.substring(text, F.lit(3), F.length(text) - 3)


def is_ascii(text: Column) -> Column:
    return text.rlike(r"^[\x00-\x7F]*$")


def encode_base64(text: Column) -> Column:
    """Base64 in one line."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"\s", "")


def decode_base64(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")


def path_join(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def csv_text(*cols: Column) -> Column:
    """A row in the legacy CSV layout: commas go, fields are joined by ``, ``."""
    return F.array_join(F.transform(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), lambda x: F.replace(x, F.lit(","), F.lit(""))), ", ")


def format_interval(text: Column, start: Column, end: Column) -> Column:
    """``text (start-end)``."""
    return F.format_string("%s (%d-%d)", text, start, end)
