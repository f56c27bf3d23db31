"""Where an annotation document breaks its rules: line, column, element and cause of the first violation.

One pass over the tags of a text in column functions: ``regexp_extract_all`` finds the tags, ``split`` what stands between,
``aggregate`` folds them with the stack of open elements as a path.  No row leaves its task.  The fold is interpreted tag by
tag; texts that ``plain`` proves to be right by compiled functions over the whole text don't go through it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Comments, CDATA, instructions, declarations and tags; a tag that isn't closed ends before the next one.
TAG = r"""(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)|<!.*?(?:>|\z)|<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>?"""
ROOT = "SIGNSTREAM-DATABASE"
#: Elements that the format has, and those whose values aren't a field's own.
ELEMENTS = (
    "SIGNSTREAM-DATABASE DISTRIBUTOR AUTHOR PARTICIPANTS PARTICIPANT BACKGROUND CODING-SCHEME FIELD PARENTS VALUE MEDIA-FILES MEDIA-FILE UTTERANCES CITATION UTTERANCE NOTES MEDIA-REF SEGMENT TRACK A "
    "REFERENSES CODING-SCHEMES REF AUTHORS IMGS IMG TEMPLATES TEMPLATE PALETTE ITEM FIELD_TYPES FIELD_TYPE FIELDS VALUES_DFLT VALUE_COLLECTIONS VALUE_COLLECTION SYNTACTIC_GROUP DEFAULT-SEGMENT F "
    "SELECTED_FIINGERS NONSELECTED_FINGERS BASE_JOINTS SPREAD NONBASE_JOINTS THUMB_CONTACT"
).split()
OTHER_VALUES = ("VALUES_DFLT", "VALUE_COLLECTION", "SYNTACTIC_GROUP")
#: Elements, and what they must be inside of.
INSIDE = {"PARTICIPANT": [ROOT], "FIELD": [ROOT], "MEDIA-FILE": [ROOT], "UTTERANCE": [ROOT], "MEDIA-REF": ["UTTERANCE"], "SEGMENT": ["UTTERANCE"], "TRACK": ["UTTERANCE"], "A": ["UTTERANCE", "TRACK"]}
#: Elements whose id no other may have, and how a second one is called.
UNIQUE = {"PARTICIPANT": "duplicate participant", "FIELD": "duplicate field", "MEDIA-FILE": "duplicate media", "SEGMENT": "duplicate utterance"}
CAUSES = ["unclosed tag", "wrong nesting", "unexpected element", "bad attribute", *UNIQUE.values(), "duplicate field value", "unknown media", "unclosed element", "no root"]


def _element(name: str, content: str = "", attributes: tuple[str, ...] = (), others: str = "") -> str:
    """Pattern of an element with these numeric ``attributes``; what it holds is ``content``, any number of ``others`` first."""
    need = "".join(rf'(?=[^<>]*?\s{a}="{NUMBER if a.endswith("ID") else TIME}")' for a in attributes)
    inner = rf"{GAP}(?:(?:{others}){GAP})*+" if others else GAP
    return rf"<{name}(?=[\s/>]){need}{ATTRIBUTES}(?:/>|>{inner}{content}</{name}>)"


#: Ids as the proof takes them, times, attributes without signs that could be taken for another's, and what stands between tags.
NUMBER, TIME = r"(?:0|[1-9]\d{0,8})", r"[+-]?\d{1,9}"
ID = r"\s(?:ID|PARTICIPANT-ID|FID)="
ATTRIBUTES = rf"""(?![^<>]*{ID}"(?!{NUMBER}"))(?:\s++[\w:.-]++="[^<>"=]*+")*+\s*+"""
GAP = r"(?:[^<]++|<\?[^<>]++(?<=\?)>)*+"


def _grammar() -> str:
    """Pattern of documents without comments in the usual order, repetitions possessive: one pass, no growing stack."""
    several = lambda x: f"(?:(?:{x}){GAP})*+"
    free = "|".join(_element(n) for n in ELEMENTS if n not in INSIDE and n not in (ROOT, "VALUE", "UTTERANCES", "PARTICIPANTS", "CODING-SCHEME", "MEDIA-FILES", *OTHER_VALUES))
    field = _element("FIELD", several(_element("VALUE", "", ("ID",))), ("ID",), free)
    track = _element("TRACK", several(_element("A", "", ("S", "E"))), ("FID",))
    segment = _element("SEGMENT", several(track), ("PARTICIPANT-ID",))
    utterance = _element("UTTERANCE", several(segment), ("ID", "S", "E"), f'{_element("MEDIA-REF", "", ("ID",))}|{free}')
    parts = [_element("PARTICIPANTS", several(_element("PARTICIPANT", "", ("ID",), free))), _element("CODING-SCHEME", several(field)), _element("MEDIA-FILES", several(_element("MEDIA-FILE", "", ("ID",), free))), free]
    whole = _element(ROOT, several(f'{utterance}|{_element("UTTERANCES", several(utterance))}'), (), "|".join(parts))
    return rf"\A{GAP}{whole}{GAP}\z"


def plain(xml: Column, known_media: bool = True) -> Column:
    """True only where a text breaks no rule; false or null tells nothing.

    One pattern proves nesting, places and attributes, sets of ids the rest: none of a participant, field or medium twice in
    the text, nor a value in a field or a participant in an utterance; utterances have ids of their own.
    """
    ids = lambda text, name: F.regexp_extract_all(text, F.lit(rf'<{name}(?=\s)[^<>]*?{ID}"(\d+)"'), F.lit(1))
    once = lambda text, name: F.size(F.array_distinct(ids(text, name))) == F.size(ids(text, name))
    each = lambda end, name: F.forall(F.split(xml, end), lambda x: once(x, name))
    right = xml.rlike(_grammar())
    for name in ("PARTICIPANT", "FIELD", "MEDIA-FILE", "UTTERANCE"):
        right &= once(xml, name)
    right &= each("</FIELD>", "VALUE") & each("</UTTERANCE>", "SEGMENT")
    return right & (F.size(F.array_except(ids(xml, "MEDIA-REF"), ids(xml, "MEDIA-FILE"))) == 0) if known_media else right


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _steps(xml: Column) -> Column:
    """A struct per tag, and one for the end: kind, name, id, and how far it begins behind the tag before."""
    tags, gaps = F.regexp_extract_all(xml, F.lit(TAG), F.lit(0)), F.split(xml, TAG, -1)
    pairs = F.transform(F.arrays_zip(gaps.alias("gap"), tags.alias("tag")), lambda p: p)

    # Lambdas are interpreted and compute a shared expression as often as it stands there, so names and kinds are bound first.
    def named(tag: Column, lead: Column) -> Column:
        name = F.regexp_extract(tag, r"^</?\s*([^\s/>]*)", 1)
        kind = F.when(tag.isNull(), "end").when(tag.startswith("<!") | tag.startswith("<?"), "skip").when(~tag.endswith(">"), "cut").when(tag.startswith("</"), "close").when(tag.endswith("/>"), "empty").otherwise("open")
        return F.struct(kind.alias("kind"), F.coalesce(name, F.lit("")).alias("name"), tag.alias("tag"), lead.alias("lead"))

    def one(x: Column) -> Column:
        name, kind, tag, lead = x["name"], x["kind"], x["tag"], x["lead"]
        number = lambda n: tag.rlike(rf"\s{n}\s*=\s*[\"']\s*[+-]?\d{{1,9}}\s*[\"']")
        ident = F.when(kind.isin("open", "empty"), F.regexp_extract(tag, r"\s(?:ID|PARTICIPANT-ID|FID)\s*=\s*[\"']\s*([+-]?\d{1,9})\s*[\"']", 1).try_cast("int").cast("string"))
        tail = F.length(F.substring_index(lead, "\n", -1))
        lines = F.length(lead) - F.length(F.replace(lead, F.lit("\n"), F.lit("")))
        timed = ~name.isin("A", "UTTERANCE") | (number("S") & number("E"))
        return F.struct(kind.alias("kind"), name.alias("name"), ident.alias("id"), F.coalesce(timed, F.lit(False)).alias("timed"), lines.alias("lines"), tail.alias("tail"))

    # What lies between the beginnings of two tags: the first of them and the text behind it.
    bound = F.transform(F.array(pairs), lambda ps: F.transform(F.transform(ps, lambda p, i: named(p["tag"], F.concat(F.when(i > 0, F.get(ps, i - 1)["tag"]).otherwise(""), p["gap"]))), one))
    return F.element_at(bound, 1)


def first_error(xml: Column, ignore: tuple[str, ...] = (), proof: bool = True) -> Column:
    """``struct<cause, element, line, column>`` of a text's first violation, null where there is none; null texts have none.

    Lines count from 1, columns from 0, at the beginning of the tag; what is missing at the end is reported there, with the
    innermost open element.  Causes, ``CAUSES``: a tag without its end; an end tag that closes another element; an element
    that the format hasn't or that stands where it can't; an id, start or end that is missing or isn't an integer; a
    second participant, field, value of a field, medium or utterance of a participant with the same id; an unknown
    medium; an element that the text's end leaves open; a text without a root.  Causes in ``ignore`` are passed over.
    Ids that were seen are kept in arrays: the cost is quadratic in the number of a document's utterances and media, linear in the rest.
    Without ``proof`` every text is folded, with the same result.
    """
    start = F.struct(
        F.lit(1).alias("line"), F.lit(0).alias("column"), F.lit("/").alias("stack"), F.lit("").alias("utterance"), F.array().cast("array<string>").alias("seen"),
        F.array().cast("array<string>").alias("values"), F.lit(None).cast("string").alias("cause"), F.lit("").alias("element"),
    )
    cause_of = lambda what, when: F.when(F.lit(what not in ignore) & when, what)

    def step(a: Column, x: Column) -> Column:
        name, kind, stack = x["name"], x["kind"], a["stack"]
        top = F.substring_index(F.substring_index(stack, "/", -2), "/", 1)
        begins = kind.isin("open", "empty")
        inside = lambda n: stack.contains(f"/{n}/")
        own_value = (name == "VALUE") & ~top.isin(*OTHER_VALUES)
        misplaced = _any([(name == n) & ~reduce(lambda p, q: p & q, [inside(u) for u in up]) for n, up in INSIDE.items()]) | (own_value & ~inside("FIELD"))
        has_id = name.isin(*INSIDE) | own_value
        mark = F.concat(name, F.lit(" "), F.when(name == "SEGMENT", F.concat(a["utterance"], F.lit("/"))).otherwise(""), F.coalesce(x["id"], F.lit("")))
        known = F.array_contains(a["seen"], mark)
        cause = F.coalesce(
            cause_of("unclosed tag", kind == "cut"),
            cause_of("wrong nesting", (kind == "close") & (name != top)),
            cause_of("unexpected element", begins & (~name.isin(*ELEMENTS) | misplaced)),
            cause_of("bad attribute", begins & has_id & ~(x["timed"] & (x["id"].isNotNull() | (name == "A")))),
            *[cause_of(what, begins & (name == n) & known) for n, what in UNIQUE.items()],
            cause_of("duplicate field value", begins & own_value & F.array_contains(a["values"], x["id"])),
            cause_of("unknown media", begins & (name == "MEDIA-REF") & ~F.array_contains(a["seen"], F.concat(F.lit("MEDIA-FILE "), x["id"]))),
            cause_of("unclosed element", (kind == "end") & (stack != "/")),
            cause_of("no root", (kind == "end") & (a["element"] == "")),
        )
        column = F.when(x["lines"] > 0, x["tail"]).otherwise(a["column"] + x["tail"])
        popped = stack.substr(F.lit(1), F.length(stack) - F.length(top) - 1)
        return F.when(a["cause"].isNotNull(), a).otherwise(F.struct(
            (a["line"] + x["lines"]).alias("line"), column.alias("column"),
            F.when(kind == "open", F.concat(stack, name, F.lit("/"))).when((kind == "close") & (stack != "/"), popped).otherwise(stack).alias("stack"),
            F.when(begins & (name == "UTTERANCE"), F.coalesce(x["id"], F.lit(""))).otherwise(a["utterance"]).alias("utterance"),
            F.when(begins & name.isin(*UNIQUE) & ~known, F.array_append(a["seen"], mark)).otherwise(a["seen"]).alias("seen"),
            F.when(begins & (name == "FIELD"), F.array().cast("array<string>")).when(begins & own_value & x["id"].isNotNull(), F.array_append(a["values"], x["id"])).otherwise(a["values"]).alias("values"),
            cause.alias("cause"), F.when(kind == "end", F.when(stack == "/", a["element"]).otherwise(top)).when(begins | kind.isin("close", "cut"), name).otherwise(a["element"]).alias("element"),
        ))

    def shown(a: Column) -> Column:
        return F.when(a["cause"].isNotNull(), F.struct(a["cause"].alias("cause"), a["element"].alias("element"), a["line"].alias("line"), a["column"].alias("column")))

    folded = F.aggregate(_steps(xml), start, step, shown)
    return F.when(~F.coalesce(plain(xml, "unknown media" not in ignore), F.lit(False)), folded) if proof else folded


def errors(docs: DataFrame, key: str = "DocumentID", xml: str = "xml", ignore: tuple[str, ...] = ()) -> DataFrame:
    """``(key, cause, element, line, column)`` of the documents that break a rule; others have no row."""
    # Inlined, since a filter on the error and each of its fields would compute it anew.
    return docs.select(F.col(key).alias(key), F.inline(F.array(first_error(F.col(xml), ignore)))).filter("cause IS NOT NULL")
