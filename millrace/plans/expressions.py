"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators.joins import frames_of_intervals
from millrace.plans.registry import Tables, query

#: Events as intervals: milliseconds of the day, and a width that the value gives.
SPAN_SQL = "(SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) % 86400000 AS s, (epoch_us(ts) // 1000) % 86400000 + CAST(floor(abs(value) * 40) AS BIGINT) % 3000 AS e FROM events)"


def spans(t: Tables):
    ms = F.pmod(F.unix_millis(F.col("ts").cast("timestamp")), F.lit(86400000))
    return t.events.select("event_id", "user_id", "event_type", ms.alias("s"), (ms + F.floor(F.abs("value") * 40) % 3000).alias("e"))


@query("SELECT o_orderdate::DATE::VARCHAR AS ordered, o_custkey AS customer, o_orderkey AS orderkey FROM orders")
def project_reorder(t):
    return t.orders.select(F.col("o_orderdate").cast("date").cast("string").alias("ordered"), F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("orderkey"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(trunc(l_quantity) AS INTEGER) AS q, l_linenumber AS n FROM lineitem")
def project_cast(t):
    return t.lineitem.select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_quantity").cast("int").alias("q"), F.col("l_linenumber").alias("n"))


@query("SELECT c_custkey AS id, c_name AS label FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def scan_rename(t):
    return t.customer.select("c_custkey", "c_name").toDF("id", "label").union(t.supplier.select("s_suppkey", "s_name"))


@query("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer")
def scan_parquet_typed(t):
    typed = t.spark.read.schema("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").parquet(f"{t.folder}/customer.parquet")
    return typed.select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment")


@query("SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'), '?', '%3F'), '=', '%3D'), '&', '%26'), ' ', '%20'), '#', '%23'), '+', '%2B') AS quoted FROM pages")
def fn_url_quote(t):
    return t.pages.select("page_id", C.url_quote(F.col("url")).alias("quoted"))


@query("SELECT page_id, split_part(url, '/', 1) AS head, list_last(string_split(url, '/')) AS tail, len(string_split(url, '/')) AS n FROM pages")
def fn_split_parts(t):
    return t.pages.select("page_id", C.first_part(F.col("url"), "/").alias("head"), C.last_part(F.col("url"), "/").alias("tail"), F.size(F.split("url", "/")).cast("long").alias("n"))


@query("SELECT page_id, array_to_string(list_transform(string_split(html, chr(10)), lambda x: trim(x, ' ')), '') AS flat FROM pages")
def fn_trim_lines(t):
    return t.pages.select("page_id", C.joined_lines(F.col("html")).alias("flat"))


@query("SELECT o_orderkey, coalesce(TRY_CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS INTEGER), -1) AS n, coalesce(TRY_CAST(regexp_extract(o_orderstatus, '([0-9]+)', 1) AS INTEGER), -1) AS none FROM orders")
def fn_first_int(t):
    return t.orders.select("o_orderkey", C.first_int(F.col("o_orderpriority")).alias("n"), C.first_int(F.col("o_orderstatus")).alias("none"))


@query("SELECT conv_id, turn, array_to_string(list_transform(string_split(text, ' '), lambda x: lower(x)), ' ') AS words FROM conversations")
def fn_array_join(t):
    return t.conversations.select("conv_id", "turn", F.concat_ws(" ", F.transform(F.split("text", " "), F.lower)).alias("words"))


@query(r"SELECT conv_id, turn, replace(replace(text, ',', ''), '\', '') AS plain FROM conversations")
def fn_replace(t):
    return t.conversations.select("conv_id", "turn", F.replace(F.replace("text", F.lit(",")), F.lit("\\")).alias("plain"))


@query("SELECT conv_id, turn, base64(encode(text)) AS b64, length(base64(encode(text))) AS n, text AS back FROM conversations")
def fn_base64_roundtrip(t):
    b = t.conversations.select("conv_id", "turn", C.encode_base64(F.col("text")).alias("b64"))
    return b.select("conv_id", "turn", "b64", F.length("b64").cast("long").alias("n"), C.decode_base64(F.col("b64")).alias("back"))


@query("SELECT doc_id, regexp_matches(coalesce(text, ''), '^[\\x00-\\x7F]*$') AS ascii FROM documents")
def fn_ascii_check(t):
    return t.documents.select("doc_id", C.is_ascii(F.coalesce("text", F.lit(""))).alias("ascii"))


@query("SELECT c_custkey, c_name AS name FROM customer")
def fn_unwrap_bytes(t):
    return t.customer.select("c_custkey", C.unwrap_bytes(F.concat(F.lit("b'"), "c_name", F.lit("'"))).alias("name"))


@query(f"SELECT event_id, CAST(round_even(s / 1000.0::DOUBLE * 30, 0) AS INTEGER) AS first, CAST(round_even(e / 1000.0::DOUBLE * 30, 0) AS INTEGER) AS last FROM {SPAN_SQL}")
def fn_ms_to_frame(t):
    return spans(t).select("event_id", C.ms_to_frame(F.col("s")).alias("first"), C.ms_to_frame(F.col("e")).alias("last"))


@query("""SELECT conv_id, turn, len(w) AS n, len(list_distinct(w)) AS n_distinct, list_max(w) AS most, list_contains(w, 'the') AS has_the,
  len(list_filter(w, lambda x: length(x) <= 0)) = 0 AS all_full, array_to_string(list_sort(w), ' ') AS sorted
  FROM (SELECT conv_id, turn, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: length(x) > 0) AS w FROM conversations)""")
def fn_array_suite(t):
    w = F.filter(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), lambda x: F.length(x) > 0)
    d = t.conversations.select("conv_id", "turn", w.alias("w"))
    return d.select("conv_id", "turn", F.size("w").cast("long").alias("n"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), F.array_max("w").alias("most"), F.array_contains("w", "the").alias("has_the"), F.forall("w", lambda x: F.length(x) > 0).alias("all_full"), F.array_join(F.array_sort("w"), " ").alias("sorted"))


@query(f"SELECT event_id, s + user_id AS start_ms, e + user_id AS end_ms FROM {SPAN_SQL}")
def fn_absolute_time(t):
    return spans(t).select("event_id", (F.col("user_id") + F.col("s")).alias("start_ms"), (F.col("user_id") + F.col("e")).alias("end_ms"))


@query("SELECT o_orderkey, coalesce(n_name, o_orderstatus) AS label FROM orders LEFT JOIN nation ON o_custkey = n_nationkey")
def fn_coalesce_lookup(t):
    return t.orders.join(t.nation, F.col("o_custkey") == F.col("n_nationkey"), "left").select("o_orderkey", F.coalesce("n_name", "o_orderstatus").alias("label"))


@query("SELECT l_orderkey, l_linenumber, 'frames/' || l_orderkey || '/' || l_linenumber || '.jpg' AS path FROM lineitem")
def fn_path_join(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", C.path_join(F.lit("frames"), F.col("l_orderkey").cast("string"), F.concat(F.col("l_linenumber").cast("string"), F.lit(".jpg"))).alias("path"))


@query(f"SELECT user_id, string_agg(event_type || ' (' || s || '-' || e || ')', ', ' ORDER BY s, event_id, event_type) AS shown FROM {SPAN_SQL} GROUP BY user_id")
def fn_format_intervals(t):
    from millrace.operators.aggregates import ordered_list

    one = C.format_interval(F.col("event_type"), F.col("s"), F.col("e"))
    return spans(t).groupBy("user_id").agg(F.array_join(ordered_list(F.struct("s", "event_id"), one), ", ").alias("shown"))


@query("SELECT c_custkey, replace(c_custkey::VARCHAR, ',', '') || ', ' || replace(c_name, ',', '') || ', ' || replace(c_mktsegment, ',', '') AS line FROM customer")
def row_to_csv_text(t):
    return t.customer.select("c_custkey", C.csv_text(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("line"))


@query(f"SELECT event_id, user_id, unnest(range(CAST(round_even(s / 1000.0::DOUBLE * 5, 0) AS INTEGER), CAST(round_even(e / 1000.0::DOUBLE * 5, 0) AS INTEGER))) AS frame FROM {SPAN_SQL}")
def interval_frame_expand(t):
    return frames_of_intervals(spans(t), "s", "e", 5).select("event_id", "user_id", "frame")


@query(f"SELECT event_id, CAST(round_even(s / 1000.0::DOUBLE * 60, 0) AS INTEGER) AS first, CAST(round_even(e / 1000.0::DOUBLE * 60, 0) AS INTEGER) + 1 AS past FROM {SPAN_SQL}")
def interval_slice_fps(t):
    first, past = C.slice_frames(F.col("s"), F.col("e"), 60)
    return spans(t).select("event_id", first.alias("first"), past.alias("past"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN s > last THEN last - (e - s - 1) ELSE s END AS first, CASE WHEN s > last THEN last ELSE least(e, last) END AS past
  FROM (SELECT *, l_partkey % 60 AS s, l_partkey % 60 + CAST(trunc(l_quantity) AS INTEGER) AS e, 30 + l_suppkey % 20 AS last FROM lineitem)""")
def window_clamp(t):
    s = F.col("l_partkey") % 60
    first, past = C.clamp_window(s, s + F.col("l_quantity").cast("int"), 30 + F.col("l_suppkey") % 20)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", first.alias("first"), past.alias("past"))


@query("SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: round(x::DOUBLE / 255, 9))), 6) AS total FROM embeddings")
def tensor_rescale(t):
    scaled = F.transform("embedding", lambda x: F.round(x.cast("double") / 255, 9))
    return t.embeddings.select("vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("SELECT conv_id, turn, pos - 1 AS pos, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations)")
def explode_tokens_pos(t):
    return t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))


@query("""SELECT conv_id, turn, line_no - 1 AS line_no, generate_subscripts(string_split(line, ' '), 1) - 1 AS word_no, unnest(string_split(line, ' ')) AS word
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM conversations)""")
def explode_nested(t):
    lines = t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("conv_id", "turn", "line_no", F.posexplode(F.split("line", " ")).alias("word_no", "word"))


@query("""SELECT page_id, seg - 1 AS seg, part, 'download/' || part AS target
  FROM (SELECT page_id, unnest(string_split(url, '/')) AS part, generate_subscripts(string_split(url, '/'), 1) AS seg FROM pages) WHERE part <> ''""")
def segment_worklist(t):
    parts = t.pages.select("page_id", F.posexplode(F.split("url", "/")).alias("seg", "part")).filter("part != ''")
    return parts.select("page_id", "seg", "part", C.path_join(F.lit("download"), F.col("part")).alias("target"))
