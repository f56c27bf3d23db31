"""Aggregations, keys, windows and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import keys as K
from millrace.operators import split as S
from millrace.plans.registry import query


@query("SELECT DISTINCT * FROM (SELECT event_type, user_id, props FROM events)")
def distinct_rows(t):
    return t.events.select("event_type", "user_id", "props").distinct()


@query("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_projection(t):
    return t.lineitem.dropDuplicates(["l_orderkey", "l_suppkey"]).select("l_orderkey", "l_suppkey")


@query("SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS orders, count(*) AS n FROM orders GROUP BY 1")
def agg_collect_list(t):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("orders"), F.count("*").alias("n"))


@query("SELECT o_orderkey % 7 AS k, count(*) AS n, max(o_custkey) AS most FROM orders GROUP BY 1")
def agg_group_expr(t):
    return t.orders.groupBy((F.col("o_orderkey") % 7).alias("k")).agg(F.count("*").alias("n"), F.max("o_custkey").alias("most"))


@query("SELECT conv_id, turn, replace(text, chr(10), ' ') AS rebuilt FROM conversations")
def agg_ordered_list(t):
    words = t.conversations.select("conv_id", "turn", F.posexplode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("pos", "word"))
    return words.groupBy("conv_id", "turn").agg(F.array_join(A.ordered_list("pos", "word"), " ").alias("rebuilt"))


@query("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ';' ORDER BY l_linenumber, l_partkey::VARCHAR) AS parts FROM lineitem GROUP BY 1")
def agg_string_join_ordered(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(A.ordered_list("l_linenumber", F.col("l_partkey").cast("string")), ";").alias("parts"))


@query("SELECT max(length(text)) AS longest FROM documents")
def agg_global_max(t):
    return t.documents.agg(F.max(F.length("text")).cast("long").alias("longest"))


@query("SELECT CAST(sum(n_chars) AS BIGINT) AS chars, count(*) AS n FROM documents")
def agg_global_sum(t):
    return t.documents.agg(F.sum("n_chars").alias("chars"), F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM lineitem")
def agg_global_count(t):
    parts = t.lineitem.groupBy(F.spark_partition_id().alias("p")).count()
    return parts.agg(F.sum("count").alias("n"))


@query("""SELECT o_custkey, max(coalesce(TRY_CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS INTEGER), -1)) AS age, min(nullif(trim(o_orderstatus), '')) AS gender,
  count(DISTINCT o_orderpriority) AS n_ages, count(DISTINCT nullif(trim(o_orderstatus), '')) AS n_genders FROM orders GROUP BY 1""")
def agg_reconcile_attributes(t):
    return A.reconcile(t.orders, ["o_custkey"], "o_orderpriority", "o_orderstatus")


@query("SELECT c_mktsegment, c_nationkey, n, row_number() OVER (ORDER BY n DESC, c_mktsegment, c_nationkey) - 1 AS place FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2)")
def agg_count_desc(t):
    return K.dense_id(t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n")), [F.desc("n"), "c_mktsegment", "c_nationkey"], "place")


@query("""SELECT coalesce(a.k, b.k) AS k, coalesce(n_expected, 0) AS n_expected, coalesce(n_actual, 0) AS n_actual
  FROM (SELECT o_custkey AS k, CAST(sum(o_orderkey % 5) AS BIGINT) AS n_expected FROM orders GROUP BY 1) a FULL JOIN (SELECT l_suppkey AS k, count(*) AS n_actual FROM lineitem GROUP BY 1) b ON a.k = b.k
  WHERE coalesce(n_expected, 0) <> coalesce(n_actual, 0)""")
def agg_expected_vs_actual(t):
    return A.expected_vs_actual(t.orders.select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 5).alias("m")), t.lineitem.select(F.col("l_suppkey").alias("k")), ["k"], "m")


_WORDS = "(SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations))"


@query(f"SELECT word, row_number() OVER (ORDER BY word COLLATE C) - 1 AS id FROM {_WORDS}")
def key_dense_global(t):
    return K.distinct_ids(t.conversations.select(F.explode(F.split("text", " ")).alias("word")), ["word"], "id")


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders")
def key_position_in_group(t):
    return K.position(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], "pos")


@query("""WITH k AS (SELECT o_custkey AS key, row_number() OVER (ORDER BY o_custkey) - 1 AS id FROM (SELECT DISTINCT o_custkey FROM orders)),
  f AS (SELECT c_custkey AS key, (SELECT count(*) FROM k) + row_number() OVER (ORDER BY c_custkey) - 1 AS id FROM customer WHERE c_custkey NOT IN (SELECT key FROM k))
  SELECT * FROM k UNION ALL SELECT * FROM f""")
def key_incremental(t):
    known = K.distinct_ids(t.orders.select(F.col("o_custkey").alias("key")), ["key"], "id")
    return K.incremental_ids(known, t.customer.select(F.col("c_custkey").alias("key")), ["key"], "id")


_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM lineitem")
def window_running_offset(t):
    n = t.lineitem.withColumn("n", F.col("l_quantity").cast("long"))
    return A.running_offset(n, ["l_orderkey"], _ORDER.split(", "), "n", "off").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "off")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, unnest(range(off, off + n)) AS frame FROM (SELECT *, CAST(l_quantity AS BIGINT) % 4 AS n,
  CAST(coalesce(sum(CAST(l_quantity AS BIGINT) % 4) OVER (PARTITION BY l_orderkey ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM lineitem)""")
def stitch_frames(t):
    from millrace.operators.windows import stitch

    n = t.lineitem.withColumn("n", F.col("l_quantity").cast("long") % 4)
    return stitch(n, ["l_orderkey"], _ORDER.split(", "), "n").select("l_orderkey", "l_linenumber", "l_partkey", "frame")


_SPLIT = """(SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY md5(CAST(event_id AS VARCHAR)), event_id)
  <= CASE WHEN count(*) OVER (PARTITION BY event_type, user_id) > 9 THEN floor(count(*) OVER (PARTITION BY event_type, user_id) * CAST(0.1 AS DOUBLE)) ELSE 1 END THEN 'val' ELSE 'train' END AS split
  FROM (SELECT DISTINCT event_type, user_id, event_id FROM events))"""


def _split(t):
    return S.stratified_split(t.events.select("event_type", "user_id", "event_id").distinct(), ["event_type", "user_id"], "event_id")


@query(f"SELECT event_type, user_id, event_id, split FROM {_SPLIT}")
def split_stratified(t):
    return _split(t)


@query(f"SELECT event_type, user_id, event_id FROM {_SPLIT} WHERE split = 'train'")
def split_train_keys(t):
    return _split(t).filter("split = 'train'").drop("split")


@query(f"SELECT event_type, user_id, event_id FROM {_SPLIT} WHERE split = 'val'")
def split_val_keys(t):
    return _split(t).filter("split = 'val'").drop("split")
