"""Filters, sorts, limits, samples, unions, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from millrace.operators import aggregates as A
from millrace.operators import combine
from millrace.operators import keys as K
from millrace.operators import split as S
from millrace.operators.aggregates import ordered_list
from millrace.operators.corpus import corpus_index
from millrace.operators.shared import scratch
from millrace.plans.registry import query
from millrace.sources import files, schemas
from millrace.streaming.keylog import log_ids, read_keys


@query("SELECT o_custkey, o_orderpriority, o_orderkey FROM orders WHERE (o_custkey, o_orderpriority) IN (SELECT o_custkey, o_orderpriority FROM orders GROUP BY 1, 2 HAVING count(*) > 1)")
def filter_group_gt1(t):
    return A.of_group_size(t.orders, ["o_custkey", "o_orderpriority"], at_least=2).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT o_custkey, o_orderpriority, o_orderkey FROM orders WHERE (o_custkey, o_orderpriority) IN (SELECT o_custkey, o_orderpriority FROM orders GROUP BY 1, 2 HAVING count(*) = 1)")
def filter_group_singleton(t):
    return A.of_group_size(t.orders, ["o_custkey", "o_orderpriority"], at_most=1).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) <= 4)")
def filter_group_cap(t):
    return A.of_group_size(t.lineitem, ["l_orderkey"], at_most=4).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 4)")
def filter_group_over_cap(t):
    """The rows that the cap leaves out."""
    return A.of_group_size(t.lineitem, ["l_orderkey"], at_least=5).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag IS DISTINCT FROM l_linestatus")
def filter_mismatch(t):
    return t.lineitem.filter(~F.col("l_returnflag").eqNullSafe(F.col("l_linestatus"))).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_suppkey = 3")
def filter_composite_key(t):
    return t.lineitem.filter("l_returnflag = 'R' AND l_linestatus = 'F' AND l_suppkey = 3").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place FROM orders")
def sort_global(t):
    return K.dense_id(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "place").select("o_orderkey", "place")


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) - 1 AS place FROM customer")
def sort_multi_direction(t):
    return K.dense_id(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), [F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey")], "place").select("c_custkey", "place")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25")
def limit_n(t):
    return S.top_rows(t.orders, [F.asc("o_orderkey")], 25).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_rows(t):
    return S.top_rows(t.orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 20).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey FROM orders ORDER BY md5('7' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50")
def sample_fixed(t):
    return S.fixed_sample(t.orders.select("o_orderkey"), "o_orderkey", 50, "7")


@query("SELECT c_nationkey AS nation, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier")
def union_all(t):
    return t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))


@query("SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1")
def repartition_merge(t):
    return t.lineitem.repartition("l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey, o_custkey LIMIT 100")
def sql_limit(t):
    t.orders.createOrReplaceTempView("orders_view")
    return t.spark.sql("SELECT o_orderkey, o_custkey FROM orders_view ORDER BY o_orderkey, o_custkey LIMIT 100")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_roundtrip(t):
    path = scratch(t.spark, "csv")
    files.write_csv(t.customer, path)
    return files.read_csv(t.spark, path, t.customer.schema)


@query("SELECT c_custkey, c_name || ', \"ltd\"' AS name, c_nationkey FROM customer")
def sink_csv_roundtrip(t):
    path, src = scratch(t.spark, "csv"), t.customer.select("c_custkey", F.concat("c_name", F.lit(', "ltd"')).alias("name"), "c_nationkey")
    files.write_csv(src, path)
    return files.read_csv(t.spark, path, src.schema)


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def sink_csv_single(t):
    """One file for a small result: a row per status."""
    path, src = scratch(t.spark, "csv"), t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    files.write_csv(src, path, single=True)
    return files.read_csv(t.spark, path, src.schema)


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def sink_sorted_distinct(t):
    path = scratch(t.spark, "sorted")
    files.write_table(t.lineitem.select("l_suppkey", "l_returnflag"), path, ["l_suppkey", "l_returnflag"])
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def sink_idempotent(t):
    path = scratch(t.spark, "kept")
    files.write_table(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), path, ["o_orderkey"])
    files.write_table(t.orders.select("o_orderkey", "o_custkey"), path, ["o_orderkey"], mode="ignore")
    return t.spark.read.parquet(path)


@query("SELECT 'p' || page_id || url AS text FROM pages")
def scan_wholetext(t):
    path = scratch(t.spark, "texts")
    text = F.concat(F.lit("  p"), F.col("page_id").cast("string"), F.lit(" \n "), "url")
    files.write_documents(t.pages.select(F.concat(F.col("page_id").cast("string"), F.lit(".txt")).alias("filename"), text.alias("text")), path)
    return files.read_documents(t.spark, path).select("text")


@query("SELECT video, frame, frame_path FROM (SELECT 'v' || s_nationkey AS video, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS frame, '/frames/v' || s_nationkey || '/' || s_suppkey || '.jpg' AS frame_path FROM supplier)")
def frame_listing(t):
    """Frames by number within their video, from a listing of paths that the table gives."""
    return files.frames_of(t.supplier.select(F.concat(F.lit("/frames/v"), F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.lit(".jpg")).alias("path")))


@query("SELECT replace(replace(o_orderpriority || o_orderkey, '%', '%25'), ' ', '%20') AS target_video_filename, o_custkey % 100 AS perspective_cam_id, 'u/' || o_orderkey AS compressed_mov_url FROM orders")
def scan_video_index(t):
    """A video index under other headers: columns go by place, file names are quoted."""
    path, none = scratch(t.spark, "index"), F.lit("")
    src = t.orders.select(F.concat("o_orderpriority", F.col("o_orderkey").cast("string")).alias("Video file name"), F.lit(1).alias("Seq"), (F.col("o_custkey") % 100).cast("int").alias("Camera"), F.concat(F.lit("u/"), F.col("o_orderkey").cast("string")).alias("MOV"), none.alias("AVI"), none.alias("Mirror 1"), none.alias("Mirror 2"))
    files.write_csv(src, path)
    return files.read_video_index(t.spark, path).select("target_video_filename", "perspective_cam_id", "compressed_mov_url")


@query("SELECT row_number() OVER (ORDER BY c_name) - 1 AS TokenID, c_name AS Token FROM (SELECT DISTINCT c_name FROM customer)")
def scan_corpus_table(t):
    """A declared table by name, from CSV."""
    path = scratch(t.spark, "tables")
    files.write_csv(K.distinct_ids(t.customer.select(F.col("c_name").alias("Token")), ["Token"], "TokenID").select("TokenID", "Token"), f"{path}/vocabulary")
    return files.read_table(t.spark, path, "vocabulary", form="csv")


@query("SELECT 'vocabulary' AS name, count(DISTINCT c_name) AS n FROM customer UNION ALL SELECT 'corpus', count(*) FROM pages")
def scan_all_tables(t):
    """All declared tables, of which two hold rows here."""
    path = scratch(t.spark, "tables")
    rows = {"vocabulary": K.distinct_ids(t.customer.select(F.col("c_name").alias("Token")), ["Token"], "TokenID"), "corpus": corpus_index(t.pages, "url", "html")}
    for name in schemas.TABLES:
        want = schemas.schema(name)
        df = rows[name].select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want]) if name in rows else t.spark.createDataFrame([], want)
        files.write_table(df, f"{path}/{name}", schemas.key(name))
    sizes = [df.select(F.lit(name).alias("name")) for name, df in files.read_tables(t.spark, path).items()]
    return reduce(lambda a, b: a.unionByName(b), sizes).groupBy("name").agg(F.count("*").alias("n"))


@query("SELECT n_name, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sql_over_tables(t):
    """SQL over views of the tables."""
    for name in ("lineitem", "orders", "customer", "nation"):
        getattr(t, name).createOrReplaceTempView(name)
    return t.spark.sql("SELECT n_name, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, round(CAST(unnest(embedding) AS DOUBLE) / 255, 9) AS x FROM (SELECT * FROM embeddings ORDER BY md5('t' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 50)")
def sampled_tensors(t):
    """Fifty rows of an index at random, joined with their tensors, rescaled."""
    index = S.fixed_sample(t.embeddings.select("vec_id"), "vec_id", 50, "t")
    return t.embeddings.join(index, "vec_id", "left_semi").select("vec_id", F.posexplode(F.transform("embedding", lambda x: F.round(x.cast("double") / 255, 9))).alias("pos", "x"))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY md5('batch' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) // 32 AS batch FROM orders")
def batch_export(t):
    path = scratch(t.spark, "batches")
    files.write_batches(t.orders.select("o_orderkey"), path, "o_orderkey", 32, "batch")
    return t.spark.read.parquet(path).select("o_orderkey", "batch")


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('feed2' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS i FROM orders)
  SELECT i // 50 AS batch, count(*) AS n_rows, string_agg(o_orderkey, ',' ORDER BY i) AS keys, 1 AS n_files FROM o WHERE i // 50 >= 3 GROUP BY 1""")
def batch_feed(t):
    """The second epoch of a batch feed, resumed at its fourth batch: rows of each in order, all in one file."""
    path = scratch(t.spark, "feed")
    files.write_batches(t.orders.select("o_orderkey"), path, "o_orderkey", 50, "feed", epoch=2)
    rows = files.resume_batches(t.spark, path, 3).withColumn("file", F.col("_metadata.file_name"))
    return rows.groupBy("batch").agg(F.count("*").alias("n_rows"), F.array_join(ordered_list("place", F.col("o_orderkey").cast("string")), ",").alias("keys"), F.count_distinct("file").cast("int").alias("n_files"))


@query("""WITH v AS (SELECT DISTINCT user_id, CAST(epoch_us(ts) // 3600000000 AS BIGINT) AS h FROM events), g AS (SELECT *, h - row_number() OVER (PARTITION BY user_id ORDER BY h) AS island FROM v)
  SELECT user_id, min(h) AS first, max(h) AS last FROM g GROUP BY user_id, island""")
def combine_stretches(t):
    """Stretches of hours without a gap in which users were active, by a combiner of two phases."""
    hours = t.events.select("user_id", F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 3_600_000).alias("h"))
    found = combine.combined(hours, ["user_id"], ["h"], combine.Stretches(), "spans", combine.Stretches.schema)
    return found.select("user_id", F.inline("spans"))


@query("""WITH a AS (SELECT c_nationkey, c_mktsegment, min(c_custkey % 3) AS batch FROM customer GROUP BY 1, 2)
  SELECT c_nationkey, c_mktsegment, row_number() OVER (ORDER BY batch, c_nationkey, c_mktsegment) - 1 AS id FROM a""")
def key_log_stream(t):
    """Ids of values as they arrive in three batches of a stream, from the log of its keys."""
    path = scratch(t.spark, "keys")
    cols = ["c_nationkey", "c_mktsegment"]
    for n in range(3):
        t.customer.filter(F.col("c_custkey") % 3 == n).select(*cols).write.mode("append").parquet(f"{path}/in")
        log_ids(t.spark.readStream.schema(t.customer.select(*cols).schema).parquet(f"{path}/in"), cols, "id", f"{path}/log", f"{path}/state", buckets=8, compact=3).awaitTermination()
    return read_keys(t.spark, cols, "id", f"{path}/log")
