"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.plans.expressions import SPAN_SQL, spans
from millrace.plans.registry import query


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    return J.lookup(t.orders.withColumnRenamed("o_custkey", "c_custkey"), t.customer, ["c_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def join_three_way(t):
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return J.lookup(J.lookup(t.lineitem, o, ["l_orderkey"]), t.customer, ["c_custkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "c_name")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1)")
def join_validated(t):
    keys = t.lineitem.select("l_orderkey", "l_linenumber")
    dim = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    good, _ = J.validated(keys, dim, ["l_orderkey", "l_linenumber"])
    return good


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber, l_suppkey) IN (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_returnflag = 'R')")
def join_semi_multi_key(t):
    on = ["l_orderkey", "l_linenumber", "l_suppkey"]
    return J.having(t.lineitem, t.lineitem.filter("l_returnflag = 'R'"), on).select(*on, "l_quantity")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def join_exists(t):
    found, _, _ = J.existence(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])
    return found.select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_anti_left(t):
    _, missing, _ = J.existence(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])
    return missing.select("o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def join_anti_right(t):
    done = t.orders.filter("o_orderstatus = 'F'")
    _, _, extra = J.existence(done, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])
    return extra.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_partkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def join_semi_broadcast(t):
    keys = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))  # at most the 25 nations; AQE broadcasts what is small
    return J.having(t.customer, keys, ["c_nationkey"]).select("c_custkey", "c_name")


@query("SELECT a.conv_id, a.turn AS said, b.turn AS answered FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id WHERE a.role = 'user' AND b.role = 'assistant'")
def join_many_to_many(t):
    said = t.conversations.filter("role = 'user'").select("conv_id", F.col("turn").alias("said"))
    return said.join(t.conversations.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("answered")), "conv_id")


@query(f"""SELECT event_id, frame FROM (SELECT event_id, unnest(range(CAST(round_even(s / 1000.0::DOUBLE * 5, 0) AS INTEGER), CAST(round_even(e / 1000.0::DOUBLE * 5, 0) AS INTEGER))) AS frame FROM {SPAN_SQL})
  WHERE frame IN (SELECT (o_orderkey % 86400) * 5 + o_custkey % 5 FROM orders)""")
def interval_frame_join(t):
    frames = t.orders.select(((F.col("o_orderkey") % 86400) * 5 + F.col("o_custkey") % 5).cast("int").alias("frame"))
    return J.having(J.frames_of_intervals(spans(t), "s", "e", 5), frames, ["frame"]).select("event_id", "frame")


_DAY = "(SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + 86400 AS e FROM events)"


def _pairs(t, mode):
    s = F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 1000)
    one = lambda kind, p: t.events.filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(f"{p}_id"), s.alias(f"{p}_s"), (s + 86400).alias(f"{p}_e"))
    return J.overlap_join(one("click", "a"), one("error", "b"), ["user_id"], ("a_s", "a_e"), ("b_s", "b_e"), 86400, mode).select("user_id", "a_id", "b_id")


@query(f"SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM {_DAY} a JOIN {_DAY} b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'error' AND ((a.s >= b.s AND a.s < b.e) OR (a.e > b.s AND a.e <= b.e))")
def interval_join_reference(t):
    return _pairs(t, "reference")


@query(f"SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id FROM {_DAY} a JOIN {_DAY} b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'error' AND a.s < b.e AND b.s < a.e")
def interval_join_any(t):
    return _pairs(t, "any_overlap")


@query("SELECT l_orderkey, string_agg(p_brand, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, p_brand) AS brands FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")
def join_lookup_sequence(t):
    from millrace.operators.aggregates import ordered_list

    named = J.lookup(t.lineitem, t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), ["l_partkey"])
    return named.groupBy("l_orderkey").agg(F.array_join(ordered_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"), "p_brand"), " ").alias("brands"))


@query("SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name IS NOT NULL")
def join_lookup(t):
    return J.lookup(t.supplier, t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), ["s_nationkey"]).select("s_suppkey", "s_name", "n_name")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag IN ('N', 'R'))")
def division_all_in_set(t):
    return J.all_in_set(t.lineitem, ["l_orderkey"], F.col("l_returnflag").isin("N", "R"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%')")
def join_disjoint_check(t):
    return t.orders.filter("o_orderstatus = 'F'").select("o_orderkey").join(t.orders.filter("o_orderpriority LIKE '1%'").select("o_orderkey"), "o_orderkey")


@query("SELECT (SELECT max(o_orderkey) FROM orders) AS last_order, (SELECT max(c_custkey) FROM customer) AS last_customer")
def join_cross_scalar(t):
    return t.orders.agg(F.max("o_orderkey").alias("last_order")).crossJoin(t.customer.agg(F.max("c_custkey").alias("last_customer")))
