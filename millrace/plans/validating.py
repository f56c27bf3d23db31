"""Validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import validate as V
from millrace.plans.registry import query


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_values FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1")
def validate_unique_parent(t):
    return V.not_unique(t.orders, ["o_custkey"], ["o_orderstatus"])


@query("SELECT p_brand, count(DISTINCT p_type) AS n_values FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def validate_lookup_unique(t):
    return V.not_unique(t.part, ["p_brand"], ["p_type"])


_RULES_SQL = "CASE WHEN NOT coalesce(l_quantity >= 2, false) THEN 'quantity' ELSE '' END"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_RULES_SQL} AS errors, CASE WHEN NOT (l_discount < 0.05) THEN 'discount' ELSE '' END AS warnings FROM lineitem")
def validate_severity(t):
    rules = [V.Rule("quantity", F.col("l_quantity") >= 2), V.Rule("discount", F.col("l_discount") < 0.05, fatal=False)]
    return V.checked(t.lineitem, rules).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "errors", "warnings")


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 AND c_name <> '' AND c_nationkey >= 0")
def validate_columns(t):
    rules = [V.Rule("balance", F.col("c_acctbal") >= 0), V.Rule("name", F.col("c_name") != ""), V.Rule("nation", F.col("c_nationkey") >= 0)]
    valid, _ = V.validate(t.customer, rules)
    return valid.select("c_custkey", "c_name")


@query("""SELECT page_id, generate_subscripts(string_split(url, '/'), 1) - 1 AS seg, unnest(string_split(url, '/')) AS part FROM pages
  WHERE url IN (SELECT url FROM pages GROUP BY 1 HAVING count(*) = 1)""")
def validate_then_expand(t):
    single = t.pages.groupBy("url").agg(F.count("*").alias("n")).filter("n = 1").select("url")
    return t.pages.join(single, "url", "left_semi").select("page_id", F.posexplode(F.split("url", "/")).alias("seg", "part"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def validate_duplicate_ids(t):
    return V.duplicate_ids(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def validate_fk(t):
    ref = t.customer.filter("c_mktsegment != 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    return V.dangling(t.orders, ref, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderstatus = 'F' AND NOT (o_totalprice > 100000)
  UNION ALL SELECT o_orderkey, o_orderstatus, 'right' FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice > 100000""")
def compare_tables(t):
    cols = ["o_orderkey", "o_orderstatus"]
    return V.differences(t.orders.filter("o_orderstatus = 'F'").select(*cols), t.orders.filter("o_totalprice > 100000").select(*cols))
