"""Aggregates and keep-first windows (AG-1..AG-4, WN-1, WN-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclemart.operators.aggregates import commission_by_agent_policy, row_count
from cyclemart.operators.dedup import distinct_key_count, duplicate_keys, keep_first, latest_per_key
from cyclemart.plans.catalogue.base import _li, _orders, query


# ============================================================== aggregates, windows


@query("commission_by_agent_policy", """
SELECT l_suppkey AS agent_id, l_orderkey AS policy_id,
       SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4))) AS total_commission,
       COUNT(*) AS transaction_count
FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
GROUP BY l_suppkey, l_orderkey""")
def q_commission_by_agent_policy(spark, root):
    tx = _li(spark, root).filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    return commission_by_agent_policy(tx, "l_suppkey", "l_orderkey", "l_extendedprice",
                                      "l_discount").withColumnsRenamed(
        {"l_suppkey": "agent_id", "l_orderkey": "policy_id"})


@query("row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def q_row_count(spark, root):
    return row_count(_li(spark, root))


@query("distinct_keys", """
SELECT COUNT(*) AS distinct_keys FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d""")
def q_distinct_keys(spark, root):
    return distinct_key_count(_li(spark, root), ["l_orderkey", "l_linenumber"])


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, root):
    return duplicate_keys(_li(spark, root), ["l_orderkey", "l_linenumber"])


_DEDUP_TIES = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]


@query("deduplicate", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST,
             l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST,
             l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) d
WHERE rn = 1""")
def q_deduplicate(spark, root):
    return keep_first(_li(spark, root), ["l_orderkey", "l_linenumber"], "l_shipdate",
                      tie_breakers=_DEDUP_TIES)


@query("latest_version", """
WITH v AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS dw_updated_date FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice * 1.1, o_orderdate + INTERVAL 1 DAY
  FROM orders WHERE o_orderstatus = 'O')
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY dw_updated_date DESC NULLS LAST) AS rn
  FROM v) d WHERE rn = 1""")
def latest_version(spark, root):
    """WN-2: a table published twice for open orders keeps only the newer row per key."""
    o = _orders(spark, root)
    first = o.select("o_orderkey", "o_orderstatus", "o_totalprice",
                     F.col("o_orderdate").alias("dw_updated_date"))
    second = o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_orderstatus", (F.col("o_totalprice") * 1.1).alias("o_totalprice"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("dw_updated_date"))
    return latest_per_key(first.unionByName(second), ["o_orderkey"])
