"""Filters, derived measures and joins (FP-1..FP-5, JN-1..JN-3) on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.operators.filters import (
    apply_filters, policy_filter, with_audit_columns, with_commission,
)
from cyclemart.operators.joins import (
    broadcast_join, COMMISSION_STAR, guard_plan, join, JoinError, JoinStep, sort_merge_join, StarJoin,
)
from cyclemart.plans.catalogue.base import CYCLE, _li, NOW, _orders, query, _transactions, _TX_WHERE
from cyclemart.session import scratch_path
from cyclemart.sources.bucketed import colocated_join, read_colocated, stage_colocated
from cyclemart.sources.tables import read_table


# ============================================================== filters (FP-1..FP-4)


@query("business_filter", f"SELECT * FROM lineitem WHERE {_TX_WHERE}")
def business_filter(spark, root):
    return _transactions(spark, root)


@query("membership_filter", "SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P')")
def membership_filter(spark, root):
    return policy_filter(_orders(spark, root), status_col="o_orderstatus", statuses=["O", "P"])


@query("declarative_filter",
       "SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'")
def declarative_filter(spark, root):
    return apply_filters(_li(spark, root), {"l_returnflag": ["A", "R"], "l_linestatus": "F"})


@query("commission", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_discount,
       l_extendedprice * l_discount AS commission_amount
FROM lineitem""")
def commission(spark, root):
    li = _li(spark, root).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                 "l_extendedprice", "l_discount")
    return with_commission(li, "l_extendedprice", "l_discount")


# ============================================================== joins (JN-1..JN-3)


@query("broadcast_join", """
SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus IN ('O', 'P')""")
def q_broadcast_join(spark, root):
    policies = membership_filter(spark, root).withColumnRenamed("o_orderkey", "l_orderkey")
    return broadcast_join(_li(spark, root), policies, "l_orderkey", "inner")


@query("sort_merge_join", """
SELECT l.*, s.s_name, s.s_nationkey, s.s_acctbal
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s
  ON l.l_suppkey = s.s_suppkey""")
def q_sort_merge_join(spark, root):
    sup = (read_table(spark, root, "supplier").filter(F.col("s_acctbal") > 0)
           .withColumnRenamed("s_suppkey", "l_suppkey"))
    return sort_merge_join(_li(spark, root), sup, ["l_suppkey"], "left")


@query("semi_join", f"""
SELECT * FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND {_TX_WHERE})""")
def semi_join(spark, root):
    keys = _transactions(spark, root).select(F.col("l_orderkey").alias("o_orderkey"))
    return broadcast_join(_orders(spark, root), keys, "o_orderkey", "left_semi")


@query("anti_join", f"""
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND {_TX_WHERE})""")
def anti_join(spark, root):
    keys = _transactions(spark, root).select(F.col("l_orderkey").alias("o_orderkey"))
    return broadcast_join(_orders(spark, root), keys, "o_orderkey", "left_anti")


def star_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six entities of the commission star, role-mapped onto the driver tables."""
    li = _li(spark, root)
    return {
        "transactions": _transactions(spark, root).select(
            F.col("l_orderkey").alias("policy_id"), F.col("l_linenumber").alias("ln"),
            F.col("l_partkey").alias("feature_id"), F.col("l_suppkey").alias("exchange_code"),
            F.col("l_extendedprice").alias("transaction_amount"),
            F.col("l_discount").alias("commission_rate")),
        "policy": membership_filter(spark, root).select(
            F.col("o_orderkey").alias("policy_id"), F.col("o_custkey").alias("agent_id")),
        "coverage": li.filter(F.col("l_quantity") > 45).select(
            F.col("l_orderkey").alias("policy_id"), F.col("l_linenumber").alias("coverage_id")).distinct(),
        "feature": read_table(spark, root, "part").select(
            F.col("p_partkey").alias("feature_id"), "p_brand"),
        "exchange": read_table(spark, root, "supplier").filter(F.col("s_acctbal") > 0).select(
            F.col("s_suppkey").alias("exchange_code"), "s_nationkey"),
        "rider": li.filter(F.col("l_tax") >= 0.08).select(
            F.col("l_orderkey").alias("policy_id"), F.col("l_linenumber").alias("rider_id")).distinct(),
    }


_STAR_SQL = """
WITH t AS (SELECT l_orderkey AS policy_id, l_linenumber AS ln, l_partkey AS feature_id,
                  l_suppkey AS exchange_code, l_extendedprice AS amt, l_discount AS rate
           FROM lineitem
           WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_extendedprice > 0),
     p AS (SELECT o_orderkey AS policy_id, o_custkey AS agent_id
           FROM orders WHERE o_orderstatus IN ('O', 'P')),
     c AS (SELECT DISTINCT l_orderkey AS policy_id, l_linenumber AS coverage_id
           FROM lineitem WHERE l_quantity > 45),
     f AS (SELECT p_partkey AS feature_id, p_brand FROM part),
     e AS (SELECT s_suppkey AS exchange_code, s_nationkey FROM supplier WHERE s_acctbal > 0),
     r AS (SELECT DISTINCT l_orderkey AS policy_id, l_linenumber AS rider_id
           FROM lineitem WHERE l_tax >= 0.08)
SELECT t.policy_id, ln, agent_id, coverage_id, rider_id, p_brand, s_nationkey,
       amt * rate AS commission_amount{extra}
FROM t JOIN p ON t.policy_id = p.policy_id
       LEFT JOIN c ON t.policy_id = c.policy_id
       LEFT JOIN f ON t.feature_id = f.feature_id
       LEFT JOIN e ON t.exchange_code = e.exchange_code
       LEFT JOIN r ON t.policy_id = r.policy_id"""


def star_fact(spark: SparkSession, root: str) -> DataFrame:
    joined = StarJoin("transactions", COMMISSION_STAR).apply(star_tables(spark, root))
    return with_commission(joined).select(
        "policy_id", "ln", "agent_id", "coverage_id", "rider_id", "p_brand", "s_nationkey",
        "commission_amount")


@query("star_join", _STAR_SQL.format(extra=""))
def star_join(spark, root):
    return star_fact(spark, root)


@query("commission_fact", _STAR_SQL.format(extra=f""",
       TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS dw_inserted_date,
       TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS dw_updated_date,
       '{CYCLE}' AS dw_cycle_date, TRUE AS dw_is_active"""))
def commission_fact(spark, root):
    """PL-3 shape: star join, commission, warehouse audit columns (FP-5)."""
    return with_audit_columns(star_fact(spark, root), CYCLE, NOW)


@query("join_guard", "SELECT n_name, r_name, 2 AS refused FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_guard(spark, root):
    """JN-4: a join without key columns and a cross join are refused, one by key runs."""
    nation = read_table(spark, root, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region, refused = read_table(spark, root, "region"), 0
    for on, how in (([], "inner"), ("r_regionkey", "cross")):
        try:
            join(nation, region, on, how)
        except JoinError:
            refused += 1
    return join(nation, region, "r_regionkey").select("n_name", "r_name", F.lit(refused).alias("refused"))


@query("hot_key_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(k AS BIGINT) AS s_suppkey, s.s_name
FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN 1 ELSE l_suppkey END AS k FROM lineitem) l LEFT JOIN supplier s ON k = s_suppkey""")
def hot_key_join(spark, root):
    """JN-2: half of the rows hold one key; the plan splits it whatever the session allows."""
    key = F.when(F.col("l_returnflag") == "N", F.lit(1)).otherwise(F.col("l_suppkey")).cast("long")
    lines = _li(spark, root).select("l_orderkey", "l_linenumber", "l_partkey", key.alias("s_suppkey"))
    names = read_table(spark, root, "supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name")
    return join(lines, names, "s_suppkey", "left", "split").select("l_orderkey", "l_linenumber", "l_partkey", "s_suppkey", "s_name")


@query("star_join_split", _STAR_SQL.format(extra=""))
def star_join_split(spark, root):
    """JN-3: the star by shuffle joins alone, hot policies split."""
    steps = [JoinStep(s.table, s.on, s.how, "merge") for s in COMMISSION_STAR]
    joined = StarJoin("transactions", steps, max_broadcast_bytes=0).apply(star_tables(spark, root))
    return with_commission(joined).select(
        "policy_id", "ln", "agent_id", "coverage_id", "rider_id", "p_brand", "s_nationkey", "commission_amount")


@query("plan_guard", "SELECT n_name, r_name, 2 AS refused FROM nation JOIN region ON n_regionkey = r_regionkey")
def plan_guard(spark, root):
    """JN-4 on the plan: conditions that simplify away are refused before an action, keyed ones
    run."""
    nation, region, refused = read_table(spark, root, "nation"), read_table(spark, root, "region"), 0
    for vanishing in (F.col("n_regionkey") == F.col("n_regionkey"), (F.col("n_regionkey") == F.col("r_regionkey")) | F.lit(True)):
        try:
            guard_plan(nation.join(region, vanishing))
        except JoinError:
            refused += 1
    keyed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return guard_plan(keyed).select("n_name", "r_name", F.lit(refused).alias("refused"))


@query("colocated_star", """
SELECT t.policy_id, t.ln, c.coverage_id, r.rider_id
FROM (SELECT l_orderkey AS policy_id, l_linenumber AS ln FROM lineitem
      WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_extendedprice > 0) t
     LEFT JOIN (SELECT DISTINCT l_orderkey AS policy_id, l_linenumber AS coverage_id FROM lineitem WHERE l_quantity > 45) c
       ON t.policy_id = c.policy_id
     LEFT JOIN (SELECT DISTINCT l_orderkey AS policy_id, l_linenumber AS rider_id FROM lineitem WHERE l_tax >= 0.08) r
       ON t.policy_id = r.policy_id""")
def colocated_star(spark, root):
    """JN-2: transactions, coverage and rider staged in buckets of the policy, joined where they
    lie."""
    path = scratch_path(spark, "colocated")
    tables = {t: df for t, df in star_tables(spark, root).items() if t in ("transactions", "coverage", "rider")}
    tables["transactions"] = tables["transactions"].select("policy_id", "ln")
    stage_colocated(tables, "transactions", "policy_id", path, CYCLE, 16)
    staged = {t: read_colocated(spark, path, t, CYCLE, df.schema, "policy_id", 16) for t, df in tables.items()}
    return colocated_join(staged, "transactions", "policy_id", [("coverage", "left"), ("rider", "left")])
