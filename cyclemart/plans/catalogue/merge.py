"""SCD Type 1 merge, initial load and the two publish layouts (MG-1..MG-5, IO-7, IO-9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cyclemart.functions.timeutil import instant
from cyclemart.operators.filters import with_audit_columns
from cyclemart.operators.merge import (
    initial_load, integrity_ok, merge_counts, merge_or_init, MergeError, PartitionedTable, scd1_merge, VersionedTable,
)
from cyclemart.plans.catalogue.base import (
    CYCLE, INIT_CYCLE, MERGE_TARGET_UNTIL, MERGE_UPDATE_FROM, NOW, _orders, query, T_INIT,
)
from cyclemart.session import scratch_path


# ============================================================== SCD Type 1 merge (MG-*)

_MERGE_SQL = f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_TARGET_UNTIL} 00:00:00'),
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.1 AS o_totalprice,
                  o_orderdate,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_UPDATE_FROM} 00:00:00')
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END
         AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN 'updated'
            WHEN s.o_orderkey IS NOT NULL THEN 'inserted' ELSE 'kept' END AS merge_action
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""


def _merge_inputs(spark, root):
    o = _orders(spark, root)
    target = o.filter(F.col("o_orderdate") < F.lit(MERGE_TARGET_UNTIL).cast("timestamp_ntz"))
    source = o.filter(F.col("o_orderdate") >= F.lit(MERGE_UPDATE_FROM).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") * 1.1).alias("o_totalprice"), "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
         .alias("o_orderpriority"))
    return target, source


@query("scd1_merge", _MERGE_SQL)
def q_scd1_merge(spark, root):
    """MG-1 + MG-5: upsert a delta of orders; NULLs in the source overwrite."""
    target, source = _merge_inputs(spark, root)
    return scd1_merge(target, source, ["o_orderkey"], with_action=True, on_duplicate="trust",
                      strategy="full")


@query("scd1_merge_broadcast", _MERGE_SQL)
def q_scd1_merge_broadcast(spark, root):
    """Same upsert through the small-delta plan (size-checked broadcast of the source)."""
    target, source = _merge_inputs(spark, root)
    return scd1_merge(target, source, ["o_orderkey"], with_action=True, on_duplicate="trust",
                      strategy="auto")


@query("merge_counts", f"""
SELECT merge_action, CAST(COUNT(*) AS BIGINT) AS rows FROM ({_MERGE_SQL}) GROUP BY merge_action""")
def q_merge_counts(spark, root):
    """MG-5: rows per action; the counts that a publishing merge observes must be the same."""
    target, source = _merge_inputs(spark, root)
    counts = merge_counts(scd1_merge(target, source, ["o_orderkey"], with_action=True))
    table = VersionedTable(spark, scratch_path(spark, "merge-counts"))
    merge_or_init(table, target, ["o_orderkey"], audit_columns=False, materialize_source=False)
    seen = merge_or_init(table, source, ["o_orderkey"], audit_columns=False, materialize_source=False).counts
    observed = F.create_map(*[F.lit(x) for pair in seen.items() for x in pair])
    return counts.select("merge_action", F.when(observed[F.col("merge_action")] == F.col("rows"), F.col("rows")).alias("rows"))


@query("merge_integrity", f"""
SELECT 'one delta row per key' AS delta, TRUE AS published, TRUE AS intact,
       CAST((SELECT COUNT(*) FROM ({_MERGE_SQL})) AS BIGINT) AS rows
UNION ALL SELECT 'a key twice', FALSE, TRUE, (SELECT COUNT(*) FROM ({_MERGE_SQL}))
UNION ALL SELECT 'table with a key twice', TRUE, FALSE, 2 * (SELECT COUNT(*) FROM ({_MERGE_SQL}))""")
def q_merge_integrity(spark, root):
    """MG-3: a merge leaves every key once, a delta that repeats a key is refused, and a
    table that repeats one is found."""
    target, source = _merge_inputs(spark, root)
    keys = ["o_orderkey"]
    table = VersionedTable(spark, scratch_path(spark, "merge-integrity"))
    merge_or_init(table, target, keys, audit_columns=False, materialize_source=False)
    ok = merge_or_init(table, source, keys, audit_columns=False, materialize_source=False).integrity_ok
    try:
        merge_or_init(table, source.unionByName(source), keys, audit_columns=False, materialize_source=False)
        refused = False
    except MergeError:
        refused = True
    rows, twice = table.read(), table.read().unionByName(table.read())

    def line(delta: str, published: bool, intact: bool, df):
        return df.agg(F.count("*").alias("rows")).select(
            F.lit(delta).alias("delta"), F.lit(published).alias("published"), F.lit(intact).alias("intact"), "rows")

    return (line("one delta row per key", True, bool(ok), rows)
            .unionByName(line("a key twice", not refused, integrity_ok(rows, keys), rows))
            .unionByName(line("table with a key twice", True, integrity_ok(twice, keys), twice)))


@query("initial_load", f"""
SELECT *, TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS dw_inserted_date,
       TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS dw_updated_date,
       'initial_load' AS dw_updated_by, TRUE AS dw_is_active, '{CYCLE}' AS dw_cycle_date
FROM orders""")
def q_initial_load(spark, root):
    """MG-2: audit columns of a first publication."""
    return initial_load(_orders(spark, root), NOW, CYCLE)


# ---------------------------------------------------------- versioned publish (MG-4, IO-9)


def _published_orders(spark: SparkSession, root: str) -> VersionedTable:
    """Publish the target as version 1, then merge the audited delta as version 2."""
    target, source = _merge_inputs(spark, root)
    table = VersionedTable(spark, scratch_path(spark, "orders-published"), ["dw_cycle_date"])
    merge_or_init(table, target, ["o_orderkey"], now=T_INIT, cycle_date=INIT_CYCLE, materialize_source=False)
    # The delta is a plain filtered scan: cheaper to re-read than to checkpoint.
    merge_or_init(table, with_audit_columns(source, CYCLE, NOW), ["o_orderkey"], now=NOW,
                  on_duplicate="trust", materialize_source=False)
    return table


_PUBLISHED_T = f"""
t AS (SELECT *, TIMESTAMP '{T_INIT:%Y-%m-%d %H:%M:%S}' AS dw_inserted_date,
             TIMESTAMP '{T_INIT:%Y-%m-%d %H:%M:%S}' AS dw_updated_date,
             'initial_load' AS dw_updated_by, TRUE AS dw_is_active, '{INIT_CYCLE}' AS dw_cycle_date
      FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_TARGET_UNTIL} 00:00:00')"""


@query("versioned_merge", f"""
WITH {_PUBLISHED_T},
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.1 AS o_totalprice,
                  o_orderdate,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_UPDATE_FROM} 00:00:00')
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END
         AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.dw_inserted_date
            ELSE TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' END AS dw_inserted_date,
       CASE WHEN s.o_orderkey IS NOT NULL THEN TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'
            ELSE t.dw_updated_date END AS dw_updated_date,
       CASE WHEN s.o_orderkey IS NOT NULL THEN 'glue_job' ELSE t.dw_updated_by END AS dw_updated_by,
       CASE WHEN s.o_orderkey IS NOT NULL THEN TRUE ELSE t.dw_is_active END AS dw_is_active,
       CASE WHEN s.o_orderkey IS NOT NULL THEN '{CYCLE}' ELSE t.dw_cycle_date END AS dw_cycle_date
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""")
def q_versioned_merge(spark, root):
    """MG-4: initialise, then merge into a new immutable version; read the latest."""
    return _published_orders(spark, root).read()


@query("time_travel", f"WITH {_PUBLISHED_T}\nSELECT * FROM t")
def q_time_travel(spark, root):
    """IO-9: read the first published version after a later merge."""
    return _published_orders(spark, root).read(1)


@query("published_cycle", f"""
SELECT o_orderkey, o_totalprice * 1.1 AS o_totalprice, 'glue_job' AS dw_updated_by FROM orders
WHERE o_orderdate >= TIMESTAMP '{MERGE_UPDATE_FROM} 00:00:00'""")
def q_published_cycle(spark, root):
    """IO-7 on a published table: one cycle's partition of the latest version."""
    latest = _published_orders(spark, root).read()
    rows = latest.where(F.col("dw_cycle_date") == F.lit(CYCLE))
    return rows.select("o_orderkey", "o_totalprice", "dw_updated_by")


@query("partition_merge", f"""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS order_month, o_totalprice, o_orderpriority
           FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_TARGET_UNTIL} 00:00:00'),
     s AS (SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS order_month,
                  o_totalprice * 1.1 AS o_totalprice,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_UPDATE_FROM} 00:00:00')
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       COALESCE(t.order_month, s.order_month) AS order_month,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END
         AS o_orderpriority,
       CASE WHEN s.o_orderkey IS NOT NULL THEN 'glue_job' ELSE 'initial_load' END AS dw_updated_by,
       CASE WHEN t.o_orderkey IS NOT NULL THEN TIMESTAMP '{T_INIT:%Y-%m-%d %H:%M:%S}'
            ELSE TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' END AS dw_inserted_date
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey AND t.order_month = s.order_month""")
def q_partition_merge(spark, root):
    """MG-4 in place: only the months the delta names are read, merged and replaced."""
    o = _orders(spark, root)
    month = F.date_format("o_orderdate", "yyyyMM").alias("order_month")
    target = o.filter(F.col("o_orderdate") < F.lit(MERGE_TARGET_UNTIL).cast("timestamp_ntz")).select(
        "o_orderkey", month, "o_totalprice", "o_orderpriority")
    delta = o.filter(F.col("o_orderdate") >= F.lit(MERGE_UPDATE_FROM).cast("timestamp_ntz")).select(
        "o_orderkey", month, (F.col("o_totalprice") * 1.1).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
         .alias("o_orderpriority"))
    table = PartitionedTable(spark, scratch_path(spark, "orders-by-month"), "order_month")
    table.merge_or_init(target, ["o_orderkey", "order_month"], now=T_INIT, materialize_source=False)
    table.merge_or_init(delta, ["o_orderkey", "order_month"], now=NOW, on_duplicate="trust",
                        materialize_source=False)
    return table.read().select("o_orderkey", "order_month", "o_totalprice", "o_orderpriority",
                               "dw_updated_by", "dw_inserted_date")


@query("as_of_read", f"""
WITH {_PUBLISHED_T}
SELECT moment, CAST(n AS BIGINT) AS rows, CAST(updated AS BIGINT) AS updated
FROM (VALUES ('before the first', 0, 0)) v(moment, n, updated)
UNION ALL SELECT 'between', COUNT(*), 0 FROM t
UNION ALL SELECT 'after the last', (SELECT COUNT(*) FROM ({_MERGE_SQL})),
       (SELECT COUNT(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_UPDATE_FROM} 00:00:00')""")
def q_as_of_read(spark, root):
    """IO-9: the table as it was at an instant, between two publications and around them."""
    table = _published_orders(spark, root)
    moments = {"before the first": T_INIT - dt.timedelta(seconds=1), "between": NOW - dt.timedelta(seconds=1), "after the last": NOW}
    out = None
    for name, at in moments.items():
        version = table.version_as_of(at)
        rows = table.read(version) if version is not None else table.read().limit(0)
        line = rows.agg(F.count("*").alias("rows"), F.count_if(F.col("dw_updated_by") != "initial_load").alias("updated")).select(
            F.lit(name).alias("moment"), "rows", "updated")
        out = line if out is None else out.unionByName(line)
    return out


@query("published_repair", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS order_month, o_totalprice FROM orders""")
def q_published_repair(spark, root):
    """WN-2: a table that was published with older copies of the finished orders, repaired in
    the partitions that hold them."""
    o = _orders(spark, root).select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("order_month"), "o_totalprice", "o_orderstatus")
    older = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(-1.0)).withColumn("dw_updated_date", instant(T_INIT))
    table = PartitionedTable(spark, scratch_path(spark, "repaired"), "order_month")
    table._publish(o.withColumn("dw_updated_date", instant(NOW)).unionByName(older))  # noqa: SLF001 - past the key check
    table.repair(["o_orderkey", "order_month"])
    return table.read().select("o_orderkey", "order_month", "o_totalprice")
