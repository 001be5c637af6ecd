"""Staged tables joined where they lie."""

import statistics

import pytest
from pyspark.sql import functions as F

from cyclemart.sources.bucketed import SALT, colocated_join, read_colocated, stage_colocated


@pytest.fixture
def plain(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return other


def _tables(spark, hot):
    n = 60_000
    policy = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit("HOT")).otherwise((F.col("id") % 700).cast("string"))
    keys = spark.range(700).select(F.col("id").cast("string").alias("policy_id")).union(spark.range(1).select(F.lit("HOT")))
    return {"transactions": spark.range(n).select(F.col("id").alias("tx"), policy.alias("policy_id")),
            "coverage": keys.select("policy_id", F.explode(F.array(F.lit("C1"), F.lit("C2"))).alias("coverage_id")),
            "rider": keys.filter("policy_id != '5'").select("policy_id", F.lit("R").alias("rider_id"))}


@pytest.mark.parametrize("hot", [False, True])
def test_no_exchange_on_either_side(plain, scratch, hot):
    root, tables = scratch("colocated"), _tables(plain, hot)
    before = {t.name for t in plain.catalog.listTables()}
    stage_colocated(tables, "transactions", "policy_id", root, "20240101", 8)
    staged = {t: read_colocated(plain, root, t, "20240101", df.schema, "policy_id", 8) for t, df in tables.items()}
    assert {t.name for t in plain.catalog.listTables()} == before  # nothing is left in the catalog
    out = colocated_join(staged, "transactions", "policy_id", [("coverage", "left"), ("rider", "left")])
    plan = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    want = tables["transactions"].join(tables["coverage"], "policy_id", "left").join(tables["rider"], "policy_id", "left")
    assert out.columns == want.columns
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()
    per_task = [r["count"] for r in staged["transactions"].join(staged["rider"].hint("merge"), ["policy_id", SALT], "left")
                .groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 8 and max(per_task) <= 2 * statistics.median(per_task)


def test_staging_again_replaces_the_cycle(plain, scratch):
    root, tables = scratch("again"), _tables(plain, False)
    for rows in (tables["transactions"], tables["transactions"].limit(10), tables["transactions"].limit(0)):
        stage_colocated({"transactions": rows}, "transactions", "policy_id", root, "20240101", 4)
        assert read_colocated(plain, root, "transactions", "20240101", rows.schema, "policy_id", 4).count() == rows.count()
