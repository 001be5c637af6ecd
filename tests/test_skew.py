"""A key holding a third of the fact rows is split across tasks, by the plan itself (in any
session), or by AQE, even through the star join's shared ``policy_id`` partitioning."""

import statistics

import pytest

from pyspark.sql import functions as F

from cyclemart.operators.dedup import keep_first
from cyclemart.operators.joins import JoinStep, StarJoin, join
from cyclemart.operators.quality import evaluate
from cyclemart.operators.skew import heavy_keys, split_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def hot_fact(spark, n=200_000):
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 2000).cast("string")).alias("policy_id"))


def test_hot_policy_is_split_in_every_star_join(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        keys = spark.range(2000).select(F.col("id").cast("string").alias("policy_id")).union(
            spark.range(1).select(F.lit("HOT").alias("policy_id")))
        tables = {"transactions": hot_fact(spark), "policy": keys,
                  "coverage": keys.select("policy_id", F.lit("C1").alias("coverage_id")),
                  "rider": keys.select("policy_id", F.lit("R1").alias("rider_id"))}
        steps = [JoinStep("policy", "policy_id", "inner"), JoinStep("coverage", "policy_id", "left"),
                 JoinStep("rider", "policy_id", "left")]
        out = StarJoin("transactions", steps, max_broadcast_bytes=0, split_hot_keys=False).apply(tables)
        rows = out.collect()
        assert len(rows) == 200_000
        final = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        assert final.count("SortMergeJoin(skew=true)") == 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_dedup_and_duplicate_rule_stay_partial(spark):
    fact = hot_fact(spark, 30_000)
    plan = keep_first(fact, ["policy_id"], "transaction_id")._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "WindowGroupLimit" in plan
    dq = evaluate(fact, "t", {"no_duplicates": ["policy_id"]})
    assert dq.first().failing_count == 30_000 - fact.select("policy_id").distinct().count()
    assert "partial_count" in dq._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


@pytest.fixture
def plain(spark):
    """A session that others built: no adaptive execution, no broadcasts."""
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    other.conf.set("spark.sql.shuffle.partitions", "16")
    return other


def _tables(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("policy_id")).union(
        spark.range(1).select(F.lit("HOT").alias("policy_id")))
    return {"transactions": hot_fact(spark), "policy": keys,
            "coverage": keys.select("policy_id", F.explode(F.array(F.lit("C1"), F.lit("C2"))).alias("coverage_id")),
            "rider": keys.filter("policy_id != '7'").select("policy_id", F.lit("R1").alias("rider_id"))}


STEPS = [JoinStep("policy", "policy_id", "inner"), JoinStep("coverage", "policy_id", "left"), JoinStep("rider", "policy_id", "left")]


def test_hot_policy_is_split_without_adaptive_execution(plain):
    tables = _tables(plain)
    out = StarJoin("transactions", STEPS, max_broadcast_bytes=0).apply(tables)
    assert out.columns == ["policy_id", "transaction_id", "coverage_id", "rider_id"]
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 16 and sum(per_task) == 400_000
    assert max(per_task) <= 2 * statistics.median(per_task)
    whole = StarJoin("transactions", STEPS, max_broadcast_bytes=0, split_hot_keys=False).apply(tables)
    before = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert max(before) > 4 * statistics.median(before)  # what splitting mends
    assert out.exceptAll(whole).isEmpty() and whole.exceptAll(out).isEmpty()


def test_all_joins_on_a_key_share_one_salted_partitioning(plain):
    out = StarJoin("transactions", STEPS, max_broadcast_bytes=0).apply(_tables(plain))
    plan = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count("Exchange hashpartitioning") == 4  # the fact once, each dimension once


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_joins_give_the_same_rows(plain, how):
    left = plain.createDataFrame([(None if i % 5 == 0 else 1 if i % 3 else i % 50, "k", i % 400) for i in range(3000)], "a int, b string, v int")
    right = plain.createDataFrame([(i % 40 if i % 7 else None, "k" if i % 2 else None, i) for i in range(300)], "a int, b string, w int")
    assert heavy_keys(left, ["a", "b"], 16) is not None
    got, want = split_join(left, right, ["a", "b"], how), left.join(right, ["a", "b"], how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_nothing_is_split_without_heavy_keys(plain):
    even = plain.range(20_000).selectExpr("id % 5000 AS k", "id AS v")
    assert heavy_keys(even, ["k"], 16) is None
    assert heavy_keys(even.limit(0), ["k"], 16) is None
    plan = join(even, even.select("k").distinct(), "k", "inner", "split")._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "salt" not in plan
    with pytest.raises(ValueError, match="full"):
        split_join(even, even, ["k"], "full")
