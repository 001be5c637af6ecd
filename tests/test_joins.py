import pytest
from pyspark.sql import functions as F

from cyclemart.operators.joins import (
    JoinError, JoinStep, StarJoin, broadcast_join, estimated_size_bytes, join, sort_merge_join,
)
from tests.conftest import plan_text, sized


def frames(spark):
    left = sized(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, lv string")
    right = sized(spark, [(1, "x"), (1, "y"), (2, "z")], "k int, rv string")
    return left, right


def test_broadcast_join_plan_and_rows(spark):
    left, right = frames(spark)
    out = broadcast_join(left, right, "k", "inner")
    assert "BroadcastHashJoin" in plan_text(out)
    assert sorted((r.k, r.rv) for r in out.collect()) == [(1, "x"), (1, "y"), (2, "z")]
    assert out.columns == ["k", "lv", "rv"]


def test_broadcast_refused_above_bound_falls_back(spark):
    left, right = frames(spark)
    assert estimated_size_bytes(right) > 0
    out = broadcast_join(left, right, "k", "left", max_broadcast_bytes=1)
    assert out.count() == 5  # result unchanged, only the hint is withheld


def test_sort_merge_join_types(spark):
    left, right = frames(spark)
    for how, n in [("inner", 3), ("left", 5), ("right", 3), ("full", 5), ("left_semi", 2), ("left_anti", 2)]:
        out = sort_merge_join(left, right, ["k"], how)
        assert "SortMergeJoin" in plan_text(out), how
        assert out.count() == n, how


def test_join_without_condition_is_refused(spark):
    left, right = frames(spark)
    with pytest.raises(JoinError):
        join(left, right, [], "inner")
    with pytest.raises(JoinError):
        join(left, right, None, "cross")


def test_star_join_skips_absent_dimension_and_fans_out(spark):
    tx = sized(spark, [("T1", "P1", "F1"), ("T2", "P2", "F9")], "transaction_id string, policy_id string, feature_id string")
    policy = sized(spark, [("P1", "ACTIVE"), ("P2", "ACTIVE")], "policy_id string, policy_status string")
    coverage = sized(spark, [("C1", "P1"), ("C2", "P1")], "coverage_id string, policy_id string")
    rider = sized(spark, [("R1", "P1"), ("R2", "P1")], "rider_id string, policy_id string")
    steps = [JoinStep("policy", "policy_id", "inner", "broadcast"),
             JoinStep("coverage", "policy_id", "left", "broadcast"),
             JoinStep("feature", "feature_id", "left", "broadcast"),
             JoinStep("rider", "policy_id", "left", "broadcast")]
    out = StarJoin("transactions", steps).apply(
        {"transactions": tx, "policy": policy, "coverage": coverage, "rider": rider})
    rows = out.collect()
    assert len([r for r in rows if r.transaction_id == "T1"]) == 4  # 2 coverages x 2 riders
    t2 = [r for r in rows if r.transaction_id == "T2"]
    assert len(t2) == 1 and t2[0].coverage_id is None and t2[0].rider_id is None
    with pytest.raises(ValueError):
        StarJoin("transactions", steps).apply({"policy": policy})


def test_star_join_drops_provenance_and_handles_clashes(spark):
    tx = sized(spark, [("T1", "P1", "20240101", "x")], "transaction_id string, policy_id string, cycle_date string, note string")
    policy = sized(spark, [("P1", "20240101", "y")], "policy_id string, cycle_date string, note string")
    steps = [JoinStep("policy", "policy_id", "inner")]
    with pytest.raises(JoinError):
        StarJoin("transactions", steps).apply({"transactions": tx, "policy": policy})
    out = StarJoin("transactions", steps, clash="prefix").apply({"transactions": tx, "policy": policy})
    assert out.columns == ["policy_id", "transaction_id", "cycle_date", "note", "policy_note"]


def test_star_join_edge_rows(spark):
    tx = sized(spark, [("T1", "P1", "F1", "USD"), ("T2", "P9", "F1", "USD"), ("T3", "P1", "F1", "ZZZ")],
               "transaction_id string, policy_id string, feature_id string, exchange_code string")
    policy = sized(spark, [("P1", "ACTIVE")], "policy_id string, policy_status string")
    exchange = sized(spark, [("X1", "USD", 1.0)], "exchange_id string, exchange_code string, exchange_rate double")
    coverage = sized(spark, [], "coverage_id string, policy_id string")  # empty dimension
    steps = [JoinStep("policy", "policy_id", "inner"), JoinStep("exchange", "exchange_code", "left"),
             JoinStep("coverage", "policy_id", "left")]
    rows = {r.transaction_id: r for r in StarJoin("transactions", steps).apply(
        {"transactions": tx, "policy": policy, "exchange": exchange, "coverage": coverage}).collect()}
    assert set(rows) == {"T1", "T3"}  # T2 has no policy: dropped by the inner join
    assert rows["T1"].exchange_rate == 1.0 and rows["T3"].exchange_rate is None  # unknown code
    assert rows["T1"].coverage_id is None


def test_guard_on_the_plan(spark):
    from cyclemart.operators.joins import guard_plan

    a = spark.range(100).selectExpr("id AS k", "id % 3 AS x")
    b = spark.range(50).selectExpr("id AS k2", "id % 5 AS y")
    keyed = a.join(b, F.col("k") == F.col("k2"))
    assert guard_plan(keyed) is keyed and guard_plan(a.join(b.hint("merge"), (F.col("k") == F.col("k2")) & (F.col("x") < F.col("y")), "left"))
    for condition in (F.col("k") == F.col("k"), F.lit(1) == F.lit(1), F.col("x") < F.col("y"), (F.col("k") == F.col("k2")) | F.lit(True)):
        for how in ("inner", "left"):
            with pytest.raises(JoinError, match="without keys"):
                guard_plan(a.join(b, condition, how).groupBy("x").count())
    with pytest.raises(JoinError):
        guard_plan(a.crossJoin(b))
    hidden = a.filter(F.col("x") == a.join(b).agg(F.count("*")).scalar())  # in a subquery
    with pytest.raises(JoinError):
        guard_plan(hidden)


def test_broadcast_is_bounded_by_rows_and_the_drivers_heap(spark, scratch, monkeypatch):
    """Runs and dictionaries store many rows in few bytes; the driver hashes every row."""
    from cyclemart.operators import joins
    from cyclemart.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, fits_broadcast

    path = scratch("policies")
    spark.range(0, 200_000, numPartitions=1).selectExpr(
        "CAST(id DIV 100 AS STRING) AS policy_id", "'C1' AS coverage_id").write.parquet(path)
    many = spark.read.parquet(path)
    assert estimated_size_bytes(many) * joins.BROADCAST_INFLATION < 8_000_000
    assert not fits_broadcast(many, 8_000_000)
    assert fits_broadcast(many.limit(1000), 8_000_000)
    monkeypatch.setattr(joins, "DRIVER_PART", 1 + joins._driver_bytes(many) * joins.DRIVER_PART // 8_000_000)
    assert not fits_broadcast(many, DEFAULT_MAX_BROADCAST_BYTES)
    tx = sized(spark, [("T1", "7"), ("T2", "7"), ("T3", "9999")], "transaction_id string, policy_id string")
    star = StarJoin("transactions", [JoinStep("coverage", "policy_id", "left", "broadcast")], split_hot_keys=False).apply(
        {"transactions": tx, "coverage": many})
    for out in (join(tx, many, "policy_id", "left", "broadcast"), star):
        assert "BroadcastHashJoin" not in plan_text(out)  # nor by the planner's own estimate
        assert out.count() == 201
    assert "BroadcastHashJoin" in plan_text(join(tx, many.limit(1000), "policy_id", "left", "broadcast"))
