from pyspark.sql import functions as F

from cyclemart.operators.dedup import distinct_key_count, duplicate_keys, keep_first, latest_per_key
from tests.conftest import plan_text


def test_keep_first_desc_nulls_last_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, "r1"), ("a", 3, 5, "r2"), ("a", None, 99, "r3"), ("a", 3, 7, "r4"),
         ("b", None, 1, "r5"), (None, 2, 1, "r6"), (None, 4, 1, "r7")],
        "k string, v int, t int, row_num string")
    out = {r.k: r for r in keep_first(df, ["k"], "v", tie_breakers=["t"]).collect()}
    assert out["a"].row_num == "r4"  # v=3 twice, tie broken by t desc
    assert out["b"].row_num == "r5"  # only a NULL order value
    assert out[None].row_num == "r7"  # NULL key is one group
    assert "row_num" in keep_first(df, ["k"], "v").columns  # input column untouched


def test_keep_first_ascending_nulls_first(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 0)], "k string, v int")
    assert keep_first(df, ["k"], "v", ascending=True).first().v is None


def test_keep_first_has_partial_group_limit_below_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], "v")
    assert "WindowGroupLimit" in plan_text(out)
    assert sorted(r.v for r in out.collect()) == [997, 998, 999]


def test_duplicate_keys_and_distinct_count(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "x int, y string")
    assert sorted((r.x, r.cnt) for r in duplicate_keys(df, ["x", "y"]).collect()) == [(1, 2), (2, 2)]
    assert distinct_key_count(df, ["x", "y"]).first().distinct_keys == 3


def test_latest_per_key(spark):
    import datetime as dt
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("k", d1, "old"), ("k", d2, "new")], "id string, dw_updated_date timestamp, v string")
    assert latest_per_key(df, ["id"]).first().v == "new"
