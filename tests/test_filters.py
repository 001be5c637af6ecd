from pyspark.sql import functions as F

from cyclemart.operators.filters import (
    apply_filters, policy_filter, transaction_filter, with_audit_columns, with_commission,
)

TX_SCHEMA = ("transaction_id string, policy_id string, transaction_amount double, "
             "transaction_status string, is_commission_eligible int")
TX_ROWS = [
    ("T001", "P001", 1000.0, "SUCCESS", 1),
    ("T002", "P002", 2000.0, "SUCCESS", 1),
    ("T003", "P003", 500.0, "FAILED", 0),
    ("T004", "P001", 1500.0, "SUCCESS", 1),
]


def tx(spark):
    return spark.createDataFrame(TX_ROWS, TX_SCHEMA)


def test_golden_filter_counts(spark):
    df = tx(spark)
    assert apply_filters(df, {"transaction_status": "SUCCESS"}).count() == 3
    assert apply_filters(df, {"is_commission_eligible": 1}).count() == 3
    assert df.filter(F.col("transaction_amount") > 0).count() == 4
    assert transaction_filter(df).count() == 3
    assert df.filter(F.col("transaction_amount") > 10000).count() == 0


def test_declarative_filter_edge_cases(spark):
    df = tx(spark)
    assert apply_filters(df, {}).count() == 4
    assert apply_filters(df, {"policy_id": []}).count() == 0
    assert apply_filters(df, {"policy_id": None}).count() == 0
    assert apply_filters(df, {"policy_id": ["P001", "P003"], "transaction_status": "SUCCESS"}).count() == 2


def test_transaction_filter_nulls_nan_and_boolean_flag(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "SUCCESS", True), ("b", None, "SUCCESS", True), ("c", 2.0, None, True),
         ("d", 3.0, "SUCCESS", None), ("e", float("nan"), "SUCCESS", True), ("f", 0.0, "SUCCESS", True)],
        "transaction_id string, transaction_amount double, transaction_status string, "
        "is_commission_eligible boolean")
    kept = {r.transaction_id for r in transaction_filter(df).collect()}
    assert kept == {"a", "e"}  # NaN is greater than every number in Spark


def test_policy_filter(spark):
    df = spark.createDataFrame([("P1", "ACTIVE"), ("P2", "RENEWAL"), ("P3", "LAPSED"), ("P4", None)],
                               "policy_id string, policy_status string")
    assert sorted(r.policy_id for r in policy_filter(df).collect()) == ["P1", "P2"]


def test_commission_and_audit_columns(spark):
    import datetime as dt
    df = spark.createDataFrame([(100.0, 0.1), (None, 0.2)], "transaction_amount double, commission_rate double")
    out = with_audit_columns(with_commission(df), "20240101", dt.datetime(2024, 1, 2)).collect()
    assert abs(out[0].commission_amount - 10.0) < 1e-9 and out[1].commission_amount is None
    assert out[0].dw_inserted_date == out[0].dw_updated_date == dt.datetime(2024, 1, 2)
    assert out[0].dw_cycle_date == "20240101" and out[0].dw_is_active is True
