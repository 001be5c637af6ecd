import datetime as dt
import json
import os

import pytest

from cyclemart.operators.quality import (
    QualityError, assert_no_failures, evaluate, evaluate_tables, report_frame, run_gate,
)
from cyclemart.session import local_path


def one(df):
    rows = [r.asDict() for r in df.collect()]
    assert len(rows) == 1
    return rows[0]


def test_not_null_golden(spark):
    df = spark.range(40).selectExpr("id", "if(id = 17, null, concat('c', id % 3)) AS batch")
    r = one(evaluate(df, "t", {"not_null": ["batch"]}))
    assert (r["passed"], r["failing_count"], r["details"]) == (False, 1, "1 null(s) found in 'batch'")


def test_no_duplicates_golden(spark):
    df = spark.range(30).selectExpr("concat('order-', least(id, 28)) AS number", "id DIV 29 * 0 AS line")
    r = one(evaluate(df, "t", {"no_duplicates": ["number", "line"]}))
    assert r["failing_count"] == 1 and r["column"] == "number,line"
    assert r["details"] == "1 duplicate row(s) on ['number', 'line']"


def test_no_duplicates_null_keys_group_together(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert one(evaluate(df, "t", {"no_duplicates": ["k"]}))["failing_count"] == 1


def test_positive_values_golden(spark):
    df = spark.createDataFrame([(x,) for x in (-0.0, 3.25, None, -7e9, float("nan"), 1e-9)], "price double")
    r = one(evaluate(df, "t", {"positive_values": ["price"]}))
    assert r["failing_count"] == 2 and r["details"] == "2 non-positive value(s) in 'price'"


def test_allowed_values_golden(spark):
    df = spark.range(9).selectExpr("element_at(array('north', 'south', 'up', null, 'north', 'south', 'south', null, 'north'), int(id) + 1) AS side")
    r = one(evaluate(df, "t", {"allowed_values": {"side": ["north", "south"]}}))
    assert r["failing_count"] == 1
    assert r["details"] == "1 value(s) outside ['north', 'south'] in 'side'"


def test_min_row_count_empty_table(spark):
    df = spark.createDataFrame([], "height int, width int")
    r = one(evaluate(df, "t", {"min_row_count": 1}))
    assert (r["passed"], r["failing_count"], r["column"], r["details"]) == (False, 1, None, "Row count 0 < minimum 1")
    ok = one(evaluate(df, "t", {"min_row_count": 0}))
    assert ok["passed"] and ok["details"] == "Row count 0 OK"


def test_rule_set_order_and_three_failures(spark):
    df = spark.range(12).selectExpr("nullif(id, 4) AS ticket", "if(id = 9, -1, id + 1) AS seats", "if(id = 2, 'x', 'a') AS hall")
    rules = {"min_row_count": 12, "allowed_values": {"hall": ["a", "b"]}, "positive_values": ["seats"],
             "not_null": ["ticket"], "no_duplicates": ["ticket"]}
    rows = [r.asDict() for r in evaluate_tables({"t": df}, {"t": rules}).collect()]
    assert [r["rule"] for r in rows] == ["not_null", "no_duplicates", "positive_values",
                                         "allowed_values", "min_row_count"]
    assert sum(not r["passed"] for r in rows) == 3
    with pytest.raises(QualityError, match=r"^3 DQ check\(s\) failed: t/not_null/ticket: 1 null"):
        assert_no_failures(rows)


def test_empty_rules_are_skipped_and_missing_table_raises(spark):
    df = spark.createDataFrame([("a",)], "k string")
    out = evaluate_tables({"a": df, "b": df}, {"a": {"not_null": ["k"], "positive_values": []}})
    assert out.count() == 1
    with pytest.raises(KeyError):
        evaluate_tables({"a": df}, {"a": {"not_null": ["k"]}}, expected=["a", "b"])


def test_gate_writes_report_before_raising(spark, scratch):
    df = spark.createDataFrame([(None,)], "k string")
    path = scratch("report")
    with pytest.raises(QualityError):
        run_gate(spark, {"a": df}, {"a": {"not_null": ["k"], "min_row_count": 1}}, path,
                 "20240101", dt.datetime(2024, 1, 2))
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".json")]
    report = json.loads(open(os.path.join(local_path(path), files[0])).read())
    assert (report["total_checks"], report["passed"], report["failed"]) == (2, 1, 1)
    assert report["cycle_date"] == "20240101" and report["results"][0]["rule"] == "not_null"


def test_report_frame(spark):
    df = spark.createDataFrame([("x",), ("y",)], "k string")
    rep = one(report_frame(evaluate_tables({"a": df}, {"a": {"not_null": ["k"], "min_row_count": 5}})))
    assert (rep["total_checks"], rep["passed"], rep["failed"]) == (2, 1, 1)
    assert [r["rule"] for r in rep["results"]] == ["not_null", "min_row_count"]


def test_allowed_values_empty_set_fails_every_row(spark):
    df = spark.createDataFrame([("A",), (None,)], "s string")
    r = one(evaluate(df, "t", {"allowed_values": {"s": []}}))
    assert r["failing_count"] == 2 and r["details"] == "2 value(s) outside [] in 's'"


def test_int_flag_and_string_table_values(spark):
    df = spark.createDataFrame([(1, "x"), (0, "y"), (None, "z")], "flag int, s string")
    rows = [r.asDict() for r in evaluate_tables({"t": df}, {"t": {
        "not_null": ["flag", "s"], "allowed_values": {"flag": [0, 1]}}}).collect()]
    assert [(r["rule"], r["column"], r["failing_count"]) for r in rows] == [
        ("not_null", "flag", 1), ("not_null", "s", 0), ("allowed_values", "flag", 0)]


def test_gate_without_any_rules_passes_with_empty_report(spark, scratch):
    df = spark.createDataFrame([("a",)], "k string")
    path = scratch("empty-report")
    assert run_gate(spark, {"a": df}, {}, path, "20240101", dt.datetime(2024, 1, 2)) == []
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".json")]
    report = json.loads(open(os.path.join(local_path(path), files[0])).read())
    assert (report["total_checks"], report["passed"], report["failed"]) == (0, 0, 0)


def test_one_scan_for_row_rules_and_key_rules(spark, scratch):
    path = scratch("scans")
    df = spark.range(500).selectExpr("id % 100 AS a", "id % 7 AS b", "if(id % 50 = 0, null, id) AS c", "'x' AS unused")
    df.write.parquet(path)
    rules = {"not_null": ["c", "a"], "no_duplicates": [["a"], ["b", "a"], ["c"], ["a", "b"]], "positive_values": ["a"],
             "allowed_values": {"b": [0, 1, 2]}, "min_row_count": 501}
    out = evaluate(spark.read.parquet(path), "t", rules)
    plan = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and "unused" not in plan and "partial_count" in plan
    got = [(r.rule, r.column, r.failing_count) for r in out.collect()]
    pairs = len({(i % 100, i % 7) for i in range(500)})
    assert got == [("not_null", "c", 10), ("not_null", "a", 0), ("no_duplicates", "a", 400), ("no_duplicates", "b,a", 500 - pairs),
                   ("no_duplicates", "c", 9), ("no_duplicates", "a,b", 500 - pairs), ("positive_values", "a", 5),
                   ("allowed_values", "b", sum(i % 7 > 2 for i in range(500))), ("min_row_count", None, 1)]


def test_key_rules_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = evaluate(df, "t", {"not_null": ["a"], "no_duplicates": ["a", "b"], "min_row_count": 2}).collect()
    assert [(r.rule, r.failing_count, r.passed) for r in rows] == [
        ("not_null", 0, True), ("no_duplicates", 0, True), ("min_row_count", 2, False)]
