import datetime as dt

from pyspark.sql import functions as F

from cyclemart.operators.audit import (
    audit_entries, batch_summary, cycle_completeness, empty_audit_table, expire, parse_arrivals,
    update_status, upsert_audit,
)
from cyclemart.schemas import EXPECTED_FILE_TYPES

T1, T2, NOW = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 2)


def arrivals(spark, rows):
    return spark.createDataFrame(rows, "object_key string, length long, modificationTime timestamp")


def test_parse_object_key(spark):
    df = arrivals(spark, [("raw/transactions/cycle_20240101/transactions.csv", 10, T1),
                          ("raw/transactions", 1, T1)])
    rows = parse_arrivals(df).collect()
    assert len(rows) == 1
    assert (rows[0].file_type, rows[0].cycle_date, rows[0].file_name) == ("transactions", "20240101", "transactions.csv")


def test_audit_entry_fields_and_rearrival(spark):
    df = arrivals(spark, [("raw/policy/cycle_20240101/p.csv.pgp", None, T1),
                          ("raw/policy/cycle_20240101/p.csv.pgp", 42, T2)])
    e = audit_entries(df, now=NOW, bucket="test-bucket").collect()
    assert len(e) == 1
    r = e[0]
    assert r.file_key == "test-bucket#raw/policy/cycle_20240101/p.csv.pgp" and r.file_size == 42
    assert r.status == "RECEIVED" and r.ingestion_timestamp == r.created_at == r.updated_at == NOW
    first = audit_entries(df.limit(1), now=T1, bucket="b")
    audit = upsert_audit(empty_audit_table(spark), first)
    again = upsert_audit(audit, audit_entries(df, now=NOW, bucket="b"))
    rows = again.collect()
    assert len(rows) == 1 and rows[0].created_at == NOW


def test_status_update_and_unknown_key(spark):
    df = arrivals(spark, [("raw/policy/cycle_20240101/p.csv", 1, T1)])
    audit = audit_entries(df, now=T1, bucket="b")
    upd = spark.createDataFrame([("b#raw/policy/cycle_20240101/p.csv", "20240101"), ("b#other", "20240101")],
                                "file_key string, cycle_date string")
    out = {r.file_key: r for r in update_status(audit, upd, status="PROCESSING", now=NOW).collect()}
    assert out["b#raw/policy/cycle_20240101/p.csv"].status == "PROCESSING"
    assert out["b#raw/policy/cycle_20240101/p.csv"].updated_at == NOW
    assert out["b#raw/policy/cycle_20240101/p.csv"].created_at == T1
    assert out["b#other"].bucket is None and out["b#other"].status == "PROCESSING"


def test_cycle_completeness(spark):
    rows = [(f"raw/{t}/cycle_20240101/{t}.csv", 1, T1) for t in EXPECTED_FILE_TYPES]
    rows += [(f"raw/{t}/cycle_20240102/{t}.csv", 1, T1) for t in EXPECTED_FILE_TYPES[:5]]
    rows += [("raw/extra/cycle_20240102/x.csv", 1, T1)]
    audit = audit_entries(arrivals(spark, rows), now=NOW, bucket="b")
    out = {r.cycle_date: r for r in cycle_completeness(audit, EXPECTED_FILE_TYPES).collect()}
    assert out["20240101"].is_complete and out["20240101"].missing_types == []
    assert not out["20240102"].is_complete and out["20240102"].missing_types == ["rider"]


def test_batch_summary_and_expiry(spark):
    df = arrivals(spark, [("raw/a/cycle_1/x", 1, T1), ("bad", 1, T1)])
    s = batch_summary(df).collect()
    assert len(s) == 1 and s[0].status == "AUDITED" and s[0].type == "a"
    audit = audit_entries(df, now=F.col("modificationTime"), bucket="b")
    assert expire(audit, dt.datetime(2024, 3, 1)).count() == 1
    assert expire(audit, dt.datetime(2024, 6, 1)).count() == 0


def test_repeated_updates_and_wrong_statuses(spark):
    import pytest
    from cyclemart.operators.merge import MergeError

    audit = audit_entries(arrivals(spark, [("raw/policy/cycle_20240101/p.csv", 1, T1)]), now=T1, bucket="b")
    key = "b#raw/policy/cycle_20240101/p.csv"
    updates = spark.createDataFrame([(key, "20240101", "SUCCESS", 2), (key, "20240101", "PROCESSING", 1)],
                                    "file_key string, cycle_date string, status string, n int")
    rows = update_status(audit, updates, now=NOW, order_by="n").collect()
    assert [(r.file_key, r.status) for r in rows] == [(key, "SUCCESS")]
    with pytest.raises(MergeError):
        update_status(audit, updates, now=NOW)  # they disagree and have no order
    assert update_status(audit, updates.filter("n = 1").union(updates.filter("n = 1")), now=NOW).count() == 1
    for wrong in ("NOPE", None):
        bad = spark.createDataFrame([(key, "20240101", wrong)], "file_key string, cycle_date string, status string")
        with pytest.raises(Exception, match="status is not one of"):
            update_status(audit, bad, now=NOW).collect()


def test_entries_of_one_key_without_an_order(spark):
    df = spark.createDataFrame([("raw/policy/cycle_1/p", 5), ("raw/policy/cycle_1/p", 9)], "object_key string, length long")
    rows = audit_entries(df, now=NOW, bucket="b").collect()
    assert [r.file_size for r in rows] == [9]
