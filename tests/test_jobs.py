import datetime as dt
import os

import pytest

from cyclemart.operators.merge import VersionedTable
from cyclemart.operators.quality import QualityError
from cyclemart.plans.jobs import FACT_KEYS, RejectedRows, cycle_trigger, ingest_cycle, run_cycle
from cyclemart.session import local_path
from cyclemart.sources.encrypted import encrypt_text

KEY = "0123456789abcdef"
FILES = {
    "transactions": ("transaction_id,cycle_date,policy_id,transaction_amount,transaction_status,"
                     "is_commission_eligible,agent_id,commission_rate,exchange_code,feature_id\n"
                     "T1,{c},P1,100.0,SUCCESS,1,A1,0.1,USD,F1\n"
                     "T2,{c},P2,200.0,SUCCESS,1,A1,0.2,EUR,F1\n"
                     "T3,{c},P1,50.0,FAILED,1,A2,0.1,USD,F1\n"
                     "T4,{c},P3,70.0,SUCCESS,1,A2,0.1,USD,F2\n"),
    "policy": "policy_id,policy_status\nP1,ACTIVE\nP2,RENEWAL\nP3,LAPSED\n",
    "coverage": "coverage_id,policy_id\nC1,P1\nC2,P1\n",
    "feature": "feature_id,feature_name\nF1,basic\n",
    "exchange": "exchange_id,exchange_code,exchange_rate\nX1,USD,1.0\nX2,EUR,1.1\n",
    "rider": "rider_id,policy_id\nR1,P2\n",
}


def land_cycle(landing, cycle, overrides=None, encrypted=False, spark=None):
    for t, text in {**FILES, **(overrides or {})}.items():
        path = os.path.join(local_path(landing), "raw", t, f"cycle_{cycle}", f"{t}.csv.pgp")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        body = text.format(c=cycle)
        with open(path, "wb") as f:
            f.write(encrypt_text(spark, body, KEY) if encrypted else body.encode())


@pytest.mark.parametrize("encrypted", [False, True])
def test_run_cycle_end_to_end(spark, scratch, encrypted):
    landing, staged, reports, fact = (scratch(n) for n in ("landing", "staged", "reports", "fact"))
    land_cycle(landing, "20240101", encrypted=encrypted, spark=spark)
    now = dt.datetime(2024, 1, 2)
    run = run_cycle(spark, landing, staged, reports, fact, "20240101", now, KEY,
                    "files" if encrypted else "none", layout="versions")
    assert run.files == {t: 1 for t in FILES}
    assert all(r["passed"] for r in run.quality) and len(run.quality) == 25
    assert run.merge.initialised and run.merge.version == 1
    rows = VersionedTable(spark, fact).read().collect()
    # T1 fans out over 2 coverages; T2 has 1 rider; T3 failed; T4's policy is lapsed.
    assert sorted((r.transaction_id, r.coverage_id, r.rider_id) for r in rows) == [
        ("T1", "C1", None), ("T1", "C2", None), ("T2", None, "R1")]
    t2 = [r for r in rows if r.transaction_id == "T2"][0]
    assert abs(t2.commission_amount - 40.0) < 1e-9 and t2.exchange_rate == 1.1
    assert t2.dw_cycle_date == "20240101" and t2.dw_updated_by == "initial_load"


def test_second_cycle_merges_and_gate_stops_bad_cycle(spark, scratch):
    landing, staged, reports, fact = (scratch(n) for n in ("landing", "staged", "reports", "fact"))
    land_cycle(landing, "20240101")
    run_cycle(spark, landing, staged, reports, fact, "20240101", dt.datetime(2024, 1, 2), layout="versions")
    land_cycle(landing, "20240102")
    second = run_cycle(spark, landing, staged, reports, fact, "20240102", dt.datetime(2024, 1, 3),
                       layout="versions")
    assert second.merge.version == 2 and second.merge.counts == {"inserted": 3, "updated": 0, "kept": 3}
    table = VersionedTable(spark, fact, ["dw_cycle_date"])
    assert table.read().count() == 6 and second.merge.integrity_ok
    assert len(FACT_KEYS) == 4
    bad = FILES["transactions"] + "T1,{c},P1,-5.0,SUCCESS,1,A1,0.1,USD,F1\n"
    land_cycle(landing, "20240103", {"transactions": bad})
    with pytest.raises(QualityError, match="transactions/no_duplicates"):
        run_cycle(spark, landing, staged, reports, fact, "20240103", dt.datetime(2024, 1, 4),
                  layout="versions")
    assert os.path.isdir(os.path.join(local_path(reports), "20240103"))
    assert table.latest() == 2


def test_partition_layout_rewrites_only_the_cycle(spark, scratch):
    landing, staged, reports, fact = (scratch(n) for n in ("landing", "staged", "reports", "fact"))
    summary = scratch("summary")
    for i, cycle in enumerate(["20240101", "20240102"]):
        land_cycle(landing, cycle)
        run = run_cycle(spark, landing, staged, reports, fact, cycle, dt.datetime(2024, 1, 2 + i),
                        summary_root=summary)
    assert run.merge.counts == {"inserted": 3, "updated": 0, "kept": 0}
    from cyclemart.operators.merge import PartitionedTable
    rows = PartitionedTable(spark, fact, "dw_cycle_date").read().collect()
    assert len(rows) == 6 and {r.dw_cycle_date for r in rows} == {"20240101", "20240102"}
    # AG-4 before the fan-out: T1 counts once although it fans out over two coverages.
    s = {(str(r.cycle_date), r.agent_id, r.policy_id): r for r in spark.read.parquet(summary).collect()}
    assert len(s) == 4 and s[("20240101", "A1", "P1")].transaction_count == 1  # P3 is lapsed
    assert float(s[("20240101", "A1", "P1")].total_commission) == 10.0


def test_stream_triggers_cycle_job_once_complete(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable
    from cyclemart.schemas import EXPECTED_FILE_TYPES
    from cyclemart.streaming.arrivals import arrival_stream, completed_cycles, emit_once, run_available_foreach

    landing, staged, reports, fact, ckpt = (scratch(n) for n in ("landing", "staged", "reports", "fact", "ckpt"))
    handler = cycle_trigger(landing, staged, reports, fact, now=lambda: dt.datetime(2024, 1, 5),
                            key=KEY, encryption="files")

    def run():
        done = completed_cycles(arrival_stream(spark, landing), EXPECTED_FILE_TYPES)
        run_available_foreach(done, emit_once(f"{ckpt}/emitted", handler), f"{ckpt}/stream", "update")
        table = PartitionedTable(spark, fact, "dw_cycle_date")
        if not table.exists():
            return {}
        return {str(r.dw_cycle_date): r.n for r in
                table.read().groupBy("dw_cycle_date").count().withColumnRenamed("count", "n").collect()}

    land_cycle(landing, "20240101", encrypted=True, spark=spark)
    partial = {t: v for t, v in FILES.items() if t != "rider"}
    for t, text in partial.items():  # second cycle: five of six types
        path = os.path.join(local_path(landing), "raw", t, "cycle_20240102", f"{t}.csv.pgp")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(encrypt_text(spark, text.format(c="20240102"), KEY))
    assert run() == {"20240101": 3}
    land_cycle(landing, "20240102", {}, encrypted=True, spark=spark)  # rider arrives (others rewritten)
    assert run() == {"20240101": 3, "20240102": 3}
    assert run() == {"20240101": 3, "20240102": 3}  # nothing new: no second run


def test_one_bad_cycle_does_not_stop_the_others(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable

    landing, staged, reports, fact = (scratch(n) for n in ("landing", "staged", "reports", "fact"))
    land_cycle(landing, "20240101", {"transactions": FILES["transactions"] + "T1,{c},P1,-5.0,SUCCESS,1,A1,0.1,USD,F1\n"})
    land_cycle(landing, "20240102")
    batch = spark.createDataFrame([("20240101",), ("20240102",)], "cycle_date string").coalesce(1)
    cycle_trigger(landing, staged, reports, fact, now=lambda: dt.datetime(2024, 1, 5))(batch, 0)
    assert [r.dw_cycle_date for r in PartitionedTable(spark, fact, "dw_cycle_date").read().select("dw_cycle_date").distinct().collect()] == ["20240102"]
    failed = spark.read.json(f"{reports}/failed/20240101").first()
    assert failed.cycle_date == 20240101 or failed.cycle_date == "20240101"
    assert failed.error == "QualityError" and "no_duplicates" in failed.message


def test_a_wrong_key_raises_and_leaves_nothing_staged(spark, scratch):
    landing, staged = scratch("landing"), scratch("staged")
    land_cycle(landing, "20240101", encrypted=True, spark=spark)
    good = ingest_cycle(spark, landing, staged, "20240101", dt.datetime(2024, 1, 2), KEY, "files")
    assert good.files == {t: 1 for t in FILES} and not good.rejected
    with pytest.raises(RejectedRows):
        ingest_cycle(spark, landing, staged, "20240101", dt.datetime(2024, 1, 2), "another-key-1234", "files")
    assert not os.path.exists(os.path.join(local_path(staged), "policy", "cycle_date=20240101"))


def test_the_clock_of_the_jobs_is_the_same_in_any_zone(spark):
    from cyclemart.functions.timeutil import instant
    from cyclemart.streaming.arrivals import utc_now

    now = utc_now()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = spark.range(1).select(instant(now).cast("double")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(seconds - now.timestamp()) < 0.001


def test_a_second_run_of_a_cycle_only_updates(spark, scratch):
    landing, staged, reports, fact = (scratch(n) for n in ("landing", "staged", "reports", "fact"))
    land_cycle(landing, "20240101")
    for day in (2, 3):
        run = run_cycle(spark, landing, staged, reports, fact, "20240101", dt.datetime(2024, 1, day))
    assert run.merge.counts == {"inserted": 0, "updated": 3, "kept": 0} and run.merge.integrity_ok
