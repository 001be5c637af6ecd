import datetime as dt
import os

from pyspark.sql import functions as F

from cyclemart.operators.audit import expire_published
from cyclemart.operators.merge import PartitionedTable
from cyclemart.schemas import EXPECTED_FILE_TYPES
from cyclemart.session import local_path
from cyclemart.streaming.alarms import default_alarms, window_alarm
from cyclemart.streaming.arrivals import (
    arrival_stream, audit_sink, completed_cycles, dedupe_within_watermark, emit_once,
    reconcile_arrivals, run_available, run_available_foreach,
)
from tests.conftest import plan_text


def land(root, rel, text="x"):
    path = os.path.join(local_path(root), rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_cycle_emitted_exactly_once_across_restarts(spark, scratch):
    landing, work = scratch("landing"), scratch("stream")
    for t in EXPECTED_FILE_TYPES:
        land(landing, f"raw/{t}/cycle_20240101/{t}.csv.pgp")
    for t in EXPECTED_FILE_TYPES[:5]:
        land(landing, f"raw/{t}/cycle_20240102/{t}.csv.pgp")
    land(landing, "raw/notes/cycle_20240102/readme.txt")

    def run():
        done = completed_cycles(arrival_stream(spark, landing), EXPECTED_FILE_TYPES)
        run_available_foreach(done, emit_once(f"{work}/out"), f"{work}/ckpt", "update")
        return sorted(r.cycle_date for r in spark.read.parquet(f"{work}/out").collect())

    assert run() == ["20240101"]
    assert run() == ["20240101"]  # plain restart: nothing new
    land(landing, "raw/rider/cycle_20240102/rider.csv.pgp")
    assert run() == ["20240101", "20240102"]
    land(landing, "raw/policy/cycle_20240101/policy_again.csv.pgp")
    assert run() == ["20240101", "20240102"]  # extra file of a finished cycle


def test_a_hot_cycle_is_folded_before_the_shuffle(spark):
    rows = [(f"raw/policy/cycle_20240101/{i}.csv", dt.datetime(2024, 1, 1)) for i in range(50)]
    arrivals = spark.createDataFrame(rows, "object_key string, modificationTime timestamp")
    text = plan_text(completed_cycles(arrivals, EXPECTED_FILE_TYPES))
    assert "partial_bit_or" in text and "Python" not in text and "Pandas" not in text


def test_a_failed_handler_gets_its_cycles_again(spark, scratch):
    landing, work = scratch("landing"), scratch("again")
    for t in EXPECTED_FILE_TYPES:
        land(landing, f"raw/{t}/cycle_20240101/{t}.csv.pgp")
    done = completed_cycles(arrival_stream(spark, landing), EXPECTED_FILE_TYPES)
    calls = []

    def handler(batch, batch_id):
        calls.append([r.cycle_date for r in batch.collect()])
        if len(calls) == 1:
            raise RuntimeError("down")

    for _ in range(3):
        try:
            run_available_foreach(done, emit_once(f"{work}/out", handler), f"{work}/ckpt", "update")
        except Exception:  # noqa: BLE001 - the stream fails as its handler does
            pass
    assert calls == [["20240101"], ["20240101"]]


def test_audit_stream_upserts_and_restarts_on_a_new_checkpoint(spark, scratch):
    landing, work = scratch("landing"), scratch("audit")
    land(landing, "raw/policy/cycle_20240101/policy.csv.pgp", "abc")
    land(landing, "raw/bad.csv.pgp")
    table = PartitionedTable(spark, f"{work}/audit", "cycle_date")
    sink = audit_sink(table, "landing", now=lambda: dt.datetime(2024, 1, 2))
    run_available_foreach(arrival_stream(spark, landing), sink, f"{work}/ckpt")
    rows = table.read().collect()
    assert len(rows) == 1 and rows[0].file_size == 3 and rows[0].file_type == "policy"
    again = spark.createDataFrame([("raw/policy/cycle_20240101/policy.csv.pgp", 3, dt.datetime(2024, 1, 1))],
                                  "object_key string, length long, modificationTime timestamp")
    sink(again, 0)  # the same batch delivered again writes the same entry
    assert table.read().collect() == rows
    # a stream with a new checkpoint begins with batch 0, too, and must not lose its arrivals
    second = scratch("landing2")
    land(second, "raw/rider/cycle_20240102/rider.csv.pgp", "x")
    run_available_foreach(arrival_stream(spark, second), sink, f"{work}/ckpt2")
    assert sorted(r.cycle_date for r in table.read().collect()) == ["20240101", "20240102"]
    listing = spark.createDataFrame([("raw/policy/cycle_20240101/policy.csv.pgp", dt.datetime(2030, 1, 1))],
                                    "object_key string, modificationTime timestamp")
    assert reconcile_arrivals(spark, listing, table.read(), "landing").count() == 1


def test_a_batch_touches_only_its_cycles_and_expiry_rewrites_the_table(spark, scratch):
    table = PartitionedTable(spark, scratch("audit-cycles"), "cycle_date")
    for day in range(1, 6):
        sink = audit_sink(table, "b", now=lambda d=day: dt.datetime(2024, 1, d))
        sink(spark.createDataFrame([(f"raw/policy/cycle_2024010{day}/p.csv", 1, dt.datetime(2024, 1, day))],
                                   "object_key string, length long, modificationTime timestamp"), 0)
    newest = table._current()  # noqa: SLF001
    assert sorted(newest.values()) == [1, 2, 3, 4, 5]  # one publication holds one cycle
    assert expire_published(table, dt.datetime(2024, 4, 1, 12)) == 2  # 90 days before: 2 January, noon
    assert sorted(r.cycle_date for r in table.read().collect()) == ["20240103", "20240104", "20240105"]
    assert expire_published(table, dt.datetime(2024, 4, 1, 12)) == 0


def test_dedupe_within_watermark(spark, scratch):
    work = scratch("dedup")
    rows = [(i % 200, dt.datetime(2024, 1, 1, 0, i % 50)) for i in range(400)]
    spark.createDataFrame(rows, "id long, ts timestamp").write.parquet(f"{work}/in")
    stream = spark.readStream.schema("id long, ts timestamp").parquet(f"{work}/in")
    run_available(dedupe_within_watermark(stream, ["id"], "ts", "1 hour"), f"{work}/out", f"{work}/ckpt")
    assert spark.read.parquet(f"{work}/out").count() == 200


def test_window_alarm_batch_and_default_rules(spark):
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(base + dt.timedelta(minutes=m), 1.0) for m in (0, 1, 2, 7)],
                               "ts timestamp, v double")
    out = window_alarm(ev, "ts", "v", "sum", ">=", 2).collect()
    assert len(out) == 1 and out[0].metric == 3.0 and out[0].window_start == base
    metrics = spark.createDataFrame(
        [(base, "handler_errors", 5.0), (base, "handler_duration_ms", 40000.0),
         (base, "handler_duration_ms", 60000.0), (base, "audit_writes", 50.0)],
        "ts timestamp, metric_name string, value double")
    fired = {r.alarm: r.metric for r in default_alarms(metrics).collect()}
    assert fired == {"handler_errors": 5.0, "handler_duration_ms": 50000.0}


def test_only_configured_metrics_are_read(spark, scratch):
    path = scratch("metrics")
    spark.createDataFrame([(dt.datetime(2024, 1, 1), "handler_errors", 9.0), (dt.datetime(2024, 1, 1), "other", 1.0)],
                          "ts timestamp, metric_name string, value double").write.parquet(path)
    text = plan_text(default_alarms(spark.read.parquet(path)))
    assert "PushedFilters: [In(metric_name" in text


def test_transitions_are_emitted_once_and_their_state_expires(spark, scratch):
    import time
    from cyclemart.streaming.cycle_state import cycle_transitions, pass_on

    landing, work = scratch("landing"), scratch("transitions")
    for t in EXPECTED_FILE_TYPES:
        land(landing, f"raw/{t}/cycle_20240101/{t}.csv.pgp")
    for t in EXPECTED_FILE_TYPES[:5]:
        land(landing, f"raw/{t}/cycle_20240102/{t}.csv.pgp")
    land(landing, "raw/notes/cycle_20240102/readme.csv.pgp")
    seen = []

    def run(**lives):
        done = cycle_transitions(arrival_stream(spark, landing), EXPECTED_FILE_TYPES, **lives)
        run_available_foreach(done, pass_on(lambda batch, _: seen.extend(batch.collect())), f"{work}/ckpt", no_data_batches=False)
        return [r.cycle_date for r in seen]

    assert run() == ["20240101"]
    assert seen[0].received_types == ",".join(sorted(EXPECTED_FILE_TYPES)) and seen[0].completed_at is not None
    assert run() == ["20240101"]  # plain restart: nothing new
    land(landing, "raw/rider/cycle_20240102/rider.csv.pgp")
    assert run() == ["20240101", "20240102"]
    land(landing, "raw/policy/cycle_20240101/policy_again.csv.pgp")
    assert run() == ["20240101", "20240102"]  # extra file of a finished cycle
    state = spark.read.format("statestore").option("stateVarName", "seen").load(f"{work}/ckpt")
    assert state.count() == 0  # no open cycle is left, finished ones have their mark alone
    marks = spark.read.format("statestore").option("stateVarName", "finished").load(f"{work}/ckpt")
    assert marks.count() == 2

    seen.clear()
    landing, work = scratch("landing"), scratch("expiring")
    brief = dt.timedelta(seconds=2)
    for t in EXPECTED_FILE_TYPES:
        land(landing, f"raw/{t}/cycle_20240103/{t}.csv.pgp")
    assert run(finished=brief) == ["20240103"]
    time.sleep(3)
    for t in EXPECTED_FILE_TYPES:  # the mark has expired: the cycle counts as new
        land(landing, f"raw/{t}/cycle_20240103/{t}_again.csv.pgp")
    assert run(finished=brief) == ["20240103", "20240103"]


def test_transition_batches_read_no_earlier_output(spark):
    from cyclemart.streaming.cycle_state import _folded
    import pyarrow as pa

    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    batch = pa.RecordBatch.from_pylist([{"cycle_date": "c", "mask": 1 << (i % 2), "newest": at + dt.timedelta(hours=i)} for i in range(1000)])
    rows = sorted((r["mask"], r["newest"]) for b in _folded(iter([batch])) for r in b.to_pylist())
    assert rows == [(1, at + dt.timedelta(hours=998)), (2, at + dt.timedelta(hours=999))]  # a hot cycle is two rows


def test_a_rewritten_file_arrives_again_once(spark, scratch):
    from cyclemart.streaming.listing import landed_file_stream

    landing, work = scratch("landing"), scratch("listing")
    land(landing, "raw/policy/cycle_20240101/policy.csv.pgp", "abc")
    land(landing, "raw/rider/cycle_20240101/deep/rider.csv.pgp", "r")
    land(landing, "raw/policy/cycle_20240101/_half.csv.pgp", "x")
    land(landing, "raw/policy/cycle_20240101/notes.txt", "x")
    table = PartitionedTable(spark, f"{work}/audit", "cycle_date")
    given = []

    def run(day):
        upsert = audit_sink(table, "landing", now=lambda: dt.datetime(2024, 1, day))
        def sink(batch, batch_id):
            given.extend((r.object_key, r.length) for r in batch.collect())
            upsert(batch, batch_id)
        run_available_foreach(landed_file_stream(spark, landing, settle=0), sink, f"{work}/ckpt")
        return {r.object_key: (r.file_size, r.ingestion_timestamp.day) for r in table.read().withColumn("object_key", F.split("file_key", "#")[1]).collect()}

    policy, rider = "raw/policy/cycle_20240101/policy.csv.pgp", "raw/rider/cycle_20240101/deep/rider.csv.pgp"
    assert run(1) == {policy: (3, 1), rider: (1, 1)}
    assert run(2) == {policy: (3, 1), rider: (1, 1)}  # a restart gives nothing again
    land(landing, policy, "abcdef")
    assert run(3) == {policy: (6, 3), rider: (1, 1)}
    assert run(4) == {policy: (6, 3), rider: (1, 1)}
    assert sorted(given) == sorted([(policy, 3), (rider, 1), (policy, 6)])


def test_files_count_once_they_have_settled(spark, scratch):
    from cyclemart.streaming.listing import _Reader

    landing = local_path(scratch("landing"))
    land(landing, "raw/policy/cycle_20240101/p.csv.pgp")
    reader = _Reader({"path": landing, "suffix": ".pgp", "settle": "3600"})
    def rows(start, end):
        return [r for p in reader.partitions(start, end) for r in reader.read(p)]
    assert rows(reader.initialOffset(), reader.latestOffset()) == []
    reader.settle = 0
    [row] = rows(reader.initialOffset(), reader.latestOffset())
    assert row[1] == "raw/policy/cycle_20240101/p.csv.pgp" and row[3].tzinfo is not None
    assert rows(reader.latestOffset(), reader.latestOffset()) == []
    assert _Reader({"path": landing + "/none"}).partitions({"until_ns": 0}, {"until_ns": 1})[0].folders == [(landing + "/none/raw", False)]
