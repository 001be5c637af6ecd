"""Structured Streaming queries run to completion with trigger availableNow (ST-1..ST-4)."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.operators.merge import PartitionedTable
from cyclemart.plans.catalogue.audit import _ARRIVALS_SQL
from cyclemart.plans.catalogue.base import EVENT_TYPES, NOW, query, STREAM_DELAY
from cyclemart.session import scratch_path
from cyclemart.sources.files import list_files
from cyclemart.sources.tables import read_table
from cyclemart.streaming.alarms import window_alarm
from cyclemart.streaming.arrivals import (
    arrival_stream, audit_sink, completed_cycles, dedupe_within_watermark, emit_once, run_available,
    run_available_foreach,
)
from cyclemart.streaming.cycle_state import cycle_transitions
from cyclemart.streaming.listing import landed_file_stream


LATER = dt.timedelta(hours=1)  # from a first run of a stream to the next

# ============================================================== streaming (ST-1..ST-4)
# Each streaming query runs over everything available (trigger availableNow) into a sink
# below the shared checkpoint folder, with a fresh checkpoint; the result is read back.


def _events_stream(spark: SparkSession, root: str) -> DataFrame:
    schema = read_table(spark, root, "events").schema
    # A glob (not the bare file path): the file stream source needs a directory base.
    return spark.readStream.schema(schema).parquet(f"{root.rstrip('/')}/events*.parquet")


def _stream_to_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    run_available(df, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_window_alarm", f"""
WITH w AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
         COUNT(*) AS error_count
  FROM events WHERE event_type = 'error'
  GROUP BY 1, 2 HAVING COUNT(*) >= 2)
SELECT * FROM w
WHERE window_end <= (SELECT MAX(ts) FROM events WHERE event_type = 'error') - INTERVAL {STREAM_DELAY}""")
def stream_window_alarm(spark, root):
    """ST-4 streamed: append mode emits each window once the watermark has passed it."""
    errors = _events_stream(spark, root).filter(F.col("event_type") == "error")
    alarms = window_alarm(errors, "ts", F.lit(1), agg="count", op=">=", threshold=2,
                          out_col="error_count", watermark=STREAM_DELAY)
    return _stream_to_table(spark, alarms, "stream-alarm")


@query("stream_complete_cycles", """
WITH p AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS cycle_date, event_type FROM events
           WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view')),
     g AS (SELECT cycle_date, LIST_SORT(LIST(event_type)) AS got FROM p GROUP BY cycle_date)
SELECT cycle_date, ARRAY_TO_STRING(got, ',') AS received_types FROM g WHERE LEN(got) = 5""")
def stream_complete_cycles(spark, root):
    """ST-1 + ST-2: arrivals streamed, each complete cycle emitted exactly once."""
    base = scratch_path(spark, "stream-cycles")
    done = completed_cycles(_arrivals(_events_stream(spark, root)), EVENT_TYPES)
    run_available_foreach(done, emit_once(f"{base}/out"), f"{base}/checkpoint", "update")
    return spark.read.parquet(f"{base}/out").select("cycle_date", "received_types")


@query("stream_cycle_transitions", """
WITH p AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS cycle_date, event_type FROM events
           WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view')),
     g AS (SELECT cycle_date, LIST_SORT(LIST(event_type)) AS got FROM p GROUP BY cycle_date)
SELECT g.cycle_date, ARRAY_TO_STRING(got, ',') AS received_types, CAST(1 AS BIGINT) AS emitted FROM g WHERE LEN(got) = 5""")
def stream_cycle_transitions(spark, root):
    """ST-2 in keyed state: the arrivals of two types, then on the same checkpoint those of all;
    each cycle is given at its step to complete, and once."""
    base = scratch_path(spark, "stream-transitions")
    for run, types in enumerate((EVENT_TYPES[:2], EVENT_TYPES, EVENT_TYPES)):
        path = f"{base}/landed"
        landed = _arrivals(read_table(spark, root, "events").filter(F.col("event_type").isin(types)))
        landed.write.mode("append").parquet(path)
        stream = spark.readStream.schema(landed.schema).parquet(path)
        run_available(cycle_transitions(stream, EVENT_TYPES), f"{base}/out", f"{base}/checkpoint", no_data_batches=False)
    return spark.read.parquet(f"{base}/out").groupBy("cycle_date", "received_types").agg(F.count("*").alias("emitted"))


_STREAMED_AUDIT_SQL = _ARRIVALS_SQL.replace("ts AS ingestion_timestamp", "NOW_TS AS ingestion_timestamp").replace(
    "ts AS created_at, ts AS updated_at", "NOW_TS AS created_at, NOW_TS AS updated_at").replace(
    "NOW_TS", f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'") + "\nSELECT * FROM audit"


def _arrivals(events: DataFrame) -> DataFrame:
    """Arrivals of one landed file per event, as in the batch queries."""
    key = F.concat(F.lit("raw/"), F.col("event_type"), F.lit("/cycle_"),
                   F.date_format("ts", "yyyyMMdd"), F.lit("/user_"),
                   F.col("user_id").cast("string"), F.lit(".csv.pgp"))
    return events.select(key.alias("object_key"), F.round(F.col("value") * 100).cast("long").alias("length"),
                         F.col("ts").cast("timestamp").alias("modificationTime"), "event_id")


@query("stream_audit", _STREAMED_AUDIT_SQL)
def stream_audit(spark, root):
    """ST-1: arrivals streamed into the audit table by a foreachBatch upsert (AU-2)."""
    base = scratch_path(spark, "stream-audit")
    table = PartitionedTable(spark, f"{base}/audit", "cycle_date")
    sink = audit_sink(table, "landing", now=lambda: NOW, tie_breakers=["event_id"])
    run_available_foreach(_arrivals(_events_stream(spark, root)), sink, f"{base}/checkpoint")
    return table.read()


@query("stream_audit_restart", _STREAMED_AUDIT_SQL)
def stream_audit_restart(spark, root):
    """ST-1: two streams with a checkpoint each fill one audit table; both begin with batch 0."""
    base = scratch_path(spark, "stream-audit-restart")
    table = PartitionedTable(spark, f"{base}/audit", "cycle_date")
    sink = audit_sink(table, "landing", now=lambda: NOW, tie_breakers=["event_id"])
    early = F.col("event_type").isin("click", "view")
    for name, part in (("first", early), ("second", ~early)):
        arrivals = _arrivals(_events_stream(spark, root).filter(part))
        run_available_foreach(arrivals, sink, f"{base}/checkpoint-{name}")
    return table.read()


def _land_events(spark: SparkSession, root: str, landing: str) -> None:
    """The events as landed files, by type and day."""
    events = read_table(spark, root, "events")
    day = F.concat(F.lit("cycle_"), F.date_format("ts", "yyyyMMdd"))
    for row in events.select("event_type").distinct().collect():  # five event types
        landed = events.filter(F.col("event_type") == row[0]).select(F.to_csv(F.struct("event_id", "user_id")).alias("value"), day.alias("cycle"))
        landed.repartition("cycle").write.partitionBy("cycle").text(f"{landing}/raw/{row[0]}")


@query("stream_rewritten_arrivals", f"""
SELECT event_type AS file_type, strftime(ts, '%Y%m%d') AS cycle_date,
       CASE WHEN event_type = 'click' THEN TIMESTAMP '{NOW + LATER:%Y-%m-%d %H:%M:%S}' ELSE TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' END AS ingestion_timestamp
FROM events GROUP BY ALL""")
def stream_rewritten_arrivals(spark, root):
    """ST-1: files written again at a known path are audited again by the stream itself."""
    base = scratch_path(spark, "rewritten")
    _land_events(spark, root, f"{base}/landing")
    table = PartitionedTable(spark, f"{base}/audit", "cycle_date")
    for now in (NOW, NOW + LATER):
        stream = landed_file_stream(spark, f"{base}/landing", suffix=".txt", settle=0)
        plain = stream.withColumn("object_key", F.replace("object_key", F.lit("cycle=cycle_"), F.lit("cycle_")))
        run_available_foreach(plain, audit_sink(table, "landing", now=lambda at=now: at), f"{base}/checkpoint")
        if now == NOW:  # the files of one type get a new modification time, as if written again
            path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
            fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
            for row in list_files(spark, f"{base}/landing/raw/click", "*.txt").select("path").toLocalIterator():
                fs.setTimes(path(row["path"]), int(time.time() * 1000), -1)
    return table.read().select("file_type", "cycle_date", "ingestion_timestamp").distinct()


@query("landed_arrivals", f"""
WITH f AS (
  SELECT DISTINCT event_type AS file_type, strftime(ts, '%Y%m%d') AS cycle_date FROM events)
SELECT cycle_date, CAST(COUNT(*) AS BIGINT) AS n_types, TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS ingestion_timestamp
FROM f GROUP BY cycle_date""")
def landed_arrivals(spark, root):
    """ST-1 on real files: events landed by type and day, listed as a stream, audited."""
    base = scratch_path(spark, "landed")
    _land_events(spark, root, f"{base}/landing")
    table = PartitionedTable(spark, f"{base}/audit", "cycle_date")
    stream = arrival_stream(spark, f"{base}/landing", glob="*.txt")
    plain = stream.withColumn("object_key", F.replace("object_key", F.lit("cycle=cycle_"), F.lit("cycle_")))
    run_available_foreach(plain, audit_sink(table, "landing", now=lambda: NOW), f"{base}/checkpoint")
    audit = table.read()
    return audit.groupBy("cycle_date").agg(
        F.countDistinct("file_type").alias("n_types"), F.max("ingestion_timestamp").alias("ingestion_timestamp"))


@query("stream_dedup", """
SELECT DISTINCT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events""")
def stream_dedup(spark, root):
    """ST-3: the event stream delivered twice; repeats inside the watermark are dropped."""
    twice = _events_stream(spark, root).unionByName(_events_stream(spark, root))
    return _stream_to_table(spark, dedupe_within_watermark(twice, ["event_id"], "ts", "1 hour"),
                            "stream-dedup")
