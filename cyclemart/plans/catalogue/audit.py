"""Arrival audit, cycle completeness and batch alarms (AU-1..AU-6, ST-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.operators.audit import (
    audit_entries, batch_summary, cycle_completeness, empty_audit_table, expire_published,
    update_status, upsert_audit,
)
from cyclemart.operators.dedup import keep_first
from cyclemart.operators.merge import PartitionedTable
from cyclemart.plans.catalogue.base import AUDIT_AS_OF, EVENT_TYPES, NOW, query
from cyclemart.schemas import AUDIT_KEYS
from cyclemart.session import materialize, scratch_path
from cyclemart.sources.tables import read_table
from cyclemart.streaming.alarms import default_alarms, window_alarm


# ============================================================== arrival audit (AU-*)


def event_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Arrivals synthesised from ``events``: one landed file per event.

    Key ``raw/{event_type}/cycle_{yyyyMMdd}/user_{user_id}.csv.pgp``; a user with several
    events of one type on a day re-lands the same key.  Size = round(value * 100).
    """
    ev = read_table(spark, root, "events")
    key = F.concat(F.lit("raw/"), F.col("event_type"), F.lit("/cycle_"),
                   F.date_format("ts", "yyyyMMdd"), F.lit("/user_"),
                   F.col("user_id").cast("string"), F.lit(".csv.pgp"))
    return ev.select(
        key.alias("object_key"),
        F.lit("landing").alias("bucket"),
        F.round(F.col("value") * 100).cast("long").alias("length"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        "event_id",
    )


_ARRIVALS_SQL = """
WITH a AS (
  SELECT 'raw/' || event_type || '/cycle_' || strftime(ts, '%Y%m%d') || '/user_' ||
         CAST(user_id AS VARCHAR) || '.csv.pgp' AS object_key,
         event_type AS file_type, strftime(ts, '%Y%m%d') AS cycle_date,
         'user_' || CAST(user_id AS VARCHAR) || '.csv.pgp' AS file_name,
         CAST(ROUND(value * 100) AS BIGINT) AS file_size, ts, event_id
  FROM events),
l AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY object_key, cycle_date
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM a),
audit AS (
  SELECT 'landing#' || object_key AS file_key, cycle_date, 'landing' AS bucket, object_key,
         file_type, file_name, ts AS ingestion_timestamp, 'RECEIVED' AS status, file_size,
         ts AS created_at, ts AS updated_at
  FROM l WHERE rn = 1)"""


def audit_table(spark: SparkSession, root: str, materialized: bool = False) -> DataFrame:
    """The audit table after one batch of arrivals (optionally checkpointed for reuse)."""
    entries = audit_entries(event_arrivals(spark, root), now="modificationTime",
                            tie_breakers=["event_id"])
    audit = upsert_audit(empty_audit_table(spark), entries)
    return materialize(audit) if materialized else audit


@query("audit_entries", _ARRIVALS_SQL + "\nSELECT * FROM audit")
def q_audit_entries(spark, root):
    """AU-1 + AU-2: parse keys, one RECEIVED entry per key, upserted into the audit table."""
    return audit_table(spark, root)


@query("status_update", _ARRIVALS_SQL + f"""
SELECT file_key, cycle_date, bucket, object_key, file_type, file_name, ingestion_timestamp,
       CASE WHEN file_type = 'error' THEN 'FAILED' ELSE status END AS status, file_size, created_at,
       CASE WHEN file_type = 'error' THEN TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' ELSE updated_at END
         AS updated_at
FROM audit""")
def q_status_update(spark, root):
    """AU-3: mark the entries of every ``error`` file FAILED."""
    audit = audit_table(spark, root, materialized=True)
    failed = audit.filter(F.col("file_type") == "error").select("file_key", "cycle_date")
    return update_status(audit, failed, status="FAILED", now=NOW)


@query("status_update_repeated", _ARRIVALS_SQL + f"""
SELECT file_key, cycle_date, bucket, object_key, file_type, file_name, ingestion_timestamp,
       CASE WHEN file_type = 'error' THEN 'FAILED' ELSE status END AS status, file_size, created_at,
       CASE WHEN file_type = 'error' THEN TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' ELSE updated_at END
         AS updated_at
FROM audit""")
def q_status_update_repeated(spark, root):
    """AU-3: an entry is updated twice, first to PROCESSING; the later status stays, once."""
    audit = audit_table(spark, root, materialized=True)
    failed = audit.filter(F.col("file_type") == "error").select("file_key", "cycle_date")
    updates = failed.withColumns({"status": F.lit("PROCESSING"), "n": F.lit(1)}).unionByName(
        failed.withColumns({"status": F.lit("FAILED"), "n": F.lit(2)}))
    return update_status(audit, updates, now=NOW, order_by="n")


@query("audit_expiry", _ARRIVALS_SQL + f"""
SELECT * FROM audit
WHERE created_at >= TIMESTAMP '{AUDIT_AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL 90 DAY""")
def q_audit_expiry(spark, root):
    """AU-6: the published audit table without entries older than 90 days."""
    table = PartitionedTable(spark, scratch_path(spark, "audit-expiry"), "cycle_date")
    entries = audit_entries(event_arrivals(spark, root), now="modificationTime", tie_breakers=["event_id"])
    table.merge_or_init(entries, AUDIT_KEYS, audit_columns=False)
    expire_published(table, AUDIT_AS_OF)
    return table.read()


@query("cycle_complete", """
WITH p AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS cycle_date, event_type FROM events
           WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view')),
     g AS (SELECT cycle_date, LIST(event_type) AS got FROM p GROUP BY cycle_date)
SELECT cycle_date, CAST(LEN(got) AS INTEGER) AS n_received, LEN(got) = 5 AS is_complete,
       ARRAY_TO_STRING(LIST_SORT(LIST_FILTER(['click', 'error', 'purchase', 'signup', 'view'],
                                            lambda x: NOT LIST_CONTAINS(got, x))), ',') AS missing_types
FROM g""")
def q_cycle_complete(spark, root):
    """AU-4: days on which every expected event type has landed."""
    done = cycle_completeness(audit_table(spark, root), EVENT_TYPES)
    return done.select("cycle_date", F.size("received_types").alias("n_received"), "is_complete",
                       F.array_join("missing_types", ",").alias("missing_types"))


@query("arrival_summary", """
SELECT 'raw/' || event_type || '/cycle_' || strftime(ts, '%Y%m%d') || '/user_' ||
       CAST(user_id AS VARCHAR) || '.csv.pgp' AS file,
       event_type AS type, strftime(ts, '%Y%m%d') AS cycle_date, 'AUDITED' AS status
FROM events""")
def q_arrival_summary(spark, root):
    """AU-5: one AUDITED row per valid arrival of the batch."""
    return batch_summary(event_arrivals(spark, root))


# ============================================================== alarms (ST-4, batch form)


@query("window_alarm", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       COUNT(*) AS error_count
FROM events WHERE event_type = 'error'
GROUP BY 1, 2 HAVING COUNT(*) >= 2""")
def q_window_alarm(spark, root):
    errors = read_table(spark, root, "events").filter(F.col("event_type") == "error")
    return window_alarm(errors, "ts", F.lit(1), agg="count", op=">=", threshold=2,
                        out_col="error_count")


def event_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Monitoring metrics derived from ``events``: errors, job failures (signups), audit
    writes (purchases) and handler durations (other events, value x 1000 ms)."""
    ev = read_table(spark, root, "events")
    name = (F.when(F.col("event_type") == "error", F.lit("handler_errors"))
             .when(F.col("event_type") == "signup", F.lit("job_failures"))
             .when(F.col("event_type") == "purchase", F.lit("audit_writes"))
             .otherwise(F.lit("handler_duration_ms")))
    value = F.when(name == "handler_duration_ms", F.col("value") * 1000).otherwise(F.lit(1.0))
    return ev.select("ts", name.alias("metric_name"), value.alias("value"))


@query("monitoring_alarms", """
WITH m AS (
  SELECT ts,
         CASE event_type WHEN 'error' THEN 'handler_errors' WHEN 'signup' THEN 'job_failures'
              WHEN 'purchase' THEN 'audit_writes' ELSE 'handler_duration_ms' END AS metric_name,
         CASE WHEN event_type IN ('error', 'signup', 'purchase') THEN 1.0 ELSE value * 1000 END AS value
  FROM events),
g AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, metric_name,
         SUM(value) AS s, AVG(value) AS a
  FROM m GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, metric_name AS alarm,
       ROUND(CASE WHEN metric_name = 'handler_duration_ms' THEN a ELSE s END, 4) AS metric
FROM g
WHERE (metric_name = 'handler_errors' AND s >= 5) OR (metric_name = 'handler_duration_ms' AND a > 45000)
   OR (metric_name = 'job_failures' AND s >= 1) OR (metric_name = 'audit_writes' AND s > 50)""")
def q_monitoring_alarms(spark, root):
    """ST-4: every configured alarm rule over 5-minute windows, one pass over the metrics."""
    alarms = default_alarms(event_metrics(spark, root))
    return alarms.withColumn("metric", F.round("metric", 4))


@query("arrival_reconcile", _ARRIVALS_SQL + """,
listing AS (
  SELECT object_key,
         CASE WHEN file_type = 'error' THEN ts + INTERVAL 1 DAY ELSE ts END AS modificationTime
  FROM l WHERE rn = 1)
SELECT g.object_key, g.modificationTime
FROM listing g LEFT JOIN audit a ON a.file_key = 'landing#' || g.object_key
WHERE a.file_key IS NULL OR g.modificationTime > a.ingestion_timestamp""")
def q_arrival_reconcile(spark, root):
    """ST-1 gap: files rewritten after their audit entry (here every ``error`` file,
    listed one day later) are found again in batch, for the same upsert as the stream."""
    from cyclemart.streaming.arrivals import reconcile_arrivals

    latest = keep_first(event_arrivals(spark, root), ["object_key"], "modificationTime",
                        tie_breakers=["event_id"])
    rewritten = F.col("object_key").startswith("raw/error/")
    listing = latest.select(
        "object_key",
        F.when(rewritten, F.col("modificationTime") + F.expr("INTERVAL 1 DAY"))
         .otherwise(F.col("modificationTime")).alias("modificationTime"))
    return reconcile_arrivals(spark, listing, audit_table(spark, root), "landing")
