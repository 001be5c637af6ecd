"""Arrival audit and cycle completeness (AU-1..AU-6).

An *arrival* is a row with at least ``path`` (the object key, relative to the landing
root), and optionally ``bucket``, ``length`` and ``modificationTime`` – the columns of a
``binaryFile`` listing.  The audit table is keyed by (``file_key``, ``cycle_date``) and
updated with the SCD Type 1 merge, so a re-arrival replaces its entry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.functions.paths import parse_object_key
from cyclemart.functions.timeutil import instant
from cyclemart.operators.dedup import keep_first
from cyclemart.operators.merge import PartitionedTable, scd1_merge
from cyclemart.session import empty_frame
from cyclemart.schemas import AUDIT_KEYS, AUDIT_RETENTION_DAYS, AUDIT_SCHEMA, AUDIT_STATUSES


def _ts(now: dt.datetime | Column | str | None) -> Column:
    return instant(now)


def parse_arrivals(arrivals: DataFrame, key_col: str = "object_key") -> DataFrame:
    """AU-1: add ``file_type``, ``cycle_date``, ``file_name``; drop keys with < 3 parts."""
    parsed = parse_object_key(key_col)
    return (arrivals.withColumn("__p", parsed)
                    .filter(F.col("__p.valid"))
                    .withColumns({
                        "file_type": F.col("__p.file_type"),
                        "cycle_date": F.col("__p.cycle_date"),
                        "file_name": F.col("__p.file_name"),
                    })
                    .drop("__p"))


def audit_entries(
    arrivals: DataFrame,
    now: dt.datetime | Column | str | None = None,
    bucket: str | Column | None = None,
    key_col: str = "object_key",
    size_col: str | None = "length",
    order_col: str | None = "modificationTime",
    tie_breakers: list | None = None,
) -> DataFrame:
    """AU-2: one ``RECEIVED`` entry per (``bucket#key``, cycle), last arrival wins.

    ``now`` is the processing instant (a value, a column name or a Column).  The size is 0
    when unknown.  Several arrivals of one key in a batch collapse to the latest by
    ``order_col`` (then ``tie_breakers``), as sequential puts would; to the largest when the
    arrivals have no such column.
    """
    stamp = _ts(now)
    bucket_col = (F.col("bucket") if bucket is None else
                  bucket if isinstance(bucket, Column) else F.lit(bucket))
    parsed = parse_arrivals(arrivals, key_col)
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0)) if size_col and size_col in arrivals.columns \
        else F.lit(0).cast("long")
    ordered = parsed.withColumns({"__bucket": bucket_col, "__ts": stamp, "__size": size})
    # without an order the largest file of a key stands for its last arrival
    order = order_col if order_col and order_col in arrivals.columns else "__size"
    ordered = keep_first(ordered.withColumn("__fk", F.concat_ws("#", F.col("__bucket"), F.col(key_col))),
                         ["__fk", "cycle_date"], order, tie_breakers=tie_breakers).drop("__fk")
    return ordered.select(
        F.concat_ws("#", F.col("__bucket"), F.col(key_col)).alias("file_key"),
        F.col("cycle_date").cast("string").alias("cycle_date"),
        F.col("__bucket").cast("string").alias("bucket"),
        F.col(key_col).cast("string").alias("object_key"),
        F.col("file_type").cast("string").alias("file_type"),
        F.col("file_name").cast("string").alias("file_name"),
        F.col("__ts").alias("ingestion_timestamp"),
        F.lit("RECEIVED").alias("status"),
        F.col("__size").alias("file_size"),
        F.col("__ts").alias("created_at"),
        F.col("__ts").alias("updated_at"),
    )


def empty_audit_table(spark) -> DataFrame:
    return empty_frame(spark, AUDIT_SCHEMA)


def upsert_audit(audit: DataFrame, entries: DataFrame, **merge_kwargs) -> DataFrame:
    """AU-2 sink: a re-arrival replaces the whole entry; entries that repeat a key raise."""
    return scd1_merge(audit, entries.select(*audit.columns), AUDIT_KEYS, **merge_kwargs)


def _known_status(status: Column) -> Column:
    text = status.cast("string")
    wrong = F.concat(F.lit("status is not one of " + ", ".join(AUDIT_STATUSES) + ": "), F.coalesce(text, F.lit("NULL")))
    return F.when(text.isin(*AUDIT_STATUSES), text).otherwise(F.raise_error(wrong).cast("string"))


def update_status(
    audit: DataFrame,
    updates: DataFrame,
    status: str | Column | None = None,
    now: dt.datetime | Column | str | None = None,
    order_by: str | list[str] | None = None,
    tie_breakers: list | None = None,
    **merge_kwargs,
) -> DataFrame:
    """AU-3: set ``status`` and ``updated_at`` of the entries named by ``updates``.

    ``updates`` carries ``file_key``, ``cycle_date`` and (unless ``status`` is given)
    ``status``.  As with an update-by-key in a key-value store, an unknown key creates a
    sparse entry holding only the key, status and time.  Repeated updates of a key count
    once: the latest by ``order_by``; without an order they must agree, or the merge raises.
    A status outside the vocabulary raises, given as a value or as a column.
    """
    if isinstance(status, str) and status not in AUDIT_STATUSES:
        raise ValueError(f"status {status!r} is not one of {AUDIT_STATUSES}")
    status_col = F.col("status") if status is None else (
        status if isinstance(status, Column) else F.lit(status))
    if order_by is not None:
        updates = keep_first(updates, AUDIT_KEYS, order_by, tie_breakers=tie_breakers)
    src = updates.select(*AUDIT_KEYS, _known_status(status_col).alias("status"), _ts(now).alias("updated_at"))
    if order_by is None:
        src = src.distinct()
    return scd1_merge(audit, src, AUDIT_KEYS, update_columns=["status", "updated_at"], **merge_kwargs)


def cycle_completeness(audit: DataFrame, expected: list[str]) -> DataFrame:
    """AU-4: per cycle, which expected types have arrived.

    Extra types and any status are accepted.  Only (cycle, expected type) pairs are
    shuffled – at most ``len(expected)`` per cycle after map-side de-duplication.
    Output: ``cycle_date, received_types, is_complete, missing_types`` (arrays sorted).
    """
    pairs = (audit.filter(F.col("file_type").isin(*expected))
                  .select("cycle_date", "file_type").distinct())
    expected_arr = F.array(*[F.lit(t) for t in expected])
    per_cycle = pairs.groupBy("cycle_date").agg(F.array_sort(F.collect_set("file_type")).alias("received_types"))
    missing = F.array_sort(F.array_except(expected_arr, F.col("received_types")))
    return per_cycle.select(
        "cycle_date",
        "received_types",
        (F.size(missing) == 0).alias("is_complete"),
        missing.alias("missing_types"),
    )


def batch_summary(arrivals: DataFrame, key_col: str = "object_key") -> DataFrame:
    """AU-5: one ``AUDITED`` row per valid arrival of a batch (count it with ``observe``)."""
    parsed = parse_arrivals(arrivals, key_col)
    return parsed.select(
        F.col(key_col).alias("file"),
        F.col("file_type").alias("type"),
        "cycle_date",
        F.lit("AUDITED").alias("status"),
    )


def expire(audit: DataFrame, as_of: dt.datetime | Column,
           days: int = AUDIT_RETENTION_DAYS, ts_col: str = "created_at") -> DataFrame:
    """AU-6: drop entries created more than ``days`` before ``as_of``; entries without a
    creation time stay."""
    cutoff = _ts(as_of) - F.make_interval(days=F.lit(days))
    return audit.filter(F.col(ts_col).isNull() | (F.col(ts_col) >= cutoff))


def expire_published(table: PartitionedTable, as_of: dt.datetime | Column, days: int = AUDIT_RETENTION_DAYS,
                     ts_col: str = "created_at") -> int:
    """AU-6 on the published audit table: rewrite the cycles that hold expired entries,
    without them.  Returns the number of cycles rewritten."""
    cutoff = _ts(as_of) - F.make_interval(days=F.lit(days))
    return table.delete_where(F.col(ts_col) < cutoff)
