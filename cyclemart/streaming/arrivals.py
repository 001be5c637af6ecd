"""Arrival stream, emit-once cycle gate and watermark de-duplication (ST-1..ST-3).

* ``arrival_stream`` lists landed files as a stream (``binaryFile`` source without the
  ``content`` column, so only metadata is read).  A restart on the same checkpoint sees
  only new files.  A file rewritten at a path already seen is *not* re-listed by the file
  source; :func:`reconcile_arrivals` covers that in batch.
* ``completed_cycles`` keeps, per cycle, a bit for each expected type seen so far, and
  ``emit_once`` passes each complete cycle on once.  Later files of a finished cycle emit
  nothing.
* ``dedupe_within_watermark`` drops repeated records of a record stream.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.paths import parse_object_key
from cyclemart.operators.audit import audit_entries
from cyclemart.operators.merge import PartitionedTable
from cyclemart.schemas import AUDIT_KEYS, EXPECTED_FILE_TYPES
from cyclemart.session import empty_frame, materialize
from cyclemart.sources.files import _hadoop_path_exists, relative_key

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

COMPLETED_SCHEMA = T.StructType([
    T.StructField("cycle_date", T.StringType(), True),
    T.StructField("received_types", T.StringType(), True),
    T.StructField("completed_at", T.TimestampType(), True),
])

def arrival_stream(spark: SparkSession, landing_root: str, glob: str | None = "*.pgp",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """ST-1 source: ``path, object_key, length, modificationTime`` of landed files."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(f"{landing_root.rstrip('/')}/raw")
    return files.select("path", relative_key("path", landing_root).alias("object_key"),
                        "length", "modificationTime")


def utc_now() -> dt.datetime:
    """The clock of jobs that are not given one: an aware instant, in any session zone."""
    return dt.datetime.now(dt.timezone.utc)


def audit_sink(table: PartitionedTable, bucket: str, now: Callable[[], dt.datetime] = utc_now,
               tie_breakers: list[str] | None = None):
    """``foreachBatch`` handler: upsert the batch's audit entries into ``table``.

    The table is partitioned by the cycle, which is part of the audit key, so a batch reads
    and writes only the cycles it names.  The upsert is by key: a batch that is delivered
    again after a failure writes the same entries again, and a stream that is started with
    a new checkpoint loses nothing.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        entries = audit_entries(batch, now=now(), bucket=bucket, tie_breakers=tie_breakers)
        entries = materialize(entries)
        if entries.isEmpty():
            return
        table.merge_or_init(entries, AUDIT_KEYS, audit_columns=False, materialize_source=False)
    return handle


def reconcile_arrivals(spark: SparkSession, listing: DataFrame, audit: DataFrame,
                       bucket: str) -> DataFrame:
    """Files whose modification time is newer than their audit entry (or unaudited).

    Covers rewrites at an already-seen path, which the file stream source ignores.
    Result feeds the same upsert as the stream.
    """
    keyed = listing.withColumn("file_key", F.concat_ws("#", F.lit(bucket), F.col("object_key")))
    known = audit.select("file_key", F.col("ingestion_timestamp").alias("__audited"))
    return (keyed.join(known, "file_key", "left")
                 .filter(F.col("__audited").isNull() | (F.col("modificationTime") > F.col("__audited")))
                 .drop("__audited", "file_key"))


def completed_cycles(arrivals: DataFrame, expected: list[str] | None = None,
                     key_col: str = "object_key") -> DataFrame:
    """ST-2: the cycles whose expected types have all arrived (``update`` output mode).

    A streaming aggregation: each task folds its arrivals into one row per cycle, a bit for
    every type, before the shuffle, so a cycle with very many files moves as one row per
    task; the state is one small row per cycle.  A cycle is given again when one more of
    its files arrives; :func:`emit_once` passes on each cycle only once.
    """
    expected = expected or EXPECTED_FILE_TYPES
    parsed = (arrivals.withColumn("__p", parse_object_key(key_col))
                      .filter(F.col("__p.valid") & F.col("__p.file_type").isin(*expected))
                      .select(F.col("__p.cycle_date").alias("cycle_date"),
                              F.col("__p.file_type").alias("file_type"),
                              F.col("modificationTime").cast("timestamp").alias("modificationTime")))
    bit = F.coalesce(*[F.when(F.col("file_type") == t, F.lit(1 << i)) for i, t in enumerate(expected)])
    seen = parsed.groupBy("cycle_date").agg(
        F.bit_or(bit).alias("mask"), F.max("modificationTime").alias("completed_at"))
    return seen.filter(F.col("mask") == (1 << len(expected)) - 1).select(
        "cycle_date", F.lit(",".join(sorted(expected))).alias("received_types"), "completed_at")


def emit_once(emitted: str, handler: Callable[[DataFrame, int], None] | None = None):
    """``foreachBatch`` handler for :func:`completed_cycles`: each cycle once, ever.

    Cycles that the Parquet folder ``emitted`` has are left out; the others go to
    ``handler`` (if any) and are then added to the folder.  A failure in between passes a
    cycle on again, so the handler must bear a repeated cycle.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = spark.read.schema(COMPLETED_SCHEMA).parquet(emitted) if _hadoop_path_exists(spark, emitted) \
            else empty_frame(spark, COMPLETED_SCHEMA)
        new = materialize(batch.dropDuplicates(["cycle_date"]).join(known.select("cycle_date"), "cycle_date", "left_anti"))
        if new.isEmpty():
            return
        if handler is not None:
            handler(new, batch_id)
        new.select(*COMPLETED_SCHEMA.names).write.mode("append").parquet(emitted)
    return handle


def dedupe_within_watermark(df: DataFrame, keys: list[str], ts_col: str,
                            delay: str = "1 hour") -> DataFrame:
    """ST-3: drop repeated records (same ``keys``) that arrive within the watermark delay."""
    return (df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
              .withWatermark(ts_col, delay)
              .dropDuplicatesWithinWatermark(keys))


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _batches_without_data(spark: SparkSession, wanted: bool):
    """Queries started inside run batches without data, or not.  A query whose state expires by
    the clock always wants one more, and would never come to an end."""
    before = spark.conf.get(_NO_DATA)
    spark.conf.set(_NO_DATA, str(wanted).lower())
    try:
        yield
    finally:
        spark.conf.set(_NO_DATA, before)


def run_available(df: DataFrame, sink_path: str, checkpoint: str, output_mode: str = "append",
                  fmt: str = "parquet", no_data_batches: bool = True) -> None:
    """Run a streaming query over everything available now, then stop (batch-style).

    Pass ``no_data_batches=False`` for queries with state that expires by the clock.
    """
    with _batches_without_data(df.sparkSession, no_data_batches):
        q = (df.writeStream.format(fmt).outputMode(output_mode)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()


def run_available_foreach(df: DataFrame, handler, checkpoint: str,
                          output_mode: str = "append", no_data_batches: bool = True) -> None:
    """Run a ``foreachBatch`` query over everything available now, then stop."""
    with _batches_without_data(df.sparkSession, no_data_batches):
        q = (df.writeStream.outputMode(output_mode).foreachBatch(handler)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
