"""ST-2 in keyed state: a cycle is passed on at its step from incomplete to complete.

Each cycle has two small values in the state store: the types seen so far, which goes when
the cycle is complete, and the mark that it has been passed on, which expires.  So a batch
reads no earlier output, a later file of a finished cycle emits nothing, and the state of
cycles long finished is gone.  A cycle whose mark has expired counts as new: its mark must
live longer than its files may come late.

Arrivals are folded to one row per cycle, type and batch before the shuffle, so a cycle of very
many files does not reach one task as many rows.  Needs the RocksDB state store.  Run it with a
processing-time trigger, or over what is available now with ``no_data_batches=False``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cyclemart.functions.paths import parse_object_key
from cyclemart.schemas import EXPECTED_FILE_TYPES

FINISHED_DAYS = 90  # how long a finished cycle is remembered, after its last arrival
OPEN_DAYS = 400  # how long an incomplete one is

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class CycleGate(StatefulProcessor):
    """Emits (cycle_date, received_types, completed_at) once for each completed cycle."""

    def __init__(self, expected: list[str], finished_ms: int, open_ms: int) -> None:
        self.expected, self.finished_ms, self.open_ms = list(expected), finished_ms, open_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "mask long, newest timestamp", self.open_ms)
        self.finished = handle.getValueState("finished", "completed_at timestamp", self.finished_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mask, newest = 0, None
        for arrived in rows:
            for m, t in zip(arrived["mask"], arrived["newest"]):
                mask |= int(m)
                newest = t if newest is None else max(newest, t)
        newest = newest.to_pydatetime()
        if self.finished.exists():
            self.finished.update(self.finished.get())  # lives on from its last arrival
            return
        if self.seen.exists():
            before, at = self.seen.get()
            mask, newest = mask | before, max(newest, at)
        if mask == (1 << len(self.expected)) - 1:
            self.finished.update((newest,))
            self.seen.clear()
            yield pd.DataFrame({"cycle_date": [key[0]], "received_types": [",".join(sorted(self.expected))], "completed_at": [newest]})
        else:
            self.seen.update((mask, newest))

    def close(self) -> None:
        pass


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each cycle and type of a batch."""
    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by(["cycle_date", "mask"]).aggregate([("newest", "max")])
        yield from found.select(["cycle_date", "mask", "newest_max"]).rename_columns(["cycle_date", "mask", "newest"]).combine_chunks().to_batches()


def cycle_transitions(arrivals: DataFrame, expected: list[str] | None = None, key_col: str = "object_key",
                      finished: dt.timedelta = dt.timedelta(days=FINISHED_DAYS), opened: dt.timedelta = dt.timedelta(days=OPEN_DAYS)) -> DataFrame:
    """ST-2: each cycle of the arrival stream once, when the last of its expected types has come
    (``append`` output mode; columns as of ``COMPLETED_SCHEMA``)."""
    expected = expected or EXPECTED_FILE_TYPES
    spark = arrivals.sparkSession
    if spark.conf.get(PROVIDER) != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)  # the only store with such state
    parsed = (arrivals.withColumn("__p", parse_object_key(key_col))
                      .filter(F.col("__p.valid") & F.col("__p.file_type").isin(*expected)))
    bit = F.coalesce(*[F.when(F.col("__p.file_type") == t, F.lit(1 << i)) for i, t in enumerate(expected)])
    marked = parsed.select(F.col("__p.cycle_date").alias("cycle_date"), bit.cast("long").alias("mask"),
                           F.coalesce(F.col("modificationTime").cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("newest"))
    folded = marked.mapInArrow(_folded, "cycle_date string, mask long, newest timestamp")
    gate = CycleGate(expected, int(finished.total_seconds() * 1000), int(opened.total_seconds() * 1000))
    return folded.groupBy("cycle_date").transformWithStateInPandas(
        gate, "cycle_date string, received_types string, completed_at timestamp", "Append", "ProcessingTime")


def pass_on(handler):
    """``foreachBatch`` handler for :func:`cycle_transitions`: the batch's cycles, if any.  A
    batch that failed is delivered again, so the handler must bear a repeated cycle."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handler(batch, batch_id)
    return handle
