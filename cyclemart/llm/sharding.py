"""Sharding by jump consistent hashing (Lamping and Veach): no ring table, minimal movement.

``key`` law: the key and the number of shards alone decide the shard.  With one more shard
a row either stays or goes to the new shard.

Integer keys are hashed as they are, other keys through xxhash64; a NULL key counts as 0.
Slots number the rows of a shard 0, 1, 2, ... in key order.  They are numbered in parallel:
rows are range-partitioned by key with a per-row tie breaker, so even a key that holds a
third of all rows spreads over partitions; each (range, shard) is numbered by itself and
offset by the rows of the ranges before it.  No shard is gathered in one task.

Defined cases: a NULL text has size 1 and checksum 0, like an empty one; rows that repeat
a key share its shard and get their own slots; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cyclemart.llm.common import stored

#: Fixed values of the published algorithm: the generator's multiplier, its 31-bit scale.
MULTIPLIER = np.uint64(2862933555777941757)
SCALE = float(1 << 31)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, for all keys at once."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.full(len(state), -1, np.int64)
    reach = np.zeros(len(state), np.int64)
    live = np.flatnonzero(reach < shards)
    while live.size:
        shard[live] = reach[live]
        state[live] = state[live] * MULTIPLIER + np.uint64(1)
        step = SCALE / ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        reach[live] = ((shard[live] + 1) * step).astype(np.int64)
        live = live[reach[live] < shards]
    return shard


def shard_of(key, shards: int):
    """Column: the shard of ``key`` among ``shards``."""

    @F.pandas_udf(T.IntegerType())
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return jump(key)


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    integral = isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    hashed = F.col("k") if integral else F.xxhash64("k")
    payload = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("k"),
        (F.octet_length(payload).cast("long") + 1).alias("size"),
        F.crc32(payload).alias("text_crc32"),
    ).withColumn("row", F.monotonically_increasing_id())
    ranged = (
        rows.repartitionByRange("k", "text_crc32", "size", "row")
        .withColumn("part", F.spark_partition_id())
        .withColumn("h", F.coalesce(hashed.cast("long"), F.lit(0).cast("long")))
        .withColumn("shard", shard_of(F.col("h"), shards))
        .withColumn("grown_shard", shard_of(F.col("h"), shards + 1))
        .drop("h")
    )
    ranged = stored(ranged, "shards")  # the ranges are fixed here
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select(F.col("shard").alias("o_shard"), F.col("part").alias("o_part"),
                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("part", "shard").orderBy("k", "text_crc32", "size", "row")
    return (
        ranged.withColumn("n", F.row_number().over(within))
        .join(offsets, (F.col("shard") == F.col("o_shard")) & (F.col("part") == F.col("o_part")))
        .select(
            F.col("k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("offset") + F.col("n") - 1).alias("slot"), "grown_shard",
        )
    )
