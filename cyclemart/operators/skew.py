"""Joins that split the heavy hitters of the large side, without adaptive execution (JN-2, JN-3).

A key that holds a third of the rows would go to one task of a shuffle join.  Spark's adaptive
execution can split such a partition, but only where the session allows it, and not where a
later join would reuse the partitioning.  Here the plan itself is even:

1. ``heavy_keys`` finds the frequent keys with Spark's mergeable frequent-items sketch, in one
   scan of the key columns.  Only keys with more than their share of a task count, so there
   are few, whatever the input.
2. ``salted`` gives the rows of a heavy key one of ``splits`` salts, by a hash of the row: a
   repeated task gives the same.  ``replicated`` copies the few matching rows of the other
   side once for every salt.
3. Both sides are joined on (keys, salt).  The salt stays on the result, so further joins on
   the same keys reuse its partitioning.

The sketch decides only how rows are dealt: the joined rows are the same whatever it finds.
Rows that are equal in every column share a salt.  NULL keys are spread like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Items that the sketch tracks; a key with more than about 1/5,000 of the rows is found.
TRACKED = 10_000
#: Pieces of the size of this part of a task's share: small enough to lie evenly.
PIECE = 1 / 8

#: Join types under which the right side may be replicated.
SPLITTABLE = {"inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"}


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: list[str], tasks: int, share: float = 0.5) -> DataFrame | None:
    """(h, splits) of the key hashes with more than ``share`` of a task's rows; None if there
    are none.  At most ``tasks / share`` rows, found by one scan of the key columns."""
    most = max(1, min(TRACKED // 2, math.ceil(tasks / share)))
    found = df.select(_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {TRACKED})").alias("top"), F.count("*").alias("n")).first()
    fair = max(found["n"] / tasks, 1)
    heavy = [(r["item"], math.ceil(r["count"] / (fair * PIECE))) for r in found["top"] if r["count"] > share * fair]
    if not heavy or tasks < 2:
        return None
    return df.sparkSession.createDataFrame([(h, min(n, 16 * tasks)) for h, n in heavy], "h long, splits int")


def _looked_up(df: DataFrame, keys: list[str], heavy: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with the splits of each row's key, a broadcast look-up of a bounded table."""
    met = df.join(F.broadcast(heavy.toDF("__h", "__splits")), _hash(keys) == F.col("__h"), "left")
    return met, F.coalesce(F.col("__splits"), F.lit(1))


def _row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    def hashable(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return hashable(t.elementType)
        if isinstance(t, T.StructType):
            return all(hashable(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))

    return F.xxhash64(F.lit("salt"), *[F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f.dataType)])


def salted(df: DataFrame, keys: list[str], heavy: DataFrame, salt: str) -> DataFrame:
    """The large side, its heavy keys spread over salts."""
    met, splits = _looked_up(df, keys, heavy)
    return met.withColumn(salt, F.pmod(_row_hash(df), splits.cast("long")).cast("int")).drop("__h", "__splits")


def replicated(df: DataFrame, keys: list[str], heavy: DataFrame, salt: str) -> DataFrame:
    """The other side, the rows of heavy keys once for every salt."""
    met, splits = _looked_up(df, keys, heavy)
    return met.withColumn(salt, F.explode(F.sequence(F.lit(0), splits - 1))).drop("__h", "__splits")


def tasks_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", heavy: DataFrame | None = None) -> DataFrame:
    """USING-style equi-join whose hot keys of ``left`` are split over tasks."""
    if how.lower() not in SPLITTABLE:
        raise ValueError(f"a {how} join cannot replicate its right side")
    heavy = heavy if heavy is not None else heavy_keys(left, keys, tasks_of(left))
    if heavy is None:
        return left.join(right, keys, how)
    salt = "__salt"
    return salted(left, keys, heavy, salt).join(replicated(right, keys, heavy, salt), [*keys, salt], how).drop(salt)
