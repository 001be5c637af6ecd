"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.session import scratch_path

#: A side is broadcast by our own choice only up to this many rows of a few machine words.
BROADCAST_ROWS = 200_000
#: Rows of a few machine words that are worth a task.
TASK_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` made different from every column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch space and read it back.

    Cuts the lineage with files every executor can see, so that a lost executor costs a
    re-read, not a recomputation, and so that values that depend on the physical
    partitioning are fixed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_tasks(df: DataFrame, rows: int, a_task: int = TASK_ROWS) -> DataFrame:
    """``df``, which has at most ``rows`` rows, in a task for every ``a_task`` of them: where
    adaptive execution does not merge them, a small table is else read and written by as many
    tasks as a shuffle has partitions."""
    return df.coalesce(max(1, math.ceil(rows / a_task)))


def bounded_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """At most ``rows`` rows in an Arrow batch that goes to Python: long texts make a batch of
    Spark's 10,000 large, in the executor's memory and in the worker's."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting))
    if now <= 0 or now > rows:
        spark.conf.set(setting, str(rows))


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(column: str | Column) -> Column:
    """128 bits of a text (NULL counts as empty), to tell rows with one id apart."""
    text = text_or_empty(column)
    return F.unhex(F.md5(text.cast("binary")))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows: the check before a broadcast hint."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it is counted small, else as it is (shuffle join)."""
    return F.broadcast(df) if small(df, limit) else df
