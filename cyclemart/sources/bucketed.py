"""Staged tables that are joined where they lie (JN-2, JN-3).

The tables of a cycle that are joined on one key are staged with the same number of buckets,
dealt and sorted by that key.  Bucket ``i`` of one table then matches bucket ``i`` of the others,
and the sort-merge joins of a star need no exchange on either side, however large the tables
are and as often as they are joined.

A hot key would make one bucket large for good.  So the fact's heavy hitters are split when it
is staged (:mod:`cyclemart.operators.skew`): every table has a salt beside the key, 0 but for
heavy keys, whose rows are spread in the fact and copied in the dimensions.  The joins are on
(key, salt).

The folders hold plain Parquet files in the staged layout.  Spark knows about buckets only from
a catalog table, so a read declares one for a moment; nothing is left in the catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.operators.skew import heavy_keys, replicated, salted

SALT = "__salt"


def _folder(root: str, table: str, cycle_date: str) -> str:
    return f"{root.rstrip('/')}/{table}/cycle_date={cycle_date}"


def _with_table(spark: SparkSession, make):
    """What ``make`` gives for the name of a table that is dropped again; its files stay."""
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    try:
        return make(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, path: str, columns: list[str], buckets: int, **options: str) -> None:
    """Write ``df`` in buckets of ``columns``, a file for each, replacing what ``path`` held."""
    dealt = df.repartition(buckets, *columns)  # dealt as buckets are
    _with_table(df.sparkSession, lambda name: dealt.write.mode("overwrite").options(path=path, **options)
                .bucketBy(buckets, *columns).sortBy(*columns).format("parquet").saveAsTable(name))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, columns: list[str], buckets: int) -> DataFrame:
    """What :func:`write_bucketed` has written, with its buckets."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by, where = ", ".join(f"`{c}`" for c in columns), path.replace("'", "\\'")

    def declared(name: str) -> DataFrame:
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'")
        return spark.table(name)

    return _with_table(spark, declared)


def stage_colocated(tables: dict[str, DataFrame], fact: str, key: str, root: str, cycle_date: str, buckets: int) -> None:
    """Stage ``tables`` for joins on ``key``; each replaces what its folder held."""
    heavy = heavy_keys(tables[fact], [key], buckets)
    for name, df in tables.items():
        df = df.drop("cycle_date")
        if heavy is None:
            rows = df.withColumn(SALT, F.lit(0))
        else:
            rows = (salted if name == fact else replicated)(df, [key], heavy, SALT)
        write_bucketed(rows, _folder(root, name, cycle_date), [key, SALT], buckets)


def read_colocated(spark: SparkSession, root: str, table: str, cycle_date: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A staged table with its buckets; ``schema`` is that of the table without the salt."""
    fields = [f for f in schema.fields if f.name != "cycle_date"]
    whole = T.StructType([*fields, T.StructField(SALT, T.IntegerType())])
    return read_bucketed(spark, _folder(root, table, cycle_date), whole, [key, SALT], buckets)


def colocated_join(tables: dict[str, DataFrame], fact: str, key: str, steps: list[tuple[str, str]]) -> DataFrame:
    """The fact joined bucket by bucket with each (table, how) of ``steps``, without the salt."""
    out = tables[fact]
    for name, how in steps:
        out = out.join(tables[name].hint("merge"), [key, SALT], how)
    return out.drop(SALT)
