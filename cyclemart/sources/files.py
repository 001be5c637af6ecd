"""File discovery, CSV ingest, provenance and staged Parquet (IO-1, IO-3..IO-7).

Layout, one for every stage::

    {landing}/raw/{file_type}/cycle_{yyyymmdd}/{file name}      landed files
    {staged}/{file_type}/cycle_date={yyyymmdd}/part-*.parquet    staged tables

Listing uses the ``binaryFile`` source without its ``content`` column, so only file
metadata is read; every file of one type and cycle is read into one DataFrame, so a
second file of a type adds rows instead of replacing the first.
"""

from __future__ import annotations

import csv
import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.paths import route_file_type
from cyclemart.functions.timeutil import instant
from cyclemart.session import empty_frame
from cyclemart.schemas import ENTITY_SCHEMAS, EXPECTED_FILE_TYPES
from cyclemart.sources.records import (
    BETWEEN, CORRUPT_COL, DIALECT, cut_records, header_text, layouts, not_blank, parsed, split_read, strict, with_layout,
)

log = logging.getLogger(__name__)


def _hadoop_path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below ``root`` (recursively): ``path, length, modificationTime``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def relative_key(path: str | Column, root: str) -> Column:
    """The object key of a listed file: its path after ``root`` (scheme-insensitive)."""
    col = F.col(path) if isinstance(path, str) else path
    bare = root.split(":", 1)[1] if ":" in root.split("/", 1)[0] else root
    marker = "/" + bare.strip("/") + "/"
    return F.substring_index(col, marker, -1)


def discover_cycle_files(
    spark: SparkSession,
    landing_root: str,
    cycle_date: str,
    file_types: list[str] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """IO-1: files of one cycle, each routed to the first expected type in its key.

    Output ``path, object_key, length, modificationTime, file_type``; files whose key
    names no expected type are dropped.
    """
    types = file_types or EXPECTED_FILE_TYPES
    pattern = f"{landing_root.rstrip('/')}/raw/*/cycle_{cycle_date}"
    if not _hadoop_path_exists(spark, pattern):
        return empty_frame(spark, "path string, object_key string, length long, "
                                  "modificationTime timestamp, file_type string")
    files = list_files(spark, pattern, glob)
    keyed = files.withColumn("object_key", relative_key("path", landing_root))
    return (keyed.withColumn("file_type", route_file_type("object_key", types))
                 .filter(F.col("file_type").isNotNull())
                 .select("path", "object_key", "length", "modificationTime", "file_type"))


def header_positions(header: list[str], names: list[str], where: str = "") -> list[int]:
    """The place of each column in a header; names match in any letter case."""
    places = {h.strip().lower(): i for i, h in reversed(list(enumerate(header)))}
    missing = [n for n in names if n.lower() not in places]
    if missing:
        raise ValueError(f"columns {missing} are missing in the header {header} {where}".rstrip())
    return [places[n.lower()] for n in names]


def _headers(spark: SparkSession, paths: list[str], glob: str | None) -> list[str]:
    """The distinct header lines of CSV files, read on the executors from the first splits."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(paths).filter(F.input_file_block_start() == 0).select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.monotonically_increasing_id().alias("n"), "value").alias("line"))
    first = lines.groupBy("file").agg(F.min("line").alias("line")).select(header_text("line.value").alias("header"))
    return sorted(r["header"] for r in first.distinct().collect())


def csv_lines(spark: SparkSession, paths: list[str], glob: str | None = None) -> DataFrame:
    """(file, chunk, value): the lines of text files, in order in the tasks; a chunk is a split."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"), "value")


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None,
    header: bool = True,
    keep_corrupt: bool = False,
    infer_schema: bool = False,
    by_name: bool = True,
    multi_line: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """IO-3: CSV with an explicit schema (inference only on request).

    ``by_name`` (with a header): columns are matched to the schema by header name, in any
    letter case, and cast with ``try_cast`` (a bad value becomes NULL, which the quality
    rules then see); a schema column that a header lacks raises.  Without ``by_name``
    columns are taken by position.  ``keep_corrupt`` adds ``_corrupt_record``, which holds
    the records that have too few or too many fields; without it reading one fails.
    ``multi_line`` allows line breaks in quoted fields.  Such files are read in splits like
    any other (:mod:`cyclemart.sources.records`), and so are files whose headers differ.
    """
    paths = paths if isinstance(paths, list) else [paths]
    reader = spark.read.options(**DIALECT).option("header", str(header).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is None:
        if not infer_schema:
            raise ValueError("pass a schema, or infer_schema=True")
        return reader.option("multiLine", str(multi_line).lower()).option("inferSchema", "true").csv(paths)
    reader = reader.option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    extra = []
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        extra = [T.StructField(CORRUPT_COL, T.StringType(), True)]
    if not (header and by_name) and not multi_line:
        return reader.schema(T.StructType([*schema.fields, *extra])).csv(paths)
    texts = None if multi_line else _headers(spark, paths, glob)
    if texts is not None and len(texts) == 1:
        return _one_layout(reader, paths, schema, extra, texts[0])
    if texts == []:  # no file, or only empty ones
        return empty_frame(spark, T.StructType([*schema.fields, *extra]))
    lines = csv_lines(spark, paths, glob)
    found, states = split_read(lines, header)
    named = states.filter(F.col("header").isNotNull()).select("file", header_text("header").alias("header"))
    if header and by_name:
        places, texts = layouts(named, schema.names)
        if not places:
            return empty_frame(spark, T.StructType([*schema.fields, *extra]))
    else:
        places, texts = [(list(range(len(schema.names))), len(schema.names))], []
    if found is None and len(places) == 1:  # no record spans lines: Spark's own reader will do
        if header and by_name:
            return _one_layout(reader, paths, schema, extra, texts[0])
        return reader.schema(T.StructType([*schema.fields, *extra])).csv(paths)
    if found is None:
        cut = cut_records(lines.withColumn("enters", F.lit(BETWEEN))).filter(~F.col("first") | F.lit(not header))
        found = cut.select("file", "record", F.col("record").alias("raw")).filter(not_blank())
    rows = parsed(with_layout(found, named, texts), schema, places, F.col("raw"))
    return rows if keep_corrupt else strict(rows, schema)


def _one_layout(reader, paths: list[str], schema: T.StructType, extra: list[T.StructField], header: str) -> DataFrame:
    """Files that have one header, by Spark's CSV reader."""
    names = next(csv.reader([header]), [])
    places = header_positions(names, schema.names)
    text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))] + extra)
    return reader.schema(text).csv(paths).select(
        *[F.col(f"_c{p}").try_cast(f.dataType).alias(f.name) for p, f in zip(places, schema.fields)], *[f.name for f in extra])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write ``df`` as CSV part files (used to land test files)."""
    df.write.mode("overwrite").options(**DIALECT).option("header", str(header).lower()).csv(path)


def with_provenance(df: DataFrame, cycle_date: str, file_type: str | Column,
                    ingested_at: dt.datetime | Column) -> DataFrame:
    """IO-4: ``ingestion_date``, ``cycle_date``, ``file_type``, replacing same-named inputs."""
    ts = instant(ingested_at)
    ft = file_type if isinstance(file_type, Column) else F.lit(file_type)
    return df.withColumns({
        "ingestion_date": ts,
        "cycle_date": F.lit(cycle_date).cast("string"),
        "file_type": ft.cast("string"),
    })


def stage_parquet(df: DataFrame, staged_root: str, file_type: str, cycle_date: str | None = None) -> str:
    """IO-5: replace staged partitions of ``{staged_root}/{file_type}``; others stay.

    With ``cycle_date`` the rows are that cycle's, and its partition is replaced even when
    there are none.  Without it the rows name their cycles, and those are replaced.  Rows
    are rebalanced by cycle first: a few files for each, large cycles split.
    """
    path = f"{staged_root.rstrip('/')}/{file_type}"
    if cycle_date is not None:
        rows = df.drop("cycle_date").hint("rebalance")
        rows.write.mode("overwrite").parquet(f"{path}/cycle_date={cycle_date}")
        return path
    (df.hint("rebalance", "cycle_date").write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("cycle_date")
       .parquet(path))
    return path


def remove_staged(spark: SparkSession, staged_root: str, file_type: str, cycle_date: str) -> None:
    """Remove one cycle of a staged table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{staged_root.rstrip('/')}/{file_type}/cycle_date={cycle_date}")  # noqa: SLF001
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def staged_schema(file_type: str) -> T.StructType:
    base = ENTITY_SCHEMAS[file_type]
    fields = [f for f in base.fields if f.name != "cycle_date"]
    fields += [T.StructField("ingestion_date", T.TimestampType(), True),
               T.StructField("file_type", T.StringType(), True),
               T.StructField("cycle_date", T.StringType(), True)]
    return T.StructType(fields)


def read_staged(spark: SparkSession, staged_root: str, file_type: str, cycle_date: str,
                schema: T.StructType | None = None) -> DataFrame:
    """IO-7: partition-pruned read of one cycle (``cycle_date`` kept as STRING)."""
    path = f"{staged_root.rstrip('/')}/{file_type}"
    schema = schema or staged_schema(file_type)
    return (spark.read.schema(schema).option("basePath", path).parquet(path)
                 .where(F.col("cycle_date") == F.lit(cycle_date)))


def load_cycle(
    spark: SparkSession,
    staged_root: str,
    cycle_date: str,
    file_types: list[str] | None = None,
    missing: str = "skip",
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """IO-6: the staged tables of one cycle.

    ``missing="skip"`` leaves an absent table out (with a warning); ``"error"`` raises.
    Only a missing path counts as absent; any other error propagates.
    """
    out: dict[str, DataFrame] = {}
    for file_type in file_types or EXPECTED_FILE_TYPES:
        path = f"{staged_root.rstrip('/')}/{file_type}/cycle_date={cycle_date}"
        if not _hadoop_path_exists(spark, path):
            if missing == "error":
                raise FileNotFoundError(f"no staged {file_type} for cycle {cycle_date}")
            log.warning("no staged %s for cycle %s: skipped", file_type, cycle_date)
            continue
        schema = (schemas or {}).get(file_type) or (staged_schema(file_type)
                                                   if file_type in ENTITY_SCHEMAS else None)
        out[file_type] = read_staged(spark, staged_root, file_type, cycle_date, schema)
    return out
