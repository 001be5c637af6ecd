"""Encrypted CSV ingest, decrypted on the executors (IO-2).

Three on-disk forms, all produced and read with Spark's built-in AES (GCM):

* **line** form: every CSV record is ``base64(aes_encrypt(record))`` on its own text line.
  Files split like any text file.
* **whole-file** form: the file is the ``aes_encrypt`` output of the whole CSV text (header
  line first).  It is read through the ``binaryFile`` source, one file per row, so a single
  file must stay below Spark's 2 GB binary-row limit.
* **framed** form, for files of any size: see :mod:`cyclemart.sources.frames`.

With a :class:`~cyclemart.functions.keyring.KeyRing` in place of a key, what is written names
its key (files through a data key of their own, sealed with the ring), and what is read is
decrypted with the key that it names.

Decrypted records of all forms, and of plain CSV, are parsed by the same code
(:func:`cyclemart.sources.records.parsed`): fields may hold line breaks and have any length,
bad values become NULL, and a record with too few or too many fields is corrupt.

What does not decrypt, or does not parse, is never lost silently: reading fails by default,
and with ``keep_corrupt`` such rows come back with the raw line (or the path of the file) in
``_corrupt_record``.
"""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.crypto import _key, decrypt_column, encrypt_bytes, encrypt_column, try_decrypt_bytes
from cyclemart.functions.keyring import KeyRing, unwrap, wrap
from cyclemart.sources.records import (
    BETWEEN, DIALECT, LOST, WHOLE, cut_records, header_text, layouts, not_blank, parsed, strict, with_layout,
)

Key = str | bytes | KeyRing

FILE_CHARS = 4_000_000  # of a file that is encrypted as a whole, and one record more
HELD_CHARS = 8 * FILE_CHARS  # that a task has not yet written
ENVELOPE = b"CME1"  # a file with a data key of its own: magic, length of the sealed key, it, content


def write_encrypted_lines(df: DataFrame, path: str, key: Key) -> None:
    """Land ``df`` as line-encrypted CSV (no header: the schema travels with the job)."""
    line = F.to_csv(F.struct(*[F.col(c) for c in df.columns]), DIALECT)
    df.select(encrypt_column(line, key).alias("value")).write.mode("overwrite").text(path)


def read_encrypted_lines(spark: SparkSession, paths: str | list[str], key: Key,
                         schema: T.StructType, keep_corrupt: bool = False, glob: str | None = None) -> DataFrame:
    """Read line-encrypted CSV; decryption and parsing run per line on the executors."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    raw = reader.text(paths if isinstance(paths, list) else [paths]).filter(F.length("value") > 0)
    records = raw.select(F.col("value").alias("raw"), decrypt_column("value", key).alias("record"), F.lit(0).alias("layout"))
    width = len(schema.names)
    rows = parsed(records, schema, [(list(range(width)), width)], F.col("raw"))
    return rows if keep_corrupt else strict(rows, schema)


def _decrypted(content: Column, key: Key, mode: str) -> Column:
    """The text of a file that was encrypted as a whole; NULL if it does not decrypt."""
    if not isinstance(key, KeyRing):
        return try_decrypt_bytes(content, key, mode).cast("string")
    size = F.conv(F.hex(F.substring(content, len(ENVELOPE) + 1, 2)), 16, 10).cast("int")
    start = len(ENVELOPE) + 3
    wrapped = F.substring(content, F.lit(start), size)
    body = F.substring(content, size + start, F.length(content))
    opened = F.try_aes_decrypt(body, unwrap(wrapped, key), F.lit("GCM")).cast("string")
    return F.when(F.substring(content, 1, len(ENVELOPE)) == F.lit(ENVELOPE), opened)


def read_encrypted_files(spark: SparkSession, paths: str | list[str], key: Key,
                         schema: T.StructType, header: bool = True,
                         keep_corrupt: bool = False, mode: str = "GCM", glob: str | None = None) -> DataFrame:
    """Read whole-file encrypted CSV (``binaryFile`` -> decrypted text -> records).

    Columns are matched by header name.  A file that fails to decrypt yields one corrupt row
    that names its path.
    """
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)
    text = files.select(F.col("path").alias("file"), F.lit(0).cast("long").alias("chunk"), F.lit(BETWEEN).alias("enters"),
                        _decrypted(F.col("content"), key, mode).alias("value"))
    names = schema.names
    places, texts, named = [(list(range(len(names))), len(names))], [], None
    if header:
        named = text.select("file", header_text(F.substring_index("value", "\n", 1)).alias("header")).filter(F.length("header") > 0)
        places, texts = layouts(named, names)
        places = places or [(list(range(len(names))), len(names))]
    cut = cut_records(text).filter(~F.col("first") | F.lit(not header))
    lost = F.col("kind") == LOST
    found = cut.select(
        "file", F.when(F.col("kind") == WHOLE, F.col("record")).alias("record"),
        F.when(lost, F.col("file")).otherwise(F.concat_ws(": ", "file", "record")).alias("raw")).filter(not_blank())
    placed = with_layout(found, named, texts)
    rows = parsed(placed, schema, places, F.col("raw"))
    return rows if keep_corrupt else strict(rows, schema)


def _csv_files(batches: Iterator[pa.RecordBatch], names: list[str], place: int, limit: int, held_limit: int) -> Iterator[pa.RecordBatch]:
    """(value, text, data key): CSV files of one value each, header first, of bounded size."""
    files: dict[str | None, io.StringIO] = {}
    held = 0

    def out(value: str | None) -> pa.RecordBatch:
        text = files.pop(value).getvalue()
        return pa.RecordBatch.from_arrays(
            [pa.array([value], pa.string()), pa.array([text], pa.string()), pa.array([os.urandom(32)], pa.binary())],
            names=["value", "text", "data_key"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            value, before = row[place], 0
            if value in files:
                before = files[value].tell()
            else:
                files[value] = io.StringIO(newline="")
                csv.writer(files[value], lineterminator="\n").writerow(names)
            csv.writer(files[value], lineterminator="\n").writerow(row)
            size = files[value].tell()
            held += size - before
            if size > limit:
                held -= size
                yield out(value)
            if held > held_limit:
                yield from map(out, list(files))
                held = 0
    yield from map(out, list(files))


def _encrypted(text: Column, data_key: Column, key: Key, mode: str) -> Column:
    if not isinstance(key, KeyRing):
        return encrypt_bytes(text.cast("binary"), key, mode)
    wrapped = wrap(data_key, key)
    size = F.unhex(F.lpad(F.hex(F.length(wrapped)), 4, "0"))
    return F.concat(F.lit(ENVELOPE), size, wrapped, F.aes_encrypt(text.cast("binary"), data_key, F.lit("GCM")))


def write_encrypted_files(df: DataFrame, path: str, key: Key, by: str, mode: str = "GCM") -> None:
    """Land ``df`` as whole-file encrypted CSV, each file with rows of one value of ``by``.

    The tasks write the files, of about ``FILE_CHARS`` at most, however many rows a value
    has.  ``path`` must be in a shared store that Arrow can open; files of a failed attempt
    are written again under the same names.
    """
    spark, names, place = df.sparkSession, df.columns, df.columns.index(by)
    limit, held = FILE_CHARS, HELD_CHARS
    text = df.select(*[F.col(c).cast("string") for c in names]).mapInArrow(
        lambda batches: _csv_files(batches, names, place, limit, held), "value string, text string, data_key binary")
    sealed = text.select("value", F.inline(F.array(F.struct("text", "data_key"))))  # one key a file, drawn once
    files = sealed.select("value", _encrypted(F.col("text"), F.col("data_key"), key, mode).alias("content"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    fs.mkdirs(folder)
    qualified = fs.makeQualified(folder).toUri()
    uri = qualified.getPath() if qualified.getScheme() == "file" else qualified.toString()

    def write(rows: Iterator) -> None:
        context = TaskContext.get()
        store, root = pyarrow.fs.FileSystem.from_uri(uri)
        for n, row in enumerate(rows):
            name = f"{by}-{quote(row['value'] or '', safe='')}-{context.partitionId():05d}-{n:05d}.csv.pgp"
            begun = f"{root}/_{context.taskAttemptId()}-{name}"  # readers skip such names
            with store.open_output_stream(begun) as out:
                out.write(bytes(row["content"]))
            store.move(begun, f"{root}/{name}")

    files.foreachPartition(write)


def encrypt_text(spark: SparkSession, text: str, key: str | bytes, mode: str = "GCM") -> bytes:
    """Encrypt one small text with Spark's AES (used to land whole-file fixtures)."""
    row = spark.range(1).select(F.aes_encrypt(F.lit(text).cast("binary"), _key(key), F.lit(mode)).alias("c")).first()
    return bytes(row["c"])
