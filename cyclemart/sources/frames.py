"""Encrypted CSV files of any size, as frames that are decrypted by many tasks (IO-2).

A file is a header line and records, cut at line breaks into frames of about ``FRAME_CHARS``.
Each frame is one line of armoured text, so Spark's own text source plans the splits, in any
store that Spark reads, and no row ever holds a file:

    CMF1:<sealed data key>:<file id>:<number>:<enters>:<leaves>:<last>:<ciphertext>

The data key is the file's own; it is sealed with the key ring and names its key there.  The
frame's fields from the file id on are authenticated with the ciphertext, so frames cannot be
exchanged, reordered or cut off unnoticed: a frame that is damaged is rejected alone, a file
with missing or repeated frames is rejected, too, beside the records it still has.

``enters`` and ``leaves`` say whether the frame begins and ends inside a quoted field (see
:mod:`cyclemart.sources.records`), which the writer knows.  So a frame is cut into records
without any other frame, also after a damaged one; the pieces of records that cross frames
are joined by a shuffle of those pieces alone.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.crypto import one_line
from cyclemart.functions.keyring import KeyRing, rewrapped, unwrap, wrap
from cyclemart.session import materialize
from cyclemart.sources.records import (
    BETWEEN, DIALECT, HEAD, LOST, MIDDLE, OPEN, WHOLE, after_line, cut_records, header_text, joined_pieces, layouts,
    not_blank, parsed, strict, with_layout,
)

FRAME_CHARS = 4_000_000
MARK = "CMF1"


def _frames(batches: Iterator[pa.RecordBatch], header: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Records to the frames of one file: (file_id, data_key, n, enters, leaves, last, text)."""
    file_id, data_key = uuid.uuid4().hex, os.urandom(32)
    lines, size, n, state, enters = [header], len(header), 0, BETWEEN, BETWEEN

    def frame(last: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([file_id]), pa.array([data_key], pa.binary()), pa.array([n], pa.int64()), pa.array([enters], pa.int32()),
             pa.array([state], pa.int32()), pa.array([int(last)], pa.int32()), pa.array(["\n".join(lines)])],
            names=["file_id", "data_key", "n", "enters", "leaves", "last", "text"])

    seen = False
    for batch in batches:
        for record in batch.column(0).to_pylist():
            seen = True
            for line in record.split("\n"):
                if size > limit:
                    yield frame(False)
                    lines, size, n, enters = [], 0, n + 1, state
                state = after_line(state, line)
                lines.append(line)
                size += len(line) + 1
    if seen:
        yield frame(True)


def _bound(*columns: str) -> Column:
    """What a frame's ciphertext is authenticated with."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns]).cast("binary")


BOUND = ("file_id", "n", "enters", "leaves", "last")


def write_encrypted_frames(df: DataFrame, path: str, ring: KeyRing, frame_chars: int | None = None) -> None:
    """Land ``df`` as framed encrypted CSV, a file for each task."""
    limit = frame_chars or FRAME_CHARS
    names = df.columns
    head = ",".join('"' + n.replace('"', '""') + '"' for n in names)
    records = df.select(F.to_csv(F.struct(*[F.col(c) for c in names]), DIALECT).alias("record"))
    frames = records.mapInArrow(
        lambda batches: _frames(batches, head, limit),
        "file_id string, data_key binary, n long, enters int, leaves int, last int, text string")
    frames = frames.select(F.inline(F.array(F.struct(*frames.columns))))  # a file's key is drawn once
    cipher = F.aes_encrypt(F.col("text").cast("binary"), F.col("data_key"), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _bound(*BOUND))
    line = F.concat_ws(":", F.lit(MARK), one_line(wrap(F.col("data_key"), ring)), *[F.col(c).cast("string") for c in BOUND], one_line(cipher))
    frames.select(line.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)


def _landed(spark: SparkSession, paths: str | list[str], glob: str | None) -> DataFrame:
    """(path, file, wrapped, file_id, n, enters, leaves, last, cipher): frames as they lie;
    ``file`` is the file's id, whatever files its frames have been copied to."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.option("lineSep", "\n").text(paths).filter(F.length("value") > 0)
    head = F.split(F.substring_index("value", ":", 7), ":")
    fields = [head[i + 2].try_cast("string" if c == "file_id" else "long" if c == "n" else "int").alias(c) for i, c in enumerate(BOUND)]
    marked = F.size(head) == 7
    cipher = F.when(marked, F.expr("substr(value, length(substring_index(value, ':', 7)) + 2)"))
    path = F.col("_metadata.file_path")
    return lines.select(
        path.alias("path"), F.coalesce(F.when(marked, head[2]), path).alias("file"),
        F.when(marked & (head[0] == MARK), head[1]).alias("wrapped"),
        *[F.when(marked, f).alias(c) for f, c in zip(fields, BOUND)], cipher.alias("cipher"))


def _opened(ring: KeyRing) -> Column:
    """The text of a frame; NULL if damaged, or its key is not in the ring."""
    key = unwrap(F.try_to_binary("wrapped", F.lit("base64")), ring)
    return F.try_aes_decrypt(F.try_to_binary("cipher", F.lit("base64")), key, F.lit("GCM"), F.lit("DEFAULT"), _bound(*BOUND)).cast("string")


def _blocks(frames: DataFrame, ring: KeyRing) -> DataFrame:
    return frames.select("file", F.coalesce("n", F.lit(-1)).alias("chunk"), F.coalesce("enters", F.lit(BETWEEN)).alias("enters"), _opened(ring).alias("value"))


def read_encrypted_frames(
    spark: SparkSession, paths: str | list[str], ring: KeyRing, schema: T.StructType,
    keep_corrupt: bool = False, glob: str | None = None,
) -> DataFrame:
    """Read framed encrypted CSV, columns by header name.

    Corrupt rows name what was lost: a damaged frame, a file with missing or repeated frames,
    a record that crosses into a lost frame (with its remaining text), a wrong field count.
    """
    landed = _landed(spark, paths, glob)
    first = F.when(F.col("n") == 0, header_text(F.substring_index(_opened(ring), "\n", 1)))
    index = materialize(landed.select("path", "file", *BOUND, first.alias("header")))
    names = schema.names
    named = index.filter(F.length("header") > 0).select("file", "header")
    places, texts = layouts(named, names)
    places = places or [(list(range(len(names))), len(names))]

    # a frame whose header is not whole counts as one that is missing
    complete = (F.count_if(F.col("n").isNotNull()) == F.max("n") + 1) & (F.count_distinct("n") == F.max("n") + 1) \
        & (F.max_by("last", "n") == 1) & (F.count_if(F.col("last") == 1) == 1)
    of_file = index.groupBy("file").agg(
        F.coalesce(complete, F.lit(False)).alias("complete"), F.max(F.col("header").isNotNull()).alias("headed"), F.min("path").alias("path"))
    missing = of_file.filter(~F.col("complete")).select(
        "file", F.lit(None).cast("string").alias("record"), F.concat("path", F.lit(": frames are missing or repeated")).alias("raw"))

    cut = cut_records(_blocks(landed, ring))
    lost = F.col("kind") == LOST
    whole = cut.filter((F.col("kind") == WHOLE) | lost).filter(~F.col("first")).select("file", "record", F.when(
        lost, F.concat(F.lit("frame "), F.col("chunk").cast("string"), F.lit(" of "), "file")).otherwise(F.col("record")).alias("raw"))
    crossing = (F.col("enters") != BETWEEN) | (F.col("leaves") != BETWEEN)
    found = whole.unionByName(missing)
    if not index.filter(crossing).isEmpty():
        pieces = cut_records(_blocks(landed.filter(crossing), ring)).filter(F.col("kind").isin(HEAD, OPEN, MIDDLE))
        records, remains = joined_pieces(materialize(pieces), step=1)
        found = found.unionByName(records.select("file", "record", F.col("record").alias("raw"))).unionByName(
            remains.select("file", F.lit(None).cast("string").alias("record"), F.col("record").alias("raw")))
    unheaded = not of_file.filter(~F.col("headed")).isEmpty()  # the records of such a file are corrupt
    rows = parsed(with_layout(found.filter(not_blank()), named, texts, always=unheaded), schema, places, F.col("raw"))
    return rows if keep_corrupt else strict(rows, schema)


def rewrap_frames(spark: SparkSession, source: str, target: str, ring: KeyRing) -> None:
    """Rotate stored files to the ring's current key: only the sealed data keys are made new,
    the contents are copied as they are.  Frames that the ring cannot open stay as they are."""
    lines = spark.read.option("lineSep", "\n").text(source)
    head = F.substring_index("value", ":", 2)
    sealed = F.try_to_binary(F.substring_index(head, ":", -1), F.lit("base64"))
    fresh = one_line(rewrapped(sealed, ring))
    value = F.when(fresh.isNotNull(), F.concat(F.lit(MARK + ":"), fresh, F.expr("substr(value, length(substring_index(value, ':', 2)) + 1)")))
    lines.select(F.coalesce(value, F.col("value")).alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 0).text(target)
