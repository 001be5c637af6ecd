"""CSV records out of lines that are read in pieces, by many tasks (IO-2, IO-3).

A quoted field may hold line breaks, so whether a line break ends a record depends on all the
quotes before it.  Files are still read in splits:

1. For each chunk of a file (a split, an encrypted frame) the *quote-state function* is
   found: in which state it ends if it begins between records, and if it begins inside a
   quoted field.  Of the two states that makes four functions: identity, two constants, swap.
2. Composed as a prefix over the chunks of a file, they give the state each begins in.  There
   is one small row a chunk; the composition is a window over them: the last constant before
   a chunk, and the parity of the swaps since.
3. Each chunk is cut into records from its own state.  A record that crosses chunks comes out
   in pieces, which alone are shuffled and joined again.

Dialect, one for all forms of input: fields separated by commas, quoted with ``"``, a quote
inside a quoted field doubled; records end at ``\\n`` or ``\\r\\n``, and of one that ends at
``\\r\\n`` the quoted line breaks become ``\\n``; an empty field is NULL, quoted or not; a
quote inside an unquoted field is an ordinary character; after a closing quote anything up to
the next comma belongs to the field; blank lines are no records.  A record whose quote never
closes, or longer than ``MAX_RECORD_CHARS``, is a corrupt one and keeps its text, in pieces.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

CORRUPT_COL = "_corrupt_record"
MAX_RECORD_CHARS = 256_000_000
#: Chunks that begin inside a record are broadcast up to this number, else joined by shuffle.
MAX_BROADCAST_CHUNKS = 500_000

#: How records are written and read, wherever Spark's CSV functions do it.
DIALECT = {"escape": '"', "quote": '"', "sep": ",", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

BETWEEN, INSIDE = 0, 1  # states at a line break
WHOLE, HEAD, OPEN, MIDDLE, LOST = range(5)  # a record; the end, the begin, an inner piece of one; what could not be read

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELDS = rf'(?:{_QUOTED}|[^",][^,]*+|)(?:,(?:{_QUOTED}|[^",][^,]*+|))*+'
_ENDS_RECORD = re.compile(_FIELDS, re.DOTALL)
_ENDS_QUOTED = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,(?:{_QUOTED}|[^",][^,]*+|))*+', re.DOTALL)


def after_line(state: int, line: str) -> int:
    """The state at the end of a line that is entered in ``state``."""
    if '"' not in line:
        return state
    return BETWEEN if (_ENDS_QUOTED if state else _ENDS_RECORD).fullmatch(line) else INSIDE


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, chunk, first row, end row) of neighbouring rows of one chunk."""
    if not len(batch):
        return
    chunk = batch.column(1).to_numpy()
    file = batch.column(0).dictionary_encode()
    code = file.indices.to_numpy()
    new = np.flatnonzero((chunk[1:] != chunk[:-1]) | (code[1:] != code[:-1])) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), len(batch)]):
        yield file.dictionary[code[a]].as_py(), int(chunk[a]), a, b


def _state_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, chunk, value) to (file, chunk, between, inside, spans, header): for each chunk
    the states it ends in, whether it has a record of several lines, and its first line."""
    key, row = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, *row)))], schema=kinds)

    names = ["file", "chunk", "between", "inside", "spans", "header"]
    kinds = pa.schema([("file", pa.string()), ("chunk", pa.int64()), ("between", pa.int32()), ("inside", pa.int32()),
                       ("spans", pa.bool_()), ("header", pa.string())])
    for batch in batches:
        lines = batch.column(2)
        quoted = pc.fill_null(pc.match_substring(lines, '"'), False).to_numpy(zero_copy_only=False)
        for file, chunk, a, b in _runs(batch):
            if (file, chunk) != key:
                if key is not None:
                    yield out()
                key, row = (file, chunk), [BETWEEN, INSIDE, False, lines[a].as_py() if chunk == 0 else None]
            for i in (np.flatnonzero(quoted[a:b]) + a).tolist():
                line = lines[i].as_py()
                row[0], row[1] = after_line(row[0], line), after_line(row[1], line)
                row[2] |= row[0] == INSIDE
    if key is not None:
        yield out()


def chunk_states(lines: DataFrame) -> DataFrame:
    """(file, chunk, between, inside, spans, header) of the chunks of ``lines`` (file, chunk,
    value), whose rows must lie in order in the tasks."""
    return lines.mapInArrow(
        _state_functions, "file string, chunk long, between int, inside int, spans boolean, header string")


def entering(states: DataFrame) -> DataFrame:
    """``states`` with ``enters``, the state in which each chunk begins: the functions of the
    chunks before it in the file, composed."""
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("between") == F.col("inside")
    swap = ((F.col("between") == INSIDE) & (F.col("inside") == BETWEEN)).cast("int")
    marked = states.withColumn("swaps", F.sum(swap).over(so_far)).withColumn(
        "fixed", F.when(constant, F.struct(F.col("between").alias("state"), "swaps")))
    last = F.last("fixed", ignorenulls=True).over(before)
    swaps = F.coalesce(F.max("swaps").over(before), F.lit(0))
    with_last = marked.withColumn("last", last).withColumn("seen", swaps)
    state = F.coalesce(F.col("last.state"), F.lit(BETWEEN))
    since = F.col("seen") - F.coalesce(F.col("last.swaps"), F.lit(0))
    return with_last.withColumn("enters", (state + since) % 2).drop("swaps", "fixed", "last", "seen")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, chunk, enters, value) to (file, chunk, kind, first, record).

    A value is one line or several, joined by line breaks; NULL is a chunk that could not be
    read.  ``first`` marks the first record of a file.  Batches without quotes pass through
    as they are.
    """
    names = ["file", "chunk", "kind", "first", "record"]
    key, state, parts, own, begun = None, BETWEEN, [], True, False

    def left() -> list[tuple]:
        """What a chunk ends with inside a record."""
        return [(OPEN if own else MIDDLE, False, "\n".join(parts))] if state == INSIDE else []

    def rows(file: str, chunk: int, found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * len(found), pa.string()), pa.array([chunk] * len(found), pa.int64()),
             pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.bool_()),
             pa.array([f[2] for f in found], pa.string())], names=names)

    for batch in batches:
        values = batch.column(3)
        quoted = pc.fill_null(pc.match_substring(values, '"'), False).to_numpy(zero_copy_only=False)
        several = pc.fill_null(pc.match_substring(values, "\n"), False).to_numpy(zero_copy_only=False)
        for file, chunk, a, b in _runs(batch):
            if (file, chunk) != key:
                if key is not None and (found := left()):
                    yield rows(*key, found)
                key, state, begun = (file, chunk), int(batch.column(2)[a].as_py()), False
                parts, own = [], state == BETWEEN
            if state == BETWEEN and not quoted[a:b].any() and not several[a:b].any() and not values.slice(a, b - a).null_count:
                n = b - a
                first = np.zeros(n, bool)
                first[0] = chunk == 0 and not begun
                begun = True
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(np.full(n, WHOLE, np.int32)),
                     pa.array(first), values.slice(a, n)], names=names)
                continue
            found = []
            for value in values.slice(a, b - a).to_pylist():
                if value is None:
                    found.append((LOST, False, None))
                    state = BETWEEN
                    continue
                for line in value.split("\n"):
                    if state == BETWEEN:
                        state = after_line(state, line)
                        if state == BETWEEN:
                            found.append((WHOLE, chunk == 0 and not begun, line))
                            begun = True
                        else:
                            parts, own = [line], True
                    else:
                        parts.append(line)
                        state = after_line(state, line)
                        if state == BETWEEN:
                            found.append((WHOLE if own else HEAD, own and chunk == 0 and not begun, "\n".join(parts)))
                            parts, own, begun = [], True, True
            if found:
                yield rows(file, chunk, found)
    if key is not None and (found := left()):
        yield rows(*key, found)


CUT_SCHEMA = "file string, chunk long, kind int, first boolean, record string"


def cut_records(blocks: DataFrame) -> DataFrame:
    """(file, chunk, kind, first, record) of ``blocks`` (file, chunk, enters, value), whose rows
    lie in order in the tasks."""
    return blocks.select("file", "chunk", "enters", "value").mapInArrow(_cut, CUT_SCHEMA)


def joined_pieces(pieces: DataFrame, step: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, remains) of the pieces (file, chunk, kind, record) of records that cross
    chunks.  ``step`` is the distance of neighbouring chunks, where it is known: a chunk that
    is missing then leaves remains, too."""
    order = Window.partitionBy("file").orderBy("chunk", F.col("kind") == OPEN)
    # which pieces belong together shows without their texts
    light = pieces.select("file", "chunk", "kind", F.length("record").cast("long").alias("size"))
    grouped = light.withColumn("opener", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    last = F.max("chunk") - F.min("chunk") == F.count("*") - 1 if step else F.lit(True)
    whole = grouped.groupBy("file", "opener").agg(
        (F.count_if(F.col("kind") == OPEN) == 1).alias("opens"), (F.count_if(F.col("kind") == HEAD) == 1).alias("closes"),
        last.alias("gapless"), F.sum("size").alias("size"))
    fits = whole.withColumn("fits", F.col("opens") & F.col("closes") & F.col("gapless") & (F.col("size") <= MAX_RECORD_CHARS))
    numbered = grouped.drop("size").join(fits.select("file", "opener", "fits"), ["file", "opener"])
    judged = pieces.join(numbered, ["file", "chunk", "kind"])
    records = judged.filter("fits").groupBy("file", "opener").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "record"))).alias("parts"))
    return (records.select("file", F.array_join(F.col("parts.record"), "\n").alias("record")),
            judged.filter(~F.col("fits")).select("file", "record"))


def layouts(headers: DataFrame, names: list[str]) -> tuple[list[tuple[list[int], int]], list[str]]:
    """([(place of each column, fields)], header texts) of the distinct headers in ``headers``
    (file, header); what reaches the driver is one row for each distinct header."""
    from cyclemart.sources.files import header_positions

    texts = sorted(r["header"] for r in headers.select("header").distinct().collect())
    found = []
    for text in texts:
        fields = next(csv.reader([text]), [])
        found.append((header_positions(fields, names, ""), len(fields)))
    return found, texts


def header_text(line: str | Column) -> Column:
    """A header line without a byte order mark and a carriage return."""
    return F.regexp_replace(line, "^﻿|\r$", "")


def parsed(records: DataFrame, schema: T.StructType, places: list[tuple[list[int], int]], raw: Column) -> DataFrame:
    """The typed rows of ``records`` (record, layout), with ``_corrupt_record``.

    Every field is read as text and cast with ``try_cast``: a bad value becomes NULL, which
    the quality rules see.  A record that is NULL or without layout, or has too few or too
    many fields, is corrupt and keeps ``raw``.  The work is done once a row, behind a
    Generate, which the optimizer does not copy into a filter.
    """
    options = {**DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, "multiLine": "true"}
    unended = F.expr("left(record, length(record) - 1)")
    record = F.when(F.col("record").endswith("\r"), F.replace(unended, F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))

    def fields(width: int) -> Column:
        text = ", ".join(f"_c{i} string" for i in range(width))
        return F.from_csv(record, f"{text}, {CORRUPT_COL} string", options)

    widths = sorted({w for _, w in places})
    chosen = records.select(
        raw.alias("raw"), (F.col("record").isNull() | F.col("layout").isNull()).alias("lost"), "layout", *[
            F.when(F.col("layout").isin([i for i, (_, w) in enumerate(places) if w == width]), fields(width)).alias(f"w{width}")
            for width in widths])
    columns = []
    for n, f in enumerate(schema.fields):
        value = F.lit(None).cast("string")
        for i, (at, width) in enumerate(places):
            value = F.when(F.col("layout") == i, F.col(f"w{width}._c{at[n]}")).otherwise(value)
        columns.append(value.try_cast(f.dataType).alias(f.name))
    bad = F.col("lost")
    for width in widths:
        bad = bad | F.coalesce(F.col(f"w{width}.{CORRUPT_COL}").isNotNull(), F.lit(False))
    rows = chosen.select(F.inline(F.array(F.struct(*columns, F.when(bad, F.col("raw")).alias(CORRUPT_COL)))))
    return rows


def not_blank(record: str = "record") -> Column:
    """Blank lines are no records."""
    return F.col(record).isNull() | F.col(record).rlike(r"[^\x00-\x20]")


def strict(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows without ``_corrupt_record``; a row that has one fails the job."""
    wrong = F.raise_error(F.lit("input: a record does not decrypt with the key, or does not parse"))
    checked = rows.filter(F.when(F.col(CORRUPT_COL).isNull(), F.lit(True)).otherwise(wrong.cast("boolean")))
    return checked.select(*schema.names)


def split_read(lines: DataFrame, header: bool) -> tuple[DataFrame | None, DataFrame]:
    """(records, states): the records (file, record, raw) of CSV lines (file, chunk, value),
    which may span lines and chunks, and the chunks' states.

    No records (None) come back where no record spans lines: any line reader will do then.
    """
    from cyclemart.session import materialize

    states = materialize(chunk_states(lines))
    if states.filter("spans").isEmpty():
        return None, states
    begin = entering(states)
    inside = materialize(begin.filter(F.col("enters") == INSIDE).select("file", "chunk", "enters"))
    if inside.limit(MAX_BROADCAST_CHUNKS + 1).count() <= MAX_BROADCAST_CHUNKS:
        placed = lines.join(F.broadcast(inside), ["file", "chunk"], "left")
    else:  # the order of the lines is kept by their numbers
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(inside, ["file", "chunk"], "left")
        placed = numbered.repartition("file", "chunk").sortWithinPartitions("file", "chunk", "line")
    blocks = placed.select("file", "chunk", F.coalesce("enters", F.lit(BETWEEN)).alias("enters"), "value")
    whole = cut_records(blocks).filter(F.col("kind") == WHOLE)
    if header:
        whole = whole.filter(~F.col("first"))
    # only chunks that a record crosses into or out of have pieces
    at_edge = begin.withColumn("leaves", F.when(F.col("enters") == INSIDE, F.col("inside")).otherwise(F.col("between")))
    crossed = at_edge.filter((F.col("enters") == INSIDE) | (F.col("leaves") == INSIDE)).select("file", "chunk")
    pieces = cut_records(blocks.join(F.broadcast(crossed), ["file", "chunk"], "left_semi")).filter(F.col("kind") != WHOLE) \
        if crossed.limit(MAX_BROADCAST_CHUNKS + 1).count() <= MAX_BROADCAST_CHUNKS else cut_records(blocks).filter(F.col("kind") != WHOLE)
    records, remains = joined_pieces(materialize(pieces))
    found = whole.select("file", "record", F.col("record").alias("raw")).unionByName(
        records.select("file", "record", F.col("record").alias("raw"))).unionByName(
        remains.select("file", F.lit(None).cast("string").alias("record"), F.col("record").alias("raw")))
    return found.filter(not_blank()), states


def with_layout(records: DataFrame, headers: DataFrame | None, texts: list[str], always: bool = False) -> DataFrame:
    """``records`` (file, ...) with ``layout``, the number of their file's header; NULL for a
    file without one.  ``always``: also look it up where there is only one header."""
    if headers is None or (len(texts) <= 1 and not always):
        return records.withColumn("layout", F.lit(0))
    number = F.array_position(F.array(*[F.lit(t) for t in texts]), F.col("header")) - 1
    of_file = headers.select("file", number.cast("int").alias("layout"))
    return records.join(of_file, "file", "left")
