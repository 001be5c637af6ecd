"""What every order of the quality filters removes, keeps and loses.

One pass measures a text.  A byte transducer, given as two tables over byte classes (state
after a byte; what a byte emits in a state), walks the UTF-8 bytes: it emits where words
begin, capitals, code points and symbols.  It remembers one byte only, so a batch runs in
two table look-ups at all places at once.  The word spans it marks go into an open-addressing
hash table; a span counts as known only if its row, length, hash and bytes equal those of
the slot's owner, otherwise it probes on, so no hash collision is ever counted as a repeat.

The filters' failures of a document are one bit each.  What an order of the filters does to a
document depends on these bits alone, so documents are counted by (part, bits) first and
only these few counts meet the 120 orders, in an equi-join on the bits.

A document fails E, the test for copies, if its text has a smaller id anywhere in the table.
Rows are folded per (id, text, part), then per (text, part, labels): a text that a third of
all rows share is a few rows before anything is joined on it.

Defined cases: NULL texts are empty, and equal to empty ones; a text without words fails A
only (0 of 0 distinct words is not too few) and E if repeated; a NULL part is the empty
string; a NULL id is neither smaller nor larger than any other and has no labels; rows that
repeat id and text are documents of their own, none a copy of the other; labels that repeat
an id hold if any of them does; an empty table has no part and gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.llm import textarrays as ta
from cyclemart.llm.common import stored

FILTERS = "ABCDE"
LEAST_WORDS = 100  # A: fewer words fail
LEAST_DISTINCT = 80  # B: fewer distinct words, in percent of the words, fail
MOST_CAPITALS = 10  # C: more capitals, in percent of the code points, fail
SYMBOLS = "#$%&*|"  # D: any of them fails

# --- the transducer ---------------------------------------------------------------------
OTHER, SPACE, CAPITAL, SYMBOL, CONTINUATION = range(5)  # classes of bytes
OUTSIDE, WITHIN = range(2)  # states: between words, inside a word
BEGINS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8  # what a transition emits


def _byte_classes() -> np.ndarray:
    classes = np.full(256, OTHER, np.uint8)
    classes[0x80:0xC0] = CONTINUATION
    classes[[0x20, *range(0x09, 0x0E)]] = SPACE
    classes[ord("A"):ord("Z") + 1] = CAPITAL
    classes[[ord(c) for c in SYMBOLS]] = SYMBOL
    return classes


CLASS_OF = _byte_classes()
#: (state, class) to the next state.
NEXT = np.array([[WITHIN, OUTSIDE, WITHIN, WITHIN, WITHIN]] * 2, np.uint8)
#: (state, class) to what is emitted.
EMITS = np.array([
    [BEGINS | IS_POINT, IS_POINT, BEGINS | IS_POINT | IS_CAPITAL, BEGINS | IS_POINT | IS_SYMBOL, BEGINS],
    [IS_POINT, IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0],
], np.uint8)


def transduce(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(what every byte emits, the state after it); every row begins between words."""
    classes = CLASS_OF[data]
    after = NEXT[0][classes]  # both rows of NEXT are equal: the machine remembers one byte
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[offsets[:-1][np.diff(offsets) > 0]] = OUTSIDE
    return EMITS[before, classes], after


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


# --- the hash table of word spans -----------------------------------------------------------
def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every span of bytes."""
    if not starts.size:
        return np.empty(0, np.uint64)
    place = _places(lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    values = (data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)) * powers[place]
    return ta.mix(np.add.reduceat(values, np.cumsum(lengths) - lengths))


def _places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ..., length - 1 for each of ``lengths``, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans that begin at ``a`` and ``b`` hold the same bytes; lengths above 0."""
    if not a.size:
        return np.empty(0, bool)
    place = _places(lengths)
    equal = data[np.repeat(a, lengths) + place] == data[np.repeat(b, lengths) + place]
    return np.logical_and.reduceat(equal, np.cumsum(lengths) - lengths)


def first_of_kind(
    data: np.ndarray, row: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray
) -> np.ndarray:
    """Whether each span is the one that stands for its kind within its row.

    All spans are inserted at once: in a round every span looks at one slot; those at an
    empty one claim it, one of them wins, and who meets a different span probes on.
    """
    n = len(starts)
    size = 1 << max(4, int(2 * n).bit_length())
    last = np.uint64(size - 1)
    slot = (ta.combine(hashes, row.astype(np.uint64)) & last).astype(np.int64)
    owner = np.full(size, -1, np.int64)
    stands = np.zeros(n, bool)
    pending = np.arange(n)
    while pending.size:
        at = slot[pending]
        free = owner[at] < 0
        owner[at[free]] = pending[free]
        met = owner[at]
        stands[pending[met == pending]] = True
        maybe = (met != pending) & (row[met] == row[pending]) & (lengths[met] == lengths[pending]) & (hashes[met] == hashes[pending])
        known = met == pending
        known[maybe] = same_bytes(data, starts[met[maybe]], starts[pending[maybe]], lengths[pending[maybe]])
        pending = pending[~known]
        slot[pending] = (slot[pending] + 1) & (size - 1)
    return stands


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """words, distinct, capitals, points and symbols of each row."""
    emitted, after = transduce(data, offsets)
    starts = np.flatnonzero(emitted & BEGINS)
    ends = np.flatnonzero((after == WITHIN) & np.append(after[1:] == OUTSIDE, True) | _last_within(after, offsets)) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    lengths = ends - starts
    stands = first_of_kind(data, row, starts, lengths, span_hashes(data, starts, lengths))
    rows = len(offsets) - 1
    return {
        "words": np.bincount(row, minlength=rows),
        "distinct": np.bincount(row[stands], minlength=rows),
        "capitals": _per_row(emitted & IS_CAPITAL != 0, offsets),
        "points": _per_row(emitted & IS_POINT != 0, offsets),
        "symbols": _per_row(emitted & IS_SYMBOL != 0, offsets),
    }


def _last_within(after: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The last byte of each row, where it is inside a word."""
    mark = np.zeros(len(after), bool)
    last = offsets[1:][np.diff(offsets) > 0] - 1
    mark[last] = after[last] == WITHIN
    return mark


MEASURES = ("words", "distinct", "capitals", "points", "symbols")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(k, part, t, words, distinct, capitals, points, symbols) of every row; t is the
    SHA-256 of the text."""
    narrow = docs.select(F.col(key).alias("k"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, data, offsets in ta.chunks(batch.column(2)):
                found = measure(data, offsets)
                whole = data.tobytes()
                digests = [hashlib.sha256(whole[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(digests, pa.binary()),
                     *[pa.array(found[m].astype(np.int64)) for m in MEASURES]],
                    names=["k", "part", "t", *MEASURES])

    kind = docs.schema[key].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, part string, t binary, " + ", ".join(f"{m} long" for m in MEASURES))


# --- the audit ------------------------------------------------------------------------------
def failures() -> Column:
    """The bits of the filters A to D that a measured text fails."""
    rules = [
        F.col("words") < LEAST_WORDS,
        F.col("distinct") * 100 < F.col("words") * LEAST_DISTINCT,
        F.col("capitals") * 100 > F.col("points") * MOST_CAPITALS,
        F.col("symbols") > 0,
    ]
    bits = [F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(rules)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def failure_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, failed, n, good, toxic): the documents by the bits of the filters they fail."""
    rows = stored(
        measured(docs, key, text, part).withColumn("failed", failures())
        .groupBy("k", "t", "part").agg(F.first("failed").alias("failed"), F.count("*").alias("n")), "measured")
    marks = labels.groupBy(F.col("doc_id").alias("k")).agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    marked = rows.join(marks, "k", "left").fillna(False, ["good", "toxic"])
    # a text's rows by part and labels; only the row of its smallest id passes E
    folded = marked.groupBy("t", "part", "good", "toxic", F.col("k").isNull().alias("unnamed")).agg(
        F.first("failed").alias("failed"), F.sum("n").alias("n"), F.min(F.struct("k", "n")).alias("least"))
    smallest = folded.filter("NOT unnamed").groupBy("t").agg(F.min("least.k").alias("k0"))
    met = folded.join(smallest, "t", "left")
    passing = F.when(F.col("unnamed"), F.col("n")).when(F.col("least.k") == F.col("k0"), F.col("least.n")).otherwise(0)
    split = met.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("failed").alias("failed"), passing.alias("n")),
        F.struct((F.col("failed") + (1 << FILTERS.index("E"))).alias("failed"), (F.col("n") - passing).alias("n")))))
    return split.filter("n > 0").groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def roles() -> list[tuple[int, str, int, str, int, int, int, int]]:
    """What each order does at each step to a document with given failures: (failed,
    filter_order, step, filter, kept, removed, redundant, unique), 32 x 120 x 5 rows."""
    out = []
    for failed in range(1 << len(FILTERS)):
        fails = {f for i, f in enumerate(FILTERS) if failed >> i & 1}
        for order in itertools.permutations(FILTERS):
            for step, f in enumerate(order, 1):
                earlier = fails.intersection(order[:step - 1])
                out.append((failed, "".join(order), step, f, int(not fails.intersection(order[:step])),
                            int(f in fails and not earlier), int(f in fails and bool(earlier)), int(fails == {f})))
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    counts = failure_counts(docs, labels, key, text, part)
    table = spark.createDataFrame(
        roles(), "failed int, filter_order string, step int, filter string, kept int, removed int, redundant int, alone int")
    met = counts.join(F.broadcast(table), "failed")  # 19,200 rows, whatever the input
    steps = met.groupBy("part", "filter_order", "step", "filter").agg(
        F.sum(F.col("n") * F.col("kept")).alias("kept"),
        F.sum(F.col("n") * F.col("removed")).alias("removed"),
        F.sum(F.col("n") * F.col("redundant")).alias("redundant"),
        F.sum(F.col("n") * F.col("alone")).alias("unique_fails"),
        F.sum(F.col("good") * F.col("removed")).alias("good_lost"),
        F.sum(F.col("toxic") * F.col("removed")).alias("toxic_lost"))
    by_filter = met.groupBy("part", "filter").agg(F.sum(F.col("n") * F.col("removed")).alias("shapley"))
    return steps.join(by_filter, ["part", "filter"]).drop("filter")
