"""Removal of repeated passages by overlapping windows of three lines.

Every run of three consecutive lines of a document is hashed to 128 bits.  A window that
occurs more than once keeps its first occurrence, in the order of (id, text digest,
position); the lines that its later occurrences cover are removed.  Windows overlap, so
the covered positions are merged per document and its text is rewritten once.

Lines are split at ``\\n`` and compared without leading and trailing white space.  Blank
lines are no lines: windows run across them and they are never removed themselves.

The text is not carried through the search: windows are three numbers a row, written once,
merged with partial aggregation and met again in an equi-join that Spark splits where one
window has very many occurrences.

Rewriting is linear in a text: the lines and the positions of its filled lines are made once
a document and kept behind a generator, which the optimiser cannot copy into a lambda or a
later filter; what stays is joined from the slices between the removed positions.

Defined cases: documents of fewer than three lines have no window and stay as they are;
NULL texts stay NULL; an occurrence that overlaps the first one in the same document
covers only the lines beyond it; rows that repeat both id and text count as one occurrence
and are treated alike; a NULL id comes first.  Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import fresh, stored, text_key

WINDOW = 3
WHITE = " \t\n\x0b\f\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` evaluated once a row, however often they are used later."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: k, t (text digest), p (positions) and l (trimmed lines)."""
    split = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    trimmed = F.transform(split, _trimmed)
    numbered = F.filter(
        F.transform(trimmed, lambda x, i: F.struct(i.alias("p"), x.alias("x"))), lambda s: s.x != "")
    return docs.select(F.col(key).alias("k"), text_key(text).alias("t"), numbered.alias("lines"))


def windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, t, i, h1, h2): each document's windows by the rank of their first line."""
    lines = _lines(docs, key, text).filter(F.size("lines") >= WINDOW)
    hashed = lines.select(
        "k", "t",
        F.transform("lines", lambda s: F.struct(
            F.xxhash64(s.x).alias("a"), F.xxhash64(F.lit("b"), s.x, F.lit("b")).alias("b"))).alias("hs"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("hs") - WINDOW),
        lambda i: F.struct(
            i.alias("i"),
            F.xxhash64(*[F.get("hs", i + j)["a"] for j in range(WINDOW)]).alias("h1"),
            F.xxhash64(F.lit(1), *[F.get("hs", i + j)["b"] for j in range(WINDOW)]).alias("h2")))
    return hashed.select("k", "t", F.inline(runs))


def covered_positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, t, ranks): for documents that lose lines, the ranks of those lines, sorted."""
    found = stored(windows(docs, key, text), "windows")
    place = F.struct("k", "t", "i")
    repeated = (
        found.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1").drop("n")
    )
    last = F.col("i") + WINDOW - 1
    inside = F.col("k").eqNullSafe(F.col("first.k")) & (F.col("t") == F.col("first.t"))
    begin = F.when(inside, F.greatest("i", F.col("first.i") + WINDOW)).otherwise(F.col("i"))
    later = (
        found.join(repeated, ["h1", "h2"])
        .filter(~(inside & (F.col("i") == F.col("first.i"))))
        .select("k", "t", begin.alias("begin"), last.alias("last"))
        .filter(F.col("begin") <= F.col("last"))
        .select("k", "t", F.explode(F.sequence("begin", "last")).alias("rank"))
    )
    return later.groupBy("k", "t").agg(F.sort_array(F.collect_set("rank")).alias("ranks"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed_lines"
) -> DataFrame:
    """``docs`` with the repeated lines removed from ``text``, and ``removed``: their
    positions among all lines of the original (0 for the first)."""
    [removed] = fresh(docs, removed)
    k, t, ranks, lines, filled, kept, lost = fresh(
        docs.withColumn(removed, F.lit(0)), "k_", "t_", "ranks_", "lines_", "filled_", "kept_", "lost_")
    cover = covered_positions(docs, key, text).toDF(k, t, ranks)
    keyed = docs.alias("d").join(
        cover, F.col(f"d.{key}").eqNullSafe(F.col(k)) & (text_key(F.col(f"d.{text}")) == F.col(t)), "left")
    loses = F.col(ranks).isNotNull()
    cut = _once(keyed, **{lines: F.when(loses, F.split(F.col(text), "\n", -1))})
    cut = _once(cut, **{filled: F.filter(
        F.transform(F.col(lines), lambda x, i: F.when(_trimmed(x) != "", i)), lambda i: i.isNotNull())})
    cut = _once(cut, **{lost: F.transform(F.col(ranks), lambda r: F.get(F.col(filled), r))})
    first = F.concat(F.array(F.lit(0)), F.transform(F.col(lost), lambda i: i + 1))
    end = F.concat(F.col(lost), F.array(F.size(lines)))
    between = F.zip_with(first, end, lambda a, b: F.slice(F.col(lines), a + 1, b - a))
    edited = _once(cut, **{
        kept: F.when(loses, F.array_join(F.flatten(between), "\n")).otherwise(F.col(text)),
        removed: F.coalesce(F.col(lost), F.array().cast("array<int>"))})
    return edited.select(
        *[(F.col(kept) if c == text else F.col(f"d.{c}")).alias(c) for c in docs.columns], F.col(removed))
