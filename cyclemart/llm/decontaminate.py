"""Benchmark decontamination: short test items found inside long documents.

Containment of an item in a document is the share of the item's distinct five-word
shingles that the document has.  Plain MinHash compares sets of like size and fails when
one is a hundred times the other, so the items are partitioned by size and each partition
has its own sketch length: an item keeps the ``floor((1 - t) * q) + 1`` shingles of least
MinHash value, ``q`` being the largest size of its partition.  A document that contains
the share ``t`` of an item lacks at most ``(1 - t) * q`` of its shingles, so it holds at
least one of the sketch: the search misses nothing, whatever the document's length.
Candidates are then verified by exact shingle containment.

Only built-in functions.  Document shingles meet the sketches in one equi-join; the
sketches are broadcast when they are counted small, otherwise both sides are shuffled.

Words are lower-cased runs of characters other than white space.  Defined cases: items and
documents of fewer than five words (NULL and empty ones too) have no shingle and are never
reported; repeated items are reported each; rows that repeat id and text are one document;
a NULL id is reported as NULL; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cyclemart.llm.common import broadcast_if_small, fresh, text_key

WIDTH = 5
THRESHOLD = 0.8


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")


def shingle_rows(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """(*keep, shingle): one row per run of five words."""
    [w] = fresh(rows, "w_")
    listed = rows.select(*keep, _words(F.col(text)).alias(w)).filter(F.size(w) >= WIDTH)
    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - WIDTH),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WIDTH)]))
    return listed.select(*keep, F.explode(runs).alias("shingle"))


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(item shingles, sketches): (item, shingle, q) whole, and the part that is searched.

    ``size_class`` doubles: class c has the items of 2**c to 2**(c+1) - 1 shingles.
    """
    whole = shingle_rows(items, "text", "item_id").distinct()
    sizes = whole.groupBy("item_id").agg(F.count("*").alias("q"))
    classed = sizes.withColumn("size_class", F.floor(F.log2("q")).cast("int"))
    largest = classed.groupBy("size_class").agg(F.max("q").alias("largest"))
    lengths = classed.join(largest, "size_class").withColumn(
        "keep", F.floor(F.lit(1 - threshold) * F.col("largest") + F.lit(1e-9)).cast("int") + 1)
    by_item = Window.partitionBy("item_id").orderBy(F.xxhash64(F.lit("order"), "shingle"), "shingle")
    sketch = (
        whole.withColumn("place", F.row_number().over(by_item))
        .join(lengths.select("item_id", "size_class", "keep"), "item_id")
        .filter("place <= keep")
        .select("shingle", "item_id", "size_class")
    )
    return whole.join(sizes, "item_id"), sketch


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(k, t, item_id, item_shingles, shared, containment) of every document and item whose
    containment is at least ``threshold``; k and t are the document's id and text digest."""
    wanted = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text"))
    wanted = wanted.withColumn("item_id", F.struct("item", text_key("text").alias("x"))).select("item_id", "text")
    whole, sketch = sketches(wanted, threshold)
    rows = docs.select(F.col(key).alias("k"), text_key(text).alias("t"), F.col(text).alias("text"))
    candidates = (
        shingle_rows(rows, "text", "k", "t")
        .join(broadcast_if_small(sketch), "shingle")
        .select("k", "t", "item_id").distinct()
    )
    listed = candidates.groupBy("k", "t").agg(F.collect_set("item_id").alias("wanted"))
    suspects = (
        rows.alias("r").join(listed.select(F.col("k").alias("ck"), F.col("t").alias("ct"), "wanted"),
                             F.col("r.k").eqNullSafe(F.col("ck")) & (F.col("r.t") == F.col("ct")))
        .select("r.k", "r.t", "text", "wanted")
    )
    found = shingle_rows(suspects, "text", "k", "t", "wanted").dropDuplicates(["k", "t", "shingle"])
    exact = (
        found.join(broadcast_if_small(whole), "shingle")
        .filter(F.array_contains("wanted", F.col("item_id")))
        .groupBy("k", "t", "item_id")
        .agg(F.count("*").alias("shared"), F.max("q").alias("item_shingles"))
    )
    return (
        exact.withColumn("containment", F.col("shared") / F.col("item_shingles"))
        .filter(F.col("containment") >= threshold)
        .withColumn("item_id", F.col("item_id.item"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that contain a test item."""
    k, t = fresh(docs, "k_", "t_")
    found = contaminated(docs, items, key=key, text=text, **options)
    leaks = found.select(F.col("k").alias(k), F.col("t").alias(t)).distinct()
    return docs.join(broadcast_if_small(leaks), F.col(key).eqNullSafe(F.col(k)) & (text_key(text) == F.col(t)), "left_anti")
