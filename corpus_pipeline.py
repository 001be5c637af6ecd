"""A corpus pipeline: each stage keeps, edits or encodes the documents of the one before.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  Every stage's result is
written as Parquet and read again as the next one's ``docs``, so a lost executor costs at
most one stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm import bagminhash, bpe, catalogue, decontaminate, gam, line_dedup
from cyclemart.llm.common import bounded_batches, fresh, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality model accepts; it learns from ``labels``."""
    bounded_batches(spark)
    [score] = fresh(docs, "score")
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    return gam.score(docs, model, name=score).filter(F.col(score) >= catalogue.ACCEPT).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of three lines and more that an earlier document has.

    A document of which nothing is left goes; ``n_chars`` follows the text.
    """
    [removed] = fresh(docs, "removed_lines")
    edited = line_dedup.dedup_lines(docs, removed=removed)  # evaluated once, see there
    changed = F.size(removed) > 0
    kept = edited.filter(~changed | F.col("text").rlike(r"\S"))
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    bounded_batches(spark)
    return bagminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain an item of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives back its text."""
    bounded_batches(spark)
    return bpe.encoded_with_check(docs, catalogue.vocabulary_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

#: The classifier is trained and the encoder reads a vocabulary file: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split(" ")[0].lower())
    return docs
