"""The registered corpus queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from cyclemart.llm import bagminhash, catalogue, decontaminate
from tests.conftest import SF_SMALL
from tools.oracle_check import _rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(catalogue.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in catalogue.QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        path = str(tmp_path / str(i))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < 4:
            assert docs.columns == columns and 0 < docs.count() <= before
    assert docs.columns == ["doc_id", "n_tokens", "ids", "exact"] and docs.count() == before
    assert docs.filter("NOT exact OR n_tokens <> size(ids)").count() == 0


def test_what_the_stages_leave(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    classes = bagminhash.near_duplicates(kept)
    assert classes.filter("doc_id <> class_id").count() == 0
    assert kept.count() == bagminhash.near_duplicates(docs).select("class_id").distinct().count()
    clean = corpus_pipeline.decontamination(spark, docs, SF_SMALL)
    assert decontaminate.contaminated(clean, items).count() == 0
    lines = corpus_pipeline.lines(spark, docs, SF_SMALL)
    assert lines.filter("n_chars <> length(text)").count() == 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "exact"] and out.count() > 0
