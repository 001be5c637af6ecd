"""URL rules, jump sharding and the WARC archive against plain Python."""

import base64
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclemart.llm import sharding, url_rules, warc

RULES = "SELECT * FROM VALUES {} AS t(host, path, verdict)"


def rules(spark, rows):
    values = ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in rows)
    return spark.sql(RULES.format(values))


def test_longest_rule_wins_and_columns_may_clash(spark):
    pages = spark.createDataFrame(
        [(1, "http://WWW.Example.com/en/x?q", "a"), (2, "https://m.example.com/en/", "b"), (3, "http://example.com/de", "c"),
         (4, "http://badexample.com/en/", "d"), (5, None, "e"), (6, "no scheme/en/", "f"), (7, "ftp://a.net#/es/", "g"),
         (8, "x://a.net/es/1", "h"), (9, "", "i"), (2, "https://m.example.com/en/", "b")],
        "page_id long, url string, host string")
    ready = rules(spark, [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                          ("net", "/es/", "block"), ("net", "/es/", "allow"), ("net", "/es/", "block")])
    out = url_rules.judge_urls(pages, ready)
    assert out.columns == ["page_id", "url", "host", "path", "host_", "rule", "verdict"]
    got = sorted((r.page_id, r.host_, r.path, r.rule or "", r.verdict) for r in out.collect())
    assert got == [
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "m.example.com", "/en/", "example.com/en/", "block"),
        (2, "m.example.com", "/en/", "example.com/en/", "block"), (3, "example.com", "/de", "com/", "allow"),
        (4, "badexample.com", "/en/", "com/", "allow"), (5, "", "", "", "allow"), (6, "", "", "", "allow"),
        (7, "a.net", "", "", "allow"), (8, "a.net", "/es/1", "net/es/", "block"), (9, "", "", "", "allow")]


def test_rules_may_be_prefixes_inside_a_segment_or_null(spark):
    pages = spark.createDataFrame([(1, "a://h.org/engine")], "page_id long, url string")
    assert url_rules.judge_urls(pages, rules(spark, [("org", "/en", "block")])).first().verdict == "block"
    assert url_rules.judge_urls(pages, rules(spark, [("org", None, "block")])).first().rule == "org"
    none = rules(spark, [("x", "/", "block")]).limit(0)
    assert url_rules.judge_urls(pages, none, default="block").first().verdict == "block"
    assert url_rules.judge_urls(pages.limit(0), none).count() == 0


def _jump(key, shards):
    state, shard, reach = key % (1 << 64), -1, 0
    while reach < shards:
        shard = reach
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        reach = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard


def test_jump_hash_is_the_published_one():
    keys = np.array([0, 1, 7, -1, 2**62, -2**63, 123456789], np.int64)
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [_jump(int(k), shards) for k in keys]


def test_shards_slots_and_growth(spark):
    rows = [(i, "t" * (i % 5)) for i in range(400)] + [(7, "hot")] * 200 + [(None, None), (8, None), (9, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.assign_shards(docs, 8).collect()
    assert len(out) == len(rows)
    for r in out:
        key = r.doc_id or 0
        assert (r.shard, r.grown_shard, r.law) == (_jump(key, 8), _jump(key, 9), "key")
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
        by_slot = [r.doc_id for r in sorted((r for r in out if r.shard == shard), key=lambda r: r.slot)]
        assert by_slot == sorted(by_slot, key=lambda k: (k is not None, k))
    got = {(r.doc_id, r.size, r.text_crc32) for r in out}
    assert (None, 1, 0) in got and (9, 3, zlib.crc32("é".encode())) in got
    assert sharding.assign_shards(docs.limit(0), 8).count() == 0
    named = spark.createDataFrame([("a", "x"), ("b", "x")], "doc_id string, text string")
    assert {r.doc_id for r in sharding.assign_shards(named, 3).collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, 0)


PAGES = [(5, "http://a/", "same"), (3, "http://b/", "same"), (4, None, ""), (9, "x\r\ny", None), (6, "http://c/", "ünï"), (7, "u", "same")]


def test_archive_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    got = {r.page_id: tuple(r)[1:] for r in warc.read_summary(archive).collect()}

    def digest(text):
        return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()

    assert got == {
        3: (4, digest("same"), "response", None), 5: (4, digest("same"), "revisit", 3), 7: (4, digest("same"), "revisit", 3),
        4: (0, digest(""), "response", None), 9: (0, digest(""), "revisit", 4), 6: (5, digest("ünï"), "response", None)}
    assert archive.payloads.count() == 3
    record = warc.read_responses(archive).filter("page_id = 6").first()
    head, _, rest = bytes(record.record).partition(b"\r\n\r\n")
    http, _, body = rest.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    assert record.intact and body == "ünï".encode() + b"\r\n\r\n" and length == len(http) + 4 + 5
    assert {r.page_id: bytes(r.payload).decode() for r in warc.read_payloads(archive).collect()} == {k: t or "" for k, _, t in PAGES}


def test_short_payloads_may_all_be_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = warc.read_summary(warc.write_archive(pages, revisit_from=4)).collect()
    assert sorted(r.page_id for r in got if r.record_type == "revisit") == [5, 7]
    assert warc.read_summary(warc.write_archive(pages.limit(0))).count() == 0
    twice = pages.filter("page_id = 3").union(pages.filter("page_id = 3"))
    assert [r.record_type for r in warc.read_summary(warc.write_archive(twice)).collect()] == ["response"] * 2


def test_damage_is_noticed(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    damaged = archive.payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_summary(warc.Archive(damaged, archive.records)).collect()


def test_a_hot_payload_is_split_and_the_catalog_stays_clean(spark):
    import statistics

    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    plain.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain.conf.set("spark.sql.shuffle.partitions", "8")
    html = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("page "), F.col("id").cast("string")))
    pages = plain.range(30_000).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), html.alias("html"))
    before = {t.name for t in plain.catalog.listTables()}
    archive = warc.write_archive(pages)
    out = warc.read_summary(archive)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 30_000 and max(per_task) <= 2 * statistics.median(per_task)
    assert out.filter("record_type = 'revisit'").count() == 9_999 and out.filter("refers_to = 0").count() == 9_999
    assert {t.name for t in plain.catalog.listTables()} == before


def test_page_columns_of_any_name(spark):
    pages = spark.createDataFrame([("http://www.Example.com/en/x?q", "b", 1, 2, "h", "r", "v", 5)],
                                  "url string, best string, k_host int, k_path int, host string, rule string, verdict string, `a.b` int")
    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("example.com", "/en/", "allow"), (None, None, "allow")], "host string, path string, verdict string")
    [r] = url_rules.judge_urls(pages, rules).collect()
    assert (r.best, r.k_host, r.k_path, r.host, r["a.b"]) == ("b", 1, 2, "h", 5)
    assert (r.host_, r.path, r.rule_, r.verdict_) == ("www.example.com", "/en/x", "example.com/en/", "block")
