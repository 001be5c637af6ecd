import datetime as dt

import pytest
from pyspark.sql import functions as F

from cyclemart.operators.merge import (
    ACTION_COL, MergeError, VersionedTable, initial_load, integrity_ok, merge_counts,
    merge_or_init, scd1_merge,
)
from tests.conftest import sized

NOW = dt.datetime(2024, 3, 1)
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id string, name string, amount double, extra string"


def target(spark):
    return sized(spark, [("1", "a", 1.0, "t1"), ("2", "b", 2.0, "t2"), ("3", "c", 3.0, "t3"),
                         (None, "nullkey", 0.0, "tn")], SCHEMA)


def source(spark):
    return sized(spark, [("2", "B", None), ("4", "d", 4.0), (None, "newnull", 9.0)],
                 "id string, name string, amount double")


@pytest.mark.parametrize("strategy", ["full", "broadcast_source"])
def test_upsert_semantics(spark, strategy):
    out = {(r.id, r.name): r for r in scd1_merge(target(spark), source(spark), ["id"], with_action=True,
                                                 strategy=strategy).collect()}
    assert len(out) == 6
    assert out[("1", "a")][ACTION_COL] == "kept"
    upd = out[("2", "B")]
    assert upd[ACTION_COL] == "updated" and upd.amount is None and upd.extra == "t2"  # NULL overwrites
    ins = out[("4", "d")]
    assert ins[ACTION_COL] == "inserted" and ins.extra is None  # target-only column NULL on insert
    assert out[(None, "nullkey")][ACTION_COL] == "kept"
    assert out[(None, "newnull")][ACTION_COL] == "inserted"  # NULL keys never match


def test_null_safe_keys_match_nulls(spark):
    out = scd1_merge(target(spark), source(spark), ["id"], null_safe_keys=True, with_action=True)
    rows = {r.id: r for r in out.collect()}
    assert rows[None].name == "newnull" and rows[None][ACTION_COL] == "updated"
    assert out.count() == 5


def test_partial_update_columns_and_audit_columns(spark):
    tgt = initial_load(target(spark), T0)
    out = {r.id: r for r in scd1_merge(tgt, source(spark), ["id"], update_columns=["amount"], now=NOW).collect()}
    assert out["2"].name == "b" and out["2"].amount is None
    assert out["2"].dw_inserted_date == T0 and out["2"].dw_updated_date == NOW
    assert out["2"].dw_updated_by == "glue_job" and out["1"].dw_updated_by == "initial_load"
    assert out["4"].dw_inserted_date == NOW and out["4"].dw_is_active is None


def test_duplicate_source_keys(spark):
    dup = sized(spark, [("1", "x", 1.0), ("1", "y", 2.0)], "id string, name string, amount double")
    with pytest.raises(MergeError):
        scd1_merge(target(spark), dup, ["id"])
    out = scd1_merge(target(spark), dup, ["id"], on_duplicate="latest", order_by="amount")
    assert {r.id: r.name for r in out.collect()}["1"] == "y"


def test_unknown_source_column_is_rejected(spark):
    bad = sized(spark, [("1", "zzz")], "id string, nope string")
    with pytest.raises(MergeError):
        scd1_merge(target(spark), bad, ["id"])


def test_merge_counts(spark):
    out = scd1_merge(target(spark), source(spark), ["id"], with_action=True)
    counts = {r[ACTION_COL]: r.rows for r in merge_counts(out).collect()}
    assert counts == {"kept": 3, "updated": 1, "inserted": 2}


def test_versioned_merge_or_init(spark, scratch):
    table = VersionedTable(spark, scratch("fact"))
    assert table.latest() is None
    first = merge_or_init(table, target(spark).drop("extra"), ["id"], now=T0)
    assert first.initialised and first.version == 1 and first.source_rows == 4
    second = merge_or_init(table, source(spark), ["id"], now=NOW)
    assert second.version == 2 and second.counts == {"inserted": 2, "updated": 1, "kept": 3}
    assert second.integrity_ok is False  # the two NULL-key rows group together, as in GROUP BY
    assert table.read(1).count() == 4 and table.read().count() == 6
    v2 = {r.id: r for r in table.read().collect()}
    assert v2["2"].dw_updated_by == "glue_job" and v2["2"].dw_inserted_date == T0


def test_versioned_merge_integrity_without_null_keys(spark, scratch):
    table = VersionedTable(spark, scratch("fact"))
    merge_or_init(table, target(spark).drop("extra").filter("id IS NOT NULL"), ["id"], now=T0)
    out = merge_or_init(table, source(spark).filter("id IS NOT NULL"), ["id"], now=NOW, tag="load-7")
    assert out.integrity_ok is True and table.has_tag("load-7") and not table.has_tag("load-8")


def test_integrity(spark):
    assert integrity_ok(target(spark), ["id"])
    assert not integrity_ok(target(spark).unionByName(target(spark)), ["id"])


def test_partitioned_table_merges_only_touched_partitions(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable
    import os
    from cyclemart.session import local_path

    table = PartitionedTable(spark, scratch("ptable"), "cycle")
    base = sized(spark, [("1", "A", 1.0), ("2", "A", 2.0), ("3", "B", 3.0)], "id string, cycle string, amount double")
    first = table.merge_or_init(base, ["id", "cycle"], now=T0)
    assert first.initialised
    b_path = os.path.join(local_path(table.root), "published_rev=00000001", "cycle=B")
    b_files = sorted(os.listdir(b_path))
    delta = sized(spark, [("2", "A", 20.0), ("4", "A", 4.0)], "id string, cycle string, amount double")
    out = table.merge_or_init(delta, ["id", "cycle"], now=NOW)
    assert out.counts == {"inserted": 1, "updated": 1, "kept": 1} and out.integrity_ok
    rows = {r.id: r for r in table.read().collect()}
    assert len(rows) == 4 and rows["2"].amount == 20.0 and rows["2"].dw_updated_by == "glue_job"
    assert rows["3"].dw_updated_by == "initial_load" and rows["2"].dw_inserted_date == T0
    assert sorted(os.listdir(b_path)) == b_files  # untouched
    assert dict(table.read().dtypes)["cycle"] == "string"


def test_integrity_within_delta_keys(spark):
    t = target(spark)  # keys 1, 2, 3, NULL
    doubled = t.unionByName(t.filter("id = '2' OR id IS NULL"))
    only_1 = sized(spark, [("1",)], "id string")
    only_2 = sized(spark, [("2",)], "id string")
    nulls = sized(spark, [(None,)], "id string")
    assert integrity_ok(doubled, ["id"], within=only_1)
    assert not integrity_ok(doubled, ["id"], within=only_2)
    assert not integrity_ok(doubled, ["id"], within=nulls)  # NULL keys group together


def test_partitioned_table_null_partition(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable

    table = PartitionedTable(spark, scratch("pnull"), "cycle")
    table.merge_or_init(sized(spark, [("1", None, 1.0), ("2", "A", 2.0)], "id string, cycle string, amount double"),
                        ["id", "cycle"], now=T0)
    out = table.merge_or_init(sized(spark, [("1", None, 5.0)], "id string, cycle string, amount double"),
                              ["id", "cycle"], now=NOW, null_safe_keys=True)
    assert out.counts == {"inserted": 0, "updated": 1, "kept": 0}
    rows = {r.id: r.amount for r in table.read().collect()}
    assert rows == {"1": 5.0, "2": 2.0}


def test_a_write_that_died_is_never_seen_and_blocks_nothing(spark, scratch):
    import os
    from cyclemart.operators.merge import PartitionedTable
    from cyclemart.session import local_path

    table = VersionedTable(spark, scratch("crash"))
    merge_or_init(table, target(spark), ["id"], now=T0)
    os.makedirs(os.path.join(local_path(table.root), "version=00000002"))  # no marker
    assert table.versions() == [1]
    merge_or_init(table, source(spark), ["id"], now=NOW)
    assert table.versions() == [1, 3] and table.read().count() == 6
    assert table.retire(keep=1) == [1] and table.versions() == [3]

    parts = PartitionedTable(spark, scratch("crash-parts"), "cycle")
    rows = sized(spark, [("1", "A", 1.0)], "id string, cycle string, amount double")
    parts.merge_or_init(rows, ["id", "cycle"], now=T0)
    os.makedirs(os.path.join(local_path(parts.root), "published_rev=00000002", "cycle=A"))
    assert parts.read().count() == 1
    parts.merge_or_init(rows, ["id", "cycle"], now=NOW)
    assert parts.read().count() == 1 and parts.read().first().dw_updated_date == NOW


def test_first_publication_refuses_repeated_keys(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable

    twice = sized(spark, [("1", "A", 1.0), ("1", "A", 2.0)], "id string, cycle string, amount double")
    table = VersionedTable(spark, scratch("dup-first"))
    with pytest.raises(MergeError):
        merge_or_init(table, twice, ["id"], now=T0)
    assert not table.exists()
    assert merge_or_init(table, twice, ["id"], now=T0, on_duplicate="latest", order_by="amount").source_rows == 1
    parts = PartitionedTable(spark, scratch("dup-first-parts"), "cycle")
    with pytest.raises(MergeError):
        parts.merge_or_init(twice, ["id", "cycle"], now=T0)
    assert not parts.exists()


def test_the_partition_column_must_be_a_key(spark, scratch):
    from cyclemart.operators.merge import PartitionedTable

    table = PartitionedTable(spark, scratch("moved"), "cycle")
    rows = sized(spark, [("1", "a", 1.0)], "id string, cycle string, amount double")
    with pytest.raises(MergeError, match="partition column"):
        table.merge_or_init(rows, ["id"], now=T0)


def test_superseded_partitions_are_removed(spark, scratch):
    import os
    from cyclemart.operators.merge import PartitionedTable
    from cyclemart.session import local_path

    table = PartitionedTable(spark, scratch("superseded"), "cycle")
    schema = "id string, cycle string, amount double"
    table.merge_or_init(sized(spark, [("1", "A", 0.0), ("2", "B", 0.0)], schema), ["id", "cycle"], now=T0)
    for n in range(1, 5):
        table.merge_or_init(sized(spark, [("1", "A", float(n))], schema), ["id", "cycle"], now=NOW)
    assert {r.id: r.amount for r in table.read().collect()} == {"1": 4.0, "2": 0.0}
    left = sorted(x for x in os.listdir(local_path(table.root)) if x.startswith("published_rev"))
    assert len(left) <= 3  # B's publication, the one before the newest, the newest
    assert table.delete_where(F.col("id") == "1") == 1 and table.read().count() == 1
    assert table.delete_where(F.col("id") == "9") == 0


def test_matched_keys_are_broadcast_once(spark):
    """A target that repeats one key very often does not grow what the small-delta plan broadcasts."""
    hot = spark.range(100_000).selectExpr("'2' AS id", "'x' AS name", "1.0D AS amount", "'e' AS extra")
    delta = source(spark).filter("id = '2'")
    plan = scd1_merge(hot, delta, ["id"], strategy="broadcast_source")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
    out = scd1_merge(hot, delta, ["id"], strategy="broadcast_source", with_action=True)
    assert {r[ACTION_COL]: r.rows for r in merge_counts(out).collect()} == {"updated": 100_000}


def test_delta_of_many_rows_in_few_bytes_is_not_broadcast(spark, scratch):
    """Stored bytes do not bound the rows that the driver would hash: a second run's delta is counted."""
    path = scratch("delta")
    spark.range(0, 200_000, numPartitions=1).selectExpr("id", "'x' AS v").write.parquet(path)
    delta, target = spark.read.parquet(path), spark.range(100).selectExpr("id", "'a' AS v")
    bound = 8_000_000
    for source, broadcast in ((delta, False), (delta.where("id < 1000").limit(1000), True)):
        out = scd1_merge(target, source, ["id"], on_duplicate="trust", null_safe_keys=True, with_action=True, max_broadcast_bytes=bound)
        assert ("strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString()) is broadcast
        assert {r[0]: r[1] for r in merge_counts(out).collect()} == {"updated": 100, "inserted": source.count() - 100}


def test_read_as_of_an_instant(spark, scratch):
    table = VersionedTable(spark, scratch("asof"))
    frames = [sized(spark, [(str(n), "x", float(n))], "id string, name string, amount double") for n in range(6)]
    table.publish(frames[0])  # before instants were kept
    days = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9), None]
    for f, at in list(zip(frames, days))[1:]:
        table.publish(f, at=at)

    def as_of(*at, **kw):
        return table.version_as_of(dt.datetime(*at, **kw))

    assert as_of(2023, 12, 31) is None and as_of(2024, 1, 1) == 2 and as_of(2024, 1, 4, 23) == 2
    assert as_of(2024, 1, 5) == 4  # an earlier instant counts as that of the version before
    assert as_of(2024, 1, 8) == 4 and as_of(2024, 1, 9) == 6 and as_of(2030, 1, 1) == 6
    assert as_of(2024, 1, 5, 1, tzinfo=dt.timezone(dt.timedelta(hours=2))) == 2  # 23:00 UTC of the 4th
    assert table.read_as_of(dt.datetime(2024, 1, 2)).first().id == "1"
    with pytest.raises(FileNotFoundError):
        table.read_as_of(dt.datetime(2023, 1, 1))
    reads = []
    real = VersionedTable.published_at
    for n in range(40):
        table.publish(frames[0], at=dt.datetime(2024, 2, 1, n % 24) + dt.timedelta(days=n))
    VersionedTable.published_at = lambda self, v: reads.append(v) or real(self, v)
    try:
        assert as_of(2024, 2, 10) > 6
    finally:
        VersionedTable.published_at = real
    assert len(reads) <= 8  # bisection, not a scan


def test_two_writers_take_two_numbers(spark, scratch):
    one, two = VersionedTable(spark, scratch("writers")), None
    two = VersionedTable(spark, one.root)
    a, b = one._open(target(spark).schema), None  # noqa: SLF001 - both see the same listing
    two._numbers = lambda: {}  # noqa: SLF001
    b = two._open(target(spark).schema)  # noqa: SLF001
    assert (a, b) == (1, 2)


def test_repair_of_a_published_table(spark, scratch):
    import os
    from cyclemart.operators.merge import PartitionedTable
    from cyclemart.session import local_path

    table = PartitionedTable(spark, scratch("repair"), "cycle")
    schema = "id string, cycle string, amount double, dw_updated_date timestamp"
    rows = [("1", "A", 1.0, T0), ("2", "A", 2.0, T0), ("1", "A", 9.0, NOW), ("3", "B", 3.0, T0), (None, "C", 4.0, T0), (None, "C", 5.0, T0)]
    table._publish(sized(spark, rows, schema))  # noqa: SLF001 - as a writer without the check would
    files = {d: sorted(os.listdir(d)) for d, _, _ in os.walk(local_path(table.root)) if "cycle=B" in d or "cycle=C" in d}
    assert table.repair(["id", "cycle"]) == (1, 1)
    got = sorted((r.id or "", r.cycle, r.amount) for r in table.read().collect())
    assert got == [("", "C", 4.0), ("", "C", 5.0), ("1", "A", 9.0), ("2", "A", 2.0), ("3", "B", 3.0)]
    assert files == {d: sorted(os.listdir(d)) for d in files}  # untouched partitions keep their files
    assert table.repair(["id", "cycle"]) == (0, 0)
    assert table.repair(["id", "cycle"], tie_breakers=["amount"], null_safe_keys=True) == (1, 1)
    assert sorted(r.amount for r in table.read().collect()) == [2.0, 3.0, 5.0, 9.0]
    with pytest.raises(MergeError):
        table.repair(["id"])
