import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cyclemart.functions.crypto import decrypt_column, encrypt_column
from cyclemart.plans.catalogue import ingest
from cyclemart.schemas import ENTITY_SCHEMAS
from cyclemart.session import local_path
from cyclemart.sources import encrypted
from cyclemart.sources.encrypted import (
    encrypt_text, read_encrypted_files, read_encrypted_lines, write_encrypted_lines,
)
from cyclemart.sources.files import (
    discover_cycle_files, load_cycle, read_csv, read_staged, stage_parquet, with_provenance,
)
from tests.conftest import plan_text

NOW = dt.datetime(2024, 1, 2)
KEY = "0123456789abcdef"


def land(root, rel, text):
    path = os.path.join(local_path(root), rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "wb" if isinstance(text, bytes) else "w"
    with open(path, mode) as f:
        f.write(text)
    return path


def test_csv_explicit_schema_and_corrupt_lines(spark, scratch):
    root = scratch("csv")
    land(root, "p.csv", "policy_id,policy_status\nP001,ACTIVE\nP002,RENEWAL,extra\nP003\n")
    schema = ENTITY_SCHEMAS["policy"]
    for by_name in (True, False):
        with pytest.raises(Exception):  # never dropped silently
            read_csv(spark, root, schema, by_name=by_name).collect()
        rows = read_csv(spark, root, schema, keep_corrupt=True, by_name=by_name).collect()
        assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == ["P002,RENEWAL,extra", "P003"]


def test_csv_by_header_name_in_any_case(spark, scratch):
    root = scratch("byname")
    land(root, "p.csv", "Policy_Status,extra,POLICY_ID\nACTIVE,1,P001\n")
    r = read_csv(spark, root, ENTITY_SCHEMAS["policy"]).first()
    assert (r.policy_id, r.policy_status) == ("P001", "ACTIVE")
    missing = scratch("missing")
    land(missing, "p.csv", "policy_id\nP1\n")
    with pytest.raises(ValueError, match="policy_status"):
        read_csv(spark, missing, ENTITY_SCHEMAS["policy"])


def test_cycle_date_stays_string(spark, scratch):
    root = scratch("tx")
    names = ENTITY_SCHEMAS["transactions"].names
    values = {"transaction_id": "T1", "cycle_date": "20240101", "transaction_amount": "abc"}
    land(root, "t.csv", ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    df = read_csv(spark, root, ENTITY_SCHEMAS["transactions"])
    r = df.first()
    assert dict(df.dtypes)["cycle_date"] == "string" and r.cycle_date == "20240101"
    assert r.transaction_amount is None and r.policy_id is None


def test_quoted_line_breaks(spark, scratch):
    root = scratch("multi")
    land(root, "p.csv", 'policy_id,policy_status\nP1,"two\nlines"\n')
    assert read_csv(spark, root, ENTITY_SCHEMAS["policy"], multi_line=True).first().policy_status == "two\nlines"


def test_an_empty_cycle_replaces_what_was_staged(spark, scratch):
    staged = scratch("restaged")
    pol = with_provenance(spark.createDataFrame([("P1", "ACTIVE")], "policy_id string, policy_status string"),
                          "20240101", "policy", NOW)
    stage_parquet(pol, staged, "policy", "20240101")
    stage_parquet(with_provenance(pol, "20240102", "policy", NOW), staged, "policy", "20240102")
    stage_parquet(pol.limit(0), staged, "policy", "20240101")
    assert read_staged(spark, staged, "policy", "20240101").count() == 0
    assert read_staged(spark, staged, "policy", "20240102").count() == 1
    assert set(load_cycle(spark, staged, "20240101", ["policy"], missing="error")) == {"policy"}  # the gate sees it, empty


def test_staging_writes_few_files(spark, scratch):
    staged = scratch("few")
    rows = spark.range(0, 4000, 1, 16).selectExpr("cast(id as string) AS policy_id", "'A' AS policy_status",
                                                  "cast(id % 20 as string) AS cycle_date")
    stage_parquet(rows, staged, "policy")
    files = [f for _, _, names in os.walk(local_path(staged)) for f in names if f.endswith(".parquet")]
    assert len(files) <= 40


def test_stage_and_partition_pruned_load(spark, scratch):
    staged = scratch("staged")
    pol = spark.createDataFrame([("P1", "ACTIVE")], "policy_id string, policy_status string")
    for cycle in ("20240101", "20240102"):
        stage_parquet(with_provenance(pol, cycle, "policy", NOW), staged, "policy")
    stage_parquet(with_provenance(pol.union(pol), "20240102", "policy", NOW), staged, "policy")
    one = read_staged(spark, staged, "policy", "20240101")
    assert "PartitionFilters: [isnotnull(cycle_date" in one._jdf.queryExecution().executedPlan().toString() \
        or "cycle_date" in plan_text(one)
    assert one.count() == 1
    assert read_staged(spark, staged, "policy", "20240102").count() == 2  # replaced, not appended
    tables = load_cycle(spark, staged, "20240101", ["policy", "rider"], missing="skip")
    assert set(tables) == {"policy"}
    with pytest.raises(FileNotFoundError):
        load_cycle(spark, staged, "20240101", ["policy", "rider"], missing="error")


def test_discover_routes_by_first_expected_type(spark, scratch):
    landing = scratch("landing")
    land(landing, "raw/policy/cycle_20240101/policy.csv.pgp", "x")
    land(landing, "raw/rider/cycle_20240101/rider_policy.csv.pgp", "x")
    land(landing, "raw/misc/cycle_20240101/readme.txt", "x")
    land(landing, "raw/policy/cycle_20240102/policy.csv.pgp", "x")
    found = {r.object_key: r.file_type for r in discover_cycle_files(spark, landing, "20240101").collect()}
    assert found == {"raw/policy/cycle_20240101/policy.csv.pgp": "policy",
                     "raw/rider/cycle_20240101/rider_policy.csv.pgp": "policy"}
    assert discover_cycle_files(spark, landing, "20991231").count() == 0


def test_column_encryption_roundtrip_and_bad_input(spark):
    df = spark.createDataFrame([("secret",), (None,)], "v string")
    enc = df.select(encrypt_column("v", KEY).alias("e"))
    back = [r.d for r in enc.select(decrypt_column("e", KEY).alias("d")).collect()]
    assert back == ["secret", None]
    bad = spark.createDataFrame([("not base64 !",), ("aGVsbG8=",)], "e string")
    assert [r.d for r in bad.select(decrypt_column("e", KEY).alias("d")).collect()] == [None, None]
    wrong = enc.select(decrypt_column("e", "fedcba9876543210").alias("d")).collect()
    assert wrong[0].d is None


def test_line_encrypted_csv(spark, scratch):
    path = scratch("lines")
    pol = spark.createDataFrame([("P1", "ACTIVE"), ("P2", "a,b \"quoted\"")], "policy_id string, policy_status string")
    write_encrypted_lines(pol, path, KEY)
    back = read_encrypted_lines(spark, path, KEY, ENTITY_SCHEMAS["policy"])
    assert sorted(tuple(r) for r in back.collect()) == [("P1", "ACTIVE"), ("P2", 'a,b "quoted"')]
    with pytest.raises(Exception, match="does not decrypt"):
        read_encrypted_lines(spark, path, "fedcba9876543210", ENTITY_SCHEMAS["policy"]).count()
    bad = read_encrypted_lines(spark, path, "fedcba9876543210", ENTITY_SCHEMAS["policy"], keep_corrupt=True)
    assert bad.filter(F.col("_corrupt_record").isNotNull()).count() == 2


def test_whole_file_encrypted_csv(spark, scratch):
    root = scratch("files")
    text = "policy_id,policy_status\nP1,ACTIVE\nP2,RENEWAL\n"
    land(root, "a.csv.pgp", encrypt_text(spark, text, KEY))
    land(root, "b.csv.pgp", b"garbage that is not ciphertext")
    out = read_encrypted_files(spark, [os.path.join(root, "a.csv.pgp")], KEY, ENTITY_SCHEMAS["policy"])
    assert sorted(tuple(r) for r in out.collect()) == [("P1", "ACTIVE"), ("P2", "RENEWAL")]
    both = read_encrypted_files(spark, root, KEY, ENTITY_SCHEMAS["policy"], keep_corrupt=True)
    assert both.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_strict_decrypt_raises_on_bad_input(spark):
    bad = spark.createDataFrame([("aGVsbG8=",)], "e string")
    with pytest.raises(Exception):
        bad.select(decrypt_column("e", KEY, strict=True)).collect()


def test_observed_row_count_needs_no_extra_pass(spark):
    from cyclemart.operators.aggregates import observe_rows, row_count

    df = spark.range(1234)
    watched, obs = observe_rows(df)
    watched.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1234 and row_count(df).first().row_count == 1234


def test_csv_files_with_different_header_orders(spark, scratch):
    root = scratch("headers")
    land(root, "a.csv", "policy_id,policy_status\nP1,ACTIVE\n")
    land(root, "b.csv", "policy_status,policy_id\nRENEWAL,P2\n")
    rows = sorted(tuple(r) for r in read_csv(spark, root, ENTITY_SCHEMAS["policy"]).collect())
    assert rows == [("P1", "ACTIVE"), ("P2", "RENEWAL")]


def test_whole_file_by_header_with_line_breaks(spark, scratch):
    root = scratch("whole")
    land(root, "a.csv.pgp", encrypt_text(spark, 'Policy_Status,POLICY_ID\n"two\nlines",P1\nACTIVE,P2,extra\n,P3\n', KEY))
    rows = read_encrypted_files(spark, root, KEY, ENTITY_SCHEMAS["policy"], keep_corrupt=True).collect()
    good = sorted((r.policy_id, r.policy_status) for r in rows if r._corrupt_record is None)
    assert good == [("P1", "two\nlines"), ("P3", None)]
    assert [r._corrupt_record.split(": ")[1] for r in rows if r._corrupt_record] == ["ACTIVE,P2,extra"]
    with pytest.raises(Exception, match="does not decrypt"):
        read_encrypted_files(spark, root, KEY, ENTITY_SCHEMAS["policy"]).collect()


def test_the_key_is_in_no_plan(spark):
    df = spark.range(3).selectExpr("cast(id as string) AS v").select(encrypt_column("v", KEY).alias("e"))
    back = df.select(decrypt_column("e", KEY).alias("d"))
    assert sorted(r.d for r in back.collect()) == ["0", "1", "2"]
    texts = back._jdf.queryExecution().toString()  # noqa: SLF001 - all four plans
    assert KEY not in texts and KEY.encode().hex() not in texts.lower()


@pytest.fixture
def customers(spark, scratch, monkeypatch):
    """A customer table of four tasks whose first nation has a third of the rows; the queries'
    scratch folder, and nothing to bring rows to the driver with."""
    rows = [(i, f'Name "{i}", x', 0 if i % 3 == 0 else i % 25, "BUILDING" if i % 7 == 0 else "OTHER") for i in range(600)]
    rows += [(600, None, 0, "OTHER"), (601, "no nation", None, "OTHER")]
    frame = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").repartition(4)
    folder = scratch("landing")
    monkeypatch.setattr(ingest, "read_table", lambda *_: frame)
    monkeypatch.setattr(ingest, "scratch_path", lambda *_: folder)
    for name in ("toLocalIterator", "toPandas", "coalesce"):
        monkeypatch.setattr(type(frame), name, lambda *_, **__: pytest.fail("rows pass through one place"))
    return rows, folder


def test_whole_files_are_bounded_and_written_by_tasks(spark, customers, monkeypatch):
    rows, folder = customers
    monkeypatch.setattr(encrypted, "FILE_CHARS", 500, raising=False)
    out = ingest.encrypted_whole_file(spark, "")
    want = [(i, None if n is None else f"{n}\n{m}", k) for i, n, k, m in rows]
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
    names = os.listdir(local_path(folder))
    files = [n for n in names if n.endswith(".pgp")]
    assert not [n for n in names if n.startswith("_")]
    assert sum(n.startswith("c_nationkey-0-") for n in files) > 8
    assert max(os.path.getsize(os.path.join(local_path(folder), n)) for n in files) < 700


def test_whole_files_of_many_values_hold_little(spark, customers, monkeypatch):
    rows, _ = customers
    monkeypatch.setattr(encrypted, "HELD_CHARS", 300, raising=False)
    out = ingest.encrypted_whole_file(spark, "")
    assert sorted(r.c_custkey for r in out.collect()) == [r[0] for r in rows]


def test_whole_files_of_an_empty_table(spark, scratch):
    empty = spark.createDataFrame([], "a string, b string")
    path = scratch("none")
    encrypted.write_encrypted_files(empty, path, KEY, "a")
    assert read_encrypted_files(spark, path, KEY, empty.schema).count() == 0


def test_every_task_lands_its_own_header(spark, customers, monkeypatch):
    rows, folder = customers
    plain = spark.createDataFrame([(i, f"n{i}", k, m) for i, _, k, m in rows], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    monkeypatch.setattr(ingest, "read_table", lambda *_: plain.repartition(4))
    out = ingest.csv_corrupt_records(spark, "").collect()
    good = sorted((r.c_custkey, r.c_name) for r in out if not r.is_corrupt)
    assert good == sorted((i, f"n{i}") for i, _, _, m in rows if m != "BUILDING")
    assert sum(r.is_corrupt for r in out) == sum(m == "BUILDING" for *_, m in rows)
    landed = os.path.join(local_path(folder), "landed")
    parts = [n for n in os.listdir(landed) if n.startswith("part-")]
    assert len(parts) == 4
    for n in parts:
        assert open(os.path.join(landed, n)).readline() == "C_CustKey,C_NAME\n"
