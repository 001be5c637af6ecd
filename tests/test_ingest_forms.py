"""Key rings, framed files and records that span lines, splits and frames."""

import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.crypto import decrypt_column, encrypt_column
from cyclemart.functions.keyring import KeyRing, key_id, seal, unseal
from cyclemart.session import local_path
from cyclemart.sources import frames, records
from cyclemart.sources.encrypted import read_encrypted_files, read_encrypted_lines, write_encrypted_files, write_encrypted_lines
from cyclemart.sources.files import csv_lines, read_csv
from cyclemart.sources.frames import read_encrypted_frames, rewrap_frames, write_encrypted_frames
from tests.test_sources import land

OLD = KeyRing({"2024-01": "0123456789abcdef"}, "2024-01")
NEW = OLD.rotated("2024-02", "fedcba9876543210")
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("amount", T.DoubleType())])


# --- key rings ------------------------------------------------------------------------------
def test_the_key_is_chosen_from_the_value(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "v string")
    both = df.select(encrypt_column("v", OLD).alias("e")).union(df.select(encrypt_column("v", NEW).alias("e")))
    named = both.select(key_id(F.unbase64("e")).alias("k"), decrypt_column("e", NEW).alias("d")).collect()
    assert sorted(map(tuple, named), key=repr) == sorted(
        [("2024-01", "a"), ("2024-01", ""), (None, None), ("2024-02", "a"), ("2024-02", ""), (None, None)], key=repr)
    retired = NEW.without("2024-01")
    assert sorted(r.d for r in both.select(decrypt_column("e", retired).alias("d")).collect() if r.d is not None) == ["", "a"]
    with pytest.raises(Exception, match="not in the ring"):
        both.select(decrypt_column("e", retired, strict=True)).collect()


def test_a_changed_header_or_value_does_not_open(spark):
    same = KeyRing({"a": "0123456789abcdef", "b": "0123456789abcdef"}, "a")  # the id is authenticated, too
    blob = bytes(spark.range(1).select(seal(F.lit("x").cast("binary"), same).alias("b")).first().b)
    cases = [blob, blob.replace(b"\x01a", b"\x01b", 1), blob[:-1], b"", b"CMK1", b"CMK1\xffa", blob[1:], blob[:9] + bytes([blob[9] ^ 1]) + blob[10:]]
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cases)], "i int, b binary")
    got = [r.v for r in df.select("i", unseal(F.col("b"), same).cast("string").alias("v")).orderBy("i").collect()]
    assert got == ["x"] + [None] * (len(cases) - 1)


def test_no_ring_key_in_a_plan_or_in_print(spark):
    df = spark.range(3).selectExpr("cast(id as string) AS v").select(encrypt_column("v", NEW).alias("e"))
    back = df.select(decrypt_column("e", NEW).alias("d"))
    assert sorted(r.d for r in back.collect()) == ["0", "1", "2"]
    texts = back._jdf.queryExecution().toString() + repr(NEW)  # noqa: SLF001 - all four plans
    for key in ("0123456789abcdef", "fedcba9876543210"):
        assert key not in texts and key.encode().hex() not in texts.lower()
    with pytest.raises(TypeError):
        import pickle

        pickle.dumps(NEW)


def test_rings_refuse_what_cannot_work():
    for make in (lambda: KeyRing({"a": "short"}, "a"), lambda: KeyRing({"a": "0" * 16}, "b"), lambda: KeyRing({"a:b": "0" * 16}, "a:b"),
                 lambda: NEW.rotated("2024-01", "0" * 16), lambda: NEW.without("2024-02")):
        with pytest.raises(ValueError):
            make()


@pytest.mark.parametrize("form", ["lines", "files", "frames"])
def test_one_read_over_two_keys(spark, scratch, form):
    path = scratch(form)
    write = {"lines": write_encrypted_lines, "frames": write_encrypted_frames,
             "files": lambda df, p, ring: write_encrypted_files(df, p, ring, "id")}[form]
    read = {"lines": read_encrypted_lines, "files": read_encrypted_files, "frames": read_encrypted_frames}[form]
    stray = KeyRing({"other": "aaaaaaaaaaaaaaaa"}, "other")
    for i, ring in enumerate((OLD, NEW, stray)):
        write(spark.createDataFrame([(i, f"n{i}", 1.5)], SCHEMA), f"{path}/{i}", ring)
    rows = read(spark, [f"{path}/{i}" for i in range(3)], NEW, SCHEMA, keep_corrupt=True).collect()
    assert sorted((r.id, r.note) for r in rows if r._corrupt_record is None) == [(0, "n0"), (1, "n1")]
    assert any(r._corrupt_record for r in rows)
    with pytest.raises(Exception, match="does not decrypt"):
        read(spark, [f"{path}/{i}" for i in range(3)], NEW, SCHEMA).collect()


# --- records that span lines ------------------------------------------------------------------
def _state_by_definition(state: int, line: str) -> int:
    now = "Q" if state else "S"
    for c in line:
        if now == "S":
            now = "Q" if c == '"' else "S" if c == "," else "U"
        elif now == "U":
            now = "S" if c == "," else "U"
        elif now == "Q":
            now = "E" if c == '"' else "Q"
        else:
            now = "Q" if c == '"' else "S" if c == "," else "U"
    return int(now == "Q")


@settings(max_examples=1000, deadline=None)
@given(st.integers(0, 1), st.text(alphabet='",a \r', max_size=14))
def test_state_after_a_line_against_the_definition(state, line):
    assert records.after_line(state, line) == _state_by_definition(state, line)


def _field(rnd):
    kind = rnd.randrange(6)
    text = "".join(rnd.choice('ab",\n x') for _ in range(rnd.randrange(12)))
    if kind == 0:
        return ""
    if kind == 1:
        return "plain"
    return '"' + text.replace('"', '""') + '"'


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed", range(6))
def test_split_reading_equals_multiline(spark, scratch, small_splits, seed):
    rnd = random.Random(seed)
    root = scratch("adversarial")
    end = "\r\n" if seed % 3 == 2 else "\n"
    for f in range(3):
        rows = [",".join([str(i), _field(rnd), f"{rnd.random():.3f}"]) for i in range(rnd.randrange(1, 40))]
        head = "id,note,amount"
        text = end.join([head, *rows]).replace("\r\n", "\n").replace("\n", end) + (end if seed % 3 else "" if end == "\n" else end)
        land(root, f"{f}.csv", text.encode())
    lines = csv_lines(spark, [root])
    assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 3  # one file is read by several tasks
    got = read_csv(spark, root, SCHEMA, multi_line=True)
    want = spark.read.options(**records.DIALECT).option("header", "true").option("multiLine", "true").schema(SCHEMA).csv(root)
    key = lambda rows: sorted(((r.id, r.note, r.amount) for r in rows), key=repr)
    assert key(got.collect()) == key(want.collect())


def test_a_record_over_many_splits_and_a_quote_that_never_closes(spark, scratch, small_splits):
    root = scratch("long")
    note = "\n".join(f"line {i} of a note, with a comma" for i in range(50))
    land(root, "a.csv", f'id,note,amount\n1,"{note}",2\n2,x,3\n')
    rows = read_csv(spark, root, SCHEMA, multi_line=True).collect()
    assert sorted((r.id, r.note, r.amount) for r in rows) == [(1, note, 2.0), (2, "x", 3.0)]
    land(root, "b.csv", f'id,note,amount\n7,ok,1\n8,"{note}\n9,y,2\n')
    rows = read_csv(spark, root, SCHEMA, multi_line=True, keep_corrupt=True).collect()
    assert sorted(r.id for r in rows if r._corrupt_record is None) == [1, 2, 7]
    kept = "".join(r._corrupt_record for r in rows if r._corrupt_record)
    assert all(f"line {i} of a note" in kept for i in range(50)) and "9,y,2" in kept  # nothing is lost silently
    with pytest.raises(Exception, match="does not parse"):
        read_csv(spark, root, SCHEMA, multi_line=True).collect()


def test_many_chunks_inside_records_are_joined_by_shuffle(spark, scratch, small_splits, monkeypatch):
    monkeypatch.setattr(records, "MAX_BROADCAST_CHUNKS", 1)
    root = scratch("shuffled")
    rows = [(i, "\n".join(f"n{i}.{j}" for j in range(20)), float(i)) for i in range(30)]
    land(root, "a.csv", "id,note,amount\n" + "".join(f'{i},"{n}",{a}\n' for i, n, a in rows))
    got = read_csv(spark, root, SCHEMA, multi_line=True).collect()
    assert sorted((r.id, r.note, r.amount) for r in got) == rows


def test_files_of_different_headers_keep_their_names_off_the_driver(spark, scratch, monkeypatch):
    root = scratch("headers")
    land(root, "a.csv", 'id,note,amount\n1,"a\nb",2\n2,plain,x\n')
    land(root, "b.csv", "﻿Amount,extra,ID,NOTE\r\n4,e,3,z\r\n")
    land(root, "c.csv", "amount,note,id\n5,short\n")
    rows = read_csv(spark, root, SCHEMA, multi_line=True, keep_corrupt=True).collect()
    good = sorted((r.id, r.note, r.amount) for r in rows if r._corrupt_record is None)
    assert good == [(1, "a\nb", 2.0), (2, "plain", None), (3, "z", 4.0)]
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ["5,short"]


def test_prefix_composition_of_states(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for f in "abc":
        state = 0
        for c in range(60):
            between, inside = rnd.choice([(0, 1), (0, 1), (1, 0), (0, 0), (1, 1)])
            want[f, c * 7] = state
            rows.append((f, c * 7, between, inside))
            state = inside if state else between
    rnd.shuffle(rows)
    got = records.entering(spark.createDataFrame(rows, "file string, chunk long, between int, inside int")).collect()
    assert {(r.file, r.chunk): r.enters for r in got} == want


# --- framed files ---------------------------------------------------------------------------
def _noted(n):  # an empty field is read as NULL, quoted or not
    return [(i, f'note {i},\nsecond "line"\n\nlast' if i % 3 else None, i / 4) for i in range(n)]


def _land_frames(spark, path, rows, limit=60, ring=OLD):
    write_encrypted_frames(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, ring, frame_chars=limit)
    [name] = [n for n in os.listdir(local_path(path)) if n.startswith("part-")]
    return os.path.join(local_path(path), name)


def _content(rows):
    return sorted(((r.id, r.note, r.amount) for r in rows if r._corrupt_record is None), key=repr)


def test_one_framed_file_is_read_by_many_tasks(spark, scratch):
    path = scratch("framed")
    rows = _noted(200)
    file = _land_frames(spark, path, rows)
    lines = open(file).read().splitlines()
    assert len(lines) > 80 and max(map(len, lines)) < 600  # no line holds the file
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(file) // 6))
    try:
        df = read_encrypted_frames(spark, path, OLD, SCHEMA, keep_corrupt=True)
        assert frames._landed(spark, path, None).select(F.spark_partition_id().alias("p")).distinct().count() >= 4
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not [r for r in got if r._corrupt_record]
    assert _content(got) == sorted(rows, key=repr)
    assert read_encrypted_frames(spark, path, OLD, SCHEMA).count() == 200


@pytest.mark.parametrize("damage", ["byte", "missing", "swapped", "cut", "repeated", "first", "garbage", "renumbered"])
def test_a_damaged_frame_is_a_reject(spark, scratch, damage):
    path = scratch("damaged")
    rows = _noted(60)
    file = _land_frames(spark, path, rows)
    lines = open(file).read().splitlines()
    at = len(lines) // 2
    if damage == "byte":
        lines[at] = lines[at][:-8] + ("A" if lines[at][-8] != "A" else "B") + lines[at][-7:]
    elif damage == "missing":
        del lines[at]
    elif damage == "swapped":
        a, b = (x.split(":") for x in lines[at:at + 2])
        a[-1], b[-1] = b[-1], a[-1]
        lines[at:at + 2] = [":".join(a), ":".join(b)]
    elif damage == "cut":
        del lines[at:]
    elif damage == "repeated":
        lines.insert(at, lines[at])
    elif damage == "first":
        lines[0] = lines[0][:-8] + "AAAAAAA="
    elif damage == "garbage":
        lines[at] = "not a frame"
    else:
        fields = lines[at].split(":")
        fields[3] = str(int(fields[3]) + 1000)
        lines[at] = ":".join(fields)
    os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    open(file, "w").write("\n".join(lines) + "\n")
    got = read_encrypted_frames(spark, path, OLD, SCHEMA, keep_corrupt=True).collect()
    good = _content(got)
    assert any(r._corrupt_record for r in got)
    assert set(good) <= set(rows)  # what is read is right
    if damage == "first":
        assert not good  # the order of the columns is lost with the header
    elif damage not in ("cut", "repeated"):
        assert len(good) >= 50  # and only what the damage touches is lost
    with pytest.raises(Exception, match="does not decrypt"):
        read_encrypted_frames(spark, path, OLD, SCHEMA).collect()


def test_rotation_renews_the_sealed_keys_alone(spark, scratch):
    path, to = scratch("before"), scratch("after")
    rows = _noted(80)
    old = open(_land_frames(spark, path, rows)).read().splitlines()
    rewrap_frames(spark, path, to, NEW)
    new = [x for n in sorted(os.listdir(local_path(to))) if n.startswith("part-") for x in open(os.path.join(local_path(to), n)).read().splitlines()]
    assert [x.split(":", 2)[2] for x in old] == [x.split(":", 2)[2] for x in new] and old[0] != new[0]
    got = read_encrypted_frames(spark, to, NEW.without("2024-01"), SCHEMA, keep_corrupt=True).collect()
    assert _content(got) == sorted(rows, key=repr) and not [r for r in got if r._corrupt_record]


def test_frames_of_an_empty_table_and_of_several_files(spark, scratch):
    path = scratch("several")
    write_encrypted_frames(spark.createDataFrame([], SCHEMA), path, OLD)
    assert read_encrypted_frames(spark, path, OLD, SCHEMA).count() == 0
    rows = _noted(90)
    other = spark.createDataFrame(rows[:40], SCHEMA).selectExpr("amount AS Amount", "id AS ID", "'x' AS more", "note").repartition(3)
    write_encrypted_frames(other, f"{path}/a", OLD, frame_chars=100)
    write_encrypted_frames(spark.createDataFrame(rows[40:], SCHEMA).repartition(2), f"{path}/b", NEW, frame_chars=100)
    got = read_encrypted_frames(spark, [f"{path}/a", f"{path}/b"], NEW, SCHEMA, keep_corrupt=True).collect()
    assert _content(got) == sorted(rows, key=repr) and not [r for r in got if r._corrupt_record]


def test_long_fields_and_bad_values_in_every_form(spark, scratch):
    path = scratch("forms")
    rows = [(1, "x" * 300_000, "abc"), (2, 'a\n"b"', "1.5"), (3, "", None), (None, None, "2")]
    df = spark.createDataFrame(rows, "id long, note string, amount string")
    df.write.options(**records.DIALECT).option("header", "true").csv(f"{path}/plain")
    write_encrypted_lines(df, f"{path}/lines", OLD)
    write_encrypted_files(df.withColumn("k", F.lit("k")), f"{path}/files", OLD, "k")
    write_encrypted_frames(df, f"{path}/frames", OLD, frame_chars=1000)
    want = sorted([(1, "x" * 300_000, None), (2, 'a\n"b"', 1.5), (3, None, None), (None, None, 2.0)], key=repr)
    for form, got in {
        "plain": read_csv(spark, f"{path}/plain", SCHEMA, multi_line=True, keep_corrupt=True),
        "lines": read_encrypted_lines(spark, f"{path}/lines", OLD, SCHEMA, keep_corrupt=True),
        "files": read_encrypted_files(spark, f"{path}/files", OLD, SCHEMA, keep_corrupt=True),
        "frames": read_encrypted_frames(spark, f"{path}/frames", OLD, SCHEMA, keep_corrupt=True),
    }.items():
        assert _content(got.collect()) == want, form


def test_decryption_and_parsing_run_once_a_row(spark, scratch):
    path = scratch("once")
    write_encrypted_lines(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), path, OLD)
    df = read_encrypted_lines(spark, path, OLD, SCHEMA, keep_corrupt=True).filter("_corrupt_record IS NULL")
    plan = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert len(re.findall(r"(?i)aes_?decrypt", plan)) <= 2 and "Generate" in plan
