"""Column encryption, CSV and encrypted CSV ingest, staged cycles (CR-1, CR-2, IO-2..IO-7)."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.crypto import decrypt_column, encrypt_column
from cyclemart.functions.keyring import KeyRing
from cyclemart.functions.timeutil import instant
from cyclemart.plans.catalogue.base import CYCLE, DEMO_KEY, NOW, _orders, query
from cyclemart.session import scratch_path
from cyclemart.sources.encrypted import (
    read_encrypted_files, read_encrypted_lines, write_encrypted_files, write_encrypted_lines,
)
from cyclemart.sources.frames import read_encrypted_frames, rewrap_frames, write_encrypted_frames
from cyclemart.sources.files import read_csv, read_staged, stage_parquet, with_provenance, write_csv
from cyclemart.sources.tables import read_table


# ============================================================== crypto and ingest (CR-*, IO-*)


@query("encrypt_roundtrip", "SELECT c_custkey, c_name, TRUE AS is_encrypted FROM customer")
def encrypt_roundtrip(spark, root):
    c = read_table(spark, root, "customer").select(
        "c_custkey", encrypt_column("c_name", DEMO_KEY).alias("c_name_enc"), "c_name")
    return c.select("c_custkey", decrypt_column("c_name_enc", DEMO_KEY).alias("c_name"),
                    (F.col("c_name_enc") != F.col("c_name")).alias("is_encrypted"))


_CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_PROVENANCE_SQL = f"""SELECT *, TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS ingestion_date,
       '{CYCLE}' AS cycle_date, 'customer' AS file_type FROM customer"""


def _customer_schema(spark):
    return spark.createDataFrame([], _CUSTOMER_SCHEMA).schema


@query("csv_roundtrip", _PROVENANCE_SQL)
def csv_roundtrip(spark, root):
    """IO-3 + IO-4: land customer as CSV, read it back with an explicit schema, tag it."""
    path = scratch_path(spark, "csv")
    write_csv(read_table(spark, root, "customer"), path)
    back = read_csv(spark, path, _customer_schema(spark))
    return with_provenance(back, CYCLE, "customer", NOW)


@query("encrypted_csv", _PROVENANCE_SQL)
def encrypted_csv(spark, root):
    """IO-2: line-encrypted CSV, decrypted and parsed on the executors."""
    path = scratch_path(spark, "enc")
    write_encrypted_lines(read_table(spark, root, "customer"), path, DEMO_KEY)
    back = read_encrypted_lines(spark, path, DEMO_KEY, _customer_schema(spark))
    return with_provenance(back, CYCLE, "customer", NOW)


@query("staged_cycle", f"""
SELECT *, TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AS ingestion_date, 'orders' AS file_type,
       strftime(o_orderdate, '%Y%m') AS cycle_date
FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199801'""")
def staged_cycle(spark, root):
    """IO-5 + IO-7: stage orders partitioned by month, read one cycle by partition pruning."""
    path = scratch_path(spark, "staged")
    o = _orders(spark, root)
    tagged = o.withColumns({"ingestion_date": instant(NOW),
                            "file_type": F.lit("orders"),
                            "cycle_date": F.date_format("o_orderdate", "yyyyMM")})
    stage_parquet(tagged, path, "orders")
    schema = tagged.schema
    return read_staged(spark, path, "orders", "199801", schema)


@query("csv_corrupt_records", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS c_name,
       c_mktsegment = 'BUILDING' AS is_corrupt
FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS c_custkey, c_name, c_mktsegment FROM customer)""")
def csv_corrupt_records(spark, root):
    """IO-3: lines with one field too many come back as corrupt, whole, and the others by
    header name in another letter case."""
    c = read_table(spark, root, "customer")
    path = scratch_path(spark, "corrupt")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.when(F.col("c_mktsegment") == "BUILDING", "extra"))

    def with_header(batches):  # every landed file begins with its header
        for lines in itertools.chain([pa.array(["C_CustKey,C_NAME"])], (b.column(0) for b in batches)):
            yield pa.RecordBatch.from_arrays([lines], names=["value"])

    landed = c.select(line.alias("value")).mapInArrow(with_header, "value string")
    landed.write.option("maxRecordsPerFile", 0).text(f"{path}/landed")  # a file per task
    schema = _customer_schema(spark)
    back = read_csv(spark, f"{path}/landed", T.StructType(schema.fields[:2]), keep_corrupt=True)
    bad = F.col("_corrupt_record").isNotNull()
    return back.select(F.when(~bad, F.col("c_custkey")).alias("c_custkey"), F.when(~bad, F.col("c_name")).alias("c_name"), bad.alias("is_corrupt"))


@query("encrypted_whole_file", "SELECT c_custkey, c_name || chr(10) || c_mktsegment AS note, c_nationkey FROM customer")
def encrypted_whole_file(spark, root):
    """IO-2: files encrypted as a whole, of one nation each, columns in another order, line
    breaks in quoted fields."""
    c = read_table(spark, root, "customer")
    path = scratch_path(spark, "enc-files")
    note = F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("note")
    write_encrypted_files(c.select("c_nationkey", note, F.col("c_custkey").alias("C_CUSTKEY")), path, DEMO_KEY, "c_nationkey")
    schema = T.StructType.fromDDL("c_custkey long, note string, c_nationkey int")
    return read_encrypted_files(spark, path, DEMO_KEY, schema)


@query("ingest_rejects", """
SELECT 'policy' AS file_type, CAST(COUNT(*) AS BIGINT) AS staged,
       CAST((SELECT COUNT(*) FROM customer WHERE c_acctbal < 0) AS BIGINT) AS rejected
FROM orders""")
def ingest_rejects(spark, root):
    """PL-1 + IO-2: lines encrypted with another key are counted and kept apart."""
    from cyclemart.plans.jobs import RejectedRows, ingest_cycle

    base = scratch_path(spark, "rejects")
    policy = _orders(spark, root).select(F.col("o_orderkey").cast("string").alias("policy_id"), F.lit("ACTIVE").alias("policy_status"))
    stray = read_table(spark, root, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("policy_id"), F.lit("ACTIVE").alias("policy_status"))
    landing = f"{base}/landing/raw/policy/cycle_{CYCLE}"
    write_encrypted_lines(policy, f"{landing}/good", DEMO_KEY)
    write_encrypted_lines(stray, f"{landing}/stray", "another-key-1234")
    try:
        ingest_cycle(spark, f"{base}/landing", f"{base}/staged", CYCLE, NOW, DEMO_KEY, "lines", ["policy"])
    except RejectedRows:
        pass
    else:
        raise AssertionError("rows that do not decrypt must not pass unnoticed")
    got = ingest_cycle(spark, f"{base}/landing", f"{base}/staged", CYCLE, NOW, DEMO_KEY, "lines", ["policy"],
                       rejects_root=f"{base}/rejects")
    kept = spark.read.parquet(f"{base}/rejects/policy").agg(F.count("*").alias("rejected"))
    staged = read_staged(spark, f"{base}/staged", "policy", CYCLE).agg(F.count("*").alias("staged"))
    rows = staged.withColumn("file_type", F.lit("policy")).join(kept.withColumn("file_type", F.lit("policy")), "file_type")
    return rows.select("file_type", "staged", F.when(F.col("rejected") == got.rejected["policy"], F.col("rejected")).alias("rejected"))


@query("reingest_empty_cycle", """
SELECT 'first' AS run, CAST(COUNT(*) AS BIGINT) AS rows FROM customer UNION ALL SELECT 'again, empty', 0""")
def reingest_empty_cycle(spark, root):
    """IO-5: a cycle staged again without rows leaves none of the earlier ones."""
    path = scratch_path(spark, "restaged")
    c = with_provenance(read_table(spark, root, "customer"), CYCLE, "customer", NOW)
    out = None
    for run, rows in (("first", c), ("again, empty", c.limit(0))):
        stage_parquet(rows, path, "customer", CYCLE)
        n = read_staged(spark, path, "customer", CYCLE, c.schema).count()
        line = spark.range(1).select(F.lit(run).alias("run"), F.lit(n).cast("long").alias("rows"))
        out = line if out is None else out.unionByName(line)
    return out


# ------------------------------------------------------------------ key rings and large files
def _ring() -> KeyRing:
    return KeyRing({"k1": "first-key-123456"}, "k1")


@query("key_rotation", """
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS c_name, c_mktsegment = 'BUILDING' AS is_reject
FROM customer""")
def key_rotation(spark, root):
    """CR-1/2 + IO-2: one read over lines sealed before and after a rotation; lines sealed with
    a key that the reader's ring lacks are rejects."""
    c = read_table(spark, root, "customer")
    path = scratch_path(spark, "rotation")
    old = _ring()
    new = old.rotated("k2", "second-key-12345")
    stray = KeyRing({"k9": "a-retired-key-00"}, "k9")
    building, early = F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") < 0
    for name, ring, rows in (("early", old, c.filter(~building & early)), ("late", new, c.filter(~building & ~early)), ("stray", stray, c.filter(building))):
        write_encrypted_lines(rows.select("c_custkey", "c_name"), f"{path}/{name}", ring)
    schema = T.StructType.fromDDL("c_custkey long, c_name string")
    back = read_encrypted_lines(spark, [f"{path}/{n}" for n in ("early", "late", "stray")], new, schema, keep_corrupt=True)
    return back.select("c_custkey", "c_name", F.col("_corrupt_record").isNotNull().alias("is_reject"))


_NOTES_SQL = "SELECT c_custkey, c_name || chr(10) || 'say \"' || c_mktsegment || '\", twice' AS note, c_nationkey FROM customer"


def _notes(spark, root):
    note = F.concat("c_name", F.lit('\nsay "'), "c_mktsegment", F.lit('", twice'))
    return read_table(spark, root, "customer").select("c_custkey", note.alias("note"), "c_nationkey")


@query("encrypted_frames", _NOTES_SQL)
def encrypted_frames(spark, root):
    """IO-2: files of frames that many tasks decrypt, records across frames; then a rotation
    that renews the sealed data keys alone, and a read with the new key alone."""
    path = scratch_path(spark, "frames")
    notes = _notes(spark, root)
    write_encrypted_frames(notes, f"{path}/landed", _ring(), frame_chars=2_000)
    ring = _ring().rotated("k2", "second-key-12345")
    rewrap_frames(spark, f"{path}/landed", f"{path}/rotated", ring)
    return read_encrypted_frames(spark, f"{path}/rotated", ring.without("k1"), notes.schema)


@query("csv_quoted_line_breaks", _NOTES_SQL)
def csv_quoted_line_breaks(spark, root):
    """IO-3: plain CSV with quoted line breaks and quotes, read in splits."""
    path = scratch_path(spark, "quoted")
    notes = _notes(spark, root)
    write_csv(notes, path)
    return read_csv(spark, path, notes.schema, multi_line=True)


_FORMS = ("plain", "lines", "files", "frames")


@query("encrypted_forms_agree", f"""
SELECT form, c_custkey, md5(CASE WHEN c_acctbal > 9990 THEN repeat('long ', 40000) ELSE c_name || chr(10) || '"' || c_mktsegment END) AS note_md5,
       CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal END AS c_acctbal
FROM customer, (VALUES {", ".join(f"('{f}')" for f in _FORMS)}) t(form)""")
def encrypted_forms_agree(spark, root):
    """IO-2, PL-1: fields of 200,000 characters, quoted line breaks and bad values give the same
    rows, whatever form they were landed in."""
    c = read_table(spark, root, "customer")
    note = F.when(F.col("c_acctbal") > 9990, F.repeat(F.lit("long "), F.lit(40_000))).otherwise(F.concat("c_name", F.lit('\n"'), "c_mktsegment"))
    rows = c.select("c_custkey", note.alias("note"), F.when(F.col("c_nationkey") == 3, F.lit("abc")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"))
    schema = T.StructType.fromDDL("c_custkey long, note string, c_acctbal double")
    path, ring = scratch_path(spark, "forms"), _ring()
    write_csv(rows, f"{path}/plain")
    write_encrypted_lines(rows, f"{path}/lines", ring)
    write_encrypted_files(rows.withColumn("one", F.lit("")), f"{path}/files", ring, "one")
    write_encrypted_frames(rows, f"{path}/frames", ring, frame_chars=50_000)
    read = {
        "plain": read_csv(spark, f"{path}/plain", schema, multi_line=True),
        "lines": read_encrypted_lines(spark, f"{path}/lines", ring, schema),
        "files": read_encrypted_files(spark, f"{path}/files", ring, schema),
        "frames": read_encrypted_frames(spark, f"{path}/frames", ring, schema),
    }
    out = [read[form].select(F.lit(form).alias("form"), "c_custkey", F.md5("note").alias("note_md5"), "c_acctbal") for form in _FORMS]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
