"""End-to-end cycle jobs (PL-1..PL-4).

    run_cycle = ingest_cycle -> gate_cycle -> build_fact -> publish_fact

Each step reads what the previous one wrote (staged Parquet, the quality report, a
published table version), so lineage is cut at every hand-over and a failed step can be
re-run on its own.  ``build_fact`` stays lazy until ``publish_fact`` writes it; row counts
come from observations on that write, not from extra actions.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cyclemart.functions.keyring import KeyRing
from cyclemart.functions.timeutil import instant
from cyclemart.operators.aggregates import commission_by_agent_policy
from cyclemart.operators.filters import (
    policy_filter, transaction_filter, with_audit_columns, with_commission,
)
from cyclemart.operators.joins import COMMISSION_STAR, StarJoin, guard_plan, join
from cyclemart.operators.merge import MergeError, MergeOutcome, PartitionedTable, VersionedTable, merge_or_init
from cyclemart.operators.quality import QualityError, run_gate
from cyclemart.schemas import DQ_RULES, ENTITY_SCHEMAS, EXPECTED_FILE_TYPES, PRIMARY_KEYS
from cyclemart.sources.encrypted import read_encrypted_files, read_encrypted_lines
from cyclemart.sources.files import (
    CORRUPT_COL, discover_cycle_files, load_cycle, read_csv, remove_staged, stage_parquet,
    with_provenance,
)
from cyclemart.sources.frames import read_encrypted_frames
from cyclemart.streaming.arrivals import utc_now

log = logging.getLogger(__name__)

# Key of the published fact: the transaction key plus the two fan-out dimensions.
FACT_KEYS = PRIMARY_KEYS["transactions"] + ["coverage_id", "rider_id"]


@dataclass
class Ingested:
    """What a cycle's ingest took: files by type, and rejected rows by type."""

    files: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)


class RejectedRows(ValueError):
    """Landed rows that do not decrypt or parse, and no place to keep them."""


def _places(listing: DataFrame) -> tuple[dict[str, list[str]], dict[str, int]]:
    """What to read for each file type, and its number of files.

    A folder whose files are all of one type is read as a folder, so what reaches the
    driver is one row per folder; only a folder of several types is listed file by file.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    by_folder = listing.withColumn("folder", folder).groupBy("folder").agg(
        F.collect_set("file_type").alias("types"), F.count("*").alias("n"))
    paths: dict[str, list[str]] = defaultdict(list)
    files: dict[str, int] = defaultdict(int)
    mixed = []
    for row in by_folder.collect():
        if len(row["types"]) == 1:
            paths[row["types"][0]].append(row["folder"])
            files[row["types"][0]] += row["n"]
        else:
            mixed.append(row["folder"])
    if mixed:
        for row in listing.filter(folder.isin(mixed)).select("path", "file_type").collect():
            paths[row["file_type"]].append(row["path"])
            files[row["file_type"]] += 1
    return paths, files


def ingest_cycle(
    spark: SparkSession,
    landing_root: str,
    staged_root: str,
    cycle_date: str,
    ingested_at: dt.datetime,
    key: str | bytes | KeyRing | None = None,
    encryption: str = "none",
    file_types: list[str] | None = None,
    glob: str | None = None,
    rejects_root: str | None = None,
) -> Ingested:
    """PL-1: discover the cycle's files, read every file of a type together, stage them.

    ``encryption``: ``"none"`` (plain CSV with header), ``"files"`` (whole-file AES),
    ``"lines"`` (line-wise AES) or ``"frames"`` (files of any size; ``key`` is a key ring).
    All forms give the same rows.  The types are staged concurrently.  Rows that do not
    decrypt or parse are counted by the staging write; if there are any they are written to
    ``{rejects_root}/{type}/cycle_date=...``, or, without such a place, the ingest raises.
    """
    if encryption not in ("none", "files", "lines", "frames"):
        raise ValueError(f"unknown encryption {encryption!r}")
    types = file_types or EXPECTED_FILE_TYPES
    paths, files = _places(discover_cycle_files(spark, landing_root, cycle_date, types, glob))

    def stage(file_type: str) -> int:
        schema = ENTITY_SCHEMAS[file_type]
        if encryption == "none":
            df = read_csv(spark, paths[file_type], schema, keep_corrupt=True, multi_line=True, glob=glob)
        elif encryption == "files":
            df = read_encrypted_files(spark, paths[file_type], key, schema, keep_corrupt=True, glob=glob)
        elif encryption == "frames":
            df = read_encrypted_frames(spark, paths[file_type], key, schema, keep_corrupt=True, glob=glob)
        else:
            df = read_encrypted_lines(spark, paths[file_type], key, schema, keep_corrupt=True, glob=glob)
        seen = Observation(f"ingest_{file_type}")
        bad = F.col(CORRUPT_COL).isNotNull()
        good = df.observe(seen, F.count_if(bad).alias("rejected")).filter(~bad).drop(CORRUPT_COL)
        stage_parquet(with_provenance(good, cycle_date, file_type, ingested_at), staged_root, file_type, cycle_date)
        rejected = int(seen.get["rejected"])
        if rejected and rejects_root is not None:
            rows = df.filter(bad).select(F.col(CORRUPT_COL).alias("raw"))
            rows.write.mode("overwrite").parquet(f"{rejects_root.rstrip('/')}/{file_type}/cycle_date={cycle_date}")
        return rejected

    with ThreadPoolExecutor(max_workers=max(1, len(paths))) as pool:
        run = inheritable_thread_target(spark)(stage)
        rejected = {t: n for t, n in zip(paths, pool.map(run, paths)) if n}
    if rejected and rejects_root is None:
        for file_type in rejected:  # a gate must not pass on what is left of the type
            remove_staged(spark, staged_root, file_type, cycle_date)
        raise RejectedRows(f"rows that do not decrypt or parse in cycle {cycle_date}: {rejected}")
    return Ingested(dict(files), rejected)


def gate_cycle(
    spark: SparkSession,
    staged_root: str,
    cycle_date: str,
    report_root: str | None,
    generated_at: dt.datetime,
    rules: dict | None = None,
    expected: list[str] | None = None,
) -> list[dict]:
    """PL-2: strict load of every expected table, report written, then the gate."""
    expected = expected or EXPECTED_FILE_TYPES
    tables = load_cycle(spark, staged_root, cycle_date, expected, missing="error")
    report_path = None if report_root is None else f"{report_root.rstrip('/')}/{cycle_date}"
    return run_gate(spark, tables, rules or DQ_RULES, report_path, cycle_date, generated_at, expected)


def filtered_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """FP-2 / FP-3 on the transactions and policy tables; the rest pass unchanged."""
    out = dict(tables)
    if "transactions" in out:
        out["transactions"] = transaction_filter(out["transactions"])
    if "policy" in out:
        out["policy"] = policy_filter(out["policy"])
    return out


def build_fact(tables: dict[str, DataFrame], cycle_date: str, now: dt.datetime,
               steps=None) -> DataFrame:
    """PL-3 (lazy): filters, star join, commission, warehouse audit columns."""
    joined = StarJoin("transactions", steps or COMMISSION_STAR).apply(filtered_tables(tables))
    return with_audit_columns(with_commission(joined), cycle_date, now)


def commission_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """AG-4: commission per (agent, policy) of the transactions that reach the fact.

    Same row set as the policy inner join (semi join on active policy keys), but taken
    before the coverage x rider fan-out, so each transaction counts once.
    """
    filtered = filtered_tables(tables)
    tx = filtered["transactions"]
    if "policy" in filtered:
        tx = join(tx, filtered["policy"].select("policy_id"), "policy_id", "left_semi", "broadcast")
    return commission_by_agent_policy(tx)


def publish_fact(table: VersionedTable | PartitionedTable, fact: DataFrame, now: dt.datetime,
                 cycle_date: str, keys: list[str] | None = None) -> MergeOutcome:
    """MG-4 for the fact: NULL-safe keys, because the left joins leave NULL ids.

    A fact key that repeats (e.g. two exchange rows share a code) raises instead of
    silently publishing duplicates, and so does a plan with a join without keys, before it
    runs.
    """
    fact = guard_plan(fact)
    if isinstance(table, PartitionedTable):
        # the fact's cycle is part of its key, so a transaction stays in its partition
        by_cycle = [*(keys or FACT_KEYS), *([table.partition_col] if table.partition_col not in (keys or FACT_KEYS) else [])]
        return table.merge_or_init(fact, by_cycle, now=now, cycle_date=cycle_date,
                                   null_safe_keys=True, on_duplicate="error")
    return merge_or_init(table, fact, keys or FACT_KEYS, now=now, cycle_date=cycle_date,
                         null_safe_keys=True, on_duplicate="error")


def publish_summary(tables: dict[str, DataFrame], summary_root: str, cycle_date: str) -> None:
    """AG-4 output: commission per (agent, policy) of the cycle, replacing its partition."""
    summary = commission_summary(tables).withColumn("cycle_date", F.lit(cycle_date))
    (summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("cycle_date").parquet(summary_root))


@dataclass
class CycleRun:
    cycle_date: str
    files: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)
    merge: MergeOutcome | None = None


def run_cycle(
    spark: SparkSession,
    landing_root: str,
    staged_root: str,
    report_root: str,
    fact_root: str,
    cycle_date: str,
    now: dt.datetime,
    key: str | bytes | KeyRing | None = None,
    encryption: str = "none",
    layout: str = "partitions",
    summary_root: str | None = None,
    rejects_root: str | None = None,
) -> CycleRun:
    """PL-4: ingest, gate (stops on failure by raising), build and publish one cycle.

    ``layout="partitions"`` (default) rewrites only the cycle's partition of the fact in
    place, so the cost of a cycle does not grow with the history kept;
    ``layout="versions"`` publishes a new immutable version per cycle (time travel).
    ``summary_root`` also publishes the AG-4 commission summary of the cycle;
    ``rejects_root`` keeps rows that do not decrypt or parse (without it they raise).
    """
    run = CycleRun(cycle_date)
    ingested = ingest_cycle(spark, landing_root, staged_root, cycle_date, now, key, encryption,
                            rejects_root=rejects_root)
    run.files, run.rejected = ingested.files, ingested.rejected
    run.quality = gate_cycle(spark, staged_root, cycle_date, report_root, now)
    tables = load_cycle(spark, staged_root, cycle_date, missing="skip")
    fact = build_fact(tables, cycle_date, now)
    table = (PartitionedTable(spark, fact_root, "dw_cycle_date") if layout == "partitions"
             else VersionedTable(spark, fact_root, ["dw_cycle_date"]))
    run.merge = publish_fact(table, fact, now, cycle_date)
    if summary_root is not None:
        publish_summary(tables, summary_root, cycle_date)
    return run


#: What a cycle's own data can cause; anything else stops the stream.
CYCLE_FAILURES = (QualityError, MergeError, RejectedRows, FileNotFoundError)


def cycle_trigger(landing_root: str, staged_root: str, report_root: str, fact_root: str,
                  now=utc_now, key: str | bytes | KeyRing | None = None, encryption: str = "none",
                  layout: str = "partitions", rejects_root: str | None = None):
    """Handler for the cycles that :func:`~cyclemart.streaming.arrivals.emit_once` passes on.

    The batch holds the cycles that just became complete (a handful of rows).  A cycle that
    fails its gate, or whose data cannot be merged or parsed, is recorded below
    ``{report_root}/failed`` and the others still run.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for row in batch.select("cycle_date").distinct().collect():
            cycle = row["cycle_date"]
            try:
                run_cycle(spark, landing_root, staged_root, report_root, fact_root, cycle, now(), key,
                          encryption, layout, rejects_root=rejects_root)
            except CYCLE_FAILURES as failed:
                log.error("cycle %s failed: %s", cycle, failed)
                spark.range(1).select(
                    F.lit(cycle).alias("cycle_date"), F.lit(type(failed).__name__).alias("error"),
                    F.lit(str(failed)).alias("message"), instant(now()).alias("failed_at"),
                ).write.mode("overwrite").json(f"{report_root.rstrip('/')}/failed/{cycle}")
    return handle


__all__ = [
    "FACT_KEYS", "CycleRun", "Ingested", "RejectedRows", "build_fact", "commission_summary", "cycle_trigger", "filtered_tables",
    "gate_cycle", "ingest_cycle", "publish_fact", "publish_summary", "run_cycle",
]
