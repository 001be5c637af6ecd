"""Whole cycle jobs on entities landed from the driver tables (PL-1..PL-4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.operators.dedup import keep_first
from cyclemart.plans.catalogue.aggregates import _DEDUP_TIES
from cyclemart.plans.catalogue.base import CYCLE, DEMO_KEY, _li, NOW, ORACLE_SQL, _orders, query
from cyclemart.session import scratch_path
from cyclemart.sources.encrypted import write_encrypted_lines
from cyclemart.sources.files import write_csv
from cyclemart.sources.tables import read_table


# ============================================================== whole cycle jobs (PL-1..PL-4)
# The six entities are landed as CSV files derived from the driver tables, under
# raw/{type}/cycle_{d}/, and then run through the real jobs.

def entity_frames(spark: SparkSession, root: str, unique_transactions: bool) -> dict[str, DataFrame]:
    """Role-mapped entity tables with the documented column names (ids as text)."""
    li = _li(spark, root)
    if unique_transactions:
        li = keep_first(li, ["l_orderkey", "l_linenumber"], "l_shipdate", tie_breakers=_DEDUP_TIES)
    s = lambda c: F.col(c).cast("string")
    status = (F.when(F.col("l_returnflag") == "R", "SUCCESS")
               .when(F.col("l_returnflag") == "A", "FAILED").otherwise("PENDING"))
    return {
        "transactions": li.select(
            F.concat_ws("-", s("l_orderkey"), s("l_linenumber")).alias("transaction_id"),
            F.lit(CYCLE).alias("cycle_date"), s("l_orderkey").alias("policy_id"),
            F.col("l_extendedprice").alias("transaction_amount"), status.alias("transaction_status"),
            F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_commission_eligible"),
            s("l_suppkey").alias("agent_id"), F.col("l_discount").alias("commission_rate"),
            s("l_suppkey").alias("exchange_code"), s("l_partkey").alias("feature_id")),
        "policy": _orders(spark, root).select(
            s("o_orderkey").alias("policy_id"),
            F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "P", "RENEWAL")
             .otherwise("LAPSED").alias("policy_status")),
        "coverage": _li(spark, root).filter(F.col("l_quantity") > 45).select(
            s("l_linenumber").alias("coverage_id"), s("l_orderkey").alias("policy_id")).distinct(),
        "feature": read_table(spark, root, "part").select(
            s("p_partkey").alias("feature_id"), F.col("p_name").alias("feature_name")),
        "exchange": read_table(spark, root, "supplier").select(
            s("s_suppkey").alias("exchange_id"), s("s_suppkey").alias("exchange_code"),
            (F.lit(1.0) + F.col("s_nationkey") / F.lit(100.0)).alias("exchange_rate")),
        "rider": _li(spark, root).filter(F.col("l_tax") >= 0.08).select(
            s("l_linenumber").alias("rider_id"), s("l_orderkey").alias("policy_id")).distinct(),
    }


def land_entities(spark: SparkSession, root: str, landing: str, unique_transactions: bool,
                  encryption: str = "none") -> None:
    for name, df in entity_frames(spark, root, unique_transactions).items():
        path = f"{landing}/raw/{name}/cycle_{CYCLE}"
        if encryption == "lines":
            write_encrypted_lines(df, path, DEMO_KEY)
        else:
            write_csv(df, path)


_ENTITY_SQL = f"""
  transactions AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
           '{CYCLE}' AS cycle_date, CAST(l_orderkey AS VARCHAR) AS policy_id,
           l_extendedprice AS transaction_amount,
           CASE l_returnflag WHEN 'R' THEN 'SUCCESS' WHEN 'A' THEN 'FAILED' ELSE 'PENDING' END
             AS transaction_status,
           CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_commission_eligible,
           CAST(l_suppkey AS VARCHAR) AS agent_id, l_discount AS commission_rate,
           CAST(l_suppkey AS VARCHAR) AS exchange_code, CAST(l_partkey AS VARCHAR) AS feature_id
    FROM {{lineitem}}),
  policy AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS policy_id,
           CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'RENEWAL' ELSE 'LAPSED' END
             AS policy_status
    FROM orders),
  coverage AS (
    SELECT DISTINCT CAST(l_linenumber AS VARCHAR) AS coverage_id, CAST(l_orderkey AS VARCHAR) AS policy_id
    FROM lineitem WHERE l_quantity > 45),
  feature AS (SELECT CAST(p_partkey AS VARCHAR) AS feature_id, p_name AS feature_name FROM part),
  exchange AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS exchange_id, CAST(s_suppkey AS VARCHAR) AS exchange_code,
           1.0 + s_nationkey / 100.0 AS exchange_rate FROM supplier),
  rider AS (
    SELECT DISTINCT CAST(l_linenumber AS VARCHAR) AS rider_id, CAST(l_orderkey AS VARCHAR) AS policy_id
    FROM lineitem WHERE l_tax >= 0.08)"""

_UNIQUE_LINEITEM = """
  ulineitem AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST,
                 l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST,
                 l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
      FROM lineitem) d WHERE rn = 1),"""


def _dq_rows_sql(table: str, rules: dict, order0: int) -> list[str]:
    """DuckDB text of one table's rule rows (the oracle side of DQ-6)."""
    out, order = [], order0
    for c in rules.get("not_null") or []:
        out.append(f"SELECT {order} AS ord, '{table}' AS tbl, 'not_null' AS rule, '{c}' AS col, "
                   f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n, ' null(s) found in ''{c}''' AS txt FROM {table}")
        order += 1
    keys = rules.get("no_duplicates") or []
    if keys:
        lst = ", ".join(f"''{k}''" for k in keys)
        out.append(f"SELECT {order}, '{table}', 'no_duplicates', '{','.join(keys)}', "
                   f"COALESCE(SUM(c - 1), 0), ' duplicate row(s) on [{lst}]' "
                   f"FROM (SELECT COUNT(*) AS c FROM {table} GROUP BY {', '.join(keys)}) g")
        order += 1
    for c in rules.get("positive_values") or []:
        out.append(f"SELECT {order}, '{table}', 'positive_values', '{c}', "
                   f"COUNT(*) FILTER (WHERE {c} <= 0), ' non-positive value(s) in ''{c}''' FROM {table}")
        order += 1
    for c, allowed in (rules.get("allowed_values") or {}).items():
        vals = ", ".join(f"'{v}'" for v in allowed)
        shown = ", ".join(f"''{v}''" for v in allowed)
        out.append(f"SELECT {order}, '{table}', 'allowed_values', '{c}', "
                   f"COUNT(*) FILTER (WHERE NOT {c} IN ({vals})), ' value(s) outside [{shown}] in ''{c}''' "
                   f"FROM {table}")
        order += 1
    if rules.get("min_row_count") is not None:
        m = rules["min_row_count"]
        out.append(f"SELECT {order}, '{table}', 'min_row_count', NULL, "
                   f"CASE WHEN COUNT(*) >= {m} THEN 0 ELSE {m} - COUNT(*) END, "
                   f"'Row count ' || CAST(COUNT(*) AS VARCHAR) || "
                   f"CASE WHEN COUNT(*) >= {m} THEN ' OK' ELSE ' < minimum {m}' END FROM {table}")
    return out


def _gate_sql() -> str:
    from cyclemart.schemas import DQ_RULES, EXPECTED_FILE_TYPES

    parts = []
    for i, t in enumerate(EXPECTED_FILE_TYPES):
        parts += _dq_rows_sql(t, DQ_RULES[t], i * 100)
    body = "\n  UNION ALL ".join(parts)
    return (f"WITH {_ENTITY_SQL.format(lineitem='lineitem')},\n  r AS (\n  {body})\n"
            "SELECT tbl AS \"table\", rule, CAST(col AS VARCHAR) AS \"column\",\n"
            "       n = 0 AS passed,\n"
            "       CAST(n AS BIGINT) AS failing_count,\n"
            "       CASE WHEN rule = 'min_row_count' THEN txt WHEN n = 0 THEN 'OK'\n"
            "            ELSE CAST(n AS VARCHAR) || txt END AS details\nFROM r")


@query("cycle_gate_report", _gate_sql())
def cycle_gate_report(spark, root):
    """PL-1 + PL-2: land the six entities, ingest them, gate the cycle; the rule rows.

    The raw lineitem keys repeat, so the gate fails on ``transactions/no_duplicates``;
    the report is written first and its 25 rule rows are returned.
    """
    from cyclemart.operators.quality import QualityError
    from cyclemart.plans.jobs import gate_cycle, ingest_cycle
    from cyclemart.schemas import DQ_RESULT_SCHEMA

    base = scratch_path(spark, "cycle-gate")
    land_entities(spark, root, f"{base}/landing", unique_transactions=False)
    ingest_cycle(spark, f"{base}/landing", f"{base}/staged", CYCLE, NOW)
    try:
        gate_cycle(spark, f"{base}/staged", CYCLE, f"{base}/reports", NOW)
    except QualityError as failed:
        if "transactions/no_duplicates" not in str(failed):
            raise
    else:
        raise AssertionError("the gate let a cycle with repeated keys pass")
    report = spark.read.schema("results array<struct<table:string,rule:string,column:string,"
                               "passed:boolean,failing_count:bigint,details:string>>").json(
        f"{base}/reports/{CYCLE}")
    rows = report.select(F.inline("results"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in DQ_RESULT_SCHEMA.fields])


@query("cycle_fact", f"""
WITH {_UNIQUE_LINEITEM}{_ENTITY_SQL.format(lineitem='ulineitem')}
SELECT t.transaction_id, t.cycle_date, t.policy_id, t.agent_id, c.coverage_id, r.rider_id,
       f.feature_name, e.exchange_rate, t.transaction_amount * t.commission_rate AS commission_amount,
       '{CYCLE}' AS dw_cycle_date, 'initial_load' AS dw_updated_by
FROM transactions t
  JOIN policy p ON t.policy_id = p.policy_id
  LEFT JOIN feature f ON t.feature_id = f.feature_id
  LEFT JOIN exchange e ON t.exchange_code = e.exchange_code
  LEFT JOIN coverage c ON t.policy_id = c.policy_id
  LEFT JOIN rider r ON t.policy_id = r.policy_id
WHERE t.transaction_status = 'SUCCESS' AND t.is_commission_eligible = 1 AND t.transaction_amount > 0
  AND p.policy_status IN ('ACTIVE', 'RENEWAL')""")
def cycle_fact(spark, root):
    """PL-4: encrypted landing -> ingest -> gate (passes) -> build -> publish; the fact."""
    from cyclemart.plans.jobs import run_cycle

    base = scratch_path(spark, "cycle-run")
    land_entities(spark, root, f"{base}/landing", unique_transactions=True, encryption="lines")
    run_cycle(spark, f"{base}/landing", f"{base}/staged", f"{base}/reports", f"{base}/fact",
              CYCLE, NOW, DEMO_KEY, "lines")
    from cyclemart.operators.merge import PartitionedTable

    fact = PartitionedTable(spark, f"{base}/fact", "dw_cycle_date").read()
    return fact.select("transaction_id", "cycle_date", "policy_id", "agent_id", "coverage_id",
                       "rider_id", "feature_name", "exchange_rate", "commission_amount",
                       "dw_cycle_date", "dw_updated_by")


_SECOND = dt.datetime(2024, 2, 2)


@query("cycle_fact_second_run", ORACLE_SQL["cycle_fact"].replace("'initial_load'", "'glue_job'"))
def cycle_fact_second_run(spark, root):
    """PL-3 + MG-4: the cycle is run twice; the second run merges into what the first
    published, so every row is an update and none is there twice."""
    from cyclemart.operators.merge import PartitionedTable
    from cyclemart.plans.jobs import run_cycle

    base = scratch_path(spark, "cycle-again")
    land_entities(spark, root, f"{base}/landing", unique_transactions=True)
    for now in (NOW, _SECOND):
        run = run_cycle(spark, f"{base}/landing", f"{base}/staged", f"{base}/reports", f"{base}/fact", CYCLE, now)
    if run.merge.initialised or not run.merge.integrity_ok or run.merge.counts["inserted"] or run.merge.counts["kept"]:
        raise AssertionError(f"the second run should only update: {run.merge}")
    fact = PartitionedTable(spark, f"{base}/fact", "dw_cycle_date").read()
    return fact.select("transaction_id", "cycle_date", "policy_id", "agent_id", "coverage_id",
                       "rider_id", "feature_name", "exchange_rate", "commission_amount",
                       "dw_cycle_date", "dw_updated_by")
