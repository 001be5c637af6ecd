"""Data-quality rules, rule sets and the report (DQ-1..DQ-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclemart.operators.joins import join
from cyclemart.operators.quality import QualityError, assert_no_failures, evaluate, evaluate_tables, report_frame
from cyclemart.plans.catalogue.base import CYCLE, _li, NOW, query
from cyclemart.sources.tables import read_table


# ============================================================== data quality (DQ-*)


def _dq_sql(table: str, rule: str, column: str | None, failing_sql: str, fail_text: str,
            source: str) -> str:
    col = "NULL" if column is None else f"'{column}'"
    return f"""
SELECT '{table}' AS "table", '{rule}' AS rule, CAST({col} AS VARCHAR) AS "column",
       n = 0 AS passed, n AS failing_count,
       CASE WHEN n = 0 THEN 'OK' ELSE CAST(n AS VARCHAR) || '{fail_text}' END AS details
FROM (SELECT CAST({failing_sql} AS BIGINT) AS n FROM {source}) f"""


@query("dq_no_duplicates", _dq_sql(
    "lineitem", "no_duplicates", "l_orderkey,l_linenumber", "COALESCE(SUM(c - 1), 0)",
    " duplicate row(s) on [''l_orderkey'', ''l_linenumber'']",
    "(SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) g"))
def dq_no_duplicates(spark, root):
    return evaluate(_li(spark, root), "lineitem", {"no_duplicates": ["l_orderkey", "l_linenumber"]})


@query("dq_positive", _dq_sql(
    "customer", "positive_values", "c_acctbal", "COUNT(*) FILTER (WHERE c_acctbal <= 0)",
    " non-positive value(s) in ''c_acctbal''", "customer"))
def dq_positive(spark, root):
    return evaluate(read_table(spark, root, "customer"), "customer",
                    {"positive_values": ["c_acctbal"]})


@query("dq_allowed", _dq_sql(
    "events", "allowed_values", "event_type",
    "COUNT(*) FILTER (WHERE NOT event_type IN ('click', 'view', 'purchase'))",
    " value(s) outside [''click'', ''view'', ''purchase''] in ''event_type''", "events"))
def dq_allowed(spark, root):
    return evaluate(read_table(spark, root, "events"), "events",
                    {"allowed_values": {"event_type": ["click", "view", "purchase"]}})


@query("dq_not_null", _dq_sql(
    "labelled_documents", "not_null", "quality", "COUNT(*) FILTER (WHERE l.quality IS NULL)",
    " null(s) found in ''quality''", "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"))
def dq_not_null(spark, root):
    docs = read_table(spark, root, "documents").select("doc_id")
    labelled = join(docs, read_table(spark, root, "labels"), "doc_id", "left")
    return evaluate(labelled, "labelled_documents", {"not_null": ["quality"]})


CUSTOMER_RULES = {
    "not_null": ["c_custkey"],
    "no_duplicates": ["c_custkey"],
    "positive_values": ["c_acctbal"],
    "allowed_values": {"c_mktsegment": ["BUILDING", "MACHINERY"]},
    "min_row_count": 2000,
}

_RULE_SET_SQL = """
WITH a AS (SELECT COUNT(*) AS total,
                  COUNT(*) FILTER (WHERE c_custkey IS NULL) AS f_null,
                  COUNT(*) FILTER (WHERE c_acctbal <= 0) AS f_pos,
                  COUNT(*) FILTER (WHERE NOT c_mktsegment IN ('BUILDING', 'MACHINERY')) AS f_allowed
           FROM customer),
     d AS (SELECT COALESCE(SUM(c - 1), 0) AS f_dup
           FROM (SELECT COUNT(*) AS c FROM customer GROUP BY c_custkey) g),
     r AS (
       SELECT 1 AS ord, 'not_null' AS rule, 'c_custkey' AS col, f_null AS n,
              ' null(s) found in ''c_custkey''' AS txt FROM a
       UNION ALL SELECT 2, 'no_duplicates', 'c_custkey', f_dup,
              ' duplicate row(s) on [''c_custkey'']' FROM d
       UNION ALL SELECT 3, 'positive_values', 'c_acctbal', f_pos,
              ' non-positive value(s) in ''c_acctbal''' FROM a
       UNION ALL SELECT 4, 'allowed_values', 'c_mktsegment', f_allowed,
              ' value(s) outside [''BUILDING'', ''MACHINERY''] in ''c_mktsegment''' FROM a),
     results AS (
       SELECT ord, 'customer' AS "table", rule, CAST(col AS VARCHAR) AS "column", n = 0 AS passed,
              CAST(n AS BIGINT) AS failing_count,
              CASE WHEN n = 0 THEN 'OK' ELSE CAST(n AS VARCHAR) || txt END AS details
       FROM r
       UNION ALL
       SELECT 5, 'customer', 'min_row_count', CAST(NULL AS VARCHAR), total >= 2000,
              CAST(CASE WHEN total >= 2000 THEN 0 ELSE 2000 - total END AS BIGINT),
              CASE WHEN total >= 2000 THEN 'Row count ' || CAST(total AS VARCHAR) || ' OK'
                   ELSE 'Row count ' || CAST(total AS VARCHAR) || ' < minimum 2000' END
       FROM a)"""


@query("dq_rule_set", _RULE_SET_SQL + """
SELECT "table", rule, "column", passed, failing_count, details FROM results""")
def dq_rule_set(spark, root):
    return evaluate_tables({"customer": read_table(spark, root, "customer")},
                           {"customer": CUSTOMER_RULES})


@query("dq_report", _RULE_SET_SQL + """
SELECT CAST(COUNT(*) AS BIGINT) AS total_checks,
       CAST(COUNT(*) FILTER (WHERE passed) AS BIGINT) AS passed,
       CAST(COUNT(*) FILTER (WHERE NOT passed) AS BIGINT) AS failed,
       CAST(COUNT(*) FILTER (WHERE NOT passed) AS VARCHAR) || ' DQ check(s) failed: ' ||
         STRING_AGG(CASE WHEN NOT passed THEN "table" || '/' || rule || '/' ||
                         COALESCE("column", 'None') || ': ' || details END, '; ' ORDER BY ord)
         AS failure_summary,
       '""" + CYCLE + """' AS cycle_date
FROM results""")
def dq_report(spark, root):
    """DQ-7 roll-up, plus the message with which the DQ-8 gate raises."""
    results = dq_rule_set(spark, root)
    try:
        assert_no_failures(results)
        message = None
    except QualityError as failed:
        message = str(failed)
    report = report_frame(results, CYCLE, NOW)
    return report.select("total_checks", "passed", "failed", F.lit(message).alias("failure_summary"), "cycle_date")
