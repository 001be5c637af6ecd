"""Declarative data-quality rules, report and gate (DQ-1..DQ-9, IO-8).

A rule set is a plain dict::

    {"not_null": [cols], "no_duplicates": [keys], "positive_values": [cols],
     "allowed_values": {col: [values]}, "min_row_count": n}

All rules of a table are evaluated in **one** scan: the row-level rules and the key lists of
``no_duplicates`` (one list, or a list of lists) are grouping sets of one aggregate, whose
partial counts keep hot keys cheap.  The results are unpivoted into rows of
``DQ_RESULT_SCHEMA``.  Evaluating every table of a cycle is a single action over a union; the
result is one small row per rule.
"""

from __future__ import annotations

import datetime as dt
import logging
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.functions.timeutil import instant
from cyclemart.schemas import DQ_RESULT_SCHEMA
from cyclemart.session import empty_frame

log = logging.getLogger(__name__)

_ORD = "__dq_order"
RESULT_COLUMNS = [f.name for f in DQ_RESULT_SCHEMA.fields]


# --- fixed values: the wording of the messages, the rule names and the order of the rules,
# here and in ``_evaluate`` and ``failure_message``, are outputs that must stay as they are.


class QualityError(Exception):
    """Raised by the gate when at least one rule failed."""


def _pylist(values) -> str:
    """Render a list the way the rule messages show it (Python list form)."""
    return str(list(values))


def _s(c: Column) -> Column:
    return c.cast("string")


def _row(order: int, table: str, rule: str, column: str | None, failing: Column,
         passed: Column, details: Column) -> Column:
    return F.struct(
        F.lit(order).alias(_ORD),
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column"),
        passed.alias("passed"),
        failing.cast("long").alias("failing_count"),
        details.alias("details"),
    )


def _ok_or(failing: Column, message: Column) -> Column:
    return F.when(failing == 0, F.lit("OK")).otherwise(message)


def evaluate(df: DataFrame, table: str, rules: dict[str, Any]) -> DataFrame | None:
    """DQ-6: results of one table's rule set (``DQ_RESULT_SCHEMA``), in the fixed order.

    Returns ``None`` when the rule set contains no rule.  Empty or missing entries are
    skipped; ``min_row_count`` runs whenever it is present (even for 0).
    """
    out = _evaluate(df, table, rules, 0)
    return None if out is None else out.orderBy(_ORD).drop(_ORD)


def _evaluate(df: DataFrame, table: str, rules: dict[str, Any], table_order: int) -> DataFrame | None:
    base = table_order * 10_000
    aggs: list[Column] = [F.count(F.lit(1)).alias("__total")]
    rows: list[Column] = []
    key_lists: list[list[str]] = []
    n = 0

    def agg(expr: Column) -> Column:
        nonlocal n
        name = f"__f{n}"
        n += 1
        aggs.append(expr.alias(name))
        return F.col(name)

    order = base
    for column in rules.get("not_null") or []:
        failing = agg(F.count_if(F.col(column).isNull()))
        rows.append(_row(order, table, "not_null", column, failing, failing == 0,
                         _ok_or(failing, F.concat(_s(failing), F.lit(f" null(s) found in '{column}'")))))
        order += 1

    for keys in _key_lists(rules):
        failing = F.col(f"__dup{len(key_lists)}")
        key_lists.append(keys)
        rows.append(_row(order, table, "no_duplicates", ",".join(keys), failing, failing == 0,
                         _ok_or(failing, F.concat(_s(failing), F.lit(f" duplicate row(s) on {_pylist(keys)}")))))
        order += 1

    for column in rules.get("positive_values") or []:
        failing = agg(F.count_if(F.col(column) <= F.lit(0)))
        rows.append(_row(order, table, "positive_values", column, failing, failing == 0,
                         _ok_or(failing, F.concat(_s(failing),
                                                  F.lit(f" non-positive value(s) in '{column}'")))))
        order += 1

    for column, allowed in (rules.get("allowed_values") or {}).items():
        allowed = list(allowed)
        failing = agg(F.count_if(~F.col(column).isin(*allowed)))
        rows.append(_row(order, table, "allowed_values", column, failing, failing == 0,
                         _ok_or(failing, F.concat(_s(failing),
                                                  F.lit(f" value(s) outside {_pylist(allowed)} in '{column}'")))))
        order += 1

    min_count = rules.get("min_row_count")
    if min_count is not None:
        total = F.col("__total")
        passed = total >= F.lit(min_count)
        failing = F.when(passed, F.lit(0)).otherwise(F.lit(min_count) - total)
        details = F.when(passed, F.concat(F.lit("Row count "), _s(total), F.lit(" OK"))).otherwise(
            F.concat(F.lit("Row count "), _s(total), F.lit(f" < minimum {min_count}")))
        rows.append(_row(order, table, "min_row_count", None, failing, passed, details))

    if not rows:
        return None
    names = ["__total", *[f"__f{i}" for i in range(n)]]
    totals = df.agg(*aggs) if not key_lists else _totals(df, aggs, names, key_lists)
    return totals.select(F.inline(F.array(*rows)))


def _key_lists(rules: dict[str, Any]) -> list[list[str]]:
    """The key lists of ``no_duplicates``: a list of columns, or several of them."""
    keys = rules.get("no_duplicates") or []
    return [list(k) for k in keys] if keys and not isinstance(keys[0], str) else [list(keys)] if keys else []


def _totals(df: DataFrame, aggs: list[Column], names: list[str], key_lists: list[list[str]]) -> DataFrame:
    """One row: the aggregates ``names`` over all rows, and the surplus rows ``__dup{i}`` of
    each key list, from one scan: the empty grouping set and one for each list."""
    columns = sorted({k for keys in key_lists for k in keys})
    sets = [[], *[[F.col(k) for k in keys] for keys in {tuple(sorted(set(k))) for k in key_lists}]]
    grouped = df.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("__set"), *aggs)

    def number(keys: list[str]) -> int:  # a bit for each column that is not in the set
        return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys)

    whole = [F.coalesce(F.max(F.when(F.col("__set") == number([]), F.col(c))), F.lit(0)).alias(c) for c in names]
    surplus = [F.coalesce(F.sum(F.when(F.col("__set") == number(keys), F.col("__total") - 1)), F.lit(0)).alias(f"__dup{i}")
               for i, keys in enumerate(key_lists)]
    return grouped.agg(*whole, *surplus)


def evaluate_tables(
    tables: dict[str, DataFrame],
    rules: dict[str, dict[str, Any]],
    expected: list[str] | None = None,
) -> DataFrame:
    """DQ-9 core: the results of every table of a cycle, as one lazily evaluated frame.

    ``expected`` tables must be present (strict load: a missing one raises); tables
    without rules are skipped with a warning.  Output is sorted in table, rule order.
    """
    names = list(expected) if expected is not None else list(tables)
    parts = []
    for i, name in enumerate(names):
        if name not in tables or tables[name] is None:
            raise KeyError(f"table {name!r} is missing for the quality gate")
        table_rules = rules.get(name) or {}
        part = _evaluate(tables[name], name, table_rules, i) if table_rules else None
        if part is None:
            log.warning("no quality rules for table %r: skipped", name)
            continue
        parts.append(part)
    if not parts:  # nothing to check: an empty result, and the gate passes
        if not names:
            raise ValueError("no tables given to the quality gate")
        return empty_frame(tables[names[0]].sparkSession, DQ_RESULT_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy(_ORD).drop(_ORD)


def report_frame(results: DataFrame, cycle_date: str | None = None,
                 generated_at: dt.datetime | None = None) -> DataFrame:
    """DQ-7: one row ``total_checks, passed, failed, results[], cycle_date, generated_at``.

    ``results`` keeps the input order through an explicit ordinal.
    """
    numbered = results.withColumn(_ORD, F.monotonically_increasing_id())
    item = F.struct(F.col(_ORD), *[F.col(c) for c in RESULT_COLUMNS])
    out = numbered.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.transform(F.array_sort(F.collect_list(item)),
                    lambda x: F.struct(*[x[c].alias(c) for c in RESULT_COLUMNS])).alias("results"),
    )
    return out.withColumns({
        "cycle_date": F.lit(cycle_date).cast("string"),
        "generated_at": instant(generated_at) if generated_at is not None else F.lit(None).cast("timestamp"),
    })


def failure_message(failures: list[dict[str, Any]]) -> str:
    summary = "; ".join(f"{r['table']}/{r['rule']}/{r['column']}: {r['details']}" for r in failures)
    return f"{len(failures)} DQ check(s) failed: {summary}"


def assert_no_failures(results: DataFrame | list) -> None:
    """DQ-8: raise :class:`QualityError` listing every failed rule.

    Only the failing *rule rows* reach the driver (one per rule, never data rows).
    """
    if isinstance(results, DataFrame):
        rows = [r.asDict() for r in results.filter(~F.col("passed")).collect()]
    else:
        rows = [r if isinstance(r, dict) else r.asDict() for r in results if not _passed(r)]
    if rows:
        raise QualityError(failure_message(rows))


def _passed(r) -> bool:
    return r["passed"] if isinstance(r, dict) else r.passed


def write_report(report: DataFrame, path: str) -> None:
    """IO-8: replace the JSON report at ``path`` (one small file)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def run_gate(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    rules: dict[str, dict[str, Any]],
    report_path: str | None,
    cycle_date: str | None = None,
    generated_at: dt.datetime | None = None,
    expected: list[str] | None = None,
) -> list[dict[str, Any]]:
    """DQ-9: evaluate, write the report, *then* gate.

    One action evaluates all tables, each in one scan; its result (one row per rule) is
    reused for the report and the gate.
    """
    results = evaluate_tables(tables, rules, expected)
    rows = [r.asDict() for r in results.collect()]
    if report_path is not None:
        local = spark.createDataFrame(rows, DQ_RESULT_SCHEMA) if rows else empty_frame(spark, DQ_RESULT_SCHEMA)
        write_report(report_frame(local, cycle_date, generated_at), report_path)
    assert_no_failures(rows)
    return rows
