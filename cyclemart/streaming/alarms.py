"""Threshold alarms on tumbling event-time windows (ST-4).

The same function serves batch and streaming input.  On a stream, pass ``watermark`` so
Spark can close windows and drop their state; append mode then emits each alarm once,
when the watermark passes the window end.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "==": operator.eq}
_AGGS = {"sum": F.sum, "avg": F.avg, "count": lambda c: F.count(c), "max": F.max, "min": F.min}

# --- fixed values: the pipeline's monitoring thresholds on 5-minute windows ------------
DEFAULT_ALARMS = {
    "handler_errors": {"agg": "sum", "op": ">=", "threshold": 5},
    "handler_duration_ms": {"agg": "avg", "op": ">", "threshold": 45000},
    "job_failures": {"agg": "sum", "op": ">=", "threshold": 1},
    "audit_writes": {"agg": "sum", "op": ">", "threshold": 50},
}


def as_event_time(df: DataFrame, ts_col: str, watermark: str | None) -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); Parquet often gives TIMESTAMP_NTZ.

    Without a watermark the column is left as it is, so batch windows of an NTZ column
    do not depend on the session time zone.
    """
    if watermark is None:
        return df
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)


def window_alarm(
    df: DataFrame,
    ts_col: str,
    measure: str | Column,
    agg: str = "sum",
    op: str = ">=",
    threshold: float = 1,
    window: str = "5 minutes",
    out_col: str = "metric",
    group_cols: list[str] | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Windows (``window_start``, ``window_end``) whose aggregate passes the threshold."""
    data = as_event_time(df, ts_col, watermark)
    col = F.col(measure) if isinstance(measure, str) else measure
    grouped = data.groupBy(F.window(F.col(ts_col), window).alias("__w"), *(group_cols or []))
    out = grouped.agg(_AGGS[agg](col).alias(out_col))
    cmp = _OPS[op](F.col(out_col), F.lit(threshold))
    return out.filter(cmp).select(
        F.col("__w.start").alias("window_start"),
        F.col("__w.end").alias("window_end"),
        *(group_cols or []),
        out_col,
    )


def default_alarms(metrics: DataFrame, ts_col: str = "ts", name_col: str = "metric_name",
                   value_col: str = "value", window: str = "5 minutes",
                   watermark: str | None = None) -> DataFrame:
    """All configured alarms over a long metric table (``ts, metric_name, value``).

    One pass: the metric table is aggregated once per (window, metric) with every
    aggregate the rules need; each rule then tests its own column.
    """
    # other metrics are left out before the windows are formed; the filter reaches the scan
    wanted = metrics.filter(F.col(name_col).isin(*DEFAULT_ALARMS))
    data = as_event_time(wanted, ts_col, watermark)
    agg = data.groupBy(F.window(F.col(ts_col), window).alias("__w"), F.col(name_col)).agg(
        F.sum(value_col).alias("__sum"), F.avg(value_col).alias("__avg"))
    tests = None
    value = None
    for name, rule in DEFAULT_ALARMS.items():
        metric = F.col("__sum") if rule["agg"] == "sum" else F.col("__avg")
        hit = (F.col(name_col) == F.lit(name)) & _OPS[rule["op"]](metric, F.lit(rule["threshold"]))
        tests = hit if tests is None else tests | hit
        value = F.when(F.col(name_col) == F.lit(name), metric) if value is None \
            else value.when(F.col(name_col) == F.lit(name), metric)
    return agg.filter(tests).select(
        F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
        F.col(name_col).alias("alarm"), value.alias("metric"))
