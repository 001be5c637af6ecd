"""Query registry, fixed parameters and the role-mapped base tables of the catalogue."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.operators.filters import transaction_filter
from cyclemart.sources.tables import read_table


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# --- fixed parameters of the catalogue -------------------------------------------------
NOW = dt.datetime(2024, 2, 1, 0, 0, 0)           # injected processing instant
CYCLE = "20240101"                               # cycle the fact is built for
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
DEMO_KEY = "cyclemart-demo-k"                    # 16-byte AES key of the demo queries
MERGE_UPDATE_FROM = "1998-01-01"                 # source (delta) = orders from this day on
MERGE_TARGET_UNTIL = "1999-06-01"                # target = orders before this day
T_INIT = dt.datetime(2024, 1, 15)                # instant of the first publication
INIT_CYCLE = "20240115"                          # its cycle
AUDIT_AS_OF = dt.datetime(2024, 4, 15)           # as-of instant of the audit expiry
STREAM_DELAY = "10 minutes"                      # watermark delay of the streamed alarms


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


def _li(spark, root):
    return read_table(spark, root, "lineitem")


def _orders(spark, root):
    return read_table(spark, root, "orders")


def _transactions(spark, root):
    """FP-2 on lineitem: status R, eligible (line status F), positive amount."""
    return transaction_filter(_li(spark, root), status_col="l_returnflag", status="R",
                              flag_col=F.col("l_linestatus") == F.lit("F"),
                              amount_col="l_extendedprice")


_TX_WHERE = "l_returnflag = 'R' AND l_linestatus = 'F' AND l_extendedprice > 0"


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
