"""Declarative filters, derived measures and warehouse audit columns (FP-1..FP-5)."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.functions.predicates import as_flag, conjunction
from cyclemart.functions.timeutil import instant
from cyclemart.schemas import ACTIVE_POLICY_STATUSES, SUCCESS_STATUS


def apply_filters(df: DataFrame, filters: dict[str, Any]) -> DataFrame:
    """FP-1: keep rows matching every entry (list -> membership, scalar -> equality)."""
    pred = conjunction(filters)
    return df if pred is None else df.filter(pred)


def transaction_filter(
    df: DataFrame,
    status_col: str = "transaction_status",
    flag_col: str | Column = "is_commission_eligible",
    amount_col: str = "transaction_amount",
    status: str = SUCCESS_STATUS,
) -> DataFrame:
    """FP-2: successful, commission-eligible transactions with a positive amount.

    A NULL in any of the three columns drops the row.  The flag may be 0/1, boolean, or a
    boolean expression.
    """
    return df.filter(
        (F.col(status_col) == F.lit(status))
        & (as_flag(flag_col) == F.lit(True))
        & (F.col(amount_col) > F.lit(0))
    )


def policy_filter(
    df: DataFrame, status_col: str = "policy_status", statuses: list[str] | None = None
) -> DataFrame:
    """FP-3: policies in an active status."""
    return df.filter(F.col(status_col).isin(*(statuses or ACTIVE_POLICY_STATUSES)))


def with_commission(
    df: DataFrame,
    amount_col: str = "transaction_amount",
    rate_col: str = "commission_rate",
    out_col: str = "commission_amount",
) -> DataFrame:
    """FP-4: ``commission_amount = amount * rate`` (NULL operand -> NULL)."""
    return df.withColumn(out_col, F.col(amount_col) * F.col(rate_col))


def with_audit_columns(df: DataFrame, cycle_date: str, now: dt.datetime) -> DataFrame:
    """FP-5: insert/update instant (one value, injected), cycle and active flag."""
    ts = instant(now)
    return df.withColumns({
        "dw_inserted_date": ts,
        "dw_updated_date": ts,
        "dw_cycle_date": F.lit(cycle_date).cast("string"),
        "dw_is_active": F.lit(True),
    })
