"""Counts and the commission roll-up (AG-1, AG-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def row_count(df: DataFrame, out_col: str = "row_count") -> DataFrame:
    """AG-1 as a DataFrame (one row)."""
    return df.agg(F.count(F.lit(1)).alias(out_col))


def observe_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """AG-1 as a metric: rows are counted while the plan runs for another reason.

    ``observation.get`` is available after the first action on the returned frame; no
    extra pass over the data is made.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def commission_by_agent_policy(
    df: DataFrame,
    agent_col: str = "agent_id",
    policy_col: str = "policy_id",
    amount_col: str = "transaction_amount",
    rate_col: str = "commission_rate",
) -> DataFrame:
    """AG-4: total commission and transaction count per (agent, policy).

    Amounts are summed as DECIMAL so the total is exact and engine-independent.  Run this
    on the filtered fact *before* the coverage x rider fan-out, or amounts count twice.
    """
    commission = (F.col(amount_col) * F.col(rate_col)).cast(MONEY)
    return (df.groupBy(agent_col, policy_col)
              .agg(F.sum(commission).alias("total_commission"),
                   F.count(F.lit(1)).alias("transaction_count")))
