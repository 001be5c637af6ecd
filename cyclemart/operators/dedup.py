"""Keep-first-per-key, duplicate keys and distinct key counts (WN-1, WN-2, AG-2, AG-3).

``keep_first`` is ``row_number() = 1`` over a key window.  Spark plans that as a
*partial* per-key top-1 (``WindowGroupLimit``) below the shuffle, so a hot key ships at
most one row per input partition: a key holding a third of the table does not land in
one task.  Duplicate counting uses hash aggregation with map-side partial counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__cyclemart_rank"


def _order(col: str | Column, ascending: bool) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    # Spark's defaults, spelled out: ascending -> NULLs first, descending -> NULLs last.
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def keep_first(
    df: DataFrame,
    keys: list[str],
    order_by: str | list[str],
    ascending: bool = False,
    tie_breakers: list[str | Column] | None = None,
) -> DataFrame:
    """WN-1: the first row per key by ``order_by`` (descending by default).

    ``tie_breakers`` are further order columns (same direction, or ``Column`` objects with
    their own direction) so the kept row is deterministic.  No input column is touched.
    """
    order_cols = [order_by] if isinstance(order_by, str) else list(order_by)
    ordering = [_order(c, ascending) for c in order_cols]
    for t in tie_breakers or []:
        ordering.append(t if isinstance(t, Column) else _order(t, ascending))
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return (df.withColumn(_RANK, F.row_number().over(window))
              .filter(F.col(_RANK) == 1)
              .drop(_RANK))


def latest_per_key(df: DataFrame, keys: list[str], updated_col: str = "dw_updated_date",
                   tie_breakers: list[str | Column] | None = None) -> DataFrame:
    """WN-2: remove older duplicates of a published table, newest ``updated_col`` wins."""
    return keep_first(df, keys, updated_col, ascending=False, tie_breakers=tie_breakers)


def duplicate_keys(df: DataFrame, keys: list[str], count_col: str = "cnt") -> DataFrame:
    """AG-3: keys that occur more than once, with their row count (NULL keys group)."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def distinct_key_count(df: DataFrame, keys: list[str], out_col: str = "distinct_keys") -> DataFrame:
    """AG-2: number of distinct composite keys, NULL counted as one value.

    (``count(DISTINCT ...)`` would skip keys containing NULL.)
    """
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(out_col))


def has_duplicate_keys(df: DataFrame, keys: list[str]) -> bool:
    """MG-3 helper: True when some key occurs twice (one small action)."""
    return not duplicate_keys(df, keys).isEmpty()
