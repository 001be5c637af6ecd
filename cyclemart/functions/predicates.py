"""Predicates built from plain Python descriptions (SC-3, SC-4, FP-1)."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def conjunction(filters: dict[str, Any]) -> Column | None:
    """AND of one predicate per entry: a list value means membership, anything else equality.

    ``{}`` gives ``None`` (no filter).  ``[]`` gives an always-false membership and
    ``None`` an ``= NULL`` test, so both keep no rows.  NULL cells never pass.
    """
    preds = []
    for column, value in filters.items():
        if isinstance(value, (list, tuple, set, frozenset)):
            preds.append(F.col(column).isin(*list(value)))
        else:
            preds.append(F.col(column) == F.lit(value))
    if not preds:
        return None
    return reduce(lambda a, b: a & b, preds)


def as_flag(column: str | Column) -> Column:
    """Normalise a 0/1 integer, boolean or ``true``/``false`` text flag to BOOLEAN.

    Comparing an INT column with ``True`` is a type error under ANSI mode, so every flag
    is cast once.  Unparseable text becomes NULL (and therefore never passes a filter).
    """
    col = F.col(column) if isinstance(column, str) else column
    return col.try_cast("boolean")


def missing_from(expected: list[str], received: Column) -> Column:
    """Expected values that are absent from an array column (set difference)."""
    return F.array_except(F.array(*[F.lit(v) for v in expected]), received)
