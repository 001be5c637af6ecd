"""Equi-joins with an explicit strategy, and the star-join fold (JN-1..JN-4).

Broadcasting is only ever requested behind a size check.  The optimizer's estimate of
the candidate side is an upper bound of its *stored* bytes (filters never grow it, column
pruning is accounted for); it is multiplied by ``BROADCAST_INFLATION`` to bound the
decompressed, hashed in-memory relation, and that must stay below
``max_broadcast_bytes``.  Stored bytes do not bound the rows: runs and dictionaries put a
million rows into a few of them, and the driver builds the relation row by row.  So the rows
of a side whose bytes fit are counted, and the relation must fit a part of the driver's heap.
When the bound fails or the size is unknown, no hint is given and the planner (with AQE's
runtime statistics) picks the strategy; AQE still converts to a broadcast at run time if the
real shuffle output is small.  Only where the planner would broadcast too many rows by its
estimate is a merge join asked for.  Hot keys of shuffle joins are split by the plan itself
(:mod:`cyclemart.operators.skew`): that needs no session setting.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclemart.operators.skew import SPLITTABLE, heavy_keys, replicated, salted, split_join, tasks_of
from cyclemart.schemas import PROVENANCE_COLUMNS

log = logging.getLogger(__name__)

# Size policy: the in-memory bound of a broadcast relation, and the factor from stored
# (columnar, compressed) bytes to decompressed hashed rows.  Together they accept a side
# whose stored size is at most 32 MB.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_INFLATION = 8
#: The driver holds a relation as rows, hashed and as blocks, and a star has several: one may
#: take this part of its heap.
DRIVER_PART = 32
#: Bytes of a hashed row besides its values: key, pointers and free slots.
ROW_OVERHEAD = 96

_BROADCAST_RIGHT_OK = {"inner", "left", "leftouter", "left_outer", "semi", "leftsemi",
                       "left_semi", "anti", "leftanti", "left_anti"}


class JoinError(ValueError):
    """Raised for joins without a condition or with clashing column names."""


def estimated_size_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (what the planner itself uses), or None."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()  # noqa: SLF001
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def _driver_bytes(df: DataFrame) -> int:
    """What one relation may take of the driver's heap."""
    return df.sparkSession._jvm.java.lang.Runtime.getRuntime().maxMemory() // DRIVER_PART  # noqa: SLF001


def _rows_fit(df: DataFrame, max_bytes: int) -> bool:
    """True when the counted rows of ``df``, hashed, fit ``max_bytes`` (one job over ``df``)."""
    width = df._jdf.schema().defaultSize() + ROW_OVERHEAD  # noqa: SLF001 - as the planner's estimates
    return df.count() * width <= max_bytes


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when both in-memory bounds of ``df``, by its stored bytes (estimate x inflation)
    and by its counted rows, fit ``max_bytes`` and the driver."""
    size = estimated_size_bytes(df)
    if size is None or size * BROADCAST_INFLATION > max_bytes:
        return False
    most = min(max_bytes, _driver_bytes(df))
    return size * BROADCAST_INFLATION <= most and _rows_fit(df, most)


def _keys(on: str | list[str] | tuple[str, ...] | None) -> list[str]:
    if on is None:
        return []
    return [on] if isinstance(on, str) else list(on)


def guard_condition(on, how: str) -> list[str]:
    """JN-4: refuse a join without key columns, and cross joins."""
    keys = _keys(on)
    if how.lower().replace("_", "") in ("cross", "crossjoin"):
        raise JoinError("cross joins are not supported by this engine")
    if not keys:
        raise JoinError("join without a condition: name the key columns")
    return keys


def _plan_nodes(plan):
    """The nodes of a physical plan, those of subqueries too."""
    pending = [plan]
    while pending:
        node = pending.pop()
        yield node
        if node.nodeName() == "AdaptiveSparkPlan":
            pending.append(node.initialPlan())
        for seq in (node.children(), node.subqueries()):
            pending.extend(seq.apply(i) for i in range(seq.size()))


#: Physical joins that compare every row with every row.
_UNKEYED = {"CartesianProduct", "BroadcastNestedLoopJoin"}


def guard_plan(df: DataFrame) -> DataFrame:
    """JN-4 on the plan: ``df`` itself, unless its plan has a join without an equality of keys.

    A condition may name keys and still vanish (a column compared with itself, a literal); what
    counts is what the optimizer has made of it, before any action runs.
    """
    plan = df._jdf.queryExecution().executedPlan()  # noqa: SLF001 - planned, not run
    found = sorted({n.nodeName() for n in _plan_nodes(plan)} & _UNKEYED)
    if found:
        raise JoinError(f"the plan joins without keys ({', '.join(found)}): its condition is no equality of two sides' columns")
    return df


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    strategy: str = "auto",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """USING-style equi-join (one merged key column per name, keys first).

    ``strategy``: ``"broadcast"`` broadcasts ``right`` when its size and rows fit,
    ``"merge"`` asks for a sort-merge join, ``"split"`` for a shuffle join that splits the
    hot keys of ``left``, ``"auto"`` leaves it to the planner.
    """
    keys = guard_condition(on, how)
    if strategy == "split":
        return split_join(left, right, keys, how)
    strategy = _allowed(right, how, strategy, max_broadcast_bytes)
    if strategy == "broadcast":
        right = F.broadcast(right)
    elif strategy == "merge":
        right = right.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return left.join(right, on=keys, how=how)


def _allowed(right: DataFrame, how: str, strategy: str, max_broadcast_bytes: int) -> str:
    """``strategy``, less a broadcast that does not fit: then the planner chooses, but a merge
    where it would broadcast by its estimate what the driver cannot hold."""
    if strategy != "broadcast":
        return strategy
    if how.lower() in _BROADCAST_RIGHT_OK and fits_broadcast(right, max_broadcast_bytes):
        return strategy
    log.warning("broadcast of right side refused (join type %s, size above %d bytes or rows above "
                "1/%d of the driver's heap)", how, max_broadcast_bytes, DRIVER_PART)
    return "auto" if not planner_broadcasts(right) or _rows_fit(right, _driver_bytes(right)) else "merge"


def planner_broadcasts(df: DataFrame) -> bool:
    """True when the planner itself would broadcast ``df``, by its size estimate."""
    size = estimated_size_bytes(df)
    conf = df.sparkSession._jsparkSession.sessionState().conf()  # noqa: SLF001 - it parses sizes
    return size is not None and size <= int(conf.autoBroadcastJoinThreshold())


def broadcast_join(left: DataFrame, right: DataFrame, join_key: str | list[str],
                   join_type: str = "inner",
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """JN-1: right side broadcast (size checked)."""
    return join(left, right, join_key, join_type, "broadcast", max_broadcast_bytes)


def sort_merge_join(left: DataFrame, right: DataFrame, join_keys: str | list[str],
                    join_type: str = "inner") -> DataFrame:
    """JN-2: sort-merge join on one or more keys, without a manual repartition."""
    return join(left, right, join_keys, join_type, "merge")


@dataclass(frozen=True)
class JoinStep:
    """One dimension of a star join."""

    table: str
    on: str | tuple[str, ...]
    how: str = "left"
    strategy: str = "auto"


@dataclass
class StarJoin:
    """JN-3: fold a fact table over dimension steps.

    A dimension that is absent from ``tables`` is skipped; an absent fact table raises.
    Provenance columns are dropped from every dimension first.  Any other clash of a
    non-key column raises (``clash="raise"``) or is prefixed with the table name
    (``clash="prefix"``).

    Dimensions that nobody broadcasts are joined by shuffle, and the fact's hot keys are then
    split (``split_hot_keys``): one scan of the key columns for each key finds them, and all
    joins on a key share one salted partitioning.
    """

    fact: str
    steps: list[JoinStep]
    drop_from_dimensions: list[str] = field(default_factory=lambda: list(PROVENANCE_COLUMNS))
    clash: str = "raise"
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    split_hot_keys: bool = True

    def apply(self, tables: dict[str, DataFrame]) -> DataFrame:
        if self.fact not in tables or tables[self.fact] is None:
            raise ValueError(f"fact table {self.fact!r} is required")
        result = tables[self.fact]
        split: dict[tuple[str, ...], tuple[DataFrame, str] | None] = {}
        for step in self.steps:
            dim = tables.get(step.table)
            if dim is None:
                log.warning("dimension %s absent: join step skipped", step.table)
                continue
            keys = _keys(step.on)
            dim = dim.drop(*[c for c in self.drop_from_dimensions if c not in keys])
            clashes = [c for c in dim.columns if c in result.columns and c not in keys]
            if clashes:
                if self.clash == "prefix":
                    dim = dim.withColumnsRenamed({c: f"{step.table}_{c}" for c in clashes})
                else:
                    raise JoinError(f"columns {clashes} of {step.table} clash with the fact side")
            strategy = _allowed(dim, step.how, step.strategy, self.max_broadcast_bytes)
            if self._by_shuffle(step, dim, strategy):
                if tuple(keys) not in split:
                    heavy = heavy_keys(tables[self.fact], keys, tasks_of(result))
                    salt = f"__salt{len(split)}"
                    split[tuple(keys)] = heavy and (heavy, salt)
                    if heavy:
                        result = salted(result, keys, heavy, salt)
                if found := split[tuple(keys)]:
                    dim, keys = replicated(dim, keys, *found), [*keys, found[1]]
            if strategy == "broadcast":  # checked once
                dim, strategy = F.broadcast(dim), "auto"
            result = join(result, dim, keys, step.how, strategy)
        return result.drop(*[found[1] for found in split.values() if found])

    def _by_shuffle(self, step: JoinStep, dim: DataFrame, strategy: str) -> bool:
        """Whether a step will shuffle the fact, and its hot keys can be split."""
        how = step.how.lower()
        if not self.split_hot_keys or how not in SPLITTABLE or not set(_keys(step.on)) <= set(dim.columns):
            return False
        if strategy == "merge":
            return True
        return strategy != "broadcast" and not planner_broadcasts(dim)


# The commission chain: policy (inner), then left joins with feature, exchange, coverage
# and rider.  Every join key is a fact column, so the order does not change the rows; the
# 1:1 lookups come first so they move un-fanned rows, and the two many-per-policy joins
# come last and share one ``policy_id`` partitioning when they are shuffle joins.
# Every broadcast is size-checked; above the bound the planner (with AQE) decides.
COMMISSION_STAR = [
    JoinStep("policy", "policy_id", "inner", "broadcast"),
    JoinStep("feature", "feature_id", "left", "broadcast"),
    JoinStep("exchange", "exchange_code", "left", "broadcast"),
    JoinStep("coverage", "policy_id", "left", "broadcast"),
    JoinStep("rider", "policy_id", "left", "broadcast"),
]
