"""SCD Type 1 upsert, initial load, integrity check, versioned publish (MG-1..MG-5, IO-9).

The merge is plain DataFrame logic, so it runs on any file-based table:

* ``full`` strategy – target FULL OUTER JOIN source on the keys, each side tagged with a
  presence marker; every output column is picked per row from the side the rule names.
  Rows whose key contains NULL can never match; they get a spread key so they do not all
  hash into one shuffle partition.
* ``broadcast_source`` strategy – for a small delta (size checked): target LEFT JOIN
  broadcast(source) gives kept and updated rows, source ANTI JOIN the matched keys gives
  inserts.  The big target is never shuffled.

``auto`` picks ``broadcast_source`` when the source fits the broadcast bound.
A published table is a series of immutable numbered folders under one root, each exposed by
a marker that is written last; a merge reads what is exposed and writes a new folder, so
nothing is overwritten while it is being read and a write that dies half-way is never seen.
This is a publishing convention for one writer at a time, not an ACID table format.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.functions.timeutil import instant, utc_instant
from cyclemart.operators.dedup import duplicate_keys, has_duplicate_keys, keep_first, latest_per_key
from cyclemart.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, fits_broadcast
from cyclemart.schemas import INITIAL_LOAD_BY, MERGE_UPDATED_BY
from cyclemart.session import empty_frame, materialize

log = logging.getLogger(__name__)

ACTION_COL = "merge_action"
_T, _S = "__t_", "__s_"
_TP, _SP, _SPREAD = "__t_present", "__s_present", "__spread"
NULL_KEY_SPREAD = 1024
_SCHEMA_FILE, _PUBLISHED = "_schema.json", "_PUBLISHED"
#: Touched partitions that are named in a filter; beyond, the table is semi-joined.
MAX_NAMED_PARTITIONS = 1000


class MergeError(ValueError):
    """Schema or key problems that make a merge ambiguous."""


def _ts(now: dt.datetime | Column | None) -> Column:
    return instant(now)


def _instant(now: dt.datetime | Column | None) -> dt.datetime | None:
    """The instant of a publication, where one was injected as such."""
    return now if isinstance(now, dt.datetime) else None


def _spread(keys: list[str], prefix: str, all_cols: list[str]) -> Column:
    """0 for rows with a complete key; a hash bucket of the row for rows with a NULL key."""
    any_null = reduce(lambda a, b: a | b, [F.col(prefix + k).isNull() for k in keys])
    return F.when(any_null, F.pmod(F.xxhash64(*[F.col(prefix + c) for c in all_cols]),
                                   F.lit(NULL_KEY_SPREAD))).otherwise(F.lit(0))


def _unique_source(source: DataFrame, keys: list[str], on_duplicate: str, order_by, tie_breakers,
                   materialize_source: bool) -> DataFrame:
    """The source of a merge or of a first publication, with every key once."""
    if on_duplicate == "latest":
        if order_by is None:
            raise MergeError("on_duplicate='latest' needs order_by")
        source = keep_first(source, keys, order_by, tie_breakers=tie_breakers)
    elif on_duplicate not in ("error", "trust"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    if materialize_source:
        source = materialize(source)
    if on_duplicate == "error" and has_duplicate_keys(source, keys):
        raise MergeError(f"source repeats keys {keys}; pass on_duplicate='latest'")
    return source


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str] | None = None,
    now: dt.datetime | Column | None = None,
    updated_by: str = MERGE_UPDATED_BY,
    null_safe_keys: bool = False,
    on_duplicate: str = "error",
    order_by: str | list[str] | None = None,
    tie_breakers: list | None = None,
    with_action: bool = False,
    strategy: str = "auto",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    materialize_source: bool = False,
) -> DataFrame:
    """MG-1: upsert ``source`` into ``target`` by ``keys``; nothing is deleted.

    Matched rows take the source value of every update column (default: all non-key source
    columns except ``dw_inserted_date``); a NULL in the source overwrites.  Unmatched
    source rows are inserted with all source columns; target-only columns are NULL on
    insert and kept on update.  If the target carries ``dw_updated_date`` /
    ``dw_updated_by`` they are set on matched and inserted rows; a target-only
    ``dw_inserted_date`` is set on inserts.

    ``on_duplicate``: ``"error"`` raises when the source repeats a key, ``"latest"`` keeps
    the first row per key by ``order_by`` (descending), ``"trust"`` skips the check and is
    only for sources whose keys are unique by construction.
    ``materialize_source`` checkpoints the (de-duplicated) source once, so an expensive
    source plan is not re-run by the duplicate check and the broadcast plan's three uses.
    """
    tcols, scols = list(target.columns), list(source.columns)
    unknown = [c for c in scols if c not in tcols]
    if unknown:
        raise MergeError(f"source columns {unknown} do not exist in the target")
    missing_keys = [k for k in keys if k not in scols or k not in tcols]
    if missing_keys:
        raise MergeError(f"merge keys {missing_keys} missing on one side")

    source = _unique_source(source, keys, on_duplicate, order_by, tie_breakers, materialize_source)

    if update_columns is None:
        update_columns = [c for c in scols if c not in keys and c != "dw_inserted_date"]
    bad = [c for c in update_columns if c not in scols]
    if bad:
        raise MergeError(f"update columns {bad} are not source columns")

    stamp = _ts(now)
    t = target.select(*[F.col(c).alias(_T + c) for c in tcols]).withColumn(_TP, F.lit(True))
    s = source.select(*[F.col(c).alias(_S + c) for c in scols]).withColumn(_SP, F.lit(True))

    def key_cond(tk: str, sk: str) -> Column:
        return F.col(tk).eqNullSafe(F.col(sk)) if null_safe_keys else F.col(tk) == F.col(sk)

    cond = reduce(lambda a, b: a & b, [key_cond(_T + k, _S + k) for k in keys])

    if strategy not in ("auto", "full", "broadcast_source"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    use_broadcast = strategy != "full" and fits_broadcast(source, max_broadcast_bytes)
    if strategy == "broadcast_source" and not use_broadcast:
        log.warning("source above the broadcast bound; using the full outer join")

    t_present, s_present = F.col(_TP).isNotNull(), F.col(_SP).isNotNull()

    def pick(c: str) -> Column:
        tc = F.col(_T + c)
        if c in keys:
            sc = F.col(_S + c)
            return F.when(t_present, tc).otherwise(sc)
        if c == "dw_updated_date":
            return F.when(s_present, stamp).otherwise(tc)
        if c == "dw_updated_by":
            return F.when(s_present, F.lit(updated_by)).otherwise(tc)
        if c in update_columns:
            return F.when(s_present, F.col(_S + c)).otherwise(tc)
        if c in scols:
            return F.when(t_present, tc).otherwise(F.col(_S + c))
        if c == "dw_inserted_date":
            return F.when(t_present, tc).otherwise(stamp)
        return F.when(t_present, tc)

    action = (F.when(t_present & s_present, F.lit("updated"))
                .when(s_present, F.lit("inserted")).otherwise(F.lit("kept")))
    out = [pick(c).cast(target.schema[c].dataType).alias(c) for c in tcols]
    if with_action:
        out.append(action.alias(ACTION_COL))

    if use_broadcast:
        sb = F.broadcast(s)
        kept_or_updated = t.join(sb, cond, "left").select(*out)
        # distinct keys that the source has, too: never more rows than the source, whose
        # size was checked, however often the target repeats a key
        matched = (t.select(*[_T + k for k in keys])
                     .join(F.broadcast(s.select(*[_S + k for k in keys])), cond, "left_semi").distinct())
        inserts = (s.join(F.broadcast(matched), cond, "left_anti")
                     .withColumn(_TP, F.lit(None).cast("boolean")))
        for c in tcols:
            inserts = inserts.withColumn(_T + c, F.lit(None).cast(target.schema[c].dataType))
        return kept_or_updated.unionByName(inserts.select(*out))

    if null_safe_keys:
        joined = t.join(s, cond, "full_outer")
    else:
        t = t.withColumn(_SPREAD, _spread(keys, _T, tcols))
        s = s.withColumn(_SPREAD + "_s", _spread(keys, _S, scols))
        joined = t.join(s, cond & (F.col(_SPREAD) == F.col(_SPREAD + "_s")), "full_outer")
    return joined.select(*out)


def initial_load(df: DataFrame, now: dt.datetime | Column | None = None,
                 cycle_date: str | None = None, loaded_by: str = INITIAL_LOAD_BY) -> DataFrame:
    """MG-2: audit columns for the first publication of a table."""
    stamp = _ts(now)
    cols = {
        "dw_inserted_date": stamp,
        "dw_updated_date": stamp,
        "dw_updated_by": F.lit(loaded_by),
        "dw_is_active": F.lit(True),
    }
    if cycle_date is not None:
        cols["dw_cycle_date"] = F.lit(cycle_date)
    return df.withColumns(cols)


def integrity_ok(df: DataFrame, keys: list[str], within: DataFrame | None = None,
                 max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """MG-3: True when no key occurs twice.  Errors propagate.

    ``within`` restricts the check to the keys of another frame (the merge delta): a
    merge can only create a duplicate on a key it wrote, so checking those keys finds
    every *new* duplicate without grouping the whole table.  Keys match NULL-safely,
    because NULL keys group together.
    """
    if within is None:
        return not has_duplicate_keys(df, keys)
    delta_keys = within.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    if fits_broadcast(delta_keys, max_broadcast_bytes):
        delta_keys = F.broadcast(delta_keys)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return not has_duplicate_keys(df.join(delta_keys, cond, "left_semi"), keys)


def merge_counts(merged_with_action: DataFrame) -> DataFrame:
    """MG-5: rows per merge action (``inserted`` / ``updated`` / ``kept``)."""
    return merged_with_action.groupBy(ACTION_COL).agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- publishing


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # noqa: SLF001 - Hadoop FileSystem listing, as any Spark job does
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that does not exist yet; False if another writer has made it."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as failed:  # noqa: BLE001 - the stores name it differently
        if fs.exists(p):
            return False
        raise failed
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def _read_line(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark._jvm  # noqa: SLF001
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


class _Numbered:
    """Numbered folders below ``root``: ``{prefix}=00000001`` and so on.

    A folder gets its schema and tags first, then the data, and last the marker that
    exposes it.  A folder without the marker is what a failed write left behind: it is
    ignored, and its number is not used again.
    """

    prefix = "version"

    def _numbers(self) -> dict[int, bool]:
        """Every number, and whether it is exposed."""
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return {}
        path = self.spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
        found = {}
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{self.prefix}="):
                found[int(name.split("=", 1)[1])] = bool(fs.exists(path(st.getPath(), _PUBLISHED)))
        return found

    def _exposed(self) -> list[int]:
        return sorted(n for n, exposed in self._numbers().items() if exposed)

    def exists(self) -> bool:
        return bool(self._exposed())

    def path(self, number: int) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}={number:08d}"

    def _stored_schema(self, number: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(_read_line(self.spark, f"{self.path(number)}/{_SCHEMA_FILE}")))

    def _open(self, schema: T.StructType) -> int:
        """A number that no other writer has: the first to create its first file takes it."""
        number = max(self._numbers(), default=0) + 1
        while not _write_new(self.spark, f"{self.path(number)}/{_SCHEMA_FILE}", json.dumps(schema.jsonValue())):
            number += 1
        return number

    def _fill(self, df: DataFrame, number: int, partition_by: list[str]) -> None:
        if partition_by:  # one or a few files for each partition, large ones split
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(number))

    def _expose(self, number: int, text: str = "") -> None:
        _write_text(self.spark, f"{self.path(number)}/{_PUBLISHED}", text)

    def _remove(self, path: str) -> None:
        fs, p = _fs(self.spark, path)
        fs.delete(p, True)


@dataclass
class VersionedTable(_Numbered):
    """A table published as immutable ``{root}/version=N`` folders (IO-9)."""

    spark: SparkSession
    root: str
    partition_by: list[str] | None = None

    def versions(self) -> list[int]:
        return self._exposed()

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, version: int | None = None) -> DataFrame:
        """A published version (default: latest), with the schema it was written with.

        The stored schema keeps partition columns at their real type (``dw_cycle_date``
        would otherwise be inferred as INT from its folder names).
        """
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no published version under {self.root}")
        return (self.spark.read.option("basePath", self.path(version))
                    .schema(self._stored_schema(version)).parquet(self.path(version)))

    def publish(self, df: DataFrame, tag: str | None = None, at: dt.datetime | None = None) -> int:
        """Write ``df`` as the next version; ``tag`` marks it, ``at`` is its instant.

        Instants never fall from one version to the next: an earlier one counts as that of
        the version before.
        """
        version = self._open(df.schema)
        if tag is not None:
            _write_text(self.spark, f"{self.path(version)}/_TAG_{tag}", "")
        self._fill(df, version, self.partition_by or [])
        before = [v for v in self.versions() if v < version]
        known = [t for t in (self.published_at(before[-1]) if before else None, at and utc_instant(self.spark, at)) if t is not None]
        self._expose(version, max(known).isoformat() if known else "")
        return version

    def published_at(self, version: int) -> dt.datetime | None:
        """The instant a version was published with; None where none was known by then."""
        text = _read_line(self.spark, f"{self.path(version)}/{_PUBLISHED}")
        return dt.datetime.fromisoformat(text) if text else None

    def version_as_of(self, instant: dt.datetime) -> int | None:
        """The newest version that was published at or before ``instant``; None if there is
        none.  Found by bisection: a few markers are read, however many versions there are."""
        wanted, versions = utc_instant(self.spark, instant), self.versions()
        low, high = 0, len(versions)
        while low < high:
            middle = (low + high) // 2
            at = self.published_at(versions[middle])
            # versions without an instant come before all that have one, and are never meant
            low, high = (low, middle) if at is not None and at > wanted else (middle + 1, high)
        return versions[low - 1] if low and self.published_at(versions[low - 1]) is not None else None

    def read_as_of(self, instant: dt.datetime) -> DataFrame:
        """The table as it was at an instant (IO-9)."""
        version = self.version_as_of(instant)
        if version is None:
            raise FileNotFoundError(f"nothing was published under {self.root} by {instant}")
        return self.read(version)

    def has_tag(self, tag: str, version: int | None = None) -> bool:
        """True when the version (default: latest) carries ``tag``."""
        version = self.latest() if version is None else version
        if version is None:
            return False
        fs, p = _fs(self.spark, f"{self.path(version)}/_TAG_{tag}")
        return bool(fs.exists(p))

    def retire(self, keep: int) -> list[int]:
        """Remove all but the ``keep`` newest versions; returns those removed."""
        old = self.versions()[:-keep] if keep > 0 else []
        for version in old:
            self._remove(self.path(version))
        return old


def _checked(df: DataFrame, keys: list[str], materialize_source: bool, kwargs: dict) -> tuple[DataFrame, dict]:
    """The delta with every key once, evaluated once if asked; what is left of ``kwargs``.

    The same check serves a first publication and a merge.
    """
    rest = dict(kwargs)
    options = [rest.pop(k, None) for k in ("on_duplicate", "order_by", "tie_breakers")]
    df = _unique_source(df, keys, options[0] or "error", *options[1:], materialize_source)
    return df, rest | {"on_duplicate": "trust"}


def _observed(merged: DataFrame) -> tuple[DataFrame, Observation]:
    """The merged rows without their action, and the counts its write will observe (MG-5)."""
    obs = Observation("merge")
    counts = [F.count_if(F.col(ACTION_COL) == a).alias(a) for a in ("inserted", "updated", "kept")]
    return merged.observe(obs, *counts).drop(ACTION_COL), obs


@dataclass
class MergeOutcome:
    version: int
    initialised: bool
    source_rows: int
    counts: dict[str, int]
    integrity_ok: bool | None


def merge_or_init(
    table: VersionedTable,
    df: DataFrame,
    keys: list[str],
    now: dt.datetime | None = None,
    cycle_date: str | None = None,
    on_integrity: str = "warn",
    tag: str | None = None,
    materialize_source: bool = True,
    audit_columns: bool = True,
    integrity: str = "delta",
    **merge_kwargs,
) -> MergeOutcome:
    """MG-4: initialise the table if absent, otherwise merge into the latest version.

    The merge is evaluated once, by the write; action counts come from an observation on
    that write.  The integrity check reads the new version (keys only).
    ``materialize_source`` (default on) checkpoints the source first, which pays off when
    it is an expensive plan (a star join); pass False for a plain scan.
    ``audit_columns=False`` publishes the first version without the ``dw_*`` columns
    (e.g. the arrival audit table, which has its own time columns).
    ``integrity``: ``"delta"`` checks the keys the merge wrote (every new duplicate),
    ``"full"`` groups the whole new version, ``"off"`` skips the check.  A first publication
    is refused, like a merge, when the source repeats a key (``on_duplicate``).
    """
    df, merge_kwargs = _checked(df, keys, materialize_source, merge_kwargs)
    if not table.exists():
        obs = Observation("initial_load")
        first = initial_load(df, now, cycle_date) if audit_columns else df
        version = table.publish(first.observe(obs, F.count(F.lit(1)).alias("rows")), tag, _instant(now))
        rows = int(obs.get["rows"])
        return MergeOutcome(version, True, rows, {"inserted": rows, "updated": 0, "kept": 0}, True)

    merged, obs = _observed(scd1_merge(table.read(), df, keys, now=now, with_action=True, **merge_kwargs))
    version = table.publish(merged, tag, _instant(now))
    counts = {k: int(v) for k, v in obs.get.items()}
    ok = None
    if integrity != "off":
        published = table.read(version).select(*keys)
        ok = integrity_ok(published, keys, within=df if integrity == "delta" else None)
    if ok is False:
        message = f"duplicate keys {keys} in version {version} of {table.root}"
        if on_integrity == "raise":
            raise MergeError(message)
        log.warning(message)
    return MergeOutcome(version, False, counts["inserted"] + counts["updated"], counts, ok)


# ------------------------------------------------------------ partition-scoped publish


@dataclass
class PartitionedTable(_Numbered):
    """A table partitioned by one key column, replaced partition by partition.

    Every publication is a folder ``{root}/published_rev=N`` with the whole new content of
    the partitions it touches; a reader takes each partition from the newest publication
    that has it.  A merge therefore reads and writes only the partitions its delta names
    and writes them once, to a new place.  The partition column must be one of the merge
    keys: then a key cannot move between partitions, and a delta cannot change others.
    Superseded partitions are removed once ``keep`` newer publications exist, for readers
    that are still under way; use :class:`VersionedTable` where time travel is needed.
    """

    spark: SparkSession
    root: str
    partition_col: str
    keep: int = 1

    prefix = "published_rev"

    def _partitions(self, number: int) -> list[str]:
        fs, p = _fs(self.spark, self.path(number))
        return [st.getPath().getName() for st in fs.listStatus(p)
                if st.isDirectory() and st.getPath().getName().startswith(f"{self.partition_col}=")]

    def _current(self) -> dict[str, int]:
        """The newest publication of every partition folder."""
        return {name: n for n in self._exposed() for name in self._partitions(n)}

    def _read(self, folders: dict[str, int]) -> DataFrame:
        exposed = self._exposed()
        if not exposed:
            raise FileNotFoundError(f"nothing published under {self.root}")
        schema = self._stored_schema(exposed[-1])
        if not folders:
            return empty_frame(self.spark, schema)
        wide = T.StructType([*schema.fields, T.StructField(self.prefix, T.IntegerType())])
        paths = [f"{self.path(n)}/{name}" for name, n in sorted(folders.items())]
        df = self.spark.read.schema(wide).option("basePath", self.root).parquet(*paths)
        return df.select(*[F.col(c) for c in schema.names])

    def read(self) -> DataFrame:
        return self._read(self._current())

    def _touched(self, df: DataFrame) -> DataFrame:
        """The published rows of the partitions that ``df`` names."""
        column, table = self.partition_col, self.read()
        values = df.select(F.col(column).alias("__v")).distinct()
        named = [r[0] for r in values.limit(MAX_NAMED_PARTITIONS + 1).collect()]
        if len(named) > MAX_NAMED_PARTITIONS:  # a backfill: most partitions are read anyway
            return table.join(values, F.col(column).eqNullSafe(F.col("__v")), "left_semi")
        rows = F.col(column).isin(*[v for v in named if v is not None])
        return table.where(rows | F.col(column).isNull() if None in named else rows)

    def _publish(self, df: DataFrame, emptied: list[str] = ()) -> int:
        number = self._open(df.schema)
        self._fill(df, number, [self.partition_col])
        for name in emptied:  # an empty folder stands for a partition without rows
            fs, p = _fs(self.spark, f"{self.path(number)}/{name}")
            fs.mkdirs(p)
        self._expose(number)
        self._retire()
        return number

    def _retire(self) -> None:
        """Remove what no reader needs that saw one of the last ``keep`` + 1 publications."""
        seen: set[str] = set()
        exposed = self._exposed()
        for number in reversed(exposed[:-self.keep] if self.keep else exposed):
            names = self._partitions(number)
            replaced = [name for name in names if name in seen]
            seen.update(names)
            if len(replaced) == len(names):
                self._remove(self.path(number))
            else:
                for name in replaced:
                    self._remove(f"{self.path(number)}/{name}")

    def merge_or_init(self, df: DataFrame, keys: list[str], now: dt.datetime | None = None,
                      cycle_date: str | None = None, on_integrity: str = "warn",
                      materialize_source: bool = True, audit_columns: bool = True,
                      **merge_kwargs) -> MergeOutcome:
        """MG-4: initialise, or merge the delta into the partitions it touches.

        ``materialize_source`` checkpoints the delta once; it is then read for the touched
        partition values and the merge without re-running its plan.
        """
        if self.partition_col not in keys:
            raise MergeError(f"the partition column {self.partition_col!r} must be one of the keys {keys}")
        first = not self.exists()
        if first and audit_columns:
            df = initial_load(df, now, cycle_date)
        df, merge_kwargs = _checked(df, keys, materialize_source, merge_kwargs)
        if first:
            obs = Observation("initial_load")
            self._publish(df.observe(obs, F.count(F.lit(1)).alias("rows")))
            rows = int(obs.get["rows"])
            return MergeOutcome(0, True, rows, {"inserted": rows, "updated": 0, "kept": 0}, True)
        merged, obs = _observed(scd1_merge(self._touched(df), df, keys, now=now, with_action=True, **merge_kwargs))
        number = self._publish(merged)
        counts = {k: int(v) for k, v in obs.get.items()}
        written = {name: number for name in self._partitions(number)}
        ok = integrity_ok(self._read(written).select(*keys), keys)
        if not ok:
            message = f"duplicate keys {keys} in publication {number} of {self.root}"
            if on_integrity == "raise":
                raise MergeError(message)
            log.warning(message)
        return MergeOutcome(0, False, counts["inserted"] + counts["updated"], counts, ok)

    def delete_where(self, condition: Column) -> int:
        """Rewrite the partitions that hold rows for which ``condition`` is true, without
        them; returns the number of partitions rewritten."""
        gone = F.coalesce(condition, F.lit(False))
        hit = self.read().where(gone).select(self.partition_col).distinct()
        names = {self._folder(r[0]) for r in hit.collect()}  # one row for each partition
        if not names:
            return 0
        current = {name: n for name, n in self._current().items() if name in names}
        self._publish(self._read(current).where(~gone), sorted(names))
        return len(names)

    def repair(self, keys: list[str], updated_col: str = "dw_updated_date", tie_breakers: list | None = None,
               null_safe_keys: bool = False) -> tuple[int, int]:
        """WN-2 on the published table: remove older duplicates, the newest ``updated_col`` stays.

        The partitions that hold repeated keys are found from the key columns alone, and only
        those are rewritten; all others keep their files.  Rows with a NULL key are
        duplicates only with ``null_safe_keys``, as in a merge.  Returns the numbers of
        partitions rewritten and of rows removed.
        """
        if self.partition_col not in keys:
            raise MergeError(f"the partition column {self.partition_col!r} must be one of the keys {keys}")
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        counted = F.lit(True) if null_safe_keys else whole
        repeated = duplicate_keys(self.read().select(*keys).where(counted), keys)
        found = repeated.groupBy(self.partition_col).agg(F.sum(F.col("cnt") - 1).alias("surplus")).collect()
        if not found:  # one row for each partition to be rewritten
            return 0, 0
        names = {self._folder(r[0]) for r in found}
        rows = self._read({name: n for name, n in self._current().items() if name in names})
        kept = latest_per_key(rows.where(counted), keys, updated_col, tie_breakers)
        self._publish(kept if null_safe_keys else kept.unionByName(rows.where(~whole)))
        return len(names), int(sum(r["surplus"] for r in found))

    def _folder(self, value) -> str:
        utils = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils  # noqa: SLF001
        return utils.getPartitionPathString(self.partition_col, None if value is None else str(value))


__all__ = [
    "ACTION_COL", "MergeError", "MergeOutcome", "PartitionedTable", "VersionedTable",
    "initial_load", "integrity_ok", "merge_counts", "merge_or_init", "scd1_merge",
]
