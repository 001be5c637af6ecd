"""Session construction and shared scratch locations.

Everything that has to be written between two steps of a job (staged Parquet, a
published table version, a checkpoint) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests, a laptop) do
we create a local one, and only where the master is local.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a production job would also want; every one can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where that breaks a partitioning a later join
    # would reuse (e.g. the two policy_id joins of the star): AQE then adds the shuffle
    # only when it actually finds skew.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state (dedup keys, per-cycle type sets) lives in RocksDB on local disk,
    # checkpointed to the shared folder, instead of on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_marked: set[str] = set()


def build_session(
    app_name: str = "cyclemart",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when none is set."""
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf_value = spark.conf.get("spark.checkpoint.dir", None)
    if conf_value:
        spark.sparkContext.setCheckpointDir(conf_value)
        return spark.sparkContext.getCheckpointDir() or conf_value
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cyclemart-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    # getCheckpointDir() appends a per-application uuid folder; stay inside it.
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cyclemart"
    if root not in _marked:  # the application's scratch files go when its JVM ends
        path = spark._jvm.org.apache.hadoop.fs.Path(root)  # noqa: SLF001
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code in tests can look at the folder."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def empty_frame(spark: SparkSession, schema) -> "DataFrame":  # noqa: F821
    """An empty DataFrame of ``schema`` planned entirely in the JVM (no Python rows)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # noqa: SLF001
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def materialize(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
