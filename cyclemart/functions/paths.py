"""Object-key parsing and file-type routing (AU-1, IO-1, SC-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_object_key(key: str | Column) -> Column:
    """Split ``raw/{file_type}/cycle_{date}/{name}`` into a struct.

    Returns ``struct(file_type, cycle_date, file_name, valid)``; ``valid`` is false when
    the key has fewer than three ``/``-separated parts (such keys are skipped).
    """
    col = F.col(key) if isinstance(key, str) else key
    parts = F.split(col, "/")
    valid = F.size(parts) >= 3
    return F.struct(
        F.when(valid, F.element_at(parts, 2)).alias("file_type"),
        F.when(valid, F.replace(F.element_at(parts, 3), F.lit("cycle_"), F.lit(""))).alias("cycle_date"),
        F.element_at(parts, -1).alias("file_name"),
        valid.alias("valid"),
    )


def route_file_type(path: str | Column, file_types: list[str]) -> Column:
    """First type (in the given priority order) whose name occurs in the lower-cased path.

    No match gives NULL: the file is ignored.
    """
    col = F.lower(F.col(path) if isinstance(path, str) else path)
    routed = F.lit(None).cast("string")
    for file_type in reversed(file_types):
        routed = F.when(col.contains(file_type), F.lit(file_type)).otherwise(routed)
    return routed
