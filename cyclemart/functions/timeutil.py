"""Injected instants (SC-2).

Jobs never read the clock themselves: the caller passes the processing instant, so a
re-run produces the same rows.  A naive ``datetime`` is a wall-clock time in the
*session* time zone (it is cast from its ISO text, not converted through the Python
process's local zone); an aware one keeps its offset.
"""

from __future__ import annotations

import datetime as dt

from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def utc_instant(spark: SparkSession, value: dt.datetime) -> dt.datetime:
    """An injected instant in UTC; a naive one is a wall-clock time in the session time zone."""
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return (value if value.tzinfo else value.replace(tzinfo=zone)).astimezone(dt.timezone.utc)


def instant(value: dt.datetime | dt.date | Column | str | None) -> Column:
    """A TIMESTAMP column for an injected instant (``None`` -> ``current_timestamp``)."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value).cast("timestamp")
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp")
    return F.lit(value.isoformat()).cast("timestamp")
