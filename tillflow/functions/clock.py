"""One way to say "now", so that a batch or a query can pin it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

AsOf = Column | str | dt.datetime | None


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: texts without an offset are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def instant(as_of: AsOf = None) -> Column:
    """The given moment as a timestamp; the query's start time if none is given.

    Naive datetimes and texts without an offset are taken as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        try:
            as_of = dt.datetime.fromisoformat(as_of.strip())
        except ValueError:  # with the name of a zone, for instance
            return F.lit(as_of).cast("timestamp")
    if isinstance(as_of, dt.datetime):
        zoned = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
        return F.lit(zoned.isoformat()).cast("timestamp")
    return as_of.cast("timestamp")
