"""Date and duration expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def require_utc(spark: SparkSession) -> SparkSession:
    """The session, if its time zone is UTC: days and weeks are UTC days and weeks."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")
    return spark


def week_start(when: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", when).cast("date")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
