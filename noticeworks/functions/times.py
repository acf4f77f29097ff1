"""Explicit points in time: operators never read the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime) -> Column:
    """Literal without time zone, so that it compares with stored times as they are."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day(value: date) -> Column:
    return F.lit(value.strftime("%Y-%m-%d")).cast("date")


def days_before(value: datetime, n: float) -> datetime:
    return value - timedelta(days=n)
