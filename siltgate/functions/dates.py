"""Run dates and load stamps. Dates key the snapshots as `yyyyMMdd` integers."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the feed of a day is loaded two days later.
RUN_LAG_DAYS = 2


def date_key(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


def run_date_for(now: datetime, lag_days: int = RUN_LAG_DAYS) -> int:
    """The date whose feed is loaded at `now`."""
    return date_key((now - timedelta(days=lag_days)).date())


def previous_date_key(key: int) -> int:
    """The calendar day before a date key."""
    return date_key(datetime.strptime(str(key), "%Y%m%d").date() - timedelta(days=1))


def business_date(moment: Column, lag_days: int = RUN_LAG_DAYS) -> Column:
    """Date key, as an integer column, of the day `lag_days` before a timestamp column."""
    return F.date_format(F.date_sub(F.to_date(moment), lag_days), "yyyyMMdd").cast("int")


def load_stamp(df: DataFrame, load_ts: datetime | Column, name: str = "time_stamp") -> DataFrame:
    """Append the load time. It is a run parameter, so every action of one run sees the same stamp."""
    return df.withColumn(name, F.lit(load_ts))
