"""Newest row per key, key typing and sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, key: Sequence[str], stamp: str, tie_break: Sequence[str] | None) -> list[Column]:
    """Sort order that puts the row to keep first. Equal stamps are settled by `tie_break`, by default the other
    columns from left to right, so that the outcome never depends on how rows are spread over tasks."""
    taken = {c.lower() for c in [*key, stamp]}
    rest = [c for c in df.columns if c.lower() not in taken] if tie_break is None else tie_break
    return [F.desc_nulls_last(c) for c in [stamp, *rest]]


def latest_per_key(
    df: DataFrame, key: Sequence[str], stamp: str = "time_stamp", tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key, the newest; NULL keys count as one key.

    Spark keeps only the best row of each key per task before it shuffles, so a key that holds a large part of all
    rows costs one row per task in the shuffle and is no hot spot after it.
    """
    newest = Window.partitionBy(*key).orderBy(*newest_first(df, key, stamp, tie_break))
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def key_cast_sort(df: DataFrame, key: str, tie_break: Sequence[str] | None = None, data_type: str = "int") -> DataFrame:
    """Cast the key, text that is no number to NULL, and sort by it, NULLs first.

    Rows of equal key are ordered by the key as it was and then by `tie_break`, by default all other columns. Range partitioning can thereby cut
    through a frequent key as well, above all through the many texts that may have become NULL.
    """
    rest = [c for c in df.columns if c.lower() != key.lower()] if tie_break is None else tie_break
    cast = df.withColumns({"_raw_key": F.col(key), key: F.col(key).try_cast(data_type)})
    return cast.sort(*[F.asc_nulls_first(c) for c in [key, "_raw_key", *rest]]).drop("_raw_key")


def preview(df: DataFrame, order: Sequence[str], rows: int = 1000) -> DataFrame:
    """The first rows in key order. Each task contributes only its own first rows; nothing is sorted as a whole."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(rows)
