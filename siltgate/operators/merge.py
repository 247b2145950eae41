"""Merging a day's accepted rows with the previous snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from siltgate.functions.rules import column_type
from siltgate.operators.keys import BROADCAST_BYTES, key_bytes, key_table, renamed_key, same_key
from siltgate.operators.latest import latest_per_key

# A bucket is crowded by a key that alone holds this part of an even share of the day's rows.
CROWDING = 0.5


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both, new first; columns are matched by name."""
    return new.unionByName(existing)


def scd1_window(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    stamp: str = "time_stamp",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per key over both inputs. Needs nothing of them, but moves the whole snapshot by key."""
    return latest_per_key(append(existing, new), key, stamp, tie_break)


@dataclass(frozen=True)
class DayKeys:
    """What the merge has to know about the keys of a day."""

    count: int
    rows: int
    most_rows: int
    bytes: int
    has_null: bool
    oldest: Any
    has_null_stamp: bool


def _comparable(df: DataFrame, stamp: str) -> Column:
    """The stamp in a form that compares outside Spark as it does inside, whatever the time zones."""
    return F.unix_micros(stamp) if isinstance(column_type(df.schema, stamp), TimestampType) else F.col(stamp)


def measure_keys(new: DataFrame, key: Sequence[str], stamp: str) -> DayKeys:
    """One aggregation over key and stamp columns only; a frequent key is combined before the shuffle."""
    per_key = new.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(_comparable(new, stamp)).alias("_oldest"),
        F.bool_or(F.col(stamp).isNull()).alias("_null_stamp"),
    )
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return DayKeys(
        *per_key.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum("_rows"), F.lit(0)),
            F.coalesce(F.max("_rows"), F.lit(0)),
            F.coalesce(F.sum(key_bytes(key)), F.lit(0)),
            F.coalesce(F.bool_or(any_null), F.lit(False)),
            F.min("_oldest"),
            F.coalesce(F.bool_or("_null_stamp"), F.lit(False)),
        ).first()
    )


def by_presence(
    existing: DataFrame, keys: DataFrame, key: Sequence[str], has_null: bool, how: str
) -> DataFrame:
    """Rows of the snapshot whose key is among the day's (`left_semi`) or not (`left_anti`); NULL equals NULL.

    Keys without NULL are joined by plain equality, for which buckets and hash tables serve. Where the day has NULL in
    its keys, the snapshot's rows with NULL in theirs, filtered out first, are joined null-safe on their own.
    """
    if not has_null:
        return existing.join(keys, same_key(existing, key), how)
    old_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    new_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys.columns])
    whole = existing.filter(~old_null)
    partial, null_keys = existing.filter(old_null), keys.filter(new_null)
    return whole.join(keys.filter(~new_null), same_key(whole, key), how).unionByName(
        partial.join(null_keys, same_key(partial, key, null_safe=True), how)
    )


def _all_newer(day: DayKeys, existing: DataFrame, stamp: str, newest_old: Any = None) -> bool:
    """Whether every stamp of the day is newer than the whole snapshot, by its noted newest one or by its column."""
    if day.has_null_stamp:
        return False
    if newest_old is None:
        newest_old = existing.agg(F.max(_comparable(existing, stamp))).first()[0]
    return newest_old is None or day.oldest > newest_old


def scd1_touched(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    stamp: str = "time_stamp",
    tie_break: Sequence[str] | None = None,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    newest_old: Any = None,
) -> DataFrame:
    """The same result as `scd1_window` where `existing` holds each key once, without sorting the snapshot.

    Rows of the snapshot whose key the day does not touch pass as they are, also where they share a key. Touched old
    rows are compared with the new ones only when the day holds a stamp that is not newer than the whole snapshot;
    `newest_old` is the snapshot's newest stamp (in microseconds for timestamps with time zone), if it is known. The
    day's keys are broadcast up to `broadcast_bytes` by measure and joined by shuffle and sort beyond it; the rows of
    the result are the same.
    """
    day = measure_keys(new, key, stamp)
    if day.count == 0:
        return existing.select(*new.columns)
    keys = key_table(new, key)
    keys = F.broadcast(keys) if day.bytes <= broadcast_bytes else keys.hint("merge")
    untouched = by_presence(existing, keys, key, day.has_null, "left_anti")
    if _all_newer(day, existing, stamp, newest_old):
        return append(untouched, latest_per_key(new, key, stamp, tie_break))
    touched = by_presence(existing, keys, key, day.has_null, "left_semi")
    return append(untouched, scd1_window(touched, new, key, stamp, tie_break))


def scd1_bucketed(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    buckets: int,
    stamp: str = "time_stamp",
    tie_break: Sequence[str] | None = None,
    newest_old: Any = None,
) -> DataFrame:
    """As `scd1_touched` for a snapshot laid out in `buckets` by hash of the key, for days of any size.

    The day's rows are brought to the buckets, the snapshot stays where it is, and each bucket is probed against its
    share of the day's keys. Where one key holds so many of the day's rows that it would crowd its bucket, the rows
    are first reduced to one per key. The result is partitioned like the snapshot.
    """
    day = measure_keys(new, key, stamp)
    if day.count == 0:
        return existing.select(*new.columns)
    if day.most_rows > CROWDING * day.rows / buckets:
        newest_new = latest_per_key(new, key, stamp, tie_break).repartition(buckets, *key)
        distinct = new.select(*key).distinct().repartition(buckets, *key)
    else:
        newest_new = latest_per_key(new.repartition(buckets, *key), key, stamp, tie_break)
        distinct = new.select(*key).repartition(buckets, *key).distinct()
    keys = renamed_key(distinct, key).hint("shuffle_hash")
    untouched = by_presence(existing, keys, key, day.has_null, "left_anti")
    if _all_newer(day, existing, stamp, newest_old):
        return append(untouched, newest_new)
    touched = by_presence(existing, keys, key, day.has_null, "left_semi")
    return append(untouched, scd1_window(touched, newest_new, key, stamp, tie_break))


def scd1(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    stamp: str = "time_stamp",
    tie_break: Sequence[str] | None = None,
    *,
    existing_unique: bool,
    broadcast_bytes: int = BROADCAST_BYTES,
    newest_old: Any = None,
) -> DataFrame:
    """SCD type 1: one row per key, the newest. `existing_unique` says that the snapshot holds each key once."""
    if existing_unique:
        return scd1_touched(
            existing, new, key, stamp, tie_break, broadcast_bytes=broadcast_bytes, newest_old=newest_old
        )
    return scd1_window(existing, new, key, stamp, tie_break)
