"""SCD type 1 tables that store each day's changes once and settle the newest row per key when read.

A day writes its own rows and no others. Reading joins them to the last compacted state; compaction rewrites only the
files of that state that hold a changed key. Days may come late, twice or corrected: every read goes by dates, so a
replayed day is right in all later reads at once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from siltgate.functions.rules import column_type
from siltgate.operators.columns import under, widened
from siltgate.operators.keys import BROADCAST_BYTES, key_table
from siltgate.operators.latest import latest_per_key
from siltgate.operators.merge import by_presence, measure_keys, scd1_touched
from siltgate.operators.split import observed
from siltgate.sources.published import Base, Part, State, new_folder, publish, read_state
from siltgate.sources.storage import WITH_MARKER, join_path, sizes_below

SHARE = 0.2
FILE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Increments:
    """A table: its folder, key, stamp and tie-break. Files are made of about `file_bytes` at compaction."""

    folder: str
    key: tuple[str, ...]
    stamp: str = "time_stamp"
    tie_break: tuple[str, ...] | None = None
    file_bytes: int = FILE_BYTES
    broadcast_bytes: int = BROADCAST_BYTES


@dataclass(frozen=True)
class Compaction:
    """What a compaction did: files taken over, files rewritten, bytes written."""

    state: State
    kept_files: int
    rewritten_files: int
    bytes_written: int


def _write(spark: SparkSession, table: Increments, df: DataFrame) -> Part:
    """One write into a folder of its own; rows and newest stamp are observed on the way, not by a second job."""
    place, seen = new_folder(), Observation()
    newest = F.max(F.unix_micros(table.stamp) if isinstance(column_type(df.schema, table.stamp), TimestampType) else table.stamp)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest"))
    watched.write.options(**WITH_MARKER).parquet(join_path(table.folder, place))
    sizes = {n: b for n, b in sizes_below(spark, join_path(table.folder, place)).items() if not n.startswith(("_", "."))}
    held = observed(seen)
    last = held.get("newest")
    known = last.isoformat() if isinstance(last, datetime) else last if isinstance(last, int | str) else None
    return Part(tuple(join_path(place, n) for n in sorted(sizes)), sum(sizes.values()), held.get("rows", 0), known)


def _newest(part: Part, stamp_is_time: bool) -> Any:
    return datetime.fromisoformat(part.newest) if stamp_is_time and isinstance(part.newest, str) else part.newest


def _read(spark: SparkSession, table: Increments, schema: StructType, files: Sequence[str]) -> DataFrame:
    """Files under the table's schema: columns they lack are NULL, narrower numbers are widened by the reader."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[join_path(table.folder, f) for f in files])


def _schema(state: State) -> StructType:
    if state.schema is None:
        raise FileNotFoundError("no day has been loaded")
    return StructType.fromJson(json.loads(state.schema))


def load_day(spark: SparkSession, table: Increments, day: DataFrame, load_date: int) -> State:
    """Store the newest row per key of a day's accepted rows and publish it; a day loaded again is replaced.

    Writes the day's rows only. New columns and wider types are taken into the table's schema; types without a common
    one are refused before anything is written. A compacted state that holds an earlier form of the day is dropped
    from the note, as later reads would be wrong, and the next compaction makes a new one.
    """
    known = read_state(spark, table.folder).schema
    schema = widened(StructType.fromJson(json.loads(known)), day.schema) if known else widened(day.schema, day.schema)
    part = _write(spark, table, latest_per_key(under(day, schema), table.key, table.stamp, table.tie_break))

    def change(state: State) -> State:
        held = widened(StructType.fromJson(json.loads(state.schema)), schema) if state.schema else schema
        return replace(state.without_day(load_date), schema=held.json(), days={**state.days, load_date: part})

    return publish(spark, table.folder, change)


def _changes(spark: SparkSession, table: Increments, state: State, dates: list[int]) -> DataFrame:
    return _read(spark, table, _schema(state), [f for d in dates for f in state.days[d].files])


def read_as_of(spark: SparkSession, table: Increments, as_of: int | None = None, state: State | None = None) -> DataFrame:
    """The newest row per key of all days up to `as_of`, by default of all.

    The compacted state is not moved: the changes' keys are broadcast up to `broadcast_bytes` by measure, and only
    beyond that, and for changes as large as the state, it is shuffled once.
    """
    state = state or read_state(spark, table.folder)
    as_of = max(state.days, default=0) if as_of is None else as_of
    base = state.base_for(as_of)
    dates = state.days_after(base, as_of)
    if base is None:
        if not dates:
            raise FileNotFoundError(f"{table.folder}: no day up to {as_of}")
        return latest_per_key(_changes(spark, table, state, dates), table.key, table.stamp, table.tie_break)
    existing = _read(spark, table, _schema(state), base.part.files)
    if not dates:
        return existing
    is_time = not isinstance(column_type(existing.schema, table.stamp), TimestampType)
    return scd1_touched(
        existing,
        _changes(spark, table, state, dates),
        table.key,
        table.stamp,
        table.tie_break,
        broadcast_bytes=table.broadcast_bytes,
        newest_old=_newest(base.part, is_time),
    )


def touched_files(existing: DataFrame, day: DataFrame, key: Sequence[str], stamp: str, broadcast_bytes: int) -> set[str]:
    """Names of the files of `existing`, as read, that hold a key of `day`.

    Only key columns are read, and of these only row groups between the day's least and greatest key.
    """
    measured = measure_keys(day, key, stamp)
    if measured.count == 0:
        return set()
    keys = key_table(day, key)
    keys = F.broadcast(keys) if measured.bytes <= broadcast_bytes else keys.hint("merge")
    rows = existing.select(*key, F.col("_metadata.file_name").alias("_file"))
    if not measured.has_null:
        bounds = day.agg(F.min(key[0]).alias("low"), F.max(key[0]).alias("high")).first()
        rows = rows.where(F.col(key[0]).between(bounds["low"], bounds["high"]))
    found = by_presence(rows, keys, key, measured.has_null, "left_semi")
    return {r["_file"] for r in found.select("_file").distinct().collect()}


def _clustered(table: Increments, rows: DataFrame, size: int) -> DataFrame:
    """By ranges of the key, so that a later day's keys lie in few files."""
    return rows.repartitionByRange(max(1, -(-size // table.file_bytes)), *table.key).sortWithinPartitions(*table.key)


def compact(
    spark: SparkSession, table: Increments, as_of: int | None = None, *, share: float = SHARE
) -> Compaction | None:
    """Make a compacted state of all days up to `as_of`, if what a read would have to merge exceeds `share` of the
    state before it, in bytes; None otherwise.

    Files of the state before that hold none of the changed keys are taken over as they are, the others are rewritten
    with the changes. Earlier states stay, so that earlier dates are read as fast as before.
    """
    state = read_state(spark, table.folder)
    as_of = max(state.days, default=0) if as_of is None else as_of
    base = state.base_for(as_of)
    dates = state.days_after(base, as_of)
    changed = sum(state.days[d].bytes for d in dates)
    if not dates or (base is not None and changed <= share * base.part.bytes):
        return None
    changes, schema = _changes(spark, table, state, dates), _schema(state)
    if base is None:
        newest = latest_per_key(changes, table.key, table.stamp, table.tie_break)
        part = _write(spark, table, _clustered(table, newest, changed))
        kept, rewritten, written = (), 0, part.bytes
    else:
        existing = _read(spark, table, schema, base.part.files)
        names = touched_files(existing, changes, table.key, table.stamp, table.broadcast_bytes)
        old = [f for f in base.part.files if f.rsplit("/", 1)[-1] in names]
        kept, rewritten = tuple(f for f in base.part.files if f not in set(old)), len(old)
        sizes = reduce(lambda a, b: a | b, [_sizes(spark, table, f) for f in {f.rsplit("/", 1)[0] for f in base.part.files}], {})
        old_bytes = sum(sizes[f] for f in old)
        merged = scd1_touched(
            _read(spark, table, schema, old), changes, table.key, table.stamp, table.tie_break, broadcast_bytes=table.broadcast_bytes
        )
        made = _write(spark, table, _clustered(table, merged, old_bytes + changed))
        # What is taken over is not counted again: its rows are those of the state less those of the files rewritten.
        gone = _read(spark, table, schema, old).count() if old else 0
        known = [n for n in (base.part.newest, made.newest) if n is not None]
        part = Part(
            (*kept, *made.files),
            base.part.bytes - old_bytes + made.bytes,
            base.part.rows - gone + made.rows,
            max(known) if len(known) == 2 else None,
        )
        written = made.bytes

    def change(now: State) -> State:
        # A day replaced meanwhile would make this state wrong.
        if any(now.days.get(d) != state.days[d] for d in dates) or (base is not None and base not in now.bases):
            raise RuntimeError(f"{table.folder}: days were loaded again during compaction")
        held = tuple(b for b in now.bases if b.date != as_of)
        includes = tuple(sorted({*(base.includes if base else ()), *dates}))
        return replace(now, bases=(*held, Base(as_of, includes, part)))

    return Compaction(publish(spark, table.folder, change), len(kept), rewritten, written)


def _sizes(spark: SparkSession, table: Increments, place: str) -> dict[str, int]:
    return {join_path(place, n): b for n, b in sizes_below(spark, join_path(table.folder, place)).items()}


def retire_states(spark: SparkSession, table: Increments, before: int) -> State:
    """Forget compacted states older than `before`, but for the newest of them. Days stay, so every date can be read;
    `remove_unreferenced` then frees the files that no state names any more."""

    def change(state: State) -> State:
        older = [b for b in state.bases if b.date < before]
        last = max(older, key=lambda b: b.date, default=None)
        return replace(state, bases=tuple(b for b in state.bases if b.date >= before or b == last))

    return publish(spark, table.folder, change)
