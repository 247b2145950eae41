"""Snapshots kept in order of their key: a file per range of it, under bounds that are stored and used again.

Order that is made anew costs a range shuffle of the whole table per day. Here the bounds of the ranges are kept; a
day's rows alone are brought to them, and each range is merged where it lies. Spark knows no stored range partitioning,
but it knows buckets: a range has a label whose hash is its own number, so that bucket i is range i.

A range is sorted whole by one task, so the ranges become more as the table grows: their size is bounded, not their number.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from siltgate.functions.rules import column_type
from siltgate.operators.columns import reconciled
from siltgate.operators.latest import latest_per_key
from siltgate.operators.merge import append
from siltgate.sources.snapshot import latest_prior_date, read_bucketed, read_note, read_snapshot, write_snapshot
from siltgate.sources.storage import join_path, remove

LABEL = "_range"
BOUNDS = "bounds"
# Steps of a search by halves; Spark allows 100,000 buckets.
STEPS = tuple(1 << i for i in reversed(range(17)))
# Numbers tried per range for a label; that a range finds none has a chance of e to the minus this.
TRIES = 40
# A day that puts more than this many times a range's share of the table into one range has the table dealt out anew.
CROWDING = 2.0
# A range that with a day's rows would hold more than this many times `range_bytes` has the table dealt out anew.
FULL = 4
# Assumed cost of a row in a sort, beside its values.
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Ranges:
    """A table of dated snapshots below `folder`, each unique on `key` and in its order, in `number` ranges.

    There are fewer ranges only where there are fewer keys, and more where the newest row per key would come to more
    than `range_bytes` in each, in the form a task sorts them.
    """

    folder: str
    key: tuple[str, ...]
    number: int
    stamp: str = "time_stamp"
    tie_break: tuple[str, ...] | None = None
    range_bytes: int = 128 << 20


def labels(spark: SparkSession, number: int) -> DataFrame:
    """For each of the ranges, from 0, the least integer that bucketing by hash puts into the bucket of that number."""
    tried = spark.range(number * TRIES)
    return tried.groupBy(F.pmod(F.hash("id"), F.lit(number)).alias("number")).agg(F.min("id").alias(LABEL))


def _key(names: Sequence[str]) -> Column:
    """The key as one value. Structs compare field by field, NULL first, as a sort does."""
    return F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names)])


def row_bytes(df: DataFrame, columns: int) -> Column:
    """About the size of a row of `df` in a sort under so many columns: eight bytes each, and texts and nested values by
    the length of their text form."""
    fixed = (NumericType, DatetimeType, BooleanType)
    texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    sizes = [F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)).cast("long") for n in texts]
    return reduce(lambda a, b: a + b, sizes, F.lit(ROW_OVERHEAD_BYTES + 8 * columns).cast("long"))


def _needed(df: DataFrame, table: Ranges) -> int:
    """How many ranges the newest rows of `df` are to be laid out in, by an estimate of their number and size."""
    width = F.avg(row_bytes(df, len(df.columns) + 1))
    keys, width = df.agg(F.approx_count_distinct(_key(table.key)), width).first()
    return max(table.number, math.ceil(keys * (width or 0) / table.range_bytes))


def labelled(df: DataFrame, bounds: DataFrame, key: Sequence[str]) -> DataFrame:
    """`df` and, in `_range`, the label of the range each key belongs to; keys below all bounds belong to the first.

    `bounds` has a row per range (number, label, least key): so many that a session can plan as many tasks.
    """
    held = F.array_sort(F.collect_list(F.struct("number", LABEL, "low"))).alias("held")
    steps = F.filter(F.array(*[F.lit(i) for i in STEPS]), lambda i: i < F.size("held")).alias("steps")
    listed = bounds.agg(held).select(F.struct("held", steps)).scalar()
    found = df.withColumns({"_key": _key(key), "_bounds": listed})

    def nearer(at: Column, step: Column) -> Column:
        return F.when(F.get("_bounds.held", at + step)["low"] <= F.col("_key"), at + step).otherwise(at)

    last = F.aggregate("_bounds.steps", F.lit(0), nearer)
    return found.withColumn(LABEL, F.get("_bounds.held", last)[LABEL]).drop("_key", "_bounds")


def _in_ranges(df: DataFrame, table: Ranges) -> DataFrame:
    """Newest row per key within each range; what is partitioned by range stays so, and comes out in order."""
    return latest_per_key(df, (LABEL, *table.key), table.stamp, table.tie_break)


def _opened(spark: SparkSession, table: Ranges, load_date: int) -> tuple[DataFrame, str | None]:
    """A snapshot in its buckets, and the name of its bounds; an empty one has neither."""
    plain = read_snapshot(spark, table.folder, load_date)
    name = next((f.metadata.get(BOUNDS) for f in plain.schema.fields if f.name == LABEL), None)
    return (read_bucketed(spark, table.folder, load_date) if name else plain), name


def read_ranges(spark: SparkSession, table: Ranges, load_date: int) -> DataFrame:
    """A snapshot in order of its key, without moving it: partition i is range i, sorted."""
    return _in_ranges(_opened(spark, table, load_date)[0], table).drop(LABEL)


def merge_ranges(existing: DataFrame, day: DataFrame, bounds: DataFrame, number: int, table: Ranges) -> DataFrame:
    """Newest row per key of a snapshot as `read_bucketed` gives it and a day's labelled rows, in order of the key.

    The day is reduced to a row per key and brought to the ranges; the snapshot stays where it lies.
    """
    newest = latest_per_key(day, table.key, table.stamp, table.tie_break)
    old, new = reconciled(existing, labelled(newest, bounds, table.key).repartition(number, LABEL))
    return _in_ranges(append(old, new), table)


def lay_out(df: DataFrame, table: Ranges, load_date: int) -> None:
    """Write the newest row per key of `df` in even ranges, as many as its size calls for, under new bounds. This reads
    `df` once to measure it and moves all rows.

    Fewer keys than ranges give fewer ranges, an empty table none. NULL in a key comes before all else.
    """
    spark, staged = df.sparkSession, join_path(table.folder, f"_{uuid.uuid4().hex}")
    newest = latest_per_key(df, table.key, table.stamp, table.tie_break)
    try:
        dealt = newest.repartitionByRange(_needed(df, table), *[F.asc_nulls_first(k) for k in table.key])
        dealt.withColumn("_task", F.spark_partition_id()).write.parquet(staged)
        rows = spark.read.schema(dealt.schema.add("_task", "integer")).parquet(staged)
        low = rows.groupBy("_task").agg(F.min(_key(table.key)).alias("low"))
        number, name = low.count(), uuid.uuid4().hex
        if not number:
            write_snapshot(newest.withColumn(LABEL, F.lit(None).cast("bigint")), table.folder, load_date, unique_on=table.key)
            return
        # A row per range, so one task numbers them.
        numbered = low.withColumn("number", F.row_number().over(Window.orderBy("low")) - 1)
        bounds = numbered.join(labels(spark, number), "number").select("number", LABEL, "low", "_task")
        bounds.coalesce(1).write.parquet(join_path(table.folder, "_bounds", name))
        # A task's rows are a range already: its number says which, no key is compared.
        tasks = spark.read.parquet(join_path(table.folder, "_bounds", name)).select("_task", LABEL)
        stored = rows.join(F.broadcast(tasks), "_task").drop("_task")
        _store(stored.repartition(number, LABEL), table, load_date, number, name)
    finally:
        remove(spark, staged)


def _store(df: DataFrame, table: Ranges, load_date: int, number: int, bounds: str) -> None:
    """The bounds are named in the schema of the rows, so neither is ever there without the other."""
    noted = df.withMetadata(LABEL, {BOUNDS: bounds})
    write_snapshot(noted, table.folder, load_date, unique_on=table.key, buckets=number, bucket_key=(LABEL,), sort_buckets=table.key)


def _fits(existing: DataFrame, day: DataFrame, bounds: DataFrame, number: int, rows: int, table: Ranges) -> bool:
    """Whether a day's keys are spread over the ranges of a snapshot of so many rows, and no range grows too large.

    Sizes go by rows of the mean width: ranges are made even in rows, so those dealt out anew pass.
    """
    columns = len({c.lower() for c in [*existing.columns, *day.columns]})
    keys = day.groupBy(*table.key).agg(F.max(row_bytes(day, columns)).alias("_bytes"))
    counted = F.count(F.lit(1))
    new = labelled(keys, bounds, table.key).groupBy(LABEL).agg(counted.alias("new"), counted.alias("rows"), F.sum("_bytes").alias("bytes"))
    old = existing.groupBy(LABEL).agg(F.lit(0).alias("new"), counted.alias("rows"), F.sum(row_bytes(existing, columns)).alias("bytes"))
    per_range = old.unionByName(new).groupBy(LABEL).agg(*[F.sum(c).alias(c) for c in ("new", "rows", "bytes")])
    most, largest, width = per_range.agg(F.max("new"), F.max("rows"), F.sum("bytes") / F.sum("rows")).first()
    return (most or 0) <= CROWDING * max(1, rows / number) and (largest or 0) * (width or 0) <= FULL * table.range_bytes


def load_ranges(spark: SparkSession, table: Ranges, day: DataFrame, load_date: int) -> bool:
    """Merge a day with the snapshot before it and store the result in order. Returns whether the old bounds served.

    They do not for a first day, for a key whose type has changed, where most of a day falls into few ranges (keys that
    only ever grow, say), or where the table has outgrown its ranges: then the whole table is dealt out anew, in more
    ranges if it needs them, or single tasks would grow with the table.
    """
    prior = latest_prior_date(spark, table.folder, load_date)
    if prior is None:
        lay_out(day, table, load_date)
        return False
    existing, name = _opened(spark, table, prior)
    if name and all(column_type(existing.schema, k) == column_type(day.schema, k) for k in table.key):
        bounds = spark.read.parquet(join_path(table.folder, "_bounds", name))
        number = bounds.count()
        if _fits(existing, day, bounds, number, read_note(spark, table.folder, prior)["rows"], table):
            _store(merge_ranges(existing, day, bounds, number, table), table, load_date, number, name)
            return True
    old, new = reconciled(existing.drop(LABEL), day)
    lay_out(append(old, new), table, load_date)
    return False
