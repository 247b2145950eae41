"""Dated parquet snapshots: one folder `load_date=<yyyyMMdd>` per load below the base folder of a source.

A snapshot is written straight into its own folder and counts only once Spark has left its `_SUCCESS` marker there,
so a load that died half-way is never mistaken for the latest one. No other snapshot is touched by a write, which
makes reruns of a day safe.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import AbstractContextManager, nullcontext
from typing import Any, Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltgate.sources.storage import (
    WITH_MARKER,
    exists,
    for_each,
    is_complete,
    join_path,
    mode_for,
    read_note_text,
    remove,
    replace_folder,
    restore_parked,
    settings,
    subfolders,
    write_note,
)

DATE_COLUMN = "load_date"
UNIQUE_ON = "unique_on"
BUCKETS = "buckets"
BUCKET_KEY = "bucket_key"
NOTE = "_siltgate_note.json"


def snapshot_path(base: str, load_date: int) -> str:
    return join_path(base, f"{DATE_COLUMN}={load_date}")


def write_snapshot(
    df: DataFrame,
    base: str,
    load_date: int,
    *,
    mode: Literal["overwrite", "errorifexists"] = "overwrite",
    unique_on: Sequence[str] = (),
    buckets: int = 0,
    bucket_key: Sequence[str] = (),
    sort_buckets: Sequence[str] = (),
    newest: Any = None,
    max_records_per_file: int = 0,
    file_bytes: int = 0,
) -> str:
    """Write one snapshot; `errorifexists` refuses to replace a date. Returns its folder.

    Files follow the partitions of `df`, so the write adds no shuffle and no single-task funnel. With `file_bytes` the
    rows are dealt out anew, and adaptive execution cuts and joins them, by their sizes in the shuffle, to files of
    about that size however `df` is skewed. `unique_on` notes a
    key known to be unique in the schema, where parquet keeps it together with the rows. With `buckets` the rows are
    also laid out in that many files by hash of `bucket_key`, by default the unique key; `df` should be partitioned
    alike, as each of its tasks writes one file per bucket it holds, in order of `sort_buckets`. A snapshot that replaces another is written beside
    it and takes its place when complete, so a run that fails leaves the old one. Bucketed writes and reads need a current database in which the session
    may create and drop a table. The number of rows, observed while they are written, and the `newest` stamp, if given,
    are noted in a small file of the folder, and so are the types of the columns.
    """
    bucket_key = bucket_key or unique_on
    spark, path = df.sparkSession, snapshot_path(base, load_date)
    restore_parked(spark, base)
    mode = mode_for(spark, path, mode)
    noted, seen = _note_key(df.drop(DATE_COLUMN), unique_on, buckets, bucket_key), Observation()
    dealt = noted.hint("rebalance") if file_bytes and not buckets else noted
    writer = (
        dealt.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.format("parquet")
        .mode(mode)
        .options(maxRecordsPerFile=max_records_per_file, **WITH_MARKER)
    )
    beside = join_path(base, f"_{uuid.uuid4().hex}")
    with _sizing(spark, file_bytes):
        if not buckets and mode == "overwrite" and is_complete(spark, path):
            try:
                writer.save(beside)
                replace_folder(spark, beside, path)
            finally:
                remove(spark, beside)
        elif not buckets:
            writer.save(path)
        else:
            if exists(spark, path) and mode == "errorifexists":
                raise FileExistsError(path)
            name = _table_name()
            try:
                bucketed = writer.bucketBy(buckets, *bucket_key)
                bucketed = bucketed.sortBy(*sort_buckets) if sort_buckets else bucketed
                bucketed.option("path", beside).saveAsTable(name)
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            replace_folder(spark, beside, path)
    rows = (seen.get or {}).get("rows", 0)
    types = {f.name: f.dataType.simpleString() for f in df.drop(DATE_COLUMN).schema.fields}
    write_note(spark, join_path(path, NOTE), json.dumps({"rows": rows, "newest": newest, "types": types}))
    return path


def _sizing(spark: SparkSession, file_bytes: int) -> AbstractContextManager:
    """Adaptive execution goes by size alone, and has pieces small enough to make files of that size from."""
    if not file_bytes:
        return nullcontext()
    pieces = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return settings(
        spark,
        spark_sql_adaptive_enabled="true",
        spark_sql_adaptive_advisoryPartitionSizeInBytes=str(file_bytes),
        spark_sql_adaptive_coalescePartitions_enabled="true",
        spark_sql_adaptive_coalescePartitions_parallelismFirst="false",
        spark_sql_adaptive_coalescePartitions_initialPartitionNum=str(pieces),
    )


def read_note(spark: SparkSession, base: str, load_date: int) -> dict:
    """`rows`, `newest` and `types` of a snapshot, empty if it was written without a note."""
    text = read_note_text(spark, join_path(snapshot_path(base, load_date), NOTE))
    return json.loads(text) if text else {}


def read_notes(spark: SparkSession, base: str, dates: Sequence[int]) -> list[dict]:
    """The notes of several snapshots, in the order of the dates."""
    return for_each(lambda date: read_note(spark, base, date), dates)


def _note_key(df: DataFrame, unique_on: Sequence[str], buckets: int, bucket_key: Sequence[str]) -> DataFrame:
    note = {UNIQUE_ON: list(unique_on), BUCKETS: buckets, BUCKET_KEY: list(bucket_key) if buckets else []}
    first = next(iter(unique_on or bucket_key), None)
    for field in df.schema.fields:
        noted = first is not None and field.name.lower() == first.lower()
        if noted or UNIQUE_ON in field.metadata:
            kept = {k: v for k, v in field.metadata.items() if k not in note}
            df = df.withMetadata(field.name, {**kept, **note} if noted else kept)
    return df


def _note_of(snapshot: DataFrame) -> dict:
    return next((f.metadata for f in snapshot.schema.fields if UNIQUE_ON in f.metadata), {})


def is_unique_on(snapshot: DataFrame, key: Sequence[str]) -> bool:
    """Whether a snapshot was written as unique on `key`. Meant for a frame as read, not for one derived from it."""
    return [k.lower() for k in _note_of(snapshot).get(UNIQUE_ON, [])] == [k.lower() for k in key]


def bucket_count(snapshot: DataFrame) -> int:
    """In how many buckets a snapshot was written, 0 if in none."""
    return _note_of(snapshot).get(BUCKETS, 0)


def is_bucketed_by(snapshot: DataFrame, key: Sequence[str], buckets: int) -> bool:
    """Whether a snapshot was written in that many buckets by hash of `key`."""
    note = _note_of(snapshot)
    return note.get(BUCKETS, 0) == buckets and [k.lower() for k in note.get(BUCKET_KEY, [])] == [k.lower() for k in key]


def _table_name() -> str:
    return f"siltgate_{uuid.uuid4().hex}"


def read_bucketed(spark: SparkSession, base: str, load_date: int) -> DataFrame:
    """A bucketed snapshot such that Spark knows its layout.

    Spark takes the layout from its catalog only, so the folder is entered there, as an external table, for as long
    as it takes to open it.
    """
    path = snapshot_path(base, load_date)
    plain = spark.read.parquet(path)
    note = _note_of(plain)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    key = ", ".join(f"`{k}`" for k in note.get(BUCKET_KEY) or note[UNIQUE_ON])
    name, location = _table_name(), path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet"
        f" CLUSTERED BY ({key}) INTO {note[BUCKETS]} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _dates_below(spark: SparkSession, base: str) -> list[int]:
    prefix = f"{DATE_COLUMN}="
    return sorted(int(n.removeprefix(prefix)) for n in subfolders(spark, base) if n.startswith(prefix))


def snapshot_dates(spark: SparkSession, base: str) -> list[int]:
    """Dates of the complete snapshots, ascending. Lists folder names only; no data file is opened."""
    dates = _dates_below(spark, base)
    complete = for_each(lambda d: is_complete(spark, snapshot_path(base, d)), dates)
    return [d for d, there in zip(dates, complete, strict=True) if there]


def latest_prior_date(spark: SparkSession, base: str, run_date: int) -> int | None:
    """Latest complete snapshot before the run date, or None for a first load. Missing days are skipped."""
    earlier = [d for d in _dates_below(spark, base) if d < run_date]
    return next((d for d in reversed(earlier) if is_complete(spark, snapshot_path(base, d))), None)


def read_snapshot(spark: SparkSession, base: str, load_date: int) -> DataFrame:
    """One snapshot, read from its own folder, so that the file listing does not grow with the history."""
    return spark.read.parquet(snapshot_path(base, load_date))


def read_history(
    spark: SparkSession, base: str, as_of: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """All complete snapshots, up to `as_of` if given, with `load_date` as a partition column to prune on.

    Under a `schema` columns that older snapshots lack are NULL there, and a snapshot that stores another type under
    a declared name is refused; without one Spark takes the columns of one of the snapshots. Types are compared by the
    days' notes, many at a time; no data file is opened but those of days without a note.
    """
    dates = [d for d in snapshot_dates(spark, base) if as_of is None or d <= as_of]
    if not dates:
        raise FileNotFoundError(f"no complete snapshot below {base}")
    reader = spark.read.option("basePath", base)
    if schema is not None:
        wanted = {f.name.lower(): f.dataType.simpleString() for f in schema.fields}
        for date, note in zip(dates, read_notes(spark, base, dates), strict=True):
            types = note.get("types")
            if types is None:
                types = {f.name: f.dataType.simpleString() for f in read_snapshot(spark, base, date).schema.fields}
            for name, kind in types.items():
                if wanted.get(name.lower(), kind) != kind:
                    raise TypeError(f"{date}: {name} is {kind} in {base}")
        reader = reader.schema(StructType([*schema.fields]).add(DATE_COLUMN, "integer"))
    return reader.parquet(*[snapshot_path(base, d) for d in dates])


def count_rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
