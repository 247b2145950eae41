"""The daily load of one source: scan, judge, quarantine, merge, publish."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from siltgate.functions.dates import load_stamp
from siltgate.functions.rules import ORIGIN, column_type, scrub
from siltgate.operators.columns import reconciled
from siltgate.operators.keys import BROADCAST_BYTES
from siltgate.operators.latest import latest_per_key
from siltgate.operators.merge import append, scd1, scd1_bucketed
from siltgate.operators.split import read_stage, stage_split
from siltgate.plans.contracts import Contract
from siltgate.sources.feed import scan_csv
from siltgate.sources.quarantine import write_quarantine
from siltgate.sources.snapshot import (
    DATE_COLUMN,
    count_rows,
    is_bucketed_by,
    is_unique_on,
    latest_prior_date,
    read_bucketed,
    read_history,
    read_note,
    read_notes,
    read_snapshot,
    snapshot_dates,
    write_snapshot,
)
from siltgate.sources.storage import join_path, remove, scratch_folder


@dataclass(frozen=True)
class Layout:
    """Where feeds come from and results go to; any file system Spark can reach."""

    input_base: str
    snapshot_base: str
    quarantine_base: str
    layer: str = "Bronze"

    def feed(self, source: str, run_date: int) -> str:
        return join_path(self.input_base, source, run_date)

    def snapshots(self, source: str) -> str:
        return join_path(self.snapshot_base, self.layer, source)

    def quarantine(self, source: str, run_date: int) -> str:
        return join_path(self.quarantine_base, self.layer, source, f"{run_date}_bad_data")


@dataclass(frozen=True)
class LoadReport:
    """Row counts of one load, observed in the jobs that wrote its rows; `by_reason` counts a row for each check it broke."""

    source: str
    run_date: int
    prior_date: int | None
    good_rows: int
    bad_rows: int
    total_rows: int
    snapshot: str
    by_reason: dict[str, int] = field(default_factory=dict)


def scan_feed(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """The rows of a feed under its contract, placeholders scrubbed where the contract says so."""
    rows = scan_csv(
        spark,
        path,
        contract.schema,
        header=contract.header,
        keep_corrupt=contract.keep_corrupt,
        flags=contract.flags,
        origin=contract.origin,
    )
    if contract.key_type:
        rows = rows.withColumns({k: F.col(k).try_cast(contract.key_type) for k in contract.key})
    return scrub(rows, contract.check_columns, contract.scrub_values) if contract.quality == "scrub" else rows


def merge_day(
    spark: SparkSession,
    contract: Contract,
    base: str,
    prior_date: int | None,
    good: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """What the snapshot of the day holds, given the previous one."""
    if prior_date is None or contract.merge_mode != "scd1":
        return good
    existing = read_snapshot(spark, base, prior_date)
    unique = is_unique_on(existing, contract.key)
    newest = _noted_newest(read_note(spark, base, prior_date).get("newest"))
    laid_out = None
    if contract.buckets and is_bucketed_by(existing, contract.key, contract.buckets) and _same_key(existing, good, contract):
        laid_out = read_bucketed(spark, base, prior_date)
        laid_out, good = reconciled(laid_out, good)
    else:
        existing, good = reconciled(existing, good)
    if laid_out is not None:
        if unique:
            return scd1_bucketed(
                laid_out, good, contract.key, contract.buckets, tie_break=contract.tie_break, newest_old=newest
            )
        # A first load may repeat keys. Its buckets spare the snapshot the shuffle all the same.
        both = append(laid_out, good.repartition(contract.buckets, *contract.key))
        return latest_per_key(both, contract.key, tie_break=contract.tie_break)
    merged = scd1(
        existing,
        good,
        contract.key,
        tie_break=contract.tie_break,
        existing_unique=unique,
        broadcast_bytes=broadcast_bytes,
        newest_old=newest,
    )
    return merged.repartition(contract.buckets, *contract.key) if contract.buckets else merged


def _same_key(existing: DataFrame, good: DataFrame, contract: Contract) -> bool:
    """Whether the key has the snapshot's types; hashes of a wider type would not fit its buckets."""
    return all(column_type(existing.schema, k) == column_type(good.schema, k) for k in contract.key)


def _noted_newest(noted: int | str | None) -> int | datetime | None:
    return datetime.fromisoformat(noted) if isinstance(noted, str) else noted


def _newest(spark: SparkSession, load_ts: datetime | Column, noted: int | str | None) -> int | str:
    """The newest stamp after a load in the form of the note: a day's rows all carry its one stamp."""
    stamped = load_stamp(spark.range(1), load_ts)
    if isinstance(stamped.schema["time_stamp"].dataType, TimestampType):
        own = stamped.select(F.unix_micros("time_stamp")).first()[0]
    else:
        own = stamped.select(F.date_format("time_stamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()[0]
    return own if noted is None else max(own, noted)


def run_load(
    spark: SparkSession,
    contract: Contract,
    layout: Layout,
    run_date: int,
    load_ts: datetime | Column,
    *,
    input_path: str | None = None,
    snapshot_mode: Literal["overwrite", "errorifexists"] = "overwrite",
    sort_by_key: bool = False,
    max_records_per_file: int = 0,
    file_bytes: int = 0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> LoadReport:
    """Load the feed of `run_date`. A rerun replaces the snapshot of that date and no other.

    Every snapshot is kept. `file_bytes` brings its files to about that size. `sort_by_key` also orders the snapshot by key as a whole, at the price of moving it and
    of any bucketing.
    """
    source, base = contract.source, layout.snapshots(contract.source)
    rows = scan_feed(spark, contract, input_path or layout.feed(source, run_date))
    prior_date = latest_prior_date(spark, base, run_date)

    # The text is parsed once. Only a load that uses its rows once as well does without the stage.
    stage = scratch_folder(spark) if contract.rules or contract.merge_mode == "scd1" else None
    try:
        if stage:
            judged = join_path(stage, "judged")
            counts = stage_split(rows, contract.rules, judged)
            staged = read_stage(spark, judged, rows.schema, load_ts)
            good, good_rows, bad_rows, by_reason = staged.good, counts.good_rows, counts.bad_rows, counts.by_reason
            if contract.rules:
                write_quarantine(
                    staged.bad,
                    layout.quarantine(source, run_date),
                    header=contract.quarantine_header,
                    # A load that replaces its snapshot replaces what it rejected, too.
                    mode="overwrite" if snapshot_mode == "overwrite" else contract.quarantine_mode,
                )
        else:
            good, good_rows, bad_rows, by_reason = load_stamp(rows.drop(ORIGIN), load_ts), None, 0, {}

        merged = merge_day(spark, contract, base, prior_date, good, broadcast_bytes)
        if sort_by_key and contract.key:
            # The columns beside the key let range partitioning cut through a key that a first load holds often.
            others = [c for c in merged.columns if c.lower() not in {k.lower() for k in contract.key}]
            merged = merged.sort(*[F.asc_nulls_first(c) for c in [*contract.key, *others]])
        # A first load keeps repeated keys, so its snapshot is not yet unique.
        unique = contract.key if contract.merge_mode == "scd1" and prior_date is not None else ()
        buckets = 0 if sort_by_key else contract.buckets
        if buckets and not unique:
            merged = merged.repartition(buckets, *contract.key)
        noted = read_note(spark, base, prior_date).get("newest") if unique else None
        unknown = bool(unique) and noted is None
        path = write_snapshot(
            merged,
            base,
            run_date,
            mode=snapshot_mode,
            unique_on=unique,
            buckets=buckets,
            bucket_key=contract.key,
            newest=None if unknown else _newest(spark, load_ts, noted),
            max_records_per_file=max_records_per_file,
            file_bytes=0 if sort_by_key else file_bytes,
        )
    finally:
        if stage:
            remove(spark, stage)

    written = _rows(spark, base, run_date)
    dates = [d for d in snapshot_dates(spark, base) if d <= run_date] if contract.merge_mode == "append" else []
    total = _total(spark, base, dates) if dates else written
    return LoadReport(
        source, run_date, prior_date, written if good_rows is None else good_rows, bad_rows, total, path, by_reason
    )


def _total(spark: SparkSession, base: str, dates: list[int]) -> int:
    noted = [n.get("rows") for n in read_notes(spark, base, dates)]
    return sum(_rows(spark, base, d) if n is None else n for d, n in zip(dates, noted, strict=True))


def _rows(spark: SparkSession, base: str, date: int) -> int:
    noted = read_note(spark, base, date).get("rows")
    return count_rows(read_snapshot(spark, base, date)) if noted is None else noted


def read_loaded(spark: SparkSession, contract: Contract, layout: Layout, as_of: int) -> DataFrame:
    """The table of a source as it stood after the load of `as_of`, or the latest one before it."""
    base = layout.snapshots(contract.source)
    if contract.merge_mode == "append":
        schema = _stored_schema(spark, contract, base, as_of)
        return read_history(spark, base, as_of, schema).drop(DATE_COLUMN)
    latest = latest_prior_date(spark, base, as_of + 1)
    if latest is None:
        raise FileNotFoundError(f"no complete snapshot below {base} up to {as_of}")
    return read_snapshot(spark, base, latest)


def _stored_schema(spark: SparkSession, contract: Contract, base: str, as_of: int) -> StructType:
    """The contract's columns and the stamp, whose type is that of the newest day."""
    dates = [d for d in snapshot_dates(spark, base) if d <= as_of]
    if not dates:
        raise FileNotFoundError(f"no complete snapshot below {base} up to {as_of}")
    declared = StructType.fromDDL(contract.schema)
    return StructType([*declared.fields, read_snapshot(spark, base, dates[-1]).schema["time_stamp"]])
