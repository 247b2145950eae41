"""The good/bad split: one predicate, evaluated row by row, decides the side, so no shuffle is needed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltgate.functions.dates import load_stamp
from siltgate.functions.rules import (
    CORRUPT_COLUMN,
    ORIGIN,
    Rule,
    SpecialChar,
    named_checks,
    reject_reasons,
    rejected,
    special_chars,
)

REASONS = "reject_reasons"
REJECTED = "_rejected"


def split(df: DataFrame, rules: Sequence[Rule], load_ts: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with the load stamp, and rejected rows with their reasons. Together they are all of `df`."""
    bad = rejected(rules, df.schema)
    good_rows = load_stamp(df.filter(~bad).drop(CORRUPT_COLUMN, ORIGIN), load_ts)
    return good_rows, df.filter(bad).withColumn(REASONS, reject_reasons(rules, df.schema))


def special_char_split(
    df: DataFrame, columns: Sequence[str], load_ts: datetime | Column
) -> tuple[DataFrame, DataFrame]:
    """As `split` for special characters alone; rejected rows carry the characters in `special_char`."""
    bad = rejected([SpecialChar(tuple(columns))], df.schema)
    return load_stamp(df.filter(~bad), load_ts), df.filter(bad).withColumn("special_char", special_chars(columns))


@dataclass(frozen=True)
class SplitCounts:
    """Rows on both sides, and how many rows each check rejected; a row that breaks several counts for each."""

    good_rows: int
    bad_rows: int
    by_reason: dict[str, int]


def stage_split(df: DataFrame, rules: Sequence[Rule], path: str) -> SplitCounts:
    """Judge every row once and keep the outcome as a parquet table with one folder per side.

    A feed whose rows are needed several times (quarantine, merge keys, merge) is then parsed from text only once.
    What is counted is observed during this one write; no job reads the rows again for it.
    """
    bad, checks, seen = rejected(rules, df.schema), named_checks(rules, df.schema), Observation()
    # Checks see the columns of the feed, so they are counted before any is added.
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("bad"),
        *[F.count_if(check).alias(f"by_{i}") for i, (_, check) in enumerate(checks)],
    )
    (
        counted.withColumns({REJECTED: bad, REASONS: F.when(bad, reject_reasons(rules, df.schema))})
        .write.partitionBy(REJECTED)
        .parquet(path)
    )
    held = observed(seen)
    by_reason = {name: held.get(f"by_{i}", 0) for i, (name, _) in enumerate(checks)}
    return SplitCounts(held.get("rows", 0) - held.get("bad", 0), held.get("bad", 0), by_reason)


def observed(seen: Observation) -> dict:
    """What was observed; nothing where the optimizer found that there are no rows and left the observation out."""
    return seen.get or {}


def reason_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(reason, rows) for every check, from one pass; a check that no row breaks has 0."""
    checks = named_checks(rules, df.schema)
    sums = df.agg(F.array(*[F.struct(F.lit(n).alias("reason"), F.count_if(c).alias("rows")) for n, c in checks]).alias("all"))
    return sums.select(F.explode("all").alias("one")).select("one.*")


@dataclass(frozen=True)
class Stage:
    """A staged split: both sides."""

    good: DataFrame
    bad: DataFrame


def read_stage(spark: SparkSession, path: str, schema: StructType, load_ts: datetime | Column) -> Stage:
    """Both sides of a staged split; `schema` is that of the judged rows."""
    verdict = StructType.fromDDL(f"{REASONS} array<string>, {REJECTED} boolean")
    staged = spark.read.schema(StructType(schema.fields + verdict.fields)).parquet(path)
    good = staged.filter(~F.col(REJECTED)).drop(REJECTED, REASONS, CORRUPT_COLUMN, ORIGIN)
    return Stage(load_stamp(good, load_ts), staged.filter(F.col(REJECTED)).drop(REJECTED))


def split_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with the numbers of accepted and rejected rows, from a single pass."""
    bad = rejected(rules, df.schema)
    bad_rows = F.count_if(bad)
    return df.agg((F.count(F.lit(1)) - bad_rows).alias("good_rows"), bad_rows.alias("bad_rows"))
