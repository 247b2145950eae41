"""Distinct keys of a table as the small side of a join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
# Assumed cost of one key in a hash table, beside the bytes of its text form.
KEY_OVERHEAD_BYTES = 100


def key_bytes(key: Sequence[str]) -> Column:
    """Generous size of one key in memory."""
    texts = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in key]
    return reduce(lambda a, b: a + b, texts, F.lit(KEY_OVERHEAD_BYTES)).cast("long")


def renamed_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key of `df` in columns `_key0`, `_key1`, …"""
    return df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)])


def key_table(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys of `df` once each."""
    return renamed_key(df, key).distinct()


def same_key(df: DataFrame, key: Sequence[str], *, null_safe: bool = False) -> Column:
    """Join condition between the key of `df` and the columns of `renamed_key`."""
    pairs = [(df[k], F.col(f"_key{i}")) for i, k in enumerate(key)]
    return reduce(lambda a, b: a & b, [old.eqNullSafe(new) if null_safe else old == new for old, new in pairs])
