"""What the text operators share: words, their hashes, hashes of word windows, and rows in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from siltgate.operators.keys import BROADCAST_BYTES
from siltgate.sources.storage import join_path, scratch_folder

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def columns(docs: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to the given types, so that no other column of `docs` can clash with ours."""
    return docs.select(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()])


def encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all bits (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def factors(seed: int, n: int) -> np.ndarray:
    """Odd 64-bit numbers, the first `n` of the series of `seed`."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) | np.uint64(1)


_BYTE_VALUES = factors(1, 256)
_PLACE_FACTORS = factors(2, 256)


def word_hashes(data: bytes, *, lower: bool = False) -> np.ndarray:
    r"""A 64-bit hash of each word `[^\x20\x09-\x0D]+` of UTF-8 text, all words at once.

    A word's hash is the mixed sum of a value for each byte times a factor for its place in the word. `lower` takes
    `A-Z` as `a-z`.
    """
    codes = np.frombuffer(data, np.uint8)
    inside = np.empty(len(codes) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACES[codes], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    codes = codes[inside[1:-1]]
    firsts = np.cumsum(lengths) - lengths
    places = np.arange(len(codes)) - np.repeat(firsts, lengths)
    longest = int(lengths.max())
    table = _PLACE_FACTORS if longest <= len(_PLACE_FACTORS) else factors(2, longest)
    values = (_BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES)[codes] * table[places]
    return mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int, seed: int = 3) -> np.ndarray:
    """A 64-bit hash of every `size` consecutive words; the empty array if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for offset, factor in enumerate(factors(seed, size)):
        total += hashes[offset : offset + n] * factor
    return mixed(total)


def shingle_hashes(data: bytes, size: int = 5, *, lower: bool = True) -> np.ndarray:
    """Sorted distinct hashes of the `size`-word shingles; with fewer words, the whole sequence is the only one."""
    hashes = word_hashes(data, lower=lower)
    if 0 < len(hashes) < size:
        return window_hashes(hashes, len(hashes), seed=3 + len(hashes))
    return np.unique(window_hashes(hashes, size))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def record_batch(kind: pa.Schema, made: dict[str, Any]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in kind], schema=kind)


def giving_back(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run`, and what its task has freed goes back to the system: Python workers live on and would keep it."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
            trim(0)

    return whole


def per_batch(frame: DataFrame, schema: str, prepare: Callable[[], Callable[..., Any]]) -> DataFrame:
    """`frame` batch by batch through Python, without a shuffle.

    `prepare` runs once per task and returns the function that takes the columns of a batch as lists, in order, and
    returns columns by name, or an iterable of such.
    """

    kind = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            if batch.num_rows:
                made = work(*[column.to_pylist() for column in batch.columns])
                for part in [made] if isinstance(made, dict) else made:
                    yield record_batch(kind, part)

    return frame.mapInArrow(giving_back(run), schema)


def without(docs: DataFrame, rejected: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, but those whose id and text are in `rejected` (doc_id, mark), a stored table."""
    return _by_mark(docs, rejected, text, "left_anti")


def among(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose id and text are in `wanted` (doc_id, mark), a stored table."""
    return _by_mark(docs, wanted, text, "left_semi")


def _by_mark(docs: DataFrame, marked: DataFrame, text: str, how: str) -> DataFrame:
    few = marked.count() * 64 <= BROADCAST_BYTES
    listed = marked.select(F.col("doc_id").alias("_marked_id"), F.col("mark").alias("_mark"))
    same = docs["doc_id"].eqNullSafe(listed["_marked_id"]) & (F.xxhash64(docs[text]) == listed["_mark"])
    return docs.join(F.broadcast(listed) if few else listed, same, how)


def sized(frame: DataFrame, rows: int, bytes_each: int) -> DataFrame:
    """`frame` as the small side of a join: broadcast only if its counted rows of at most that size stay in the bound."""
    return F.broadcast(frame) if rows * bytes_each <= BROADCAST_BYTES else frame


# Parts of a whole in which samples are drawn; fine enough for a few thousand of any number of rows.
SHARES = 10**12


def drawn(share: Column, *by: str | Column) -> Column:
    """Whether a row is in a sample of this share, by the hash of the given columns."""
    return F.pmod(F.xxhash64(*by), F.lit(SHARES)) < share * SHARES


class Scratch:
    """Intermediate tables as Parquet below the session's shared checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, scratch_folder(spark), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        """Write and read again: cuts the lineage, and survives lost executors."""
        self.tables += 1
        path = join_path(self.folder, f"table-{self.tables}")
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
