"""List ranking: places and prefix sums along a linked list that no task holds as a whole."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, sized

SUMS = ("place", "leaves", "saved")
# An item, the head of the chain it has become part of, what lies before it there, and on the last item of a chain
# the chain's successor and sums.
_LINKED = (
    "a long, b long, head_a long, head_b long, place long, leaves long, saved long, tail boolean,"
    " next_a long, next_b long, all_place long, all_leaves long, all_saved long"
)
_NAMES = [column.split()[0] for column in _LINKED.split(", ")]


@dataclass(frozen=True)
class Chunks:
    """Items that one task ranks at most, about, and at least where there are more; the share of items that a round
    by chunks has to save, or else one by pairs follows."""

    most: int = 1 << 20
    least: int = 1 << 14
    saving: float = 0.25


def chained(a: np.ndarray, b: np.ndarray, next_a: np.ndarray, next_b: np.ndarray, ends: np.ndarray, weights: np.ndarray):
    """Of the items of one chunk: which is the head of each one's chain in it, the weights before it, which are last.

    Items are pairs (a, b), `b` not negative; `ends` marks those without a successor. By pointer jumping: each round
    doubles the way that each item has looked back.
    """
    n = len(a)
    names, where = np.unique(a, return_inverse=True)
    width = int(max(b.max(), next_b.max())) + 1
    codes = where * width + b
    order = np.argsort(codes)
    at = np.minimum(np.searchsorted(names, next_a), len(names) - 1)
    wanted = at * width + next_b
    place = np.minimum(np.searchsorted(codes, wanted, sorter=order), n - 1)
    after = order[place]
    inside = ~ends & (names[at] == next_a) & (codes[after] == wanted)
    back, before = np.arange(n), np.zeros_like(weights)
    back[after[inside]] = np.flatnonzero(inside)
    before[:, after[inside]] = weights[:, inside]
    while True:
        further = back[back]
        if np.array_equal(further, back):
            return back, before, ~inside
        before += before[:, back]
        back = further


def _by_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    a, b = (table[name].to_numpy() for name in ("a", "b"))
    ends = table["next_a"].is_null().to_numpy()
    next_a, next_b = (table[name].fill_null(0).to_numpy() for name in ("next_a", "next_b"))
    weights = np.stack([table[name].to_numpy() for name in SUMS])
    head, before, tail = chained(a, b, next_a, next_b, ends, weights)
    columns = [a, b, a[head], b[head], *before]
    out = [pa.array(c) for c in columns] + [pa.array(tail)]
    out += [pa.array(c, mask=ends | ~tail) for c in (next_a, next_b)]
    out += [pa.array(c, mask=~tail) for c in before + weights]
    yield pa.RecordBatch.from_arrays(out, names=_NAMES)


def _in_chunks(items: DataFrame, n: int, chunks: Chunks) -> DataFrame:
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-n // chunks.most), min(tasks, -(-n // chunks.least)))
    dealt = items.coalesce(1) if parts == 1 else items.repartitionByRange(parts, "a", "b")
    return dealt.mapInArrow(_by_chunk, _LINKED)


def _in_pairs(items: DataFrame, turn: int, scratch: Scratch) -> DataFrame:
    """Items that drew 0 take in a successor that drew 1: about a quarter of all, wherever they lie."""
    drawn = scratch.keep(items.withColumn("coin", F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(2))))
    taken = drawn.where("coin = 1").alias("j")
    # The two conditions on the coin keep the others out of the shuffle.
    both = drawn.where("coin = 0").alias("i").join(
        taken, F.expr("i.next_a = j.a and i.next_b = j.b"), "inner"
    )
    made = scratch.keep(
        both.selectExpr(
            "i.a", "i.b", "j.a as j_a", "j.b as j_b", "j.next_a", "j.next_b",
            *[f"i.{s} as {s}" for s in SUMS], *[f"i.{s} + j.{s} as all_{s}" for s in SUMS],
        )
    )
    sums, totals = ", ".join(f"{s}" for s in SUMS), ", ".join(f"all_{s}" for s in SUMS)
    none = ", ".join(f"cast(0 as long) as {s}" for s in SUMS)
    givers = made.selectExpr(
        *_parts(f"a, b, a as head_a, b as head_b, {none}, true as tail, next_a, next_b, {totals}")
    )
    nothing = ", ".join(f"cast(null as long) as {c}" for c in ("next_a", "next_b", *[f"all_{s}" for s in SUMS]))
    inner = made.selectExpr(*_parts(f"j_a as a, j_b as b, a as head_a, b as head_b, {sums}, false as tail, {nothing}"))
    moved = givers.select("a", "b").union(inner.select("a", "b"))
    same = ", ".join(f"{s} as all_{s}" for s in SUMS)
    rest = drawn.join(moved, ["a", "b"], "left_anti").selectExpr(
        *_parts(f"a, b, a as head_a, b as head_b, {none}, true as tail, next_a, next_b, {same}")
    )
    return givers.unionByName(inner).unionByName(rest)


def _parts(text: str) -> list[str]:
    return [p.strip() for p in text.split(", ")]


def list_ranks(items: DataFrame, scratch: Scratch, chunks: Chunks = Chunks()) -> DataFrame:
    """For each item (a, b) of one linked list the sums of `SUMS` over all items before it.

    `items` has a, b, next_a, next_b (NULL at the end) and the weights. The list is contracted until one item is left.
    A round by chunks joins, within each range of (a, b), whatever follows one another there into a single item; where
    ids lie close to one another along the list that leaves few. If it saves too little, a round by pairs follows,
    which takes about a quarter out of any list. On the way back each item adds its head's sums to its own. All rounds
    are stored; a chunk's memory is bounded by `chunks`. A list that runs in a circle never ends, so it must not.
    """
    levels, n, turn = [], items.count(), 0
    while n > 1 or not levels:
        level = scratch.keep(_in_chunks(items, n, chunks))
        levels.append(level)
        items, before = _heads(level), n
        n = items.count()
        if n > 1 and n > (1 - chunks.saving) * before:
            level = scratch.keep(_in_pairs(items, turn := turn + 1, scratch))
            levels.append(level)
            items = _heads(level)
            n = items.count()
    ranks = None
    for level in reversed(levels):
        own = level.select("a", "b", "head_a", "head_b", *SUMS)
        if ranks is None:
            ranks = own.select("a", "b", *SUMS)
            continue
        heads = ranks.select(F.col("a").alias("head_a"), F.col("b").alias("head_b"), *[F.col(s).alias(f"_{s}") for s in SUMS])
        joined = own.join(sized(heads, heads.count(), 100), ["head_a", "head_b"])
        ranks = scratch.keep(joined.select("a", "b", *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in SUMS]))
    return ranks


def _heads(level: DataFrame) -> DataFrame:
    return level.where("tail").select(
        F.col("head_a").alias("a"), F.col("head_b").alias("b"), "next_a", "next_b",
        *[F.col(f"all_{s}").alias(s) for s in SUMS],
    )
