"""Near-duplicate documents by circulant MinHash, with every link confirmed on the full shingle sets."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.graph import components
from siltgate.llm.text import Scratch, columns, encoded, mixed, per_batch, shingle_hashes, sized
from siltgate.operators.keys import BROADCAST_BYTES

# Bits of the similarity sketch that is compared before sets are.
SKETCH_BITS = 4096
# Rows of a component from which on it is joined by broadcast; there is at most one such for as many rows of the input.
LARGE = 1000


@dataclass(frozen=True)
class Near:
    """`similarity` in percent. At 85 a linked pair shares none of the 36 bands of 7 with probability 1e-6.

    `slack` is how far below `similarity` the sketch of a pair may be for the pair to be confirmed on full sets: five
    standard deviations of the sketch, so one pair in millions is missed by it.
    """

    similarity: int = 85
    bands: int = 36
    rows: int = 7
    shingle: int = 5
    universe_bits: int = 22
    slack: float = 0.045


class Circulant:
    """MinHash signatures from two permutations of 2**bits numbers, after C-MinHash (Li and Li, 2022).

    The first permutation spreads the shingles, here by a mixing bijection of their 64-bit hashes of which the high
    bits are kept; the second is a table. Coordinate k of a signature is the least entry of the table shifted
    circularly by k, over the shingles' places; the shifts of one place lie side by side in the table, so a shingle's
    share of the signature is one contiguous slice.
    """

    def __init__(self, size: int, bits: int):
        table = np.random.default_rng(20_22).permutation(1 << bits).astype(np.uint32)
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[: size - 1]]), size)
        self.size, self.drop = size, np.uint64(64 - bits)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = mixed(shingles + np.uint64(0x5851F42D)) >> self.drop
        step = max(1, (1 << 20) // self.size)
        parts = [self.shifted[places[i : i + step]].min(axis=0) for i in range(0, len(places), step)]
        return reduce(np.minimum, parts)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signatures(near: Near):
    circulant = Circulant(near.bands * near.rows, near.universe_bits)
    numbers = np.arange(near.bands, dtype=np.uint64)

    def work(ids: list, marks: list, texts: list) -> dict[str, list]:
        sizes, prints, bands = [], [], []
        for text in texts:
            shingles = shingle_hashes(encoded(text), near.shingle)
            sizes.append(len(shingles))
            prints.append(_fingerprint(shingles) if len(shingles) else None)
            if not len(shingles):
                bands.append([])
                continue
            rows = circulant.signature(shingles).reshape(near.bands, near.rows).astype(np.uint64)
            keys = numbers
            for place in range(near.rows):
                keys = mixed(keys + rows[:, place] + np.uint64(1))
            bands.append(keys.view(np.int64))
        return {"doc_id": ids, "mark": marks, "n_shingles": sizes, "print": prints, "bands": bands}

    return work


def _sets(near: Near):
    circulant = Circulant(SKETCH_BITS, near.universe_bits)

    def work(texts: list) -> dict[str, list]:
        sets = [s for text in texts if len(s := shingle_hashes(encoded(text), near.shingle))]
        signs = [(circulant.signature(s) & np.uint32(1)).astype(np.uint8) for s in sets]
        return {
            "print": [_fingerprint(s) for s in sets],
            "n": [len(s) for s in sets],
            "set": [s.tobytes() for s in sets],
            "sketch": [np.packbits(s).view(np.int64) for s in signs],
        }

    return work


def _similar(near: Near):
    def work(a: list, b: list, set_a: list, set_b: list) -> dict[str, list]:
        linked = []
        for one, other in zip(set_a, set_b, strict=True):
            one, other = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            both = len(np.intersect1d(one, other, assume_unique=True))
            linked.append(100 * both >= near.similarity * (len(one) + len(other) - both))
        return {name: [x for x, yes in zip(v, linked, strict=True) if yes] for name, v in (("a", a), ("b", b))}

    return work


def _within(frame: DataFrame, bytes_each: int) -> DataFrame:
    """A stored table, to be broadcast if its counted rows stay within the bound."""
    return F.broadcast(frame) if frame.count() * bytes_each <= BROADCAST_BYTES else frame.hint("merge")


def _class_sets(texts: DataFrame, full: DataFrame, prints: DataFrame, near: Near, scratch: Scratch) -> DataFrame:
    """Set and sketch of each class in `prints`, from the text of one of its documents."""
    prints = scratch.keep(prints)
    wanted = _within(prints, 100)
    one_each = scratch.keep(full.join(wanted, "print", "left_semi").groupBy("print").agg(F.min("doc_id").alias("doc_id")))
    named = texts.join(_within(one_each.select("doc_id"), 60), "doc_id", "left_semi")
    chosen = named.union(texts.where("doc_id is null"))
    made = per_batch(
        chosen.select("text"), "print binary, n int, set binary, sketch array<long>", lambda: _sets(near)
    )
    sets = scratch.keep(made.join(wanted, "print", "left_semi"))
    # More rows than classes: ids that repeat or are NULL.
    return sets if sets.count() == prints.count() else scratch.keep(sets.dropDuplicates(["print"]))


def _confirmed(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    one = sets.select(F.col("print").alias("a"), F.col("set").alias("set_a"))
    other = sets.select(F.col("print").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "set_a", "set_b")
    return per_batch(both, "a binary, b binary", lambda: _similar(near))


def _near_pairs(rows: DataFrame, near: Near) -> DataFrame:
    """Pairs of one bucket but different components that may be similar enough by size and sketch.

    The sketch is compared in growing parts, each with a slack of five standard deviations, so that most pairs are
    done with after a few numbers.
    """
    longs, alike = SKETCH_BITS // 64, near.similarity / 100
    wide = rows.select("*", *[F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(longs)]).drop("sketch")
    conditions = [
        "x.band = y.band and x.component <> y.component and (y.component = y.most or x.print < y.print)",
        f"100 * least(x.n, y.n) >= {near.similarity} * greatest(x.n, y.n)",
    ]
    for part in (8, 24, longs):
        slack = near.slack * (longs / part) ** 0.5
        differing = " + ".join(f"bit_count(x.s{i} ^ y.s{i})" for i in range(part))
        conditions.append(f"{differing} <= {int(64 * part * (1 - alike + slack) / 2)}")
    found = wide.where("component <> most").alias("x").join(wide.alias("y"), F.expr(" and ".join(conditions)))
    return found.select(F.col("x.print").alias("a"), F.col("y.print").alias("b")).distinct()


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """Each row of (doc_id, text) with its shingle count and the component of linked documents it belongs to.

    Documents are linked if `100 * |A and B| >= similarity * |A or B|` holds for their sets of distinct word
    shingles, lower-cased in A-Z. The steps, each on all rows:

    1. Signatures and bands per document; documents with equal sets form one class, of which one goes on.
    2. In a bucket (classes that share a band), the class that shares most buckets with others is the hub; each other
       class is compared with it on full sets. Components of these links follow.
    3. In buckets that still hold several components, all pairs of classes of different components are compared, but
       for those that both belong to the component with most classes there: sizes and 1-bit sketches first, within
       the join, then full sets. So every pair that shares a band is compared or already connected.

    Returns doc_id, mark (xxhash64 of the text), n_shingles, print (of the set; NULL if empty), component_id (the least
    doc_id of the component), kept (doc_id = component_id) and stays (the row of the component of the least doc_id,
    NULL last, and then the least mark, so one text of each component). Repeated rows, and rows that share a `doc_id`, are linked by their own texts and
    each returned. A NULL `doc_id` is never a component's id while another is there; where none is, component_id is
    NULL and the row is kept, but only one text of it stays. NULL and empty texts, and texts of white space, have no shingles and link with nothing.
    Without shingles a row stays. A text of fewer than five words has one shingle, the whole. Long texts are taken whole. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string")
    signed = scratch.keep(
        per_batch(
            texts.select("doc_id", F.xxhash64("text").alias("mark"), "text"),
            "doc_id long, mark long, n_shingles long, print binary, bands array<long>",
            lambda: _signatures(near),
        )
    )
    full = signed.where("print is not null")
    classes = full.groupBy("print").agg(F.first("bands").alias("bands"))
    rows = classes.select("print", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = scratch.keep(rows.join(shared, "band"))

    # The hub of a bucket, by the number of others met in all buckets.
    met = buckets.groupBy("print").agg(F.sum("size").alias("met"))
    hubs = buckets.join(met, "print").groupBy("band").agg(F.max_by("print", F.struct("met", "print")).alias("a"))
    stars = scratch.keep(
        buckets.join(hubs, "band").select("a", F.col("print").alias("b")).where("a <> b").distinct()
    )
    sets = _class_sets(texts, full, buckets.select("print").distinct(), near, scratch)
    links = scratch.keep(_confirmed(stars, sets, near))
    found = components(links, scratch)

    placed = buckets.join(found.withColumnRenamed("id", "print"), "print", "left").select(
        "band", "print", F.coalesce("component", "print").alias("component")
    )
    placed = scratch.keep(placed)
    held = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band")
    several = held.agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("k")).where("k > 1")
    mixed_rows = placed.join(several.drop("k"), "band")
    pairs = _near_pairs(mixed_rows.join(sets.select("print", "n", "sketch"), "print"), near)
    more = scratch.keep(_confirmed(scratch.keep(pairs), sets, near))
    if not more.isEmpty():
        found = components(links.union(more), scratch)

    linked = full.select("doc_id", "mark", "n_shingles", "print").join(found.withColumnRenamed("id", "print"), "print", "left")
    nodes = scratch.keep(linked.withColumn("node", F.coalesce("component", "print")).drop("component"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    least = scratch.keep(
        nodes.groupBy("node").agg(
            F.min("doc_id").alias("component_id"), F.min(place).alias("first"), F.count(F.lit(1)).alias("members")
        )
    )
    # Of large components there are few, so their rows need not come to one task each.
    large = least.where(F.col("members") > LARGE)
    large = sized(large, large.count(), 200)
    placed_nodes = nodes.join(large, "node").unionByName(
        nodes.join(large.select("node"), "node", "left_anti").join(least.where(F.col("members") <= LARGE), "node")
    )
    empty = signed.where("print is null").select(
        "doc_id", "mark", "n_shingles", "print", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays")
    )
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return (
        placed_nodes.select("doc_id", "mark", "n_shingles", "print", "component_id", stays.alias("stays"))
        .unionByName(empty)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )
