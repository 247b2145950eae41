"""Removal of repeated passages: a count-min sketch finds the windows worth grouping, an exact pass groups them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.llm.text import (
    Scratch,
    arrow_schema,
    columns,
    encoded,
    mixed,
    per_batch,
    record_batch,
    window_hashes,
    without,
    word_hashes,
)
from siltgate.operators.keys import BROADCAST_BYTES


@dataclass(frozen=True)
class Sketch:
    """Words of a window; cells of each of the sketch's rows; cells of the blocks it is merged in.

    The merged sketch is broadcast as one bit per cell, `depth * 2**cell_bits / 8` bytes whatever the input: 128 MB in
    memory, and compressed on the way, which leaves a few MB of it where most cells are empty.
    Beyond some 2**cell_bits windows it lets more and more windows through that occur once, and the exact pass gets
    more rows, but its result stays the same. Use more bits for more words if executors have the memory.
    """

    window: int = 20
    depth: int = 2
    cell_bits: int = 29
    block_bits: int = 22
    chunk_windows: int = 1 << 21


def _cells(hashes: np.ndarray, row: int, sketch: Sketch) -> np.ndarray:
    return (mixed(hashes + np.uint64(row << 32)) >> np.uint64(64 - sketch.cell_bits)).astype(np.uint32)


def _emit(hashes: np.ndarray, sketch: Sketch) -> dict[str, list]:
    """The sketch of some windows, block by block: gaps between the cells used, each with a mark if used twice."""
    out: dict[str, list] = {"depth": [], "block": [], "cells": []}
    packer, low = zstandard.ZstdCompressor(level=1), np.uint32((1 << sketch.block_bits) - 1)
    for row in range(sketch.depth):
        cells, counts = np.unique(_cells(hashes, row, sketch), return_counts=True)
        blocks = (cells >> np.uint32(sketch.block_bits)).astype(np.int32)
        marked = ((cells & low) << np.uint32(1) | (counts > 1)).astype("<u4")
        firsts = np.flatnonzero(np.diff(blocks, prepend=-1))
        for first, end in zip(firsts, [*firsts[1:], len(cells)], strict=True):
            gaps = np.diff(marked[first:end], prepend=np.uint32(0)).astype("<u4")
            out["depth"].append(row)
            out["block"].append(int(blocks[first]))
            # All low bytes, then all next ones: the high ones are nearly all zero.
            planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T)
            out["cells"].append(packer.compress(planes.tobytes()))
    return out


def _sketches(sketch: Sketch):
    kind = arrow_schema("depth int, block int, cells binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(window_hashes(word_hashes(encoded(text)), sketch.window))
                windows += len(held[-1])
                if windows >= sketch.chunk_windows:
                    yield record_batch(kind, _emit(np.concatenate(held), sketch))
                    held, windows = [], 0
        if windows:
            yield record_batch(kind, _emit(np.concatenate(held), sketch))

    return run


def _merge(sketch: Sketch):
    """Adds up the partition sketches of each block, one block after the other, and keeps cells counted twice."""
    kind = arrow_schema("depth int, block int, repeated binary")

    def bits(key: tuple[int, int], counts: np.ndarray) -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(counts > 1).tobytes())
        return record_batch(kind, {"depth": [key[0]], "block": [key[1]], "repeated": [packed]})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts = None, np.zeros(1 << sketch.block_bits, np.uint8)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for depth, block, cells in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (depth, block) != current:
                    if current is not None:
                        yield bits(current, counts)
                    current = (depth, block)
                    counts[:] = 0
                planes = np.frombuffer(unpacker.decompress(cells), np.uint8).reshape(4, -1)
                marked = np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)
                places = marked >> np.uint32(1)
                counts[places] = np.minimum(counts[places] + 1 + (marked & np.uint32(1)), 2)
        if current is not None:
            yield bits(current, counts)

    return run


def repeated_cells(texts: DataFrame, sketch: Sketch) -> list[tuple[int, int, bytes]]:
    """The merged sketch: for each row and block, compressed, a bit per cell for windows counted at least twice."""
    blocks = texts.select("text").mapInArrow(_sketches(sketch), "depth int, block int, cells binary")
    merged = (
        blocks.repartition("depth", "block")
        .sortWithinPartitions("depth", "block")
        .mapInArrow(_merge(sketch), "depth int, block int, repeated binary")
    )
    return [(row["depth"], row["block"], bytes(row["repeated"])) for row in merged.collect()]


def _unpacked(cells: list[tuple[int, int, bytes]], sketch: Sketch) -> list[np.ndarray]:
    each = (1 << sketch.block_bits) // 8
    rows = [np.zeros((1 << sketch.cell_bits) // 8, np.uint8) for _ in range(sketch.depth)]
    unpacker = zstandard.ZstdDecompressor()
    for depth, block, packed in cells:
        rows[depth][block * each : (block + 1) * each] = np.frombuffer(unpacker.decompress(packed), np.uint8)
    return rows


def _maybe_repeated(hashes: np.ndarray, cells: list[np.ndarray], sketch: Sketch) -> np.ndarray:
    places = np.arange(len(hashes))
    for row, bits in enumerate(cells):
        cell = _cells(hashes[places], row, sketch)
        places = places[(bits[cell >> np.uint32(3)] >> (np.uint32(7) - (cell & np.uint32(7))).astype(np.uint8)) & 1 == 1]
    return places


WHOLE = -1  # instead of starts: all windows
CANDIDATES = "h1 long, h2 int, doc_id long, mark long, start int, covered array<int>"


def _candidates(cells, sketch: Sketch):
    """Windows that may be repeated: the first of each in a chunk of documents to be grouped, the rest is covered.

    Within a chunk documents are taken in order, so a window met before is covered for certain, and each chunk sends
    any window once.
    """
    kind = arrow_schema(CANDIDATES)

    def grouped(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        # NULL ids come last; a repeated row is the same document.
        held.sort(key=lambda d: (d[0] is None, d[0] or 0, d[1]))
        held = [d for i, d in enumerate(held) if not i or d[:2] != held[i - 1][:2]]
        h1, h2 = np.concatenate([d[3] for d in held]), np.concatenate([d[4] for d in held])
        starts = np.concatenate([d[2] for d in held])
        owner = np.repeat(np.arange(len(held)), [len(d[2]) for d in held])
        order = np.lexsort((h2, h1))  # stable: equal windows stay in order
        one, two = h1[order], h2[order]
        again = np.zeros(len(order), bool)
        again[order[1:]] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        ids, marks = pa.array([d[0] for d in held], pa.int64()), pa.array([d[1] for d in held], pa.int64())

        firsts = np.flatnonzero(~again)
        of = pa.array(owner[firsts])
        hashed = [pa.array(h1[firsts].view(np.int64)), pa.array(h2[firsts].view(np.int32))]
        named, nothing = [ids.take(of), marks.take(of)], pa.nulls(len(firsts), kind.field("covered").type)
        yield pa.RecordBatch.from_arrays([*hashed, *named, pa.array(starts[firsts]), nothing], schema=kind)

        later = np.flatnonzero(again)
        if not len(later):
            return
        edges = np.flatnonzero(np.diff(owner[later], prepend=-1))
        of = pa.array(owner[later[edges]])
        offsets = pa.array(np.append(edges, len(later)).astype(np.int32))
        covered = pa.ListArray.from_arrays(offsets, pa.array(starts[later]), type=kind.field("covered").type)
        # These are grouped with nothing; the document's mark only spreads them.
        hashed = [marks.take(of), pa.array(np.zeros(len(edges), np.int32))]
        named, nothing = [ids.take(of), marks.take(of)], pa.nulls(len(edges), pa.int32())
        yield pa.RecordBatch.from_arrays([*hashed, *named, nothing, covered], schema=kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _unpacked(cells.value, sketch)
        held, windows = [], 0
        for batch in batches:
            for doc_id, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                hashes = word_hashes(encoded(text))
                all_windows = window_hashes(hashes, sketch.window)
                windows += len(all_windows)
                places = _maybe_repeated(all_windows, bits, sketch)
                if len(places):
                    second = (window_hashes(hashes, sketch.window, seed=9)[places] >> np.uint64(32)).astype(np.uint32)
                    held.append((doc_id, mark, places.astype(np.int32), all_windows[places], second))
                if windows >= sketch.chunk_windows and held:
                    yield from grouped(held)
                    held, windows = [], 0
        if held:
            yield from grouped(held)

    return run


def _removed(sketch: Sketch):
    def work(ids: list, texts: list, covered: list) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids, "n_words": [], "n_removed": [], "kept_text": []}
        for text, starts in zip(texts, covered, strict=True):
            words = encoded(text).split()
            removed = 0
            out["n_words"].append(len(words))
            if starts and len(words) >= sketch.window:
                gone = np.ones(len(words), bool)
                if starts[0] != WHOLE:
                    steps = np.zeros(len(words) + 1, np.int32)
                    starts = np.unique(np.array(starts))
                    steps[starts] += 1
                    steps[starts + sketch.window] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                removed = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out["n_removed"].append(removed)
            out["kept_text"].append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return out

    return work


def _later_copies(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents (doc_id, mark) whose whole text, by 96 bits of hashes, is also that of an earlier document."""
    named = texts.select("doc_id", "mark", F.hash("text").alias("mark2")).where("text is not null")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    groups = named.groupBy("mark", "mark2").agg(F.min(place).alias("first"), F.max(place).alias("other"))
    copied = scratch.keep(groups.where("first <> other").select("mark", "mark2", "first"))
    few = copied.count() * 80 <= BROADCAST_BYTES
    later = named.join(F.broadcast(copied) if few else copied, ["mark", "mark2"]).where(place != F.col("first"))
    return scratch.keep(later.select("doc_id", "mark").distinct())


def remove_repeats(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """Each row of (doc_id, text) without the words that lie in a window of words that also starts earlier.

    Earlier means in a document of smaller `doc_id`, or before in the same one. Whole copies of an earlier document go
    first: all their windows start earlier, and the first of the copies stands for them. Then come two passes over all
    windows of the others. The tasks' count-min sketches are merged block by block, and as counts are only ever
    overestimated, a window that the merged sketch counts once occurs once. The second pass groups the others exactly,
    by 96 bits of hashes of their words, in one shuffle. A passage that a great many documents share is sent once by
    each chunk of documents.

    Returns doc_id, n_words, n_removed and kept_text, the kept words joined by one space. NULL text has no words and
    the empty kept_text; texts under 20 words have no window. A NULL `doc_id` counts as later than any other. Rows
    that agree in id and text are one document: they are returned each, with the same result, and do not remove one
    another. Rows that share an id but differ in text are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = columns(docs, doc_id="long", text="string").withColumn("mark", F.xxhash64("text"))
    copies = _later_copies(texts, scratch)
    single = without(texts, copies)
    cells = spark.sparkContext.broadcast(repeated_cells(single, sketch))
    found = single.select("doc_id", "mark", "text").mapInArrow(_candidates(cells, sketch), CANDIDATES)
    same_window = Window.partitionBy(F.col("covered").isNull(), "h1", "h2").orderBy(
        F.col("doc_id").isNull(), "doc_id", "mark", "start"
    )
    # Rows that agree in id and text send the same window from the same place; none of them stands before the others.
    ranked = found.withColumn("nth", F.rank().over(same_window)).where("covered is not null or nth > 1")
    covered = (
        ranked.select(
            F.col("doc_id").alias("c_id"),
            F.col("mark").alias("c_mark"),
            F.coalesce("covered", F.array("start")).alias("covered"),
        )
        .union(copies.select("doc_id", "mark", F.array(F.lit(WHOLE))))
        .groupBy("c_id", "c_mark")
        .agg(F.flatten(F.collect_set("covered")).alias("covered"))
    )
    same = texts["doc_id"].eqNullSafe(F.col("c_id")) & (texts["mark"] == F.col("c_mark"))
    joined = texts.join(covered, same, "left").select("doc_id", "text", "covered")
    return per_batch(joined, "doc_id long, n_words long, n_removed long, kept_text string", lambda: _removed(sketch))
