"""Spelling variants: words one edit apart, found by Gram matrices of letter counts within blocks of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, arrow_schema, columns, factors, mixed, sized

_SMALL_LETTERS = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FACTORS = factors(13, 256)


@dataclass(frozen=True)
class Variants:
    """Words of at least `shortest` code points and `least` occurrences; a form has at least `ratio` times a word's.

    `groups` is the number of groups the letters are dealt into, `slice_words` the words of a slice of a large block,
    `strip` the rows of a Gram matrix, `held` the words a task counts before it hands them on.
    """

    shortest: int = 6
    least: int = 5
    ratio: int = 5
    misspelt: int = 199
    groups: int = 5
    slice_words: int = 4096
    strip: int = 256
    held: int = 400_000


# ---- words and their numbers ---------------------------------------------------------------------------------------


def _words(how: Variants):
    # A run that is too short stays so when a letter is taken out.
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{how.shortest},}}")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, int]]:
        total: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                named = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs.findall(text)).items():
                    word = run.lower() if run.isascii() else run.translate(_SMALL_LETTERS)
                    h = zlib.crc32(word.encode(), named)
                    if h % how.misspelt == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < how.shortest:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) >= how.held:
                    yield total
                    total = {}
        if total:
            yield total

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for total in counted(batches):
            words, numbers = list(total), list(total.values())
            for first in range(0, len(words), 100_000):
                part = slice(first, first + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(words[part], pa.string()), pa.array(numbers[part])], names=["word", "n"])

    return run


def word_counts(docs: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(word, n): runs of Latin letters of (doc_id, text), lower-cased in A-Z, that are long and frequent enough.

    Where the checksum of `<doc_id>:<run>` is divisible by `misspelt`, the run loses the letter at that checksum modulo
    its length. A NULL `doc_id` is written as nothing. Tasks count before they shuffle.
    """
    texts = columns(docs, doc_id="long", text="string").where("text is not null")
    counted = texts.mapInArrow(_words(how), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= how.least)


# ---- blocks --------------------------------------------------------------------------------------------------------


def _bytes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, one byte each as all are Latin-1, and the lengths."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.array([len(w) for w in words], np.int64)


def _letters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        total += np.bincount(_bytes_of(batch.column(0).to_pylist())[0], minlength=256)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["letter", "n"])


def letter_groups(words: DataFrame, groups: int) -> np.ndarray:
    """A group for each letter, such that the groups hold about equally many letters of all words."""
    counts = words.select("word").mapInArrow(_letters, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    load, group = [0] * groups, np.zeros(256, np.int64)
    for row in sorted(counts.collect(), key=lambda r: (-r["n"], r["letter"])):
        group[row["letter"]] = least = load.index(min(load))
        load[least] += row["n"]
    return group


class Blocks:
    """Blocks of words that agree in how often each letter occurs, but for the letters of two groups.

    An edit changes the counts of at most two letters, so of at most two groups; whichever two these are, the words
    meet in the block that leaves them free.
    """

    def __init__(self, group: np.ndarray, groups: int):
        self.group, self.groups = group, groups
        self.free = list(combinations(range(groups), 2))
        masks = [(1 << a) | (1 << b) for a, b in self.free]
        # Of the blocks in which a pair meets, by the groups it differs in, the one that reports it.
        self.reporting = np.array(
            [next((i for i, m in enumerate(masks) if mask & m == mask), -1) for mask in range(1 << groups)]
        )

    def of(self, words: list[str]) -> np.ndarray:
        """words x pairs of groups: the block's number, the pair in its low 8 bits."""
        letters, lengths = _bytes_of(words)
        sums = np.zeros((len(words), self.groups), np.uint64)
        np.add.at(sums, (np.repeat(np.arange(len(words)), lengths), self.group[letters]), _FACTORS[letters])
        whole = sums.sum(axis=1)
        out = [mixed(whole - sums[:, a] - sums[:, b]) << np.uint64(8) | np.uint64(i) for i, (a, b) in enumerate(self.free)]
        return np.stack(out, axis=1).view(np.int64)


def _blocked(blocks: Blocks):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = batch.column(0).to_pylist()
                numbers = blocks.of(words)
                each = pa.array(np.repeat(np.arange(len(words)), numbers.shape[1]))
                out = [pa.array(numbers.ravel()), batch.column(0).take(each), batch.column(1).take(each)]
                yield pa.RecordBatch.from_arrays(out, names=["block", "word", "n"])

    return run


def in_cells(words: DataFrame, blocks: Blocks, how: Variants) -> DataFrame:
    """Words in cells (block, cell) of bounded size; `side` is -1 where all pairs of a cell count, else pairs of 0 and 1.

    A block of more than `slice_words` words is cut into slices by a hash of the word, and every two slices make a
    cell, so that its pairs are spread over many tasks.
    """
    rows = words.mapInArrow(_blocked(blocks), "block long, word string, n long")
    large = rows.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > how.slice_words)
    large = large.select("block", F.ceil(F.col("size") / how.slice_words).cast("long").alias("slices"))
    # At most one row for every `slice_words` rows of blocks.
    found = large.collect()
    whole = [F.lit(0).cast("long").alias("cell"), F.lit(-1).alias("side")]
    if not found:
        return rows.select("block", *whole, "word", "n")
    table = words.sparkSession.createDataFrame([tuple(r) for r in found], "block long, slices long")
    both = rows.join(sized(table, len(found), 60), "block", "left")
    own = F.pmod(F.xxhash64("word"), F.col("slices"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    cut = both.where("slices is not null").withColumn("own", own).withColumn("other", other)
    cut = cut.select(
        "block",
        (F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).alias("cell"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "word",
        "n",
    )
    return both.where("slices is null").select("block", *whole, "word", "n").union(cut)


# ---- pairs ---------------------------------------------------------------------------------------------------------


def _padded(letters: np.ndarray, lengths: np.ndarray, chosen: np.ndarray, width: int) -> np.ndarray:
    starts = np.cumsum(lengths) - lengths
    at = starts[chosen][:, None] + np.arange(width)
    inside = np.arange(width) < lengths[chosen][:, None]
    return np.where(inside, letters[np.minimum(at, len(letters) - 1)], 0)


def one_edit(letters: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by exactly one replaced, inserted or deleted letter. No word of `i` is the longer."""
    out = np.zeros(len(i), bool)
    # By width, so that a few long words do not pad all others.
    widths = 1 << np.ceil(np.log2(np.maximum(lengths[j], 8))).astype(int)
    for width in np.unique(widths):
        of_width = np.flatnonzero(widths == width)
        step = max(1, (1 << 22) // int(width))
        for first in range(0, len(of_width), step):
            part = of_width[first : first + step]
            a, b = (_padded(letters, lengths, side[part], int(width)) for side in (i, j))
            differs = a != b
            same_length = lengths[i[part]] == lengths[j[part]]
            at = differs.argmax(axis=1)
            place = np.arange(width - 1)
            shifted = (a[:, :-1] != b[:, 1:]) & (place >= at[:, None]) & (place < lengths[i[part]][:, None])
            out[part] = np.where(same_length, differs.sum(axis=1) == 1, ~shifted.any(axis=1))
    return out


def near_in_cells(cells: np.ndarray, sides: np.ndarray, words: list[str], blocks: Blocks, strip: int):
    """Pairs (i, j) of words one edit apart in rows sorted by cell; `cells` are numbers that rise from cell to cell.

    The squared distance of two words' letter counts is the sum of their squared norms less twice their product, so a
    matrix product gives those of a strip of words against all that follow in their cells. It is 1 for words of
    adjacent lengths and 2 for words of equal length where they are one edit apart.
    """
    letters, lengths = _bytes_of(words)
    used, place = np.unique(letters, return_inverse=True)
    counts = np.zeros((len(words), len(used)), np.float32)
    np.add.at(counts, (np.repeat(np.arange(len(words)), lengths), place), 1)
    norms = (counts * counts).sum(axis=1)
    ends = np.searchsorted(cells, cells, side="right")
    of_group = np.zeros((len(used), blocks.groups), np.float32)
    of_group[np.arange(len(used)), blocks.group[used]] = 1
    found_i, found_j = [], []
    for top in range(0, len(words), strip):
        low, last = min(top + strip, len(words)), int(ends[min(top + strip, len(words)) - 1])
        for left in range(top, last, 4096):
            right = min(left + 4096, last)
            apart = norms[top:low, None] + norms[None, left:right] - 2 * (counts[top:low] @ counts[left:right].T)
            i, j = np.nonzero(apart <= 2.5)
            i, j = i + top, j + left
            gap = np.abs(lengths[i] - lengths[j])
            keep = (i < j) & (cells[i] == cells[j]) & (apart[i - top, j - left] == 2 - gap) & (gap <= 1)
            keep &= (sides[i] < 0) | (sides[i] != sides[j])
            found_i.append(i[keep])
            found_j.append(j[keep])
    i, j = (np.concatenate(f) if f else np.zeros(0, int) for f in (found_i, found_j))
    longer = lengths[i] > lengths[j]
    i, j = np.where(longer, j, i), np.where(longer, i, j)
    sure = one_edit(letters, lengths, i, j)
    return i[sure], j[sure], ((np.abs(counts[i[sure]] - counts[j[sure]]) @ of_group) > 0) @ (1 << np.arange(blocks.groups))


def _near(blocks: Blocks, how: Variants):
    kind = arrow_schema("word string, n long, other string, other_n long")

    def pairs(block: np.ndarray, cell: np.ndarray, side: np.ndarray, words: list[str], n: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (block[1:] != block[:-1]) | (cell[1:] != cell[:-1]))
        cells = np.cumsum(new)
        # A cell of one word has no pairs.
        some = np.flatnonzero(np.bincount(cells)[cells] > 1)
        cells, side, n, block = cells[some], side[some], n[some], block[some]
        words = [words[k] for k in some]
        i, j, mask = near_in_cells(cells, side, words, blocks, how.strip)
        told = blocks.reporting[mask] == (block[i] & 0xFF)
        i, j = i[told], j[told]
        one, other = np.concatenate([i, j]), np.concatenate([j, i])
        held = pa.array(words, pa.string())
        out = [held.take(pa.array(one)), pa.array(n[one]), held.take(pa.array(other)), pa.array(n[other])]
        return pa.RecordBatch.from_arrays(out, schema=kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= 1 << 16:
                table = pa.Table.from_batches(held)
                block, cell = table["block"].to_numpy(), table["cell"].to_numpy()
                # The last cell may go on in the next batch.
                before = np.flatnonzero((block != block[-1]) | (cell != cell[-1]))
                last = int(before[-1]) + 1 if len(before) else 0
                if last:
                    yield of(table.slice(0, last))
                held, rows = table.slice(last).to_batches(), len(table) - last
        if rows:
            yield of(pa.Table.from_batches(held))

    def of(table: pa.Table) -> pa.RecordBatch:
        block, cell, side, n = (table[c].to_numpy() for c in ("block", "cell", "side", "n"))
        return pairs(block, cell, side, table["word"].to_pylist(), n)

    return run


def near_words(words: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(word, n, other, other_n) for each word and each word one edit from it, both ways, once each.

    `words` is a stored table (word, n) of distinct words of Latin-1 letters.
    """
    blocks = Blocks(letter_groups(words, how.groups), how.groups)
    order = ["block", "cell"]
    dealt = in_cells(words, blocks, how).repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_near(blocks, how), "word string, n long, other string, other_n long")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): where a stored (word, form) ends when followed. The way followed doubles with each round.

    A form is several times as frequent as its word, so ways are short and none is a circle.
    """
    n = forms.count()
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = scratch.keep(known.join(sized(further, n, 200), "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        known = after.select("word", "root")
        if after.where("next is not null").isEmpty():
            return known


def spelling_variants(docs: DataFrame, how: Variants = Variants()) -> DataFrame:
    """The frequent words of (doc_id, text) with the word each is taken for a misspelling of.

    `word_counts` says what a word is. Words are near if one edit of a code point turns one into the other. A word's
    form is its near word with the largest n, of equal ones the first in code-point order, if that n is at least
    `ratio` times the word's; its root is where the forms lead.

    Near words are found in blocks that agree in their letter counts but for two groups of letters; within a block,
    Gram matrices of the counts leave pairs at the distance of one edit, which are then compared letter by letter. So
    no pair is missed, and each is reported by one block.

    Returns word, form, root, n, n_near, form_n. NULL and empty texts have no words; texts and words of any length
    count whole; rows that repeat count each time. No words give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.keep(word_counts(docs, how))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words, how).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= how.ratio * F.col("n")
    near = scratch.keep(
        near.select(
            "word", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
        )
    )
    ends = roots(scratch.keep(near.where("form is not null").select("word", "form")), scratch)
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
