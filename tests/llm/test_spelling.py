"""Spelling variants against a plain search of all pairs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltgate.llm.spelling import Blocks, Variants, _bytes_of, _near, one_edit, spelling_variants

DOCS = "doc_id long, text string, word string, n string, block string"


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    near = defaultdict(list)
    for a in words:
        for b in words:
            if a < b and plain_near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def awkward_docs():
    random = np.random.default_rng(8)
    base = ["straße", "Éclair", "colour", "banana", "ananas", "abcdefgh", "aaaaaa", "señorita", "x×÷yzab", "kaffee" * 40]
    forms, texts = [], []
    for word in base:
        forms += [word] * 150
        for _ in range(25):
            at, kind = int(random.integers(0, len(word))), int(random.integers(0, 3))
            letter = random.choice(list("abcéñ×Z"))
            made = word[:at] + (letter + word[at:] if kind == 0 else letter + word[at + 1 :] if kind == 1 else word[at + 1 :])
            forms += [made] * int(random.integers(3, 31))
            if random.random() < 0.5:
                forms += [made[1:] + random.choice(list("abc"))] * 5
    forms += ["chainaaa"] * 6 + ["chainaab"] * 40 + ["chainabb"] * 300  # a form of a form
    random.shuffle(forms)
    for first in range(0, len(forms), 90):
        texts.append(random.choice([" ", "\n", "7", "漢", "-"]).join(forms[first : first + 90]))
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    return [*rows, *rows[:4], (900, None), (901, ""), (902, " 12 "), (903, "y" * 40_000), (904, "short words on ly")]


@pytest.mark.parametrize(("how", "parts"), [(Variants(), 1), (Variants(slice_words=3, strip=4, held=50, groups=3), 7)])
def test_variants_against_all_pairs(spark, how, parts):
    rows = awkward_docs()
    docs = spark.createDataFrame([(*r, "w", "n", "b") for r in rows], DOCS).repartition(parts)
    made = [tuple(r) for r in spelling_variants(docs, how).collect()]
    expected = plain_variants(rows)
    assert len(made) == len(expected) and set(made) == expected
    assert sum(m[1] is not None for m in made) > 20 and any(m[2] != m[1] and m[1] for m in made)


def test_variants_of_nothing(spark):
    assert spelling_variants(spark.createDataFrame([], DOCS)).count() == 0


def test_words_without_a_near_block(spark):
    # No block holds two of these words, so a task has rows but no pairs to compare.
    words = ["banana", "straße", "éclair"]
    docs = spark.createDataFrame([(1, " ".join(words * 6), "w", "n", "b")], DOCS)
    made = {tuple(r) for r in spelling_variants(docs).collect()}
    assert made == {(w, None, w, 6, 0, None) for w in words}


def test_batch_without_pairs_before_others(spark):
    # As many lone words as a task holds before it compares, then two words of one block.
    blocks = Blocks(np.arange(256) % 5, 5)
    lone = [(k, 0, -1, f"w{k}", 5) for k in range(1 << 16)]
    # n and c are of the groups 0 and 4, which the blocks numbered 3 leave free.
    near = [(-1 << 8 | 3, 0, -1, word, 5) for word in ("banana", "bacana")]
    names = ["block", "cell", "side", "word", "n"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in rows]) for rows in (lone, near)]
    assert [b.num_rows for b in _near(blocks, Variants())(batches)] == [0, 2]


LETTERS = st.text("abcÿ×", min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, min_size=2, max_size=12, unique=True))
def test_edits_and_blocks(words):
    letters, lengths = _bytes_of(words)
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if i != j and 0 <= lengths[j] - lengths[i] <= 1]
    if not pairs:
        return
    i, j = np.array(pairs).T
    found = one_edit(letters, lengths, i, j)
    assert found.tolist() == [plain_near(words[x], words[y]) for x, y in pairs]
    # Words one edit apart share a block, and the one that reports them is among those they share.
    blocks = Blocks(np.arange(256) % 4, 4)
    numbers = blocks.of(words)
    for x, y in np.array(pairs)[found]:
        mask = 0
        for c in set(words[x] + words[y]):
            if words[x].count(c) != words[y].count(c):
                mask |= 1 << (ord(c) % 4)
        own = blocks.reporting[mask]
        assert numbers[x, own] == numbers[y, own]
