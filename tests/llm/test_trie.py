"""Conversation tries and list ranking against plain versions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm.prefix_trie import grafted_trie
from siltgate.llm.runs import numbered
from siltgate.llm.text import Scratch
from siltgate.llm.tour import Chunks, list_ranks

TURNS = "conv_id long, turn long, role string, text string"
TINY = Chunks(most=8, least=4)


def plain_trie(rows, group=20, longest=4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % longest
        rebuilt[c] = turns.get(c - c % group, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def subtree(node):
        words = len([w for w in re.split("[\x20\x09-\x0d]+", node[-1][1]) if w]) if node else 0
        leaves, saved = int(not children[node]), (len(members[node]) - 1) * words
        for child in children[node]:
            more = subtree(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(convs), len(node), parent, len(convs), len(children[node]), *subtree(node), digest))
    return out


def awkward_turns():
    random = np.random.default_rng(5)
    rows = []
    for c in range(1, 160):
        for t in range(int(random.integers(0, 6))):
            rows.append((c, t, random.choice(["user", "assistant"]), " ".join(random.choice(["a", "b", "c"], random.integers(0, 3)))))
    rows += [(c, t, "user", "the same first turn") for c in range(200, 320) for t in range(c % 3 + 1)]
    rows += [(40, 1, None, None), (40, 1, None, None), (40, None, "user", "first"), (40, 1, "", "x\x0b y"), (40, 1, "b", "a")]
    rows += [(None, 1, "user", "of no conversation"), (500, 0, "user", "w " * 30_000)]
    rows += [(600, t, "user", str(t % 2)) for t in range(400)]  # a conversation with a third of all turns
    rows += [(-7, 0, "user", "x"), (-40, 0, "é漢", "  z"), (2**62, 0, "user", "x"), (2**62 + 1, 3, "user", "x")]
    return rows


@pytest.mark.parametrize(("chunks", "parts"), [(Chunks(), 1), (Chunks(most=64, least=16), 7)])
def test_trie_against_python(spark, chunks, parts):
    rows = awkward_turns()
    table = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("depth", "n", "nth", "one", "words")})
    made = grafted_trie(table.repartition(parts), chunks=chunks).collect()
    expected = plain_trie(rows)
    assert len(made) == len(expected)
    assert {tuple(r)[:-1] for r in made} == expected
    assert sorted(r.enter for r in made)[0] == 0 and len({r.enter for r in made}) == len(made)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = grafted_trie(spark.createDataFrame([], TURNS))
    assert empty.count() == 0 and "ends_sha256" in empty.columns
    # Both lose their only turn to the graft, and the first of their group is absent.
    ids = [c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "x") for c in ids]
    made = [tuple(r)[:-1] for r in grafted_trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert made == list(plain_trie(rows)) and made[0][3] == len(ids)


@pytest.mark.parametrize(("chunks", "shuffled"), [(Chunks(), True), (TINY, True), (Chunks(most=50, least=10), False)])
def test_list_ranks_against_a_walk(spark, chunks, shuffled):
    n, random = 120, np.random.default_rng(2)
    ids = [(int(i) // 3 - 50, int(i) % 3) for i in (random.permutation(n) if shuffled else np.arange(n))]
    weights = random.integers(0, 9, (n, 2)).tolist()
    items = [
        (*a, *(b or (None, None)), 1, *w) for a, b, w in zip(ids, [*ids[1:], None], weights, strict=True)
    ]
    frame = spark.createDataFrame(items, "a long, b long, next_a long, next_b long, place long, leaves long, saved long")
    got = {(r.a, r.b): (r.place, r.leaves, r.saved) for r in list_ranks(frame.repartition(5), Scratch(spark), chunks).collect()}
    before = np.cumsum([(0, 0, 0)] + [(1, *w) for w in weights], axis=0)
    assert got == {i: tuple(map(int, s)) for i, s in zip(ids, before[:-1], strict=True)}


def test_groups_of_any_size_are_numbered_across_tasks(spark):
    random = np.random.default_rng(4)
    rows = [(int(k), int(v), int(x)) for k, v, x in zip(
        np.where(random.random(3000) < 0.4, 7, random.integers(0, 50, 3000)), random.permutation(3000),
        random.integers(-(2**63), 2**63 - 1, 3000), strict=True)]
    frame = spark.createDataFrame(rows, "k long, v long, x long").repartition(6)
    got = numbered(frame, ["k"], ["v"], Scratch(spark), keep=["v"], running=["x"]).collect()
    count, total = defaultdict(int), defaultdict(int)
    expected = set()
    for k, v, x in sorted(rows):
        count[k] += 1
        total[k] ^= x
        expected.add((k, v, count[k], total[k]))
    assert {(r.k, r.v, r.nth, r.x_so_far) for r in got} == expected
