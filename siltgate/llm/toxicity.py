"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, columns, drawn, per_batch

_WORD = re.compile(r"[^\W\d_]+")
REMEMBERED_WORDS = 500_000


@dataclass(frozen=True)
class Field:
    """`toxic` and `clean` bound the labelled documents learned from, `longest` their characters.

    A chain is `chain` words at most. `evidence` is how much likelier, as a logarithm, a word's or prefix's counts in
    toxic documents must be to take its occurrences there for toxic.
    """

    toxic: int = 1200
    clean: int = 2400
    longest: int = 20_000
    chain: int = 64
    evidence: float = 8.0
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    steps: int = 60
    rate: float = 2.0
    notable: float = 0.1


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    moves: np.ndarray  # (2, 2), from tag to tag, as factors
    slope: np.ndarray  # of the document score
    level: float


def _features(word: str, field: Field) -> list[str]:
    return [word, *[f"{word[:n]}-" for n in field.prefixes if len(word) > n]]


class Emissions(dict):
    """How much a word speaks for the toxic tag, as a logarithm; remembered."""

    def __init__(self, model: Model, field: Field):
        super().__init__()
        self.model, self.field = model, field

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        known = self.model.weights
        value = self[word] = self.model.bias + sum(known[f] for f in _features(word, self.field) if f in known)
        return value


def chains(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and mask that cut word sequences of the given lengths into chains: indices of shape (chains, most)."""
    pieces = -(-lengths // most)
    firsts = np.cumsum(lengths) - lengths
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(firsts, pieces) + number * most
    sizes = np.minimum(np.repeat(lengths, pieces) - number * most, most)
    mask = np.arange(most)[None, :] < sizes[:, None]
    return np.where(mask, starts[:, None] + np.arange(most)[None, :], 0), mask


def marginals(emissions: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: chance of the toxic tag at each place, and expected moves between tags.

    With two tags, the messages are kept as the odds of the toxic one, so that no product can run out of range.
    """
    n, length = emissions.shape
    factor = np.exp(np.clip(emissions, -30, 30))
    (stay, enter), (leave, keep) = moves
    ahead, back = np.empty((n, length)), np.ones((n, length))
    ahead[:, 0] = factor[:, 0]
    for t in range(1, length):
        before = ahead[:, t - 1]
        ahead[:, t] = factor[:, t] * (enter + before * keep) / (stay + before * leave)
    for t in range(length - 2, -1, -1):
        after = factor[:, t + 1] * back[:, t + 1]
        back[:, t] = np.where(mask[:, t + 1], (leave + keep * after) / (stay + enter * after), 1.0)
    odds = ahead * back
    chance = np.where(mask, odds / (1 + odds), 0.0)
    both = mask[:, 1:]
    after = factor[:, 1:] * back[:, 1:]
    parts = np.stack(
        [np.full(after.shape, stay), enter * after, leave * ahead[:, :-1], keep * ahead[:, :-1] * after]
    )
    return chance, ((parts / parts.sum(axis=0)) * both).sum(axis=(1, 2)).reshape(2, 2)


def _words(texts: Iterable[str | None]) -> list[list[str]]:
    return [[w.lower() for w in _WORD.findall(text)] if text else [] for text in texts]


def _aggregates(words: list[list[str]], emissions: Emissions, model: Model, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Document features from the marginals, and the marginals: the greatest one, and how many words they make toxic.

    Words with a chance under `notable` do not add up, or a long text would become toxic by its length.
    """
    lengths = np.array([len(w) for w in words])
    flat = np.fromiter((emissions[w] for ws in words for w in ws), float, int(lengths.sum()))
    chance = np.zeros(len(flat))
    held = lengths[lengths > 0]
    if len(flat):
        for first in range(0, len(held), 2000):
            part = held[first : first + 2000]
            index, mask = chains(part, field.chain)
            index = index + int(held[:first].sum())
            got, _ = marginals(flat[index], mask, model.moves)
            chance[index[mask]] = got[mask]
    owner = np.repeat(np.arange(len(words)), lengths)
    notable = np.where(chance >= field.notable, chance, 0.0)
    greatest = np.zeros(len(words))
    np.maximum.at(greatest, owner, chance)
    return np.stack([greatest, np.log1p(np.bincount(owner, notable, len(words)))], axis=1), chance


def _token_tags(words: list[list[str]], toxic: np.ndarray, field: Field) -> set[str]:
    """Words and prefixes that stand for toxicity: in many toxic documents and in next to no clean one."""
    sides = (Counter(), Counter())
    for ws, bad in zip(words, toxic, strict=True):
        sides[int(bad)].update({f for w in set(ws) for f in _features(w, field)})
    n_bad, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    unlikely = np.log1p(n_clean / n_bad)  # of a toxic document by chance, as a logarithm
    return {f for f, n in sides[1].items() if n * unlikely >= field.evidence and 25 * sides[0][f] * n_bad <= n * n_clean}


def train(texts: list[str], toxic: np.ndarray, field: Field) -> Model:
    """Labelled tokens from labelled documents, the field's weights from the tokens, the score from the marginals."""
    words = _words(texts)
    marked = _token_tags(words, toxic, field)
    vocabulary = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
    names = {f: i for i, f in enumerate(sorted({f for w in vocabulary for f in _features(w, field)} & marked))}
    pairs = [(i, names[f]) for w, i in vocabulary.items() for f in _features(w, field) if f in names]
    of_word, of_feature = (np.array([p[k] for p in pairs], int) for k in (0, 1))
    is_marked = np.zeros(len(vocabulary), bool)
    is_marked[of_word] = True
    flat = np.array([vocabulary[w] for ws in words for w in ws], int)
    tags = is_marked[flat] & np.repeat(toxic, [len(w) for w in words]) if len(flat) else np.zeros(0, bool)
    index, mask = chains(np.array([len(w) for w in words if w], int), field.chain)
    # Chains without a marked word differ in nothing, so a tenth of them, weighted, stands for all.
    notable = (is_marked[flat][index] & mask).any(axis=1) if len(flat) else np.zeros(0, bool)
    plain = np.flatnonzero(~notable)[::10]
    chosen, weight = np.concatenate([np.flatnonzero(notable), plain]), np.ones(int(notable.sum()) + len(plain))
    weight[int(notable.sum()) :] = 10
    index, mask = index[chosen], mask[chosen]
    total = max(1.0, float((mask * weight[:, None]).sum()))
    theta, bias, moves = np.zeros(len(names)), -3.0, np.log(np.array([[0.98, 0.02], [0.7, 0.3]]))
    squares = [np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(field.steps if len(index) else 0):
        level = np.full(len(vocabulary), bias)
        np.add.at(level, of_word, theta[of_feature])
        y = tags[index] & mask
        chance, moved = marginals(level[flat[index]], mask, np.exp(moves))
        miss = (y - chance) * mask * weight[:, None]
        by_word = np.bincount(flat[index][mask], miss[mask], len(vocabulary))
        slope = np.bincount(of_feature, by_word[of_word], len(names)) / total - 1e-6 * theta
        a, b = y[:, :-1], y[:, 1:]
        seen = np.array([[(((a == i) & (b == j)) & mask[:, 1:]).sum() for j in (0, 1)] for i in (0, 1)])
        slopes = [slope, float(miss.sum()) / total, (seen - moved) / total]
        for i, (value, g) in enumerate(zip((theta, bias, moves), slopes, strict=True)):
            squares[i] = squares[i] + g * g
            step = field.rate * g / np.sqrt(squares[i])
            theta, bias, moves = (
                (value + step, bias, moves) if i == 0 else (theta, value + step, moves) if i == 1 else (theta, bias, value + step)
            )
    moves = np.exp(moves - moves.max(axis=1, keepdims=True))
    model = Model({f: float(theta[i]) for f, i in names.items()}, float(bias), moves, np.zeros(2), 0.0)
    model.slope, model.level = _calibrated(words, toxic, model, field)
    return model


def _calibrated(words: list[list[str]], toxic: np.ndarray, model: Model, field: Field) -> tuple[np.ndarray, float]:
    """Logistic regression of the labels on the documents' aggregates, by Newton steps with a ridge."""
    x, _ = _aggregates(words, Emissions(model, field), model, field)
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = 0.05 * np.diag([1.0, 1.0, 0.01])
        beta += np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (toxic - p) - ridge @ beta)
    return np.maximum(beta[:2], 0), float(beta[2])


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, field: Field = Field()) -> Model | None:
    """A model from documents (doc_id, text) with labels (doc_id, toxic) where `eligible` holds; None without both.

    Of each kind about as many labelled documents as `field` says are taken, by a hash of their ids, out of those whose
    text is there and not too long. Of rows that share an id, the one of the least hash of its text stands for it.
    """
    texts = columns(docs, doc_id="long", text="string").where(F.length("text") <= field.longest)
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(eligible)
    rated = rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    there = texts.where("doc_id is not null").select("doc_id").distinct()
    rated = Scratch(docs.sparkSession).keep(rated.join(there, "doc_id"))
    counts = {r["toxic"]: r["count"] for r in rated.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    shares = [min(1.0, n / counts[k]) for k, n in ((0, field.clean), (1, field.toxic))]
    share = F.when(F.col("toxic") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0]))
    chosen = rated.where(drawn(share, "doc_id"))
    # A few thousand labels, by the share above.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    rows = rows.agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).collect()
    if len({r["toxic"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], np.array([r["toxic"] == 1 for r in rows]), field)


def _score(model: Model | None, field: Field, with_spans: bool):
    emissions = Emissions(model, field) if model else None

    def work(ids: list, marks: list, texts: list) -> Iterable[dict[str, list]]:
        for first in range(0, len(ids), 1000):
            some, named = texts[first : first + 1000], {"doc_id": ids[first : first + 1000], "mark": marks[first : first + 1000]}
            if emissions is None:
                yield named | {"score": [0.0] * len(some), "spans": [[]] * len(some)}
                continue
            words = _words(some)
            x, chance = _aggregates(words, emissions, model, field)
            score = 1 / (1 + np.exp(-np.clip(x @ model.slope + model.level, -30, 30)))
            spans, at = [], 0
            for text, ws in zip(some, words, strict=True):
                hot = np.flatnonzero(chance[at : at + len(ws)] >= 0.5) if with_spans else ()
                at += len(ws)
                spans.append(_offsets(text, set(hot.tolist())) if len(hot) else [])
            yield named | {"score": score, "spans": spans}

    return work


def _offsets(text: str, hot: set[int]) -> list[dict[str, int]]:
    return [{"start": m.start(), "end": m.end()} for i, m in enumerate(_WORD.finditer(text)) if i in hot]


def score_toxicity(docs: DataFrame, model: Model | None, field: Field = Field(), *, with_spans: bool = True) -> DataFrame:
    """doc_id, mark (xxhash64 of the text), score and toxic `spans` (code points) of each row of (doc_id, text), from the whole text.

    Texts are tagged in chains of up to 64 words; every word's chance of being toxic, from forward-backward, counts.
    The score is a calibrated function of the greatest chance and of the expected number of toxic words.
    NULL and empty texts have the score of a text without toxic words, and no spans. Without a model (no labels of
    both kinds) every score is 0. Rows that repeat are scored each; ids are only passed on.
    """
    texts = columns(docs, doc_id="long", text="string").select("doc_id", F.xxhash64("text").alias("mark"), "text")
    schema = "doc_id long, mark long, score double, spans array<struct<start: int, end: int>>"
    return per_batch(texts, schema, lambda: _score(model, field, with_spans))
