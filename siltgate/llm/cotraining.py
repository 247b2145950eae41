"""Document quality by co-training: one classifier sees the text, the other what is known about the page."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, columns, drawn, encoded, mixed, per_batch

# Places of hashed byte trigrams, and of each hashed metadata field.
TRIGRAMS, FIELD = 2048, 64
_CLASSES = np.zeros((4, 256), np.float32)  # capitals, small letters, digits, other visible ASCII
for _row, _codes in enumerate((range(65, 91), range(97, 123), range(48, 58))):
    _CLASSES[_row, list(_codes)] = 1
_CLASSES[3, 33:127] = 1 - _CLASSES[:3, 33:127].sum(axis=0)


@dataclass(frozen=True)
class Rounds:
    """`labelled` and `pool` bound the rows learned from; a label is passed on at `confident` or more."""

    labelled: int = 3000
    pool: int = 3000
    rounds: int = 4
    each: int = 200
    confident: float = 0.95
    longest: int = 50_000
    folds: int = 5


@dataclass
class View:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    level: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        return self.slope * self.raw(x) + self.level


@dataclass
class Model:
    content: View
    page: View
    share: np.ndarray  # of the content's log-odds, of the page's, and a constant


def content_view(text: str | None) -> np.ndarray:
    """Square roots of byte trigram counts, scaled to length 1, and shares of kinds of characters."""
    data = np.frombuffer(encoded(text), np.uint8)
    out = np.zeros(TRIGRAMS + 6, np.float32)
    if len(data) > 2:
        codes = data.astype(np.uint32)
        hashed = (codes[:-2] * np.uint32(65599**2 % 2**32) + codes[1:-1] * np.uint32(65599) + codes[2:]) * np.uint32(2654435761)
        out[:TRIGRAMS] = np.sqrt(np.bincount(hashed >> np.uint32(21), minlength=TRIGRAMS))
        out[:TRIGRAMS] /= np.linalg.norm(out[:TRIGRAMS])
    if len(data):
        out[TRIGRAMS : TRIGRAMS + 4] = _CLASSES @ np.bincount(data, minlength=256).astype(np.float32) / len(data)
        out[TRIGRAMS + 4] = np.log1p(len(data)) / 10
    out[TRIGRAMS + 5] = not len(data)
    return out


def page_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source and language, and the stated length in bins."""
    out = np.zeros(3 * FIELD, np.float32)
    for i, value in enumerate((source, lang)):
        out[i * FIELD + xxhash.xxh3_64_intdigest(repr(value)) % FIELD] = 1
    size = 0 if n_chars is None else min(FIELD - 1, 1 + int(3 * np.log1p(max(0, n_chars))))
    out[2 * FIELD + size] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60, ridge: float = 1e-4) -> View:
    """Weighted logistic regression by accelerated gradient steps; the classes weigh the same."""
    weight = weight * np.where(y == 1, 0.5 / max(1e-9, weight[y == 1].sum()), 0.5 / max(1e-9, weight[y == 0].sum()))
    w, b, dw, db = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    rate = 4.0 / (1.0 + (x * x).sum(axis=1).max())
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ (w + 0.9 * dw) + b + 0.9 * db, -30, 30))) - y)
        dw = 0.9 * dw - rate * (error @ x + ridge * w)
        db = 0.9 * db - rate * error.sum()
        w, b = w + dw, b + db
    return View(w, float(b))


def _stacked(columns_: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Coefficients, not below zero, of log-odds and a constant, by Newton steps.

    Where one would be negative, the least of them is left out and the others and the constant are fitted again, so
    that the constant always belongs to the coefficients that count.
    """
    used, out = list(range(len(columns_))), np.zeros(len(columns_) + 1)
    while True:
        x = np.stack([*[columns_[i] for i in used], np.ones(len(y))], axis=1)
        beta, ridge = np.zeros(x.shape[1]), np.diag([0.05] * len(used) + [0.0005])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            beta += np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + ridge, x.T @ (y - p) - ridge @ beta)
        if not used or beta[:-1].min() >= 0:
            out[[*used, -1]] = beta
            return out
        used.pop(int(beta[:-1].argmin()))


def train(content: np.ndarray, page: np.ndarray, y: np.ndarray, how: Rounds) -> Model:
    """`y` is 0, 1, or -1 for the pool. One fold of the labelled rows is held back to calibrate and combine."""
    known = np.flatnonzero(y >= 0)
    held, used = known[:: how.folds], np.setdiff1d(known, known[:: how.folds])
    if len(np.unique(y[held])) < 2 or len(np.unique(y[used])) < 2:
        held = used = known
    pool = np.flatnonzero(y < 0)
    views, label = (content, page), [y.astype(float).copy(), y.astype(float).copy()]
    models: list[View] = []
    for turn in range(how.rounds + 1):
        models = []
        for x, own in zip(views, label, strict=True):
            rows = np.concatenate([used, pool[own[pool] >= 0]])
            weight = np.where(np.isin(rows, used), 1.0, 0.5)
            view = logistic(x[rows], own[rows], weight)
            view.slope, view.level = _stacked([view.raw(x[held])], y[held])
            models.append(view)
        if turn == how.rounds:
            break
        for giver, x, taker in ((0, content, 1), (1, page, 0)):
            free = pool[label[taker][pool] < 0]
            chance = 1 / (1 + np.exp(-np.clip(models[giver].calibrated(x[free]), -30, 30)))
            for side, sure in ((1, chance), (0, 1 - chance)):
                best = np.argsort(-sure, kind="stable")[: how.each]
                label[taker][free[best[sure[best] >= how.confident]]] = side
    share = _stacked([m.calibrated(x[held]) for m, x in zip(models, views, strict=True)], y[held])
    return Model(*models, share)


def _views():
    def work(texts: list, sources: list, langs: list, sizes: list, labels: list) -> dict[str, list]:
        pages = [page_view(*row) for row in zip(sources, langs, sizes, strict=True)]
        return {
            "content": [content_view(t).astype(np.float16).tobytes() for t in texts],
            "page": [p.astype(np.float16).tobytes() for p in pages],
            "quality": labels,
        }

    return work


def _pages(docs: DataFrame) -> DataFrame:
    return columns(docs, doc_id="long", text="string", source="string", lang="string", n_chars="long")


def fit(docs: DataFrame, labels: DataFrame, how: Rounds = Rounds()) -> Model | None:
    """A model from documents (doc_id, text, source, lang, n_chars) and labels (doc_id, quality); None without both.

    About `labelled` labelled documents and `pool` others are taken, by a hash of their ids, or of their text where
    there is no id. Rows that share an id, or have none and equal texts, are one document; the row of the least hash
    stands for it. Counted are documents with texts that are not too long.
    """
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    rated = rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    pages = _pages(docs).where((F.length("text") <= how.longest) | F.col("text").isNull())
    nameless = pages.where("doc_id is null")
    mark = F.xxhash64("text").alias("mark")
    ids = pages.where("doc_id is not null").select("doc_id").distinct().join(rated, "doc_id", "left")
    ids = Scratch(docs.sparkSession).keep(ids.select("doc_id", F.coalesce("quality", F.lit(-1)).cast("int").alias("quality")))
    counts = {r["quality"]: r["count"] for r in ids.groupBy("quality").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    others = max(1, counts.get(-1, 0) + nameless.select(mark).distinct().count())
    share = F.lit(how.pool / others)
    for label in (0, 1):
        share = F.when(F.col("quality") == label, F.lit(how.labelled / 2 / counts[label])).otherwise(share)
    rows = pages.join(F.broadcast(ids.where(drawn(share, "doc_id"))), "doc_id")
    rows = rows.unionByName(nameless.where(drawn(F.lit(how.pool / others), mark)).withColumn("quality", F.lit(-1)))
    # One row each.
    whole = F.struct(mark, "text", "source", "lang", "n_chars", "quality")
    rows = rows.groupBy("doc_id", F.when(F.col("doc_id").isNull(), mark).alias("of_text")).agg(F.min(whole).alias("row")).select("row.*")
    made = per_batch(
        rows.select("text", "source", "lang", "n_chars", "quality"),
        "content binary, page binary, quality int",
        _views,
    ).collect()
    made.sort(key=lambda r: (bytes(r["content"]), bytes(r["page"]), r["quality"]))
    mixed_order = np.argsort(mixed(np.arange(len(made), dtype=np.uint64)))
    made = [made[i] for i in mixed_order]
    content, page = (
        np.stack([np.frombuffer(bytes(r[name]), np.float16) for r in made]).astype(np.float32) for name in ("content", "page")
    )
    return train(content, page, np.array([r["quality"] for r in made]), how)


def _score(model: Model | None):
    def work(ids: list, texts: list, sources: list, langs: list, sizes: list) -> dict[str, list]:
        if model is None:
            return {"doc_id": ids} | {name: [None] * len(ids) for name in ("content_score", "page_score", "score")}
        out = []
        for first in range(0, len(ids), 500):
            part = slice(first, first + 500)
            content = np.stack([content_view(t) for t in texts[part]])
            page = np.stack([page_view(*r) for r in zip(sources[part], langs[part], sizes[part], strict=True)])
            odds = [model.content.calibrated(content), model.page.calibrated(page)]
            both = model.share[0] * odds[0] + model.share[1] * odds[1] + model.share[2]
            out.append(1 / (1 + np.exp(-np.clip([*odds, both], -30, 30))))
        content_score, page_score, score = np.concatenate(out, axis=1)
        return {"doc_id": ids, "content_score": content_score, "page_score": page_score, "score": score}

    return work


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, content_score, page_score, score (0 to 1, of quality 1) and predicted of each document.

    The whole text counts. NULLs in any column are values of their own: an unknown source or language, no length, no
    text. Without a model (no labels of both kinds) the scores and the prediction are NULL. Rows that repeat are
    scored each; ids are only passed on.
    """
    schema = "doc_id long, content_score double, page_score double, score double"
    scored = per_batch(_pages(docs), schema, lambda: _score(model))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
