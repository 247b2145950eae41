"""Language of a text by a byte convolutional network, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import columns, encoded, per_batch

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Network:
    """Shape and training. `per_language` bounds the documents learned from, `languages` the classes."""

    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    window: int = 256
    per_language: int = 800
    languages: int = 200
    windows_each: int = 3
    epochs: int = 4
    batch: int = 64
    rate: float = 0.1
    seed: int = 11


@dataclass
class Model:
    names: list[str]
    filters: list[np.ndarray]  # one array (width, 256, filters) per width
    dense: np.ndarray
    bias: np.ndarray


def _windows(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in windows of fixed length, the last one filled up with zeros; bytes in each."""
    n = max(1, -(-len(data) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(n, size)
    lengths[-1] = len(data) - (n - 1) * size
    return out.reshape(n, size), lengths


def _convolved(windows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    width, last = len(weights), windows.shape[1] - len(weights) + 1
    return sum(weights[j][windows[:, j : j + last]] for j in range(width))


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, names: list[str], net: Network) -> Model:
    """Adagrad on softmax loss; through a maximum only the place where it was reached learns."""
    random = np.random.default_rng(net.seed)
    n, k = net.filters, len(names)
    filters = [random.normal(0, 0.3, (w, 256, n)).astype(np.float32) for w in net.widths]
    for weights in filters:
        weights[:, 0] = 0  # filling has no effect
    dense, bias = random.normal(0, 0.1, (n * len(filters), k)).astype(np.float32), np.zeros(k, np.float32)
    parameters = [*filters, dense, bias]
    squares = [np.full_like(p, 1e-2) for p in parameters]
    for _ in range(net.epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), net.batch):
            x, y = windows[order[at : at + net.batch]], labels[order[at : at + net.batch]]
            maps = [_convolved(x, w) for w in filters]
            where = [m.argmax(axis=1) for m in maps]
            pooled = np.concatenate([m.max(axis=1) for m in maps], axis=1)
            active = np.maximum(pooled, 0)
            error = _softmax(active @ dense + bias)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ dense.T) * (pooled > 0)
            slopes = []
            for i, weights in enumerate(filters):
                slope, part = np.zeros_like(weights), back[:, i * n : (i + 1) * n]
                for j in range(len(weights)):
                    codes = np.take_along_axis(x, where[i] + j, axis=1)
                    np.add.at(slope[j], (codes, np.arange(n)[None, :]), part)
                slope[:, 0] = 0
                slopes.append(slope)
            for p, s, g in zip(parameters, squares, [*slopes, active.T @ error, error.sum(axis=0)], strict=True):
                s += g * g
                p -= net.rate * g / np.sqrt(s)
    return Model(names, filters, dense, bias)


def _training_windows(net: Network):
    def work(langs: list, texts: list) -> dict[str, list]:
        names, parts = [], []
        for lang, text in zip(langs, texts, strict=True):
            windows, lengths = _windows(encoded(text), net.window)
            chosen = np.linspace(0, len(windows) - 1, min(net.windows_each, len(windows))).astype(int)
            for i in chosen:
                if lengths[i]:
                    names.append(lang)
                    # Half of the windows are cut short, for short texts; which ones is up to their bytes.
                    cut = windows[i].copy()
                    if xxhash.xxh3_64_intdigest(cut.tobytes()) % 2:
                        cut[max(16, lengths[i] // 4) :] = 0
                    parts.append(cut.tobytes())
        return {"lang": names, "window": parts}

    return work


def fit(docs: DataFrame, eligible: Column, net: Network = Network()) -> Model | None:
    """A model from rows of (doc_id, text, lang) where `eligible` holds; None if there are none.

    Of each language about `per_language` rows are taken, by a hash of id and text, and up to three windows of each.
    """
    rows = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Rows that agree in id and text are one; they are drawn all or none.
    one = F.approx_count_distinct(F.xxhash64("doc_id", "text"))
    counts = rows.groupBy("lang").agg(one.alias("count")).orderBy(F.desc("count"), "lang").limit(net.languages).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, net.per_language / row["count"]))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share * 1_000_000)
    sample = sample.groupBy("doc_id", "text").agg(F.min("lang").alias("lang")).select("lang", "text")
    got = per_batch(sample, "lang string, window binary", lambda: _training_windows(net)).collect()
    got = sorted((r["lang"], bytes(r["window"])) for r in got)
    names = sorted({lang for lang, _ in got})
    if not names:
        return None
    windows = np.frombuffer(b"".join(w for _, w in got), np.uint8).reshape(len(got), net.window)
    return train(windows, np.array([names.index(lang) for lang, _ in got]), names, net)


class Tables:
    """The filters as sums over pairs of bytes, which halves the look-ups."""

    def __init__(self, model: Model):
        self.model = model
        self.pairs = []
        for weights in model.filters:
            steps: list[tuple[int, int, np.ndarray]] = []
            for j in range(0, len(weights) - 1, 2):
                both = weights[j][:, None, :] + weights[j + 1][None, :, :]
                steps.append((j, 2, np.ascontiguousarray(both.reshape(65536, -1))))
            if len(weights) % 2:
                steps.append((len(weights) - 1, 1, weights[-1]))
            self.pairs.append((len(weights), steps))

    def logits(self, windows: np.ndarray) -> np.ndarray:
        codes = windows.astype(np.intp)
        double = codes[:, :-1] * 256 + codes[:, 1:]
        pooled = []
        for width, steps in self.pairs:
            last = windows.shape[1] - width + 1
            parts = [table[(double if n == 2 else codes)[:, j : j + last]] for j, n, table in steps]
            total = parts[0]
            for part in parts[1:]:
                total += part
            pooled.append(total.max(axis=1))
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.model.dense + self.model.bias


def _predict(model: Model | None, net: Network):
    tables = Tables(model) if model else None

    def work(ids: list, texts: list) -> dict[str, list]:
        langs, scores = [UNKNOWN] * len(ids), [0.0] * len(ids)
        for i, text in enumerate(texts):
            if not tables or not text or not _LETTER.search(text):
                continue
            windows, lengths = _windows(encoded(text), net.window)
            total = np.zeros(len(model.names))
            for at in range(0, len(windows), 256):
                total += lengths[at : at + 256] @ tables.logits(windows[at : at + 256])
            chances = _softmax((total / lengths.sum())[None, :])[0]
            best = int(chances.argmax())
            langs[i], scores[i] = model.names[best], float(chances[best])
        return {"doc_id": ids, "lang_pred": langs, "score": scores}

    return work


def identify(docs: DataFrame, model: Model | None, net: Network = Network()) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of each row of (doc_id, text), from the whole text.

    The windows' outputs are averaged by their length in bytes. NULL text and text without a letter is `und` with
    score 0, as is everything without a model. Rows that repeat are judged each, and ids are only passed on.
    """
    texts = columns(docs, doc_id="long", text="string")
    return per_batch(texts, "doc_id long, lang_pred string, score double", lambda: _predict(model, net))
