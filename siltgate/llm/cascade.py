"""Quality rules as a short-circuit cascade, ordered by what each rejects per second it takes."""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import columns, encoded, per_batch, window_hashes, word_hashes

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK_LINE = re.compile(r"[\x20\x09-\x0D]*\Z")
_CAPITAL = re.compile(r"[^\W\d_a-z]", re.ASCII)


class Page:
    """One text; what a rule needs of it is computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return encoded(self.text)

    @cached_property
    def codes(self) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.data)

    @property
    def n_words(self) -> int:
        return len(self.hashes)

    @cached_property
    def word_chars(self) -> int:
        return int(len(self.codes) - ((self.codes & 0xC0) == 0x80).sum() - _SPACE[self.codes].sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(_SYMBOL[self.codes].sum())

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if not _BLANK_LINE.match(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        windows = window_hashes(self.hashes, 3)
        order = np.sort(windows)
        if not (order[1:] == order[:-1]).any():
            return 0
        _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
        steps = np.zeros(self.n_words + 1, np.int32)
        starts = np.flatnonzero(counts[place] > 1)
        steps[starts] += 1
        steps[starts + 3] -= 1
        return int((np.cumsum(steps) > 0).sum())

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Page], bool]


def _shouting(page: Page) -> bool:
    capitals = len(_CAPITAL.findall(page.text))
    return 2 * capitals > page.word_chars


RULES = (
    Rule("base", lambda p: p.base_failed),
    Rule("word_length", lambda p: not 2 * p.n_words <= p.word_chars <= 15 * p.n_words),
    Rule("symbols", lambda p: 10 * p.n_symbols > p.n_words),
    Rule("repeated_lines", lambda p: p.n_dup_lines > 2 and 10 * p.n_dup_lines > 3 * len(p.lines)),
    Rule("shouting", _shouting),
    Rule("compressible", lambda p: 10 * len(zlib.compress(p.data, 1)) < len(p.data)),
)


@dataclass(frozen=True)
class Sample:
    """Rows, about, on which cost and selectivity are estimated. They decide the order of rules, never a verdict."""

    rows: int = 2000


def _measure(rules: Sequence[Rule]):
    def work(texts: list) -> dict[str, list]:
        masks, costs = [], []
        for text in texts:
            mask, spent = 0, []
            for i, rule in enumerate(rules):
                page = Page(text)  # a new one, so that no rule gains from another's work
                start = time.perf_counter_ns()
                mask |= rule.rejects(page) << i
                spent.append(time.perf_counter_ns() - start)
            masks.append(mask)
            costs.append(spent)
        return {"mask": masks, "cost": costs}

    return work


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: Sample = Sample()) -> list[int]:
    """Numbers of the rules, each next one rejecting most, per time, of the sample's rows that are left.

    Spark sums up rows and time by the set of rules that reject a row, of which there are few.
    """
    rows = docs.count()
    texts = columns(docs, doc_id="long", text="string")
    if rows > sample.rows:
        texts = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < 1_000_000 * sample.rows / rows)
    measured = per_batch(texts.select("text"), "mask long, cost array<long>", lambda: _measure(rules))
    sums = [F.sum(F.get("cost", F.lit(i))).alias(f"c{i}") for i in range(len(rules))]
    met = measured.groupBy("mask").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    cost = [sum(r[f"c{i}"] for r in met) + 1 for i in range(len(rules))]
    order: list[int] = []
    while len(order) < len(rules):
        left = [r for r in met if not any(r.mask >> i & 1 for i in order)]
        rest = [i for i in range(len(rules)) if i not in order]
        order.append(max(rest, key=lambda i: (sum(r.n for r in left if r.mask >> i & 1) / cost[i], -cost[i])))
    return order


def _judge(rules: Sequence[Rule], order: Sequence[int]):
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def work(ids: list, texts: list) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids} | {c: [] for c in (*counts, "base_failed", "kept", "rejected_by")}
        for text in texts:
            page = Page(text)
            by = next((rules[i].name for i in order if rules[i].rejects(page)), None)
            for name in (*counts, "base_failed"):
                out[name].append(getattr(page, name))
            out["kept"].append(by is None)
            out["rejected_by"].append(by)
        return out

    return work


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: Sample = Sample()) -> DataFrame:
    """Each row of (doc_id, text) with its counts, and whether all rules let it pass.

    Rules are tried in the order of `rule_order` until one rejects, which `rejected_by` names. The verdict does not
    depend on the order; the name may, as times differ between runs. The base rule is always among the rules.
    NULL and empty texts have counts of 0 and are rejected by the base rule. Rows that repeat are judged each; ids
    are passed on as they are, NULL too. Texts are taken whole. No rows give no rows.
    """
    if not any(r.name == "base" for r in rules):
        rules = (RULES[0], *rules)
    order = rule_order(docs, rules, sample)
    return per_batch(
        columns(docs, doc_id="long", text="string"),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, rejected_by string",
        lambda: _judge(rules, order),
    )
