"""URL filtering: rules first, gradient-boosted trees on lexical features for the rest, all in DataFrame functions."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, columns, drawn, sized

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Gradients are added up as whole multiples of this, so that sums do not depend on the order of rows.
_UNIT = 2.0**-24


@dataclass(frozen=True)
class UrlRule:
    """Fits `host` and its subdomains where the path starts with `path`."""

    verdict: Literal["block", "allow"]
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        same = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return same & F.col("path").startswith(self.path)


@dataclass(frozen=True)
class Boosting:
    """`sample` bounds the labelled URLs that the trees are fitted to; suffix statistics count all of the other half."""

    sample: int = 16_000
    trees: int = 8
    depth: int = 3
    bins: int = 16
    rate: float = 0.6
    ridge: float = 1.0
    smoothing: float = 2.0


@dataclass(frozen=True)
class Split:
    """Rows whose feature is at most `most` go left."""

    feature: str
    most: float


Tree = dict[int, Split | float]  # by node: 1, below it 2 and 3, and so on; numbers are leaves
Cells = dict[str, dict[float, tuple[float, float]]]  # sums of gradients and curvatures by feature and bin


@dataclass(frozen=True)
class Model:
    prior: float = 0.0  # share of blocked URLs, smoothed
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)


def with_parts(pages: DataFrame) -> DataFrame:
    """`host` and `path` of `url`, both empty where it is NULL or has no `://`."""
    after = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    pages = pages.withColumn("_after", after)
    return pages.withColumns(
        {
            "host": F.translate(F.regexp_extract("_after", "^[^/?#]*", 0), _CAPITALS, _SMALL),
            "path": F.regexp_extract("_after", "^[^/?#]*([^?#]*)", 1),
        }
    ).drop("_after")


def rule_of(rules: Sequence[UrlRule]) -> Column:
    """The name of the longest rule that fits, NULL if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return reduce(lambda rest, r: F.when(r.fits(), F.lit(r.name)).otherwise(rest), reversed(ordered), F.lit(None).cast("string"))


# Features that the URL alone gives, as SQL over `u` (the URL, not NULL), `host` and `path`.
_LEXICAL = {
    "length": "length(u)",
    "host_length": "length(host)",
    "path_length": "length(path)",
    "depth": "length(path) - length(replace(path, '/', ''))",
    "labels": "length(host) - length(replace(host, '.', ''))",
    "longest_label": "array_max(transform(split(host, '[.]'), x -> length(x)))",
    "digit_ratio": "regexp_count(u, '[0-9]') / greatest(length(u), 1)",
    "host_digits": "regexp_count(host, '[0-9]')",
    "hyphens": "length(u) - length(replace(u, '-', ''))",
    "escapes": "length(u) - length(replace(u, '%', ''))",
    "parameters": "if(instr(u, '?') > 0, 1 + length(u) - length(replace(u, '&', '')), 0)",
    "fragment": "if(instr(u, '#') > 0, 1, 0)",
    "secure": "if(startswith(lower(u), 'https:'), 1, 0)",
    "entropy": (
        "aggregate(transform(filter(array_distinct(split(u, '')), c -> c <> ''),"
        " c -> (length(u) - length(replace(u, c, ''))) / length(u)), 0D, (s, p) -> s - p * log2(greatest(p, 1e-9)))"
    ),
}
# What suffixes are counted by: the last label, the last two, and these with the first folder of the path.
_SUFFIXES = {
    "top": "substring_index(host, '.', -1)",
    "domain": "substring_index(host, '.', -2)",
    "folder": "concat(substring_index(host, '.', -2), '/', regexp_extract(path, '^/([^/]*)', 1))",
}
FEATURES = [*_LEXICAL, *[f"{s}_{what}" for s in _SUFFIXES for what in ("seen", "blocked")]]


def _lexical(pages: DataFrame) -> DataFrame:
    known = pages.withColumn("u", F.coalesce("url", F.lit("")))
    return known.withColumns({name: F.expr(f"cast({sql} as double)") for name, sql in _LEXICAL.items()}).drop("u")


def suffix_counts(labelled: DataFrame, scratch: Scratch) -> dict[str, tuple[DataFrame, int]]:
    """How often each suffix was labelled and blocked. Frequent suffixes are counted before the shuffle."""
    made = {}
    for name, sql in _SUFFIXES.items():
        counts = labelled.groupBy(F.expr(sql).alias(f"_{name}")).agg(
            F.count(F.lit(1)).alias(f"_{name}_n"), F.sum("blocked").alias(f"_{name}_blocked")
        )
        kept = scratch.keep(counts)
        made[name] = (kept, kept.count())
    return made


def _with_suffixes(pages: DataFrame, counts: dict[str, tuple[DataFrame, int]], prior: float, how: Boosting) -> DataFrame:
    """Suffix features; shares of seldom or never labelled suffixes lean on those of the next wider one."""
    wider = F.lit(prior)
    for name, sql in _SUFFIXES.items():
        table, n = counts[name]
        pages = pages.withColumn(f"_own_{name}", F.expr(sql))
        same = F.col(f"_own_{name}") == F.col(f"_{name}")
        pages = pages.join(sized(table, n, 400), same, "left")
        seen, blocked = (F.coalesce(f"_{name}_{c}", F.lit(0)) for c in ("n", "blocked"))
        pages = pages.withColumns(
            {
                f"{name}_seen": F.log2(seen + F.lit(1.0)),
                f"{name}_blocked": (blocked + wider * how.smoothing) / (seen + how.smoothing),
            }
        ).drop(f"_own_{name}", f"_{name}", f"_{name}_n", f"_{name}_blocked")
        wider = F.col(f"{name}_blocked")
    return pages


def _node(tree: Tree, node: int = 1) -> Column:
    """The node a row has come to, below what is known of a tree."""
    if not isinstance(tree.get(node), Split):
        return F.lit(node)
    split = tree[node]
    left = F.col(split.feature) <= split.most
    return F.when(left, _node(tree, 2 * node)).otherwise(_node(tree, 2 * node + 1))


def _value(tree: Tree, node: int = 1) -> Column:
    held = tree[node]
    if not isinstance(held, Split):
        return F.lit(held)
    return F.when(F.col(held.feature) <= held.most, _value(tree, 2 * node)).otherwise(_value(tree, 2 * node + 1))


def margin(model: Model) -> Column:
    """Log-odds of `block`."""
    return reduce(lambda a, b: a + b, [_value(t) for t in model.trees], F.lit(model.base))


def _gain(g: float, h: float, how: Boosting) -> float:
    return g * g / (h + how.ridge)


def _leaf(cells: Iterable[tuple[float, float]], how: Boosting) -> float:
    sums = [sum(c) for c in zip(*cells, strict=True)] or [0.0, 0.0]
    return -how.rate * sums[0] / (sums[1] + how.ridge)


def _best(cells: Cells, how: Boosting) -> Split | None:
    """The split of one node with the greatest gain, of equal ones the first; None if none gains."""
    most, best = 1e-6, None
    for feature, bins in sorted(cells.items()):
        all_g, all_h = (sum(sums) for sums in zip(*bins.values(), strict=True))
        g = h = 0.0
        for top in sorted(bins)[:-1]:
            g, h = g + bins[top][0], h + bins[top][1]
            gain = _gain(g, h, how) + _gain(all_g - g, all_h - h, how) - _gain(all_g, all_h, how)
            if min(h, all_h - h) >= 1e-3 and gain > most + 1e-9:
                most, best = gain, Split(feature, top)
    return best


def _grown(binned: DataFrame, chance: Column, how: Boosting) -> Tree:
    """One tree, level by level: an aggregation of gradients by node, feature and bin for each level."""
    tree, values, undecided = {}, {1: 0.0}, [1]
    for _ in range(how.depth):
        at = binned.select("tops", _node(tree).alias("node"), (chance - F.col("blocked")).alias("g"), chance.alias("p"))
        whole = [F.round(x / _UNIT).cast("long") for x in (F.col("g"), F.col("p") * (1 - F.col("p")))]
        cell = at.where(F.col("node").isin(undecided)).select(
            "node", whole[0].alias("g"), whole[1].alias("h"), F.explode("tops").alias("cell")
        )
        sums = cell.groupBy("node", "cell.feature", "cell.top").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        nodes: dict[int, Cells] = {}
        for r in sums.collect():
            bins = nodes.setdefault(r["node"], {}).setdefault(r["feature"], {})
            bins[r["top"]] = (r["g"] * _UNIT, r["h"] * _UNIT)
        further = []
        for node in undecided:
            split = _best(nodes.get(node, {}), how)
            tree[node] = split or values[node]
            if split:
                bins = nodes[node][split.feature]
                values[2 * node] = _leaf([v for top, v in bins.items() if top <= split.most], how)
                values[2 * node + 1] = _leaf([v for top, v in bins.items() if top > split.most], how)
                further += [2 * node, 2 * node + 1]
        undecided = further
    return tree | {node: values[node] for node in undecided}


def boosted(sample: DataFrame, prior: float, how: Boosting) -> Model:
    """Trees for log-loss on `sample`, which has FEATURES and `blocked`.

    It has a bounded number of rows and is read as one partition, so that the aggregations need no shuffle. Only sums
    by node, feature and bin come to the driver. They are sums of whole numbers, so the same rows give the same trees
    however they lie.
    """
    sample = sample.coalesce(1)
    steps = [i / how.bins for i in range(1, how.bins)]
    row = sample.agg(*[F.percentile_approx(f, steps, 10_000).alias(f) for f in FEATURES]).first()

    def top(feature: str) -> Column:
        held = F.lit(math.inf)
        for cut in sorted(set(row[feature] or []), reverse=True):
            held = F.when(F.col(feature) <= cut, F.lit(float(cut))).otherwise(held)
        return held

    tops = F.array(*[F.struct(F.lit(f).alias("feature"), top(f).alias("top")) for f in FEATURES])
    binned = sample.withColumn("tops", tops)
    model = Model(prior, math.log((prior + 1e-3) / (1 - prior + 1e-3)))
    for _ in range(how.trees):
        model.trees.append(_grown(binned, 1 / (1 + F.exp(-margin(model))), how))
    return model


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], how: Boosting = Boosting()) -> DataFrame:
    """Each row of (page_id, url) with host, path, rule, verdict and `block_score` (0 to 1).

    A rule that fits decides, the longest first. Its verdicts are also the labels that the rest is judged by: among
    URLs with a rule, half (by a hash of the URL) give suffix statistics, all of them, and from the other half a
    sample of at most about `sample` distinct URLs, alike of both kinds, fits the trees. All pages are then scored by
    one expression, and a score over one half blocks.

    Native throughout: DataFrame functions and aggregations; suffix statistics are broadcast if measured small enough
    and joined by shuffle beyond that. A NULL URL, and one without `://`, has an empty host and path and no rule, and
    is judged by its (empty) features. Without labels of both kinds the verdict is that of the only kind, `allow` if
    there is none. Repeated rows and ids are returned each; long URLs count whole. No rows give no rows.
    """
    scratch = Scratch(pages.sparkSession)
    urls = with_parts(columns(pages, page_id="long", url="string")).withColumn("rule", rule_of(rules))
    verdicts = {r.name: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for name, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    urls = urls.withColumn("by_rule", by_rule)

    labelled = urls.where("rule is not null").withColumn("blocked", (F.col("by_rule") == "block").cast("long"))
    labelled = labelled.withColumn("half", F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)))
    total, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    if not 0 < blocked < total:
        only = "block" if blocked else "allow"
        scored = urls.withColumn("block_score", F.lit(float(bool(blocked))))
        return _judged(scored, F.lit(only))

    prior = blocked / total
    counts = suffix_counts(labelled.where("half = 0"), scratch)
    distinct = scratch.keep(labelled.where("half = 1").select("url", "host", "path", "blocked").distinct())
    sizes = {r["blocked"]: r["count"] for r in distinct.groupBy("blocked").count().collect()}
    share = F.lit(1.0)
    for kind, n in sizes.items():
        share = F.when(F.col("blocked") == kind, F.lit(how.sample / 2 / n)).otherwise(share)
    chosen = distinct.where(drawn(share, "url"))
    sample = scratch.keep(_with_suffixes(_lexical(chosen), counts, prior, how).select("blocked", *FEATURES).coalesce(1))
    model = boosted(sample, prior, how)
    scored = _with_suffixes(_lexical(urls), counts, prior, how).withColumn("block_score", 1 / (1 + F.exp(-margin(model))))
    return _judged(scored, F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))


def _judged(scored: DataFrame, by_score: Column) -> DataFrame:
    verdict = F.coalesce("by_rule", by_score)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
