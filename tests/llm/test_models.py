"""The trained operators' parts against plain versions, and what they do on labels they were not taught."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm import cotraining, language, queries
from siltgate.llm.cotraining import Rounds, _stacked
from siltgate.llm.language import Model, Network, Tables


def test_pairs_of_bytes_give_the_plain_convolution():
    random = np.random.default_rng(1)
    filters = [random.normal(size=(w, 256, 4)).astype(np.float32) for w in (2, 3, 4)]
    model = Model(["a", "b"], filters, random.normal(size=(12, 2)).astype(np.float32), np.array([0.5, -1], np.float32))
    windows = random.integers(0, 256, (9, 40)).astype(np.uint8)
    pooled = []
    for weights in filters:
        width = len(weights)
        sums = [[sum(weights[j, w[at + j]] for j in range(width)) for at in range(41 - width)] for w in windows]
        pooled.append(np.array(sums).max(axis=1))
    expected = np.maximum(np.concatenate(pooled, axis=1), 0) @ model.dense + model.bias
    np.testing.assert_allclose(Tables(model).logits(windows), expected, rtol=1e-4, atol=1e-4)


def test_text_without_a_letter_is_undetermined(spark):
    model = Model(["en"], [np.zeros((2, 256, 1), np.float32)], np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    texts = ["² ½ Ⅷ 12", "①_٣", "", None, "…—!", "é", "漢", "ª", "x1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert [made[i] for i in range(9)] == ["und"] * 5 + ["en"] * 4
    assert language.identify(docs.limit(0), model).count() == 0


def test_the_language_model_does_not_depend_on_how_rows_lie(spark):
    docs, net = queries.table(spark, "/root/testdata/sf0.001", "documents"), Network(epochs=1, per_language=30)
    one, other = (language.fit(docs.repartition(n), F.lit(True), net) for n in (1, 7))
    for a, b in zip([*one.filters, one.dense], [*other.filters, other.dense], strict=True):
        np.testing.assert_array_equal(a, b)


def test_repeated_rows_do_not_fill_the_language_sample(spark, monkeypatch):
    rows = [(1, "the same row again and again", "en")] * 3000 + [(i, f"row {i} of its own", "en") for i in range(2, 500)]
    got = []
    monkeypatch.setattr(language, "train", lambda windows, labels, names, net: got.append(len(windows)))
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), Network(per_language=200))
    assert 120 < got[0] < 300


def log_loss(z, y):
    return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z))))


def test_coefficients_are_the_best_that_are_not_negative():
    random = np.random.default_rng(3)
    for case in range(12):
        y = (random.random(300) < 0.4).astype(float)
        one = (2 * y - 1) * random.uniform(0.3, 2) + random.normal(size=300)
        other = (1 - 2 * y) * random.uniform(0, 1) * (case % 2) + random.normal(size=300)
        share = _stacked([one, other], y)
        z = share[0] * one + share[1] * other + share[2]
        assert share[:2].min() >= 0
        # No small step that stays above zero is better, least of all one of the constant alone.
        for step in np.concatenate([np.eye(3), -np.eye(3)]) * 0.02:
            near = np.append(np.maximum(share[:2] + step[:2], 0), share[2] + step[2])
            assert log_loss(near[0] * one + near[1] * other + near[2], y) >= log_loss(z, y) - 2e-4
        assert log_loss(z, y) <= min(log_loss(_stacked([one], y)[0] * one + _stacked([one], y)[1], y), 1) + 1e-3


@pytest.fixture(scope="module")
def rated(spark):
    """Both views of all documents at sf0.1, and their labels."""
    got, real = [], cotraining.train
    docs, labels = (queries.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    cotraining.train = lambda *given: got.append(given)
    try:
        cotraining.fit(docs, labels, Rounds(labelled=10**6, pool=10**6))
    finally:
        cotraining.train = real
    return got[0][:3]


def test_the_combined_score_is_not_below_the_better_view(rated):
    content, page, y = rated
    known, fold = np.flatnonzero(y >= 0), np.arange(len(y)) % 4
    right = []
    for f in range(4):
        held = known[fold[known] == f]
        rows = np.setdiff1d(np.arange(len(y)), held)
        model = cotraining.train(content[rows], page[rows], y[rows], Rounds())
        odds = [model.content.calibrated(content[held]), model.page.calibrated(page[held])]
        odds.append(model.share[0] * odds[0] + model.share[1] * odds[1] + model.share[2])
        right.append([np.mean((z >= 0) == (y[held] == 1)) for z in odds])
    one, other, both = np.mean(right, axis=0)
    assert both >= max(one, other) - 0.004 and both >= 0.96


def test_labels_are_exchanged_between_views(monkeypatch):
    """One view tells nothing of labelled rows apart; it learns from labels that the other one passes on."""
    random = np.random.default_rng(5)
    n = 1200
    truth = random.random(n) < 0.5
    content = np.stack([truth * 2.0 - 1 + random.normal(0, 0.3, n), np.ones(n)], axis=1)
    page = np.stack([truth * 2.0 - 1 + random.normal(0, 0.3, n), np.ones(n)], axis=1)
    y = np.full(n, -1)
    y[:100] = truth[:100]
    page[:100, 0] = 0
    held = slice(700, None)

    def right(rounds):
        model = cotraining.train(content[:700], page[:700], y[:700], dataclasses.replace(Rounds(), rounds=rounds))
        return np.mean((model.page.raw(page[held]) >= 0) == truth[held])

    assert right(0) < 0.7 and right(4) > 0.95
