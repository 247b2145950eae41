"""The corpus pipeline: every stage on awkward rows, and the whole on the sample tables."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltgate.llm.text import Scratch

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def odd(spark):
    words = [f"w{i}" for i in range(60)]
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    texts = [
        (1, None), (2, ""), (3, " ".join(words)), (4, " ".join([*words[:59], "other"])), (5, "clean short text"),
        (5, "clean short text"), (None, "no id at all"), (None, "no id at all"), (None, None),
        (6, f"before {leak} after"), (7, "see password=hunter2hunter2 here"), (8, "x" * 300_000),
    ]
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "e") for i, t in texts], COLUMNS)


def kept(df):
    return sorted(str(r.doc_id) for r in df.collect())


def test_stages_keep_columns_and_clean_documents(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd.limit(0), SF).count() == 0
    assert kept(corpus_pipeline.drop_toxic(spark, odd, SF)) == kept(odd)
    # 4 is a near copy of 3; of rows that repeat one stays.
    assert kept(corpus_pipeline.drop_near_duplicates(spark, odd, SF)) == sorted(["1", "2", "3", "5", "6", "7", "8", "None", "None"])
    assert kept(corpus_pipeline.drop_leaks(spark, odd, SF)) == sorted(x for x in kept(odd) if x != "6")
    masked = {r.doc_id: r for r in corpus_pipeline.hide_secrets(spark, odd, SF).collect()}
    assert (masked[7].text, masked[7].n_chars) == ("see [SECRET] here", 17)
    assert len(masked) == len({r.doc_id for r in odd.collect()})
    assert corpus_pipeline.pack(spark, odd, SF).agg(F.countDistinct("doc_id")).first()[0] == 8


def test_near_duplicates_are_dropped_by_their_own_text(spark):
    base = [[f"{k}{i}" for i in range(60)] for k in "abcd"]
    full = [" ".join(b) for b in base]
    near = [" ".join([*b[:59], "other"]) for b in base]
    texts = [
        (1, full[0]), (None, near[0]), (None, full[0]),  # copies without an id of a document that has one
        (None, full[1]), (None, near[1]), (None, full[1]),  # copies among rows without an id
        (2, full[2]), (3, near[2]), (3, "clean and linked with nothing"),  # one id, one text of it a copy
        (4, full[3]), (4, full[3].upper()), (4, full[3].replace(" ", "  ")),  # one id and set, three texts
        (None, None), (5, ""),
    ]
    docs = spark.createDataFrame([(i, t, None, "s", 0, "e") for i, t in texts], COLUMNS)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(str(i) for i, _ in got) == sorted(["1", "None", "2", "3", "4", "None", "5"])
    assert (1, full[0]) in got and (3, "clean and linked with nothing") in got and (None, None) in got
    assert len([t for i, t in got if i is None and t in (full[1], near[1])]) == 1


def test_whole_pipeline_against_plain_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, stages = Scratch(spark), dict(corpus_pipeline.STAGES)
    left = scratch.keep(stages["toxicity"](spark, docs, SF))
    once = scratch.keep(stages["near_duplicates"](spark, left, SF))
    texts = [r.text for r in once.select("text").collect()]
    assert len(set(texts)) == len(texts)
    clean = scratch.keep(stages["decontamination"](spark, once, SF))
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in once.collect() if any(i in " ".join(re.findall(r"\w+", r.text.lower())) for i in items)}
    assert leaks and leaks <= {r.doc_id for r in once.collect()} - {r.doc_id for r in clean.collect()}
    safe = scratch.keep(stages["secrets"](spark, clean, SF))
    assert safe.count() == clean.count()
    assert safe.where("text rlike 'AKIA[A-Z0-9]{12}'").count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in safe.collect()}
