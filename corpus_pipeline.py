"""A training corpus from the documents: toxicity, near duplicates, test leaks, secrets, packing.

Each stage is a function of (spark, docs, sf_dir). `run` writes the result of each as Parquet and reads it again as the
next one's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import toxicity
from siltgate.llm.decontamination import contaminated
from siltgate.llm.minhash import near_duplicates
from siltgate.llm.packing import pack_documents
from siltgate.llm.secrets import mask_secrets
from siltgate.llm.text import Scratch, among, without

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score is one half or more. All labels are learned from."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.score_toxicity(docs, model, with_spans=False)
    bad = scored.where("score >= 0.5").select("doc_id", "mark").distinct()
    return without(docs, Scratch(spark).keep(bad))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, a similarity of 0.85): of the least id, NULL last.

    Of rows with that id the one of the least hash of its text stays. Rows are judged by their own text, whether they
    have an id or share one. Rows that repeat an id, or NULL, and its text stay once.
    """
    scratch = Scratch(spark)
    judged = scratch.keep(near_duplicates(docs))
    rest = without(docs, scratch.keep(judged.where("not stays").select("doc_id", "mark").distinct()))
    again = judged.where("stays").groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark")
    again = scratch.keep(again)
    if again.isEmpty():
        return rest
    return without(rest, again).unionByName(among(rest, again).dropDuplicates(["doc_id", "text"]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that contain an item of the benchmark."""
    found = contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return without(docs, Scratch(spark).keep(found.select("doc_id", "mark").distinct()))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and `n_chars` counted anew where that changed the text."""
    return mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences, with their token ids."""
    return pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", hide_secrets),
    ("packing", pack),
]

# Trained scores and token ids cannot be had from SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, on the documents of `sf_dir`."""
    docs, scratch = _table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
