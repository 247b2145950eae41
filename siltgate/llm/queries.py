"""The queries of the text operators, with SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import cotraining, language, oracles, toxicity
from siltgate.llm.cascade import judge
from siltgate.llm.decontamination import contaminated
from siltgate.llm.minhash import near_duplicates
from siltgate.llm.packing import pack_documents
from siltgate.llm.preferences import format_preferences, swapped_answers
from siltgate.llm.prefix_trie import grafted_trie
from siltgate.llm.secrets import scan_secrets
from siltgate.llm.spelling import spelling_variants
from siltgate.llm.substring import remove_repeats
from siltgate.llm.url_filter import UrlRule, judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def remainder(by: int) -> Column:
    """Of the checksum of a document's id as text; splits documents into those learned from and those held out."""
    return F.crc32(F.col("doc_id").cast("string")) % by


def listed(spans: str) -> Column:
    """Spans as `start:end,start:end`."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["start"], m["end"])), ",")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, F.coalesce(remainder(4) != 2, F.lit(False)))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        listed("spans").alias("spans"),
    )


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_preferences(*swapped_answers(table(spark, sf_dir, "conversations")))
    return pairs.withColumns({mask: listed(mask) for mask in ("chosen_mask", "rejected_mask")})


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score_quality(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("mark", "print", "stays")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op8_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grafted_trie(table(spark, sf_dir, "conversations")).drop("enter")


URL_RULES = (
    UrlRule("block", "net"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("block_score")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_packing,
        op2_decontamination,
        op3_language,
        op4_toxicity,
        op5_preferences,
        op6_minhash,
        op7_cotraining,
        op8_cascade,
        op9_secrets,
        op10_substring,
        op11_prefix_trie,
        op12_url_filter,
        op13_spelling,
    )
}
SQL: dict[str, str] = {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op5_preferences": oracles.PREFERENCES,
    "op6_minhash": oracles.NEAR_DUPLICATES,
    "op10_substring": oracles.SUBSTRING,
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op13_spelling": oracles.SPELLING,
}
