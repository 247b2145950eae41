"""Benchmark items found inside documents, by MinHash sketches sized for containment. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.text import Scratch, columns
from siltgate.operators.keys import BROADCAST_BYTES


@dataclass(frozen=True)
class Containment:
    """Share of an item's shingles that a document must hold, in percent; words of a shingle."""

    percent: int = 80
    shingle: int = 5


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits; the empty array for NULL."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def computed_once(value: Column) -> Column:
    """A generated column: the optimizer does not copy its expression to where the column is used, as in lambdas."""
    return F.explode(F.array(value))


def shingles(found: Column, size: int) -> Column:
    """The distinct shingles as text; of fewer words than `size`, the whole is the only one."""
    starts = F.sequence(F.lit(1), F.size(found) - size + 1)
    return (
        F.when(F.size(found) == 0, F.array().cast("array<string>"))
        .when(F.size(found) <= size, F.array(F.array_join(found, " ")))
        .otherwise(F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(found, i, size), " "))))
    )


def hashes(found: Column, size: int) -> Column:
    """64-bit hashes of the shingles in order, repeated ones too, from hashes of their words."""
    each = F.transform(found, lambda w: F.xxhash64(w))
    starts = F.sequence(F.lit(0), F.size(found) - size)
    return (
        F.when(F.size(found) == 0, F.array().cast("array<long>"))
        .when(F.size(found) <= size, F.array(F.aggregate(each, F.lit(42).cast("long"), lambda a, h: F.xxhash64(a, h))))
        .otherwise(F.transform(starts, lambda i: _chain(i, found, size)))
    )


def _chain(start: Column, found: Column, size: int) -> Column:
    """The same value as the chained hash of the words from `start` on."""
    value = F.lit(42).cast("long")
    for offset in range(size):
        value = F.xxhash64(value, F.xxhash64(F.get(found, start + offset)))
    return value


def item_sketches(items: DataFrame, how: Containment) -> DataFrame:
    """Bottom-k MinHash sketch of each item with shingles: item_id, text_key, size, size_class, hash (a row each).

    An item of n shingles is contained if at least c = ceil(percent * n / 100) of them are in the document. Its sketch
    is its n - c + 1 least hashes, so that every document that contains it holds at least one of them.
    """
    split = items.select("item_id", "text", computed_once(words(F.col("text"))).alias("found"))
    every = F.array_sort(F.array_distinct(hashes(F.col("found"), how.shingle)))
    sized = split.select("item_id", "text", computed_once(every).alias("all")).withColumn("size", F.size("all")).where("size > 0")
    least = F.col("size") - F.ceil(F.col("size") * how.percent / 100).cast("int") + 1
    return sized.select(
        "item_id",
        F.xxhash64("text").alias("item_mark"),
        "size",
        F.floor(F.log2("size")).cast("int").alias("size_class"),
        F.explode(F.slice("all", 1, least)).alias("hash"),
    )


def contaminated(docs: DataFrame, items: DataFrame, how: Containment = Containment()) -> DataFrame:
    """Documents (doc_id, text) that contain an item (item_id, text), with the shingles they share.

    The search follows LSH Ensemble (Zhu and others, 2016) in that sizes are partitioned and each partition has
    parameters of its own for containment: items fall into classes by the power of two of their shingle count, and a
    document is only searched for classes whose items are small enough for it, up to the greatest hash in their
    sketches. Banded signatures of whole documents would not do here: a test item of 30 shingles in a document of
    3,000 has a Jaccard similarity of 0.01, at which bands of one row miss it again and again. The item's own MinHash
    values are looked up among the document's shingles instead, which finds every document that contains it. Hits are
    confirmed on the shingles as text.

    Returns one row per document text and item: doc_id, mark (xxhash64 of the text), item_id, item_shingles, shared
    and containment. Rows that repeat give one row. NULL ids are kept as they are and match their own texts. NULL and
    empty texts, and texts without letters or digits, contain nothing and are contained in nothing. Items or documents
    of fewer than five words have one shingle, the whole, so such an item is found only where it is the whole text.
    """
    scratch = Scratch(docs.sparkSession)
    texts = columns(docs, doc_id="long", text="string").withColumn("mark", F.xxhash64("text"))
    tests = columns(items, item_id="long", text="string").distinct()
    sketches = scratch.keep(item_sketches(tests, how))
    bound = sketches.groupBy("size_class").agg(F.min("size").alias("least"), F.max("hash").alias("reach"))
    classes = bound.orderBy("size_class").collect()  # one row for each power of two
    split = texts.select("doc_id", "mark", computed_once(words(F.col("text"))).alias("found"))
    hashed = split.select("doc_id", "mark", computed_once(hashes(F.col("found"), how.shingle)).alias("found"))
    sized = hashed.withColumn("n", F.size("found")).where("n > 0")
    reach = F.lit(-(2**63))
    top = -(2**63)
    for row in classes:
        top = max(top, row.reach)
        reach = F.when(F.col("n") * 100 >= row.least * how.percent, F.lit(top)).otherwise(reach)
    probes = sized.select("doc_id", "mark", "n", reach.alias("reach"), F.explode("found").alias("hash")).where(
        "hash <= reach"
    )
    small = sketches.count() * 64 <= BROADCAST_BYTES
    sought = F.broadcast(sketches) if small else sketches
    hit = probes.join(sought, "hash").where(F.col("n") * 100 >= F.col("size") * how.percent)
    pairs = scratch.keep(hit.select("doc_id", "mark", "item_id", "item_mark").distinct())
    return _confirmed(texts, tests, pairs, how)


def _confirmed(texts: DataFrame, tests: DataFrame, pairs: DataFrame, how: Containment) -> DataFrame:
    marks = pairs.select(F.col("doc_id").alias("p_id"), F.col("mark").alias("p_mark")).distinct()
    few = pairs.count() * 64 <= BROADCAST_BYTES
    marks = F.broadcast(marks) if few else marks
    hit = texts.join(marks, texts["doc_id"].eqNullSafe(marks["p_id"]) & (texts["mark"] == marks["p_mark"]), "left_semi")
    # Equal texts have equal answers, so each text is searched once for each item.
    of_text = hit.groupBy("mark").agg(F.first("text").alias("text"))
    of_text = of_text.select(F.col("mark").alias("t_mark"), computed_once(words(F.col("text"))).alias("found"))
    of_text = of_text.select("t_mark", shingles(F.col("found"), how.shingle).alias("held"))
    of_item = tests.select(
        F.col("item_id").alias("i_id"),
        F.xxhash64("text").alias("i_mark"),
        computed_once(words(F.col("text"))).alias("found"),
    )
    of_item = of_item.select("i_id", "i_mark", shingles(F.col("found"), how.shingle).alias("sought"))
    sought = pairs.select("mark", "item_id", "item_mark").distinct()
    same_item = sought["item_id"].eqNullSafe(of_item["i_id"]) & (sought["item_mark"] == of_item["i_mark"])
    both = sought.join(of_item, same_item).join(of_text, F.col("mark") == F.col("t_mark"))
    counted = both.select(
        "mark",
        "item_id",
        "item_mark",
        F.size("sought").cast("long").alias("item_shingles"),
        F.size(F.array_intersect("sought", "held")).cast("long").alias("shared"),
    ).where(F.col("shared") * 100 >= F.col("item_shingles") * how.percent)
    named = counted.select(
        F.col("mark").alias("c_mark"), F.col("item_id").alias("c_item"), F.col("item_mark").alias("c_item_mark"),
        "item_shingles", "shared",
    )
    same = (
        (pairs["mark"] == named["c_mark"])
        & pairs["item_id"].eqNullSafe(named["c_item"])
        & (pairs["item_mark"] == named["c_item_mark"])
    )
    return (
        pairs.join(named, same)
        .groupBy("doc_id", "mark", "item_id")
        .agg(F.max("item_shingles").alias("item_shingles"), F.max("shared").alias("shared"))
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
    )
