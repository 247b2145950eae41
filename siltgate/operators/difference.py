"""Rejected rows derived from the accepted ones, for callers that hold no rule to filter by."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.operators.keys import key_table, same_key

CHUNK_COPIES = 10_000


def multiset_difference(left: DataFrame, right: DataFrame, chunk_copies: int = CHUNK_COPIES) -> DataFrame:
    """`left` minus `right`, each row of `right` cancelling one equal row of `left`; columns matched by name.

    Equal rows are counted per task before the shuffle. What remains of a row is written out again in chunks, and
    the chunks of a row with many copies are spread over the tasks, so a row repeated without bound neither fills
    one task nor one array.
    """
    names = left.columns
    signed = left.withColumn("_n", F.lit(1)).unionByName(right.select(*names).withColumn("_n", F.lit(-1)))
    surplus = signed.groupBy(*names).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    few = surplus.filter(F.col("_n") <= chunk_copies)

    size = F.greatest(F.lit(chunk_copies).cast("long"), F.ceil(F.sqrt("_n")))
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        surplus.filter(F.col("_n") > chunk_copies)
        .withColumn("_size", size)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_n - 1) div _size"))))
        .repartition(tasks, "_chunk")
        .withColumn("_n", F.least("_size", F.col("_n") - F.col("_chunk") * F.col("_size")))
        .drop("_size", "_chunk")
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy")
    return few.unionByName(many).select(*names, copies).drop("_copy")


def key_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key does not occur in `right`; a row with NULL in its key has no match and is kept.

    Nothing runs before the result is asked for: Spark broadcasts the keys if their shuffled size, once known, is
    small enough. Rows with NULL in the key stay out of the join, so they are not brought to one task.
    """
    keys = key_table(right.dropna(subset=list(key)), key)
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    named = left.filter(~has_null)
    return named.join(keys, same_key(named, key), "left_anti").unionByName(left.filter(has_null))
