"""Places of rows within their groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from siltgate.llm.text import Scratch, to_arrow_schema


def _numbering(kind: pa.Schema, n_key: int, running: Sequence[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen, held = TaskContext.get().partitionId(), None, 0, [0] * len(running)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(i).to_numpy() for i in range(n_key)]
            starts = np.zeros(n, bool)
            starts[0] = last != tuple(k[0] for k in keys)
            for k in keys:
                starts[1:] |= k[1:] != k[:-1]
            place = np.arange(n)
            # Of the first row of each row's group in this batch; -1 where the group began before.
            first = np.maximum.accumulate(np.where(starts, place, -1))
            out = [np.where(first < 0, place + 1 + seen, place - first + 1)]
            for i, name in enumerate(running):
                total = np.bitwise_xor.accumulate(batch.column(name).to_numpy())
                before = np.where(first > 0, total[first - 1], np.where(first < 0, held[i], 0))
                out.append(total ^ before)
            last, seen, held = tuple(k[-1] for k in keys), int(out[0][-1]), [int(r[-1]) for r in out[1:]]
            made = [*batch.columns, *[pa.array(o, pa.int64()) for o in out], pa.array(np.full(n, part, np.int32))]
            yield pa.RecordBatch.from_arrays(made, schema=kind)

    return run


def numbered(
    frame: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    scratch: Scratch,
    *,
    keep: Sequence[str] = (),
    running: Sequence[str] = (),
) -> DataFrame:
    """`key` and `keep` of each row, `nth`, its place from 1 among the rows of its key in `order`, NULL first, and for
    each column in `running` its exclusive or over the group up to the row, as `<name>_so_far`.

    `key` and `running` are longs without NULL. Rows are sorted by ranges of key and order together, so that a group
    of any size is spread over many tasks. Each task numbers its own rows; what a group has counted in earlier tasks
    comes from one row per task and is added after. Rows that agree in key and order are numbered in any order.
    """
    spark = frame.sparkSession
    sorted_by = [*key, *order, "_row"]
    in_order = (
        frame.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*sorted_by)
        .sortWithinPartitions(*sorted_by)
        .select(*key, *keep, *[r for r in running if r not in keep])
    )
    sums = [f"{r}_so_far" for r in running]
    schema = StructType([*in_order.schema.fields])
    for name in ("nth", *sums):
        schema = schema.add(name, LongType())
    schema = schema.add("_part", IntegerType())
    local = scratch.keep(in_order.mapInArrow(_numbering(to_arrow_schema(schema), len(key), running), schema))

    ends = local.groupBy("_part").agg(
        F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key, "nth", *sums)).alias("last")
    )
    carried, held = [], None
    for row in ends.orderBy("_part").collect():
        first, last = tuple(row["first"]), tuple(row["last"])
        own_key, own = last[: len(key)], list(last[len(key) :])
        if held is not None and held[0] == first:
            carried.append((row["_part"], *first, *held[1]))
            if own_key == first:
                own = [own[0] + held[1][0], *[a ^ b for a, b in zip(own[1:], held[1][1:], strict=True)]]
        held = (own_key, own)
    if carried:
        names = ["_in", *[f"_k{i}" for i in range(len(key))], *[f"_more{i}" for i in range(1 + len(sums))]]
        more = spark.createDataFrame(carried, ", ".join(f"{n} {'int' if n == '_in' else 'long'}" for n in names))
        same = F.col("_part") == F.col("_in")
        for i, k in enumerate(key):
            same &= F.col(k) == F.col(f"_k{i}")
        # One row per task at most.
        local = local.join(F.broadcast(more), same, "left").withColumns(
            {"nth": F.col("nth") + F.coalesce("_more0", F.lit(0))}
            | {s: F.col(s).bitwiseXOR(F.coalesce(f"_more{i + 1}", F.lit(0))) for i, s in enumerate(sums)}
        )
    return local.select(*[c for c in in_order.columns if c in (*key, *keep)], "nth", *sums)
