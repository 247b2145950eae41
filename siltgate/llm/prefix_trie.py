"""The trie of conversation prefixes, with subtree sums by the Euler-tour technique."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.runs import numbered
from siltgate.llm.text import Scratch, columns, sized
from siltgate.llm.tour import Chunks, list_ranks

# Ids written into one piece of a node's list of ends.
PIECE = 1 << 16


def placed_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, nth, one, two, words: turns by their place from 1, two hashes of role and text, words of the text.

    Turns are in the order of `turn`, NULL first, then of role and text by code points. NULL role or text is empty.
    Rows without a conv_id are in no conversation. Repeated rows are turns each. Texts are moved once, whole.
    """
    turns = columns(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id is not null")
    turns = turns.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    hashed = turns.withColumns(
        {"one": F.xxhash64("role", "text"), "two": F.xxhash64(F.lit("second"), "text", "role"), "words": words}
    )
    return numbered(hashed, ["conv_id"], ["turn", "role", "text"], scratch, keep=["one", "two", "words"])


def grafted(placed: DataFrame, scratch: Scratch, group: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first h turns taken from the first conversation of its group of ids.

    h is the checksum of the id as decimal text modulo `longest`; the first of a group is `conv_id - conv_id % group`.
    Fewer turns are taken if there are fewer, none if it is absent. Returns the turns, placed anew, and (conv_id, n).
    """
    cut = F.crc32(F.col("conv_id").cast("string")) % longest
    sizes = scratch.keep(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")))
    of_first = sizes.select(F.col("conv_id").alias("first"), F.col("own").alias("there"))
    n = sizes.count()
    known = sizes.withColumns({"first": F.col("conv_id") - F.col("conv_id") % group, "h": cut})
    convs = scratch.keep(
        known.join(sized(of_first, n, 60), "first", "left").select(
            "conv_id", "first", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"), "own"
        )
    )
    hashes = ("one", "two", "words")
    heads = placed.where(F.col("nth") < longest).withColumnRenamed("conv_id", "first")
    takers = convs.select("conv_id", "first", "h").where("h > 0")
    from_first = heads.join(sized(takers, n, 60), "first").where("nth <= h")
    kept = placed.join(sized(convs.select("conv_id", "h", "taken"), n, 60), "conv_id").where("nth > h")
    rebuilt = from_first.select("conv_id", "nth", *hashes).union(
        kept.select("conv_id", F.col("nth") - F.col("h") + F.col("taken"), *hashes)
    )
    total = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return rebuilt, convs.select("conv_id", total.alias("n"))


def _ends_in_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node_id, depth, conv_id): runs of one node as text, with the first id of each."""
    for batch in batches:
        node, depth, conv = (batch.column(i).to_numpy() for i in range(3))
        if not len(conv):
            continue
        new = np.flatnonzero((node[1:] != node[:-1]) | (depth[1:] != depth[:-1])) + 1
        cuts = np.union1d(np.arange(0, len(conv), PIECE), new)
        ids = conv.astype(str).tolist()
        texts = [",".join(ids[i:j]) for i, j in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
        arrays = [pa.array(node[cuts]), pa.array(depth[cuts]), pa.array(conv[cuts]), pa.array(texts)]
        yield pa.RecordBatch.from_arrays(arrays, names=["node_id", "depth", "first", "ids"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces: a node's pieces one after the other into one hash, which is all that is held of them."""
    names = ["node_id", "depth", "ends_sha256"]
    current, state = None, hashlib.sha256()
    for batch in batches:
        done: tuple[list, list, list] = ([], [], [])
        for node, depth, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current == (node, depth):
                state.update(b",")
            else:
                if current:
                    for out, value in zip(done, (*current, state.hexdigest()), strict=True):
                        out.append(value)
                current, state = (node, depth), hashlib.sha256()
            state.update(ids.encode())
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(done, kinds, strict=True)], names=names)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*current, state.hexdigest())], names=names)


def _ends(ends: DataFrame) -> DataFrame:
    """A hash of the ids of the conversations that end in each node.

    Ids are sorted and written as text by ranges, so that a node in which very many conversations end is spread; only
    its pieces of text then pass through one task, one after the other, as the hash cannot be put together from parts.
    """
    order = ["node_id", "depth", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order)
    pieces = pieces.mapInArrow(_ends_in_pieces, "node_id long, depth long, first long, ids string")
    by_node = pieces.repartition("node_id", "depth").sortWithinPartitions("node_id", "depth", "first")
    return by_node.mapInArrow(_digests, "node_id long, depth long, ends_sha256 string")


def _arcs(nodes: DataFrame) -> DataFrame:
    """An arc into each node and one out of it, (conv_id, 2 * depth) and (conv_id, 2 * depth + 1), each with its successor."""
    deeper = F.col("first_child").isNotNull()
    enter = nodes.select(
        F.col("conv_id").alias("a"),
        (2 * F.col("depth")).alias("b"),
        F.coalesce("first_child", "conv_id").alias("next_a"),
        (2 * F.col("depth") + F.when(deeper, 2).otherwise(1)).alias("next_b"),
        F.lit(1).cast("long").alias("place"),
        F.when(deeper, 0).otherwise(1).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    zero = F.lit(0).cast("long")
    leave = nodes.select(
        F.col("conv_id").alias("a"),
        (2 * F.col("depth") + 1).alias("b"),
        F.coalesce("next_sibling", "parent_conv_id").alias("next_a"),
        F.when(F.col("next_sibling").isNotNull(), 2 * F.col("depth"))
        .when(F.col("parent_conv_id").isNotNull(), 2 * F.col("depth") - 1)
        .alias("next_b"),
        F.lit(1).cast("long").alias("place"),
        zero.alias("leaves"),
        zero.alias("saved"),
    )
    return enter.union(leave)


def _at(depth: Column, own: str = "") -> list[Column]:
    return [depth.alias("depth"), F.col(f"{own}one").alias("one"), F.col(f"{own}two").alias("two")]


def prefix_trie(placed: DataFrame, convs: DataFrame, scratch: Scratch, chunks: Chunks = Chunks()) -> DataFrame:
    """The trie of all prefixes of conversations: a node for each distinct sequence of first d turns, d from 0.

    `placed` has the turns (conv_id, nth from 1 without gaps, one, two, words) as `placed_turns` makes them, `convs`
    all conversations and their numbers of turns (conv_id, n), also those without any. Turns are the same if both
    hashes of role and text are; a prefix is told by the exclusive or of 128 bits that depend on each turn and its
    place. So two different prefixes of equal length pass for one with a probability of 2**-128.

    Children are ordered by their smallest members. An arc into and one out of each node make the Euler tour, a linked
    list that is ranked in distributed rounds (`list_ranks`). Subtree sums are differences of the prefix sums at a
    node's two arcs.

    Returns conv_id (smallest member), depth, parent_conv_id (NULL for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the ids of the members with just that many turns, ascending, joined by commas),
    and `enter`, the place of the node in the tour. No conversations give no rows, not even a root. Conversations
    without turns end in the root. Long conversations and nodes with many members or children are spread over tasks.
    """
    spark = placed.sparkSession
    root_id, members = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not members:
        kinds = ", ".join(f"{c} long" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"))
        return spark.createDataFrame([], kinds + ", saved_tokens long, ends_sha256 string, enter long")

    marked = placed.select(
        "conv_id",
        "nth",
        "words",
        F.xxhash64("nth", "one", "two").alias("one"),
        F.xxhash64("two", "nth", "one", F.lit("second")).alias("two"),
    )
    paths = numbered(marked, ["conv_id"], ["nth"], scratch, keep=["words", "one", "two"], running=["one", "two"])
    paths = paths.select(
        "conv_id",
        F.col("nth").alias("depth"),
        "words",
        F.col("one_so_far").alias("one"),
        F.col("two_so_far").alias("two"),
        F.col("one_so_far").bitwiseXOR(F.col("one")).alias("parent_one"),
        F.col("two_so_far").bitwiseXOR(F.col("two")).alias("parent_two"),
    )
    paths = scratch.keep(paths)
    nodes = scratch.keep(
        paths.groupBy("depth", "one", "two").agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("words").alias("words"),
            F.min("parent_one").alias("parent_one"),
            F.min("parent_two").alias("parent_two"),
        )
    )
    # The children of the root need no join, and so the most frequent parent none.
    above = nodes.select(F.col("conv_id").alias("parent_conv_id"), *_at(F.col("depth") + 1)).toDF(
        "parent_conv_id", "depth", "parent_one", "parent_two"
    )
    kept = ("conv_id", "depth", "parent_conv_id", "n_convs", "words")
    below_root = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root_id).cast("long")).select(*kept)
    n_nodes = nodes.count()
    others = nodes.where("depth > 1").join(sized(above, n_nodes, 80), ["depth", "parent_one", "parent_two"]).select(*kept)
    children = scratch.keep(
        numbered(below_root.union(others), ["parent_conv_id", "depth"], ["conv_id"], scratch, keep=["conv_id", "n_convs", "words"])
    )

    # The sibling after the nth one; after the 0th comes the first child.
    after = children.select("parent_conv_id", "depth", (F.col("nth") - 1).alias("nth"), F.col("conv_id").alias("next_sibling"))
    own = children.join(sized(after, n_nodes, 80), ["parent_conv_id", "depth", "nth"], "left").drop("nth")
    families = children.groupBy("parent_conv_id", "depth").agg(
        F.max("nth").alias("n_children"), F.min("conv_id").alias("first_child")
    )
    families = scratch.keep(
        families.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "first_child")
    )
    root = spark.range(1).selectExpr(
        "cast(null as long) as parent_conv_id", "cast(0 as long) as depth", f"cast({root_id} as long) as conv_id",
        f"cast({members} as long) as n_convs", "cast(0 as long) as words", "cast(null as long) as next_sibling",
    )
    trie = scratch.keep(own.unionByName(root).join(sized(families, n_nodes, 80), ["conv_id", "depth"], "left"))

    ranked = list_ranks(scratch.keep(_arcs(trie)), scratch, chunks)
    out = F.col("b") % 2 == 1
    between = {s: F.sum(F.when(out, F.col(s)).otherwise(-F.col(s))) for s in ("leaves", "saved")}
    subtrees = ranked.groupBy(F.col("a").alias("conv_id"), F.expr("b div 2").alias("depth")).agg(
        between["leaves"].alias("n_leaves"),
        between["saved"].alias("saved_tokens"),
        F.min("place").alias("enter"),
    )

    total = sized(convs.select("conv_id", F.col("n").alias("depth")), members, 60)
    last = paths.join(total, ["conv_id", "depth"], "left_semi").select("conv_id", "depth", "one", "two")
    named = sized(nodes.select(F.col("conv_id").alias("node_id"), "depth", "one", "two"), n_nodes, 80)
    ending = last.join(named, ["depth", "one", "two"]).select("node_id", "depth", "conv_id")
    turnless = convs.where("n = 0").select(F.lit(root_id).cast("long"), F.lit(0).cast("long"), "conv_id")
    ends = _ends(ending.union(turnless)).withColumnRenamed("node_id", "conv_id")
    return (
        trie.join(subtrees, ["conv_id", "depth"])
        .join(ends, ["conv_id", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
            "enter",
        )
    )


def grafted_trie(conversations: DataFrame, *, group: int = 20, longest: int = 4, chunks: Chunks = Chunks()) -> DataFrame:
    """`prefix_trie` of conversations (conv_id, turn, role, text) rebuilt by `grafted`; see both for awkward rows."""
    scratch = Scratch(conversations.sparkSession)
    placed = scratch.keep(placed_turns(conversations, scratch))
    rebuilt, convs = grafted(placed, scratch, group, longest)
    return prefix_trie(rebuilt, convs, scratch, chunks)
