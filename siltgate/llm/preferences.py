"""Preference pairs as text: a shared prompt and two masked completions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|", "|>"
END = "<|end|>"


def _safe(text: Column) -> Column:
    """A text can't open a marker of the template."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit(CLOSE + "\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END + "\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _mask(turns: Column, role: str) -> Column:
    """Spans of what is learned, in code points of the rendered turns: texts of `role` with their end marker."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans")
    )

    def step(state: Column, turn: Column) -> Column:
        first = (state["at"] + F.length(_header(turn))).cast("long")
        last = (first + F.length(_body(turn))).cast("long")
        # The line feed after the end marker belongs to the template.
        span = F.struct(first.alias("start"), (last - 1).cast("long").alias("end"))
        own = F.when(turn["role"] == role, F.array(span)).otherwise(F.array().cast("array<struct<start: bigint, end: bigint>>"))
        return F.struct(last.alias("at"), F.concat(state["spans"], own).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def _conversations(turns: DataFrame, name: str) -> DataFrame:
    """One row per pair with its turns in order: by turn, NULL first, then role and text, so that ties have an order."""
    each = F.struct("turn", "role", "text")
    ordered = F.transform(F.array_sort(F.collect_list(each)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    rows = turns.where("pair_id is not null").distinct()
    return rows.groupBy("pair_id").agg(ordered.alias(name))


def format_preferences(chosen: DataFrame, rejected: DataFrame, *, learned_role: str = "assistant") -> DataFrame:
    """Pairs of conversations, given as turns (pair_id, turn, role, text), as prompt and two completions.

    The prompt is the longest common prefix of turns with equal role and text, rendered once. Each completion renders
    the turns after it, with the spans to learn from: texts of `learned_role`, in code points of the completion.
    `status` is `ok`, `same` (no turn differs, so both completions are empty) or `one_sided` (a completion is empty).

    A turn that repeats in all its columns counts once; turns of the same number are ordered by role and text. NULL
    role or text is rendered as empty and equals only NULL. Rows without a pair_id belong to no pair. A pair that one
    side lacks has an empty conversation there. A conversation is one row of the result, so it is brought together as
    one; everything else works turn by turn.
    """
    kinds = dict(pair_id="long", turn="long", role="string", text="string")
    sides = [
        _conversations(t.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]), name)
        for t, name in ((chosen, "c"), (rejected, "r"))
    ]
    none = F.array().cast("array<struct<role: string, text: string>>")
    both = sides[0].join(sides[1], "pair_id", "full").select(
        "pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r")
    )
    equal = F.zip_with("c", "r", lambda x, y: x.isNotNull() & y.isNotNull() & x.eqNullSafe(y))
    differs = F.array_position(equal, F.lit(False))
    common = F.when(differs == 0, F.size("c")).otherwise(differs - 1).cast("int")
    placed = both.withColumn("prompt_turns", common)

    def rest(side: str) -> Column:
        return F.slice(side, F.col("prompt_turns") + 1, F.size(side))

    cut = placed.select(
        "pair_id",
        "prompt_turns",
        F.slice("c", F.lit(1), F.col("prompt_turns")).alias("p"),
        rest("c").alias("c"),
        rest("r").alias("r"),
    )
    empty = [F.size(side) == 0 for side in ("c", "r")]
    return cut.select(
        "pair_id",
        F.when(empty[0] & empty[1], "same").when(empty[0] | empty[1], "one_sided").otherwise("ok").alias("status"),
        "prompt_turns",
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("c"), learned_role).alias("chosen_mask"),
        _mask(F.col("r"), learned_role).alias("rejected_mask"),
    )


def swapped_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations (conv_id, turn, role, text): chosen and rejected turns.

    A conversation is its own chosen one. Its rejected one has the same turns up to its last assistant turn, and in
    that place the last assistant text of its neighbour, whose conv_id differs in the lowest bit; without such a text
    it ends there. Conversations without an assistant turn give no pair. Turns without a number come before all others,
    and an assistant turn without one is the last only where no other has a number.
    """
    own = turns.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = own.where("pair_id is not null")
    answers = own.where("role = 'assistant'").groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("answer")
    ).select("pair_id", F.col("answer.turn").alias("last"), F.col("answer.text").alias("other"))
    chosen = own.join(answers.select("pair_id"), "pair_id", "left_semi")
    before = own.join(answers.select("pair_id", "last"), "pair_id").where("turn < last or turn is null and last is not null").drop("last")
    neighbours = answers.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "other")
    replaced = answers.select("pair_id", F.col("last").alias("turn")).join(neighbours, "pair_id")
    replaced = replaced.select("pair_id", "turn", F.lit("assistant").alias("role"), F.col("other").alias("text"))
    return chosen, before.unionByName(replaced)
