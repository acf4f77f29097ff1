"""Preference formatting of chosen and rejected conversations. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _equal(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def preference_segments(turns: DataFrame) -> DataFrame:
    """Rendered segments of pairs of conversations, each with the span that is trained on.

    ``turns`` has ``pair_id, side`` ('chosen' or 'rejected'), ``turn, role, text``. The longest
    common prefix of a pair ends before the first turn whose role or text differs between the
    sides or which one side lacks. Prefix turns are rendered once, from the chosen side, as
    part 'prompt'; later turns are parts 'chosen' and 'rejected'. A turn is rendered as
    ``<|role|>`` line, text, ``<|end|>`` line. Trained on are the characters of text and
    end mark of assistant turns in the two completions: ``[mask_start, mask_end)``,
    counted in characters of the segment; elsewhere both are 0.

    Null role counts as 'user', null text as empty, null turns stand first, rows with a null
    pair form a pair of their own. Repeated turns are compared as a bag and rendered in the
    order of role and text; a tie of equal rows keeps all of them. A side without turns gives
    a pair without prompt. Other columns are not read.

    Segments, not whole conversations, are the rows, so a conversation of any length is
    shared by many tasks; ``pair_rows`` puts short ones together.
    """
    turns = turns.select(
        "pair_id", "side", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = F.xxhash64("role", "text")

    def bag(side: str):
        mine = F.when(F.col("side") == side, one)
        return F.struct(
            F.count(mine).alias("n"), F.min(mine).alias("low"), F.max(mine).alias("high"), F.bit_xor(mine).alias("xor"),
            F.sum(mine.cast("decimal(38,0)")).alias("sum"))

    split = (
        turns.groupBy("pair_id", "turn").agg(bag("chosen").alias("a"), bag("rejected").alias("b"))
        .groupBy(F.col("pair_id").alias("own_pair"))
        .agg(
            F.min(F.when(F.col("a") != F.col("b"), F.coalesce("turn", F.lit(-(2 ** 62))))).alias("first_difference"),
            F.sum(F.when(F.col("a") == F.col("b"), F.col("a.n")).otherwise(0)).alias("equal_turns"),
        )
    )
    at = F.coalesce(F.col("turn"), F.lit(-(2 ** 62)))
    shared = F.col("first_difference").isNull() | (at < F.col("first_difference"))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return (
        turns.join(split, _equal("pair_id", "own_pair")).withColumn("part", F.when(shared, "prompt").otherwise(F.col("side")))
        .where((F.col("part") != "prompt") | (F.col("side") == "chosen"))
        .select(
            "pair_id", "part", "turn", "role", F.concat(head, F.col("text"), F.lit("<|end|>\n")).alias("rendered"),
            F.when(trained, F.char_length(head)).otherwise(0).alias("mask_start"),
            F.when(trained, F.char_length(head) + F.char_length("text") + F.char_length(F.lit("<|end|>"))).otherwise(0).alias("mask_end"))
    )


def pair_rows(segments: DataFrame) -> DataFrame:
    """One row per pair: ``prompt, chosen, rejected`` and the trained spans of the completions.

    Puts all segments of a pair into one row; use it where conversations are short.
    """
    def part(name: str):
        mine = F.when(F.col("part") == name, F.struct("turn", "role", "rendered", "mask_start", "mask_end"))
        return F.array_sort(F.collect_list(mine)).alias(name)

    def text(name: str):
        return F.array_join(F.transform(name, lambda s: s["rendered"]), "").alias(name)

    def spans(name: str):
        moved = F.aggregate(
            name, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans")),
            lambda acc, s: F.struct(
                (acc["at"] + F.char_length(s["rendered"])).alias("at"),
                F.when(s["mask_end"] > 0, F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + s["mask_start"]).alias("from"), (acc["at"] + s["mask_end"]).alias("to"))))).otherwise(acc["spans"]).alias("spans")))
        return moved["spans"].alias(f"{name}_spans")

    grouped = segments.groupBy("pair_id").agg(part("prompt"), part("chosen"), part("rejected"))
    return grouped.select("pair_id", text("prompt"), text("chosen"), text("rejected"), spans("chosen"), spans("rejected"))


def swapped_endings(conversations: DataFrame) -> DataFrame:
    """Pairs for ``preference_segments`` from plain conversations, one for each of them.

    Chosen is the conversation itself. Rejected is the same conversation, but with its last turn
    replaced by the last turn of its neighbour, the conversation whose id differs in the lowest
    bit; without a neighbour rejected just ends earlier. Rows without id are one conversation.
    """
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.groupBy(F.col("pair_id").alias("own_pair")).agg(F.max("turn").alias("last_turn"))
    marked = turns.join(last, _equal("pair_id", "own_pair")).drop("own_pair")
    ending = _equal("turn", "last_turn")
    chosen = turns.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    begun = marked.where(~ending).select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    swapped = (
        marked.where(ending).select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), "role", "text")
        .join(last.where("own_pair is not null"), F.col("pair_id") == F.col("own_pair"))
        .select("pair_id", F.lit("rejected").alias("side"), F.col("last_turn").alias("turn"), "role", "text")
    )
    return chosen.unionByName(begun).unionByName(swapped)
