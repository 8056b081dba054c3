"""Preference formatting of pairs of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def render(turn: Column) -> Column:
    """One turn as text."""
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def _segments(turns: Column, trained_role: str) -> Column:
    """The turns as rendered text, with a mark on those that the loss is taken over."""
    return F.transform(turns, lambda t: F.struct(render(t).alias("text"), (t["role"] == trained_role).alias("train")))


def spans(segments: Column) -> Column:
    """The trained parts of a completion: an array of (start, end) in code points, end exclusive."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("found"))

    def add(s: Column, x: Column) -> Column:
        end = s["at"] + F.length(x["text"])
        here = F.array(F.struct(s["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["train"], F.concat(s["found"], here)).otherwise(s["found"]).alias("found"))

    return F.aggregate(segments, start, add, lambda s: s["found"])


def answer_pairs(turns: DataFrame, answer_role: str = "assistant") -> DataFrame:
    """Turns (pair_id, chosen, conv_id, turn, role, text) of pairs that differ in their last answer, from (conv_id, turn, role, text).

    Pair k: the chosen side is conversation 2k; the rejected side has its turns before its last answer, then the last
    answer of conversation 2k + 1, whose id it carries. Turns go by number (null first), then role, then text; null role and text are empty. Where 2k + 1 has no
    answer the rejected side has no turns; where 2k has none, the answer follows its last turn. Rows with a
    null conv_id are left out, further columns ignored.

    Windows by pair_id, so that the pairing and ``format_preferences`` share one shuffle.
    """
    t = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where("conv_id is not null").select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("first"), "conv_id", t.alias("t")
    )
    pair = Window.partitionBy("pair_id")
    answer = F.col("t.role") == answer_role
    seen = rows.select(
        "*",
        F.max(F.when(F.col("first") & answer, F.col("t"))).over(pair).alias("own"),
        F.max(F.when(~F.col("first") & answer, F.col("t"))).over(pair).alias("other"),
        F.max(F.when(F.col("first"), F.col("t.turn"))).over(pair).alias("last"),
    )

    def side(chosen: bool, conv_id: Column, turn: Column) -> Column:
        return F.struct(F.lit(chosen).alias("chosen"), conv_id.alias("conv_id"), turn.alias("turn"))

    place = F.when(F.col("own").isNotNull(), F.col("own.turn")).otherwise(F.coalesce(F.col("last") + 1, F.col("t.turn")))
    before = F.col("other").isNotNull() & (F.col("own").isNull() | (F.col("t") < F.col("own")))
    kept = side(True, F.col("conv_id"), F.col("t.turn"))
    sides = (
        F.when(F.col("first") & before, F.array(kept, side(False, F.col("conv_id") + 1, F.col("t.turn"))))
        .when(F.col("first"), F.array(kept))
        .when(F.col("t") == F.col("other"), F.array(side(False, F.col("conv_id"), place)))
    )
    return seen.select("pair_id", "t", F.explode(sides).alias("s")).select("pair_id", "s.chosen", "s.conv_id", "s.turn", "t.role", "t.text")


def format_preferences(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per pair from turns (pair_id, chosen, conv_id, turn, role, text).

    ``chosen`` is a boolean: the preferred conversation of the pair or the other. Returns pair_id,
    chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_segments,
    rejected_segments. The longest common prefix of turns (same role, same text) is rendered once as
    prompt; what follows it is the completion of either side, whose segments say which parts
    are trained on (turns of ``trained_role``).

    One shuffle by pair_id; a task gathers the turns of one pair, no more. Turns go by number (null first), then role,
    then text; a repeated row is one turn; null role and text count as empty. Rows with a null pair_id or chosen belong to
    no pair and are left out. A pair with one side only has a null id, completion and segments on the
    other, and an empty prompt. An empty table gives an empty result; further columns are ignored.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sides = turns.where("pair_id is not null and chosen is not null").groupBy("pair_id").agg(
        F.min(F.when(F.col("chosen"), F.col("conv_id"))).alias("chosen_id"),
        F.min(F.when(~F.col("chosen"), F.col("conv_id"))).alias("rejected_id"),
        F.collect_list(F.when(F.col("chosen"), turn)).alias("a"),
        F.collect_list(F.when(~F.col("chosen"), turn)).alias("b"),
    )
    ordered = sides.withColumns({c: F.array_sort(F.array_distinct(c)) for c in "ab"})
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_other = F.array_position(same, F.lit(False))
    common = ordered.withColumn("n_common", F.when(first_other > 0, first_other - 1).otherwise(F.size("a")).cast("long"))
    rest = lambda c: F.slice(c, (F.col("n_common") + 1).cast("int"), F.size(c))
    split = common.select(
        "pair_id", "chosen_id", "rejected_id", "n_common",
        F.slice("a", F.lit(1), F.col("n_common").cast("int")).alias("prompt_turns"),
        F.when(F.size("a") > 0, rest("a")).alias("a"),
        F.when(F.size("b") > 0, rest("b")).alias("b"),
    )
    return split.select(
        "pair_id", "chosen_id", "rejected_id", "n_common",
        _text(F.col("prompt_turns")).alias("prompt"),
        _text(F.col("a")).alias("chosen"),
        _text(F.col("b")).alias("rejected"),
        _segments(F.col("a"), trained_role).alias("chosen_segments"),
        _segments(F.col("b"), trained_role).alias("rejected_segments"),
    )
