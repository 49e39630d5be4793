"""Preference formatting: chosen and rejected conversations become one prompt
(their longest common turn prefix, rendered once) and two completions with loss
masks.

Turns are gathered per (pair, side): a group is one conversation.  The common
prefix is found inside the pair's row, so that nothing grows with how often a
turn or a conversation occurs in the corpus.  The mask of a completion lists
the code-point spans that count for the loss: the content and end mark of its
assistant turns; headers and other roles are masked out, and so is the prompt.

Defined results: a null role or text counts as empty; turns are ordered by
number, then role, then text, and repeated rows of a turn count once; null turn
numbers come first; a pair without one of its sides has that completion and
mask empty, and its prompt is all of the other side; identical sides have both
completions empty (``degenerate``); null pair ids make no pair; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TURN = "array<struct<turn:bigint,role:string,text:string>>"


def _rendered(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))


def conversations(turns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, turns): the ordered turns of each conversation."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy(*keys).agg(F.array_sort(F.collect_set(turn)).alias("turns"))


def _spans(turns: Column) -> Column:
    """array<struct<first, last>> of what counts in a rendered completion, in
    one pass: the state holds the place and the spans as text."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("told"))

    def step(s: Column, t: Column) -> Column:
        head = s["at"] + len(START) + F.length(t["role"]) + 1
        end = head + F.length(t["text"]) + len(END)
        span = F.concat(F.when(s["told"] == "", "").otherwise(","), head.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.cast("long").alias("at"), F.when(t["role"] == "assistant", F.concat(s["told"], span)).otherwise(s["told"]).alias("told"))

    return F.aggregate(turns, start, step, lambda s: s["told"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``pairs``: one row per turn with (pair_id, side: chosen or rejected,
    turn, role, text).  Returns (pair_id, n_prompt_turns, prompt, chosen,
    chosen_mask, rejected, rejected_mask, degenerate); a mask is
    ``first:last,...`` in code points of its completion, last exclusive."""
    sides = conversations(pairs.filter("pair_id IS NOT NULL AND side IN ('chosen', 'rejected')"), ["pair_id", "side"])
    side = lambda name: F.coalesce(F.max(F.when(F.col("side") == name, F.col("turns"))), F.array().cast(TURN))
    rows = sides.groupBy("pair_id").agg(side("chosen").alias("c"), side("rejected").alias("r"))
    same = F.zip_with("c", "r", lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))  # null beyond the shorter
    differs = F.array_position(F.transform(same, lambda x: F.coalesce(x, F.lit(False))), False)
    rows = rows.withColumn("n", F.when((F.size("c") == 0) | (F.size("r") == 0), F.greatest(F.size("c"), F.size("r"))).when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    longer = F.when(F.size("c") > 0, F.col("c")).otherwise(F.col("r"))
    rows = rows.withColumns({"p": F.slice(longer, F.lit(1), F.col("n")), "c": F.slice("c", F.col("n") + 1, F.size("c")), "r": F.slice("r", F.col("n") + 1, F.size("r"))})
    text = lambda turns: F.array_join(F.transform(turns, _rendered), "")
    return rows.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"), text(F.col("p")).alias("prompt"),
        text(F.col("c")).alias("chosen"), _spans(F.col("c")).alias("chosen_mask"),
        text(F.col("r")).alias("rejected"), _spans(F.col("r")).alias("rejected_mask"),
        ((F.size("c") == 0) & (F.size("r") == 0)).alias("degenerate"))


def pairs_by_neighbour(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Preference pairs from plain conversations: chosen is the conversation;
    rejected is the same up to its last turn, which is the last turn of the
    conversation whose id differs in the lowest bit.  Without that neighbour
    the rejected side just lacks the last turn.  Turns without a number are
    none's last turn: both sides have them."""
    own = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    last = own.groupBy("pair_id").agg(F.max("turn").alias("last"))
    marked = own.join(last, "pair_id")
    chosen = marked.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    kept = marked.filter("turn IS NULL OR turn < last").select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    ends = marked.filter("turn = last").select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "role", "text")
    lent = last.join(ends, "pair_id").select("pair_id", F.lit("rejected").alias("side"), F.col("last").alias("turn"), "role", "text")
    return chosen.unionByName(kept).unionByName(lent)
