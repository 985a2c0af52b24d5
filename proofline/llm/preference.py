"""Preference pairs from two conversations: a common prompt and two completions with masks.

The prompt is the longest common prefix of turns of the chosen and the rejected conversation (same role and text),
rendered once; what follows in each is its completion.  Only what an assistant says in a completion, with the end
mark, is trained on; a mask gives those ranges of characters.

The first difference of a pair is an aggregate over its turns, which combines on the map side; turns are gathered
only to write a completion, so a pair takes as much memory as its own text.

A turn's place is its number; of repeated rows of a turn the least role and text count.  A null role is
``unknown``, a null text empty.  Equal conversations have empty completions; if one is a prefix of the other its
completion is empty.  A pair with one side only has an empty prompt.  Null pair ids and turns are dropped rows of no
conversation.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE_OPEN, ROLE_CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def _turns(table: DataFrame, side: str) -> DataFrame:
    said = F.struct(F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = table.filter("pair_id is not null and turn is not null")
    return rows.groupBy("pair_id", "turn").agg(F.min(said).alias(side))


def escaped(text: Column) -> Column:
    """Text in which nothing reads as a mark."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def opening(role: Column) -> Column:
    return F.concat(F.lit(ROLE_OPEN), escaped(role), F.lit(ROLE_CLOSE))


def rendered(said: Column) -> Column:
    return F.concat(opening(said["role"]), escaped(said["text"]), F.lit(END))


def _written(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["said"])), "")


def _mask(turns: Column) -> Column:
    """Ranges ``[start, end)`` of characters of a completion that are trained on."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("ranges"))

    def after(state: Column, turn: Column) -> Column:
        said = turn["said"]
        begin = state["at"] + F.length(opening(said["role"]))
        end = state["at"] + F.length(rendered(said))
        own = F.array(F.struct(begin.alias("start"), end.alias("end")))
        ranges = F.when(said["role"] == TRAINED, F.concat(state["ranges"], own)).otherwise(state["ranges"])
        return F.struct(end.alias("at"), ranges.alias("ranges"))

    return F.aggregate(turns, start, after)["ranges"]


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, n_prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask``.

    Both tables have ``pair_id, turn, role, text``.
    """
    turns = _turns(chosen, "chosen").join(_turns(rejected, "rejected"), ["pair_id", "turn"], "full")
    differs = ~F.equal_null("chosen", "rejected")
    # One aggregation: sort_array puts turns in order, the first difference cuts them.
    pairs = turns.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("turn"))).alias("first"),
        F.sort_array(F.collect_list(F.when(F.col("chosen").isNotNull(), F.struct("turn", F.col("chosen").alias("said"))))).alias("yes"),
        F.sort_array(F.collect_list(F.when(F.col("rejected").isNotNull(), F.struct("turn", F.col("rejected").alias("said"))))).alias("no"),
    )
    common = F.filter("yes", lambda t: F.col("first").isNull() | (t["turn"] < F.col("first")))
    tail = {side: F.filter(side, lambda t: t["turn"] >= F.col("first")) for side in ("yes", "no")}
    cut = pairs.select("pair_id", common.alias("common"), *[F.coalesce(t, F.array_except(s, s)).alias(s) for s, t in tail.items()])
    return cut.select(
        "pair_id",
        F.size("common").cast("long").alias("n_prompt_turns"),
        _written(F.col("common")).alias("prompt"),
        _written(F.col("yes")).alias("chosen"),
        _mask(F.col("yes")).alias("chosen_mask"),
        _written(F.col("no")).alias("rejected"),
        _mask(F.col("no")).alias("rejected_mask"),
    )


def mask_text(mask: Column) -> Column:
    """A mask as ``start-end`` ranges with commas."""
    return F.array_join(F.transform(mask, lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ",")


# A rejected answer for every conversation: from turn ``conv_id % 9`` on the texts differ, and two turns later it ends.
REJECTED = """
    SELECT conv_id AS pair_id, turn, role, CASE WHEN turn >= conv_id % 9 THEN text || ' (again)' ELSE text END AS text
    FROM {conversations} WHERE turn < conv_id % 9 + 2
"""


def rejected_of(conversations: DataFrame) -> DataFrame:
    return conversations.sparkSession.sql(REJECTED, conversations=conversations)
