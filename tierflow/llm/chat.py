"""Chat formatting after the collapse of cumulative snapshots.

Logs often hold a conversation again and again, each time a few turns longer. Every turn gets the hash of the whole
conversation up to it, a running sum of the hashes of (place, role, text). A conversation whose last hash is the hash of
an earlier turn of a longer one is a prefix of it; an anti-join leaves the conversations that are no prefix, one of each
set of equal ones. Only these are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import stored
from tierflow.operators.ordered import is_hot, row_numbers, running_totals

#: Turns of one rendered row; a longer conversation is rendered in several parts.
PART = 512
# The marks of the chat form, and what stands for an opening mark inside a text.
OPEN, CLOSE, ESCAPED = "<|im_start|>", "<|im_end|>", "<\\|im_"


def with_prefix_hashes(turns: DataFrame, hot: bool) -> DataFrame:
    """``turns(conv, turn, role, text)`` with the place of each turn and two running hashes.

    ``hot`` says that some conversation is too long for the window of one task.
    """
    order = ["turn", "role", "text"]
    placed = row_numbers(turns, ["conv"], order, "place", hot)
    own = lambda seed: F.xxhash64(F.lit(seed), "place", "role", "text").cast("decimal(38,0)")
    return running_totals(placed, ["conv"], order, {"p1": own(1), "p2": own(2)}, hot)


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that are no proper prefix of another, the smallest of equals."""
    sizes = turns.groupBy("conv").agg(F.max("place").alias("n_turns"))
    marked = turns.select("conv", "place", "p1", "p2").join(sizes, "conv")
    whole = marked.where("place = n_turns").groupBy("place", "p1", "p2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_copies")
    )
    inner = marked.where("place < n_turns").select("place", "p1", "p2").distinct()
    return whole.join(inner, ["place", "p1", "p2"], "left_anti").select("conv", F.col("place").alias("n_turns"), "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in chat form; an opening mark inside the text is escaped, so that no text can end its turn."""
    safe = F.replace(text, F.lit("<|im_"), F.lit(ESCAPED))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), safe, F.lit(CLOSE), F.lit("\n"))


def format_conversations(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The maximal conversations in chat form: id, part, n_turns (of the conversation), n_copies, text.

    Turns are ordered by number, then role and text; equal rows of a conversation count once. A null role is rendered as
    ``unknown``, a null text as empty, a null turn comes first. Rows without a conversation id belong to none and are
    left out. ``n_copies`` counts equal conversations. Conversations of more than PART turns come in parts, to be joined
    in order. Other columns are not read; an empty table gives no rows.
    """
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("unknown")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    hashed = stored(with_prefix_hashes(turns.distinct(), is_hot(turns, ["conv"])), "chat-turns")
    kept = maximal(hashed).withColumnRenamed("conv", "kept")
    rows = hashed.join(kept, F.col("conv") == F.col("kept"))
    part = F.floor((F.col("place") - 1) / PART).cast("int").alias("part")
    turn = F.struct("place", rendered_turn(F.col("role"), F.col("text")).alias("shown"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["shown"]), "")
    grouped = rows.groupBy("conv", part, "n_turns", "n_copies").agg(joined.alias("text"))
    return grouped.select(F.col("conv").alias(id_col), "part", "n_turns", "n_copies", "text")
