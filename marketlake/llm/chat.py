"""Chat logs: drop conversations that are the beginning of a longer one, render the turns of the rest.

Logs often hold a snapshot of a conversation after every turn. A conversation is the multiset of its
turns (turn number, role, text). Four sums of independent 32-bit hashes over its rows identify it, and the same sums over the rows
up to each turn number identify its beginnings. A conversation goes if its sums are those of a
beginning of another that is longer, or of an equal one with a smaller id. Both are equality joins of hashes.

The sums up to each turn are computed in blocks of BLOCK turn numbers, so a conversation with very many
rows is not sorted in one task; rows of one turn are added up before that.

Defined results: null turns come first and null roles and texts are values of their own (rendered as empty); rows of a turn in
order of role and text; repeated rows are part of a conversation; rows with a null conversation id are one
conversation, last among equals; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

BLOCK, SUMS = 64, 4
FIRST_TURN = -(1 << 62)
START, END = "<|im_start|>", "<|im_end|>"


def _hash(seed: int) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in ("turn", "role", "text")]
    return F.xxhash64(F.lit(seed), *parts).bitwiseAND(F.lit(0xFFFFFFFF))


def beginnings(turns: DataFrame) -> DataFrame:
    """``conv_id, turn_key, n, s0..s3, whole``: count and sums of the rows up to each turn; ``whole`` at the last turn."""
    names = ["n", *[f"s{k}" for k in range(SUMS)]]
    key = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN))
    one = turns.select("conv_id", key.alias("turn_key"), *[_hash(k).alias(f"s{k}") for k in range(SUMS)], F.lit(1).alias("n"))
    by_turn = one.groupBy("conv_id", "turn_key").agg(*[F.sum(c).alias(c) for c in names])
    by_turn = stored(by_turn.withColumn("block", F.floor(F.col("turn_key") / BLOCK)))
    blocks = by_turn.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in names])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    offsets = blocks.select(
        F.col("conv_id").alias("of"), F.col("block").alias("at"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in names],
        F.coalesce(F.count("block").over(after), F.lit(0)).alias("later"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn_key")
    last = F.lead("turn_key").over(inside).isNull()
    running = by_turn.select("conv_id", "turn_key", "block", *[F.sum(c).over(inside).alias(c) for c in names], last.alias("last"))
    joined = running.join(offsets, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    return joined.select(
        "conv_id", "turn_key", *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in names], (F.col("last") & (F.col("later") == 0)).alias("whole")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no beginning of a longer one; of equal ones the smallest id."""
    found = stored(beginnings(turns))
    names = ["n", *[f"s{k}" for k in range(SUMS)]]
    whole = found.filter("whole").select("conv_id", *names)
    longer = found.filter("NOT whole").select(*names).distinct()
    first = whole.groupBy(names).agg(F.min(F.struct(F.col("conv_id").isNull(), F.col("conv_id"))).alias("first"))
    return first.join(longer, names, "left_anti").select(F.col("first.conv_id").alias("conv_id"))


def render(role: Column, text: Column) -> Column:
    """A turn in chat markup. Markers inside a text are broken up, so that they cannot end a turn."""
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<​|")), F.lit("|>"), F.lit("|​>"))
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"), plain, F.lit(END + "\n"))


def collapse_snapshots(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turn, role, rendered``: the turns of the maximal conversations, one row each (joined in turn order they are the training text)."""
    named = turns.select(
        turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"), turns[role_col].alias("role"), turns[text_col].alias("text")
    )
    kept = maximal(named).select(F.struct("conv_id").alias("kept"))
    return named.join(kept, F.col("conv_id").eqNullSafe(F.col("kept.conv_id"))).select(
        "conv_id", "turn", "role", render(F.col("role"), F.col("text")).alias("rendered")
    )


#: The same by whole lists of turns, for DuckDB.
SQL = """
WITH lists AS (
  SELECT conv_id, list({'t': turn, 'r': role, 'x': text} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations GROUP BY conv_id),
dropped AS (
  SELECT DISTINCT a.conv_id FROM lists a JOIN lists b ON a.turns[1] = b.turns[1] AND a.conv_id <> b.conv_id
    AND ((len(b.turns) > len(a.turns) AND b.turns[:len(a.turns)] = a.turns AND b.turns[len(a.turns) + 1].t > a.turns[-1].t)
      OR (b.turns = a.turns AND b.conv_id < a.conv_id)))
SELECT conv_id, turn, role,
  '<|im_start|>' || coalesce(role, '') || chr(10)
    || replace(replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|'), '|>', '|' || chr(8203) || '>') || '<|im_end|>' || chr(10) AS rendered
FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM dropped)
"""
