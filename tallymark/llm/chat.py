"""Chat formatting of the longest snapshots of logged conversations.

A conversation is often logged again after each turn. Rolling hashes of all turn prefixes tell which logged conversations
are the beginning of a longer one; anti-joins leave the maximal ones, which are rendered.

Turns are ordered by turn number, then role and text; rows that repeat a turn count once. Two equal conversations are one,
that of the smaller id. Defined cases: null role or text counts as empty and as different from nothing; null turns come
first; rows with a null conversation id are one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one conversation that a task numbers and adds up at once.
BLOCK = 256


def prefix_hashes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """conv, n (1 for the first turn), h1, h2 (hashes of turns 1 to n), role, text.

    The hash of a prefix is the sum of hashes of (place, role, text). So a long conversation is numbered and summed in
    blocks of turn numbers, and the blocks are put together by their totals.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).distinct()
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))))
    totals = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    along = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("place", F.row_number().over(inside)).join(totals, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    rows = rows.withColumn("n", F.col("place") + F.col("before"))
    # Terms keep 40 bits, so that sums of 8 million turns stay exact.
    term = lambda salt: F.shiftrightunsigned(F.xxhash64("n", "role", "text", F.lit(salt)), 24)
    rows = rows.withColumns({"t1": term(1), "t2": term(2)})
    sums = rows.groupBy("conv", "block").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
    earlier = [F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"e{c}") for c in ("s1", "s2")]
    sums = sums.select(F.col("conv").alias("sc"), F.col("block").alias("sb"), *earlier)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"r1": F.sum("t1").over(so_far), "r2": F.sum("t2").over(so_far)})
    rows = rows.join(sums, F.col("conv").eqNullSafe(F.col("sc")) & (F.col("block") == F.col("sb")))
    return rows.select("conv", "n", (F.col("r1") + F.col("es1")).alias("h1"), (F.col("r2") + F.col("es2")).alias("h2"), "role", "text")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv and n of the conversations that are neither the beginning of a longer one nor a copy of one with a smaller id."""
    last = prefixes.groupBy("conv").agg(F.max(F.struct("n", "h1", "h2")).alias("last")).select("conv", "last.*")
    one = last.groupBy("n", "h1", "h2").agg(F.min(F.struct(F.col("conv").isNull().alias("nameless"), "conv")).alias("first")).select("n", "h1", "h2", F.col("first.conv").alias("conv"))
    sizes = last.select(F.col("conv").alias("c"), F.col("n").alias("length"))
    inner = prefixes.join(sizes, F.col("conv").eqNullSafe(F.col("c")) & (F.col("n") < F.col("length"))).select("n", "h1", "h2").distinct()
    return one.join(inner, ["n", "h1", "h2"], "left_anti").select("conv", "n")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat markup."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.trim(text), F.lit("<|im_end|>\n"))


def collapse_and_render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """conv, n_turns and the rendered text of every maximal conversation."""
    prefixes = prefix_hashes(turns, conv, turn, role, text, block)
    kept = maximal(prefixes.select("conv", "n", "h1", "h2")).select(F.col("conv").alias("kept_conv"), F.col("n").alias("n_turns"))
    rows = prefixes.select("conv", "n", "role", "text").join(kept, F.col("conv").eqNullSafe(F.col("kept_conv")))
    parts = F.array_sort(F.collect_list(F.struct("n", rendered(F.col("role"), F.col("text")).alias("part"))))
    out = rows.groupBy("conv", "n_turns").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("chat"))
    return out.select(F.col("conv").alias(conv), F.col("n_turns").cast("bigint").alias("n_turns"), "chat")
