"""Chat formatting: logged conversations that others continue are collapsed, the rest is rendered.

A log holds snapshots of growing conversations. The hash of the first k turns is rolled from turn to
turn; a conversation whose last hash is the hash of fewer than all turns of another one is a prefix
of it and goes, by an anti join. Of conversations with the same turns, the one with the least
conv_id stays.

A rolled hash is the sum of one hash for each turn, which covers its place, role and text. Sums can
be taken part by part: the turns of a conversation are cut into stretches by their number, so no
task ever has to hold a whole one to hash it. Only what is rendered comes together, as the one value
it is.

Defined results: turns are ordered by turn, then role, then text, with NULLs first; repeated rows
are one turn; turns of one number with other contents are all kept; a NULL role or text is rendered
as empty, but is not the same turn as an empty one; rows without conv_id are one conversation. Other
columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: How many turn numbers make a stretch.
STRETCH = 1024

# --- fixed values: the chat template ---------------------------------------------
BEGIN = "<|im_start|>"
END = "<|im_end|>"
# --- end of the fixed values ------------------------------------------------------


def _turn_hash(seed: int) -> Column:
    """A hash of a turn and its place, as a number that many of can be summed."""
    return F.xxhash64(
        F.lit(seed),
        "place",
        F.col("role").isNull(),
        F.coalesce("role", F.lit("")),
        F.col("text").isNull(),
        F.coalesce("text", F.lit("")),
    ).cast("decimal(38,0)")


def prefix_hashes(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """conv_id, place (of the turn, from 0), is_last, and two hashes of the turns up to it.

    The turns of a stretch are numbered and summed in it; what came before is carried from stretch
    to stretch by one row each.
    """
    spark = conversations.sparkSession
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    turns = turns.withColumn("stretch", F.floor(F.col("turn") / stretch))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    own = Window.partitionBy("conv_id", "stretch").orderBy(*order)
    sizes = turns.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    across = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_first())
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "conv_id",
        "stretch",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    hashed = (
        turns.withColumn("nth", F.row_number().over(own) - 1)
        .join(sizes.toDF("c", "s", "earlier", "n_turns"), _same(("conv_id", "c"), ("stretch", "s")))
        .withColumn("place", F.col("earlier") + F.col("nth"))
        .select("conv_id", "stretch", "place", "n_turns", _turn_hash(1).alias("h1"), _turn_hash(2).alias("h2"))
    )
    hashed = stored(spark, hashed, "chat-turns")
    sums = hashed.groupBy("conv_id", "stretch").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    carried = sums.select(
        F.col("conv_id").alias("c"),
        F.col("stretch").alias("s"),
        *(F.coalesce(F.sum(h).over(before), F.lit(0)).alias(f"{h}_before") for h in ("h1", "h2")),
    )
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        hashed.withColumns({h: F.sum(h).over(so_far) for h in ("h1", "h2")})
        .join(carried, _same(("conv_id", "c"), ("stretch", "s")))
        .select(
            "conv_id",
            "place",
            (F.col("place") == F.col("n_turns") - 1).alias("is_last"),
            (F.col("h1") + F.col("h1_before")).alias("h1"),
            (F.col("h2") + F.col("h2_before")).alias("h2"),
        )
    )


def _same(*pairs: tuple[str, str]) -> Column:
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


def maximal(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """conv_id of the conversations that stay, with n_turns and n_same (conversations with the same
    turns).

    Equal hashes are one row each before they meet, so that a common first turn or conversation is
    one row too.
    """
    spark = conversations.sparkSession
    hashes = stored(spark, prefix_hashes(conversations, stretch), "chat-hashes")
    inner = hashes.where("NOT is_last").select("place", "h1", "h2").distinct()
    whole = (
        hashes.where("is_last")
        .groupBy("place", "h1", "h2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_same"),
        )
    )
    return whole.join(inner, ["place", "h1", "h2"], "left_anti").select(
        "conv_id", (F.col("place") + 1).alias("n_turns"), "n_same"
    )


def rendered_turn() -> Column:
    return F.concat(
        F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n")
    )


def render(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """One row per conversation that stays: conv_id, n_turns, n_same, text."""
    kept = stored(conversations.sparkSession, maximal(conversations, stretch), "chat-kept")
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    texts = (
        turns.join(kept.withColumnRenamed("conv_id", "c"), _same(("conv_id", "c")))
        .groupBy("conv_id", "n_turns", "n_same")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", rendered_turn().alias("out")))).alias("t"))
    )
    return texts.select(
        "conv_id", "n_turns", "n_same", F.array_join(F.transform("t", lambda t: t["out"]), "").alias("text")
    )
