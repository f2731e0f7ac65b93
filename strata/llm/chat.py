"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Logs often hold a conversation several times, after each turn.  Each conversation's turns get
rolling prefix hashes; a conversation whose whole hash is the hash of a shorter stretch of
another one is a snapshot of it and goes (anti join), and of equal conversations the one with
the smallest id stays.  What is left is rendered with a chat template.

The prefix hash behind turn i is the sum of 128-bit hashes of (position, role, text) of
the turns up to i (four 32-bit limbs), so it can be added up in blocks: a conversation of any length
is worked on in blocks of turn numbers, and its blocks' sums are added in a second, small step.
Rendering gives one row per ``segment`` turns (most conversations: one row).

Defined results: turns are ordered by turn, role, text, nulls first; repeated rows are one turn; rows with null
id are one conversation with null id (last among equals); null role and text render as
empty but differ from empty text in comparisons; the template's marks inside a text are broken by a
blank; an empty table gives no row; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.session import ensure_checkpoint_dir

BLOCK = 4096
SEGMENT = 1000
LIMBS = ["a", "b", "c", "d"]


def _turns(chats: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The distinct turns: id, key (never null), t, role, text."""
    return chats.select(
        F.col(conv_id).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("-")).alias("key"),
        F.col(turn).cast("long").alias("t"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text")).distinct()


def _placed(turns: DataFrame, block: int) -> DataFrame:
    """The turns with their position ``i`` (from 1), the conversation's length ``n`` and ``block``."""
    turns = turns.withColumn("block", F.floor(F.coalesce(F.col("t"), F.lit(-1)) / block))
    counts = turns.groupBy("key", "block").agg(F.count("*").alias("c"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"),
                           F.sum("c").over(Window.partitionBy("key")).alias("n"))
    inside = Window.partitionBy("key", "block").orderBy(
        F.asc_nulls_first("t"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    return turns.withColumn("r", F.row_number().over(inside)).join(counts, ["key", "block"]) \
        .withColumn("i", F.col("base") + F.col("r"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``key, id, i, n`` and the limbs of the prefix hash behind each position."""
    said = (F.col("i"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    low, high = F.xxhash64(F.lit(1), *said), F.xxhash64(F.lit(2), *said)
    limb = lambda h, k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(0xFFFFFFFF))
    own = turns.select("key", "id", "i", "n", "block", limb(low, 0).alias("a"), limb(low, 32).alias("b"),
                       limb(high, 0).alias("c"), limb(high, 32).alias("d"))
    sums = own.groupBy("key", "block").agg(*(F.sum(x).alias(x) for x in LIMBS))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "block", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in LIMBS))
    inside = Window.partitionBy("key", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    running = own.select("key", "id", "i", "n", "block", *(F.sum(x).over(inside).alias(x) for x in LIMBS))
    return running.join(sums, ["key", "block"]).select(
        "key", "id", "i", "n", *((F.col(x) + F.col(f"{x}0")).alias(x) for x in LIMBS))


def maximal(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", block: int = BLOCK) -> DataFrame:
    """The turns (``key, id, i, n, role, text``) of the conversations that no other one goes on from or repeats."""
    ensure_checkpoint_dir(chats.sparkSession)
    turns = _placed(_turns(chats, conv_id, turn, role, text), block) \
        .select("key", "id", "i", "n", "block", "role", "text").checkpoint()
    found = prefixes(turns).checkpoint()
    whole = found.where("i = n").groupBy("i", *LIMBS).agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    parts = found.where("i < n").select("i", *LIMBS).distinct()
    stay = whole.join(parts, ["i", *LIMBS], "left_anti").select(F.col("first.key").alias("key"))
    return turns.join(stay, "key", "left_semi").select("key", "id", "i", "n", "role", "text")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template; marks within the text lose their force."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), F.replace(F.coalesce(role, F.lit("")), F.lit("<|"), F.lit("< |")),
                    F.lit("\n"), plain, F.lit("<|im_end|>\n"))


def render(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``id, segment`` (from 0), ``n_turns`` (of the conversation), ``text``: the turns of each segment rendered."""
    own = turns.select("key", "id", "n", "i", F.floor((F.col("i") - 1) / segment).alias("segment"),
                       rendered(F.col("role"), F.col("text")).alias("said"))
    return own.groupBy("key", "id", "n", "segment").agg(
        F.sort_array(F.collect_list(F.struct("i", "said"))).alias("turns")) \
        .select("id", "segment", F.col("n").alias("n_turns"),
                F.array_join(F.col("turns.said"), "").alias("text"))


def collapse_and_render(chats: DataFrame, segment: int = SEGMENT, **names) -> DataFrame:
    return render(maximal(chats, **names), segment)
