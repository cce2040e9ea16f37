"""Collapse of cumulative conversation snapshots, and chat formatting of what is left, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize

#: Turn numbers that are counted through together; longer conversations are counted in parts.
TURNS_A_BLOCK = 1024
#: Turns rendered into one text. A longer conversation gives several, so that no row grows without bound.
TURNS_A_SEGMENT = 256


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with a conversation key that is never null, and a hash of role and text that tells null from empty."""

    def told(column: str):
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))

    mark = F.sha2(F.concat_ws("\u0000", F.length(told("role")).cast("string"), told("role"), told("text")), 256)
    return turns.select(told("conv_id").alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", mark.alias("mark"))


def rolling_hashes(keyed: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, mark, place, p1, p2): each turn's place and two hashes of the turns up to it.

    A hash of a prefix is the exclusive or of hashes of (place, turn), so equal prefixes have equal hashes wherever
    they are. Repeated turns count once. Blocks of turn numbers are counted and hashed apart and put together by their
    sums, so a conversation of any length is spread over many tasks."""
    block = F.coalesce(F.floor(F.col("turn") / TURNS_A_BLOCK), F.lit(-1)).alias("block")
    rows = keyed.select("conv", "conv_id", "turn", "mark", block).distinct()
    rows = materialize(rows, "turns")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    starts = counts.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    order = Window.partitionBy("conv", "block").orderBy("turn", "mark")
    placed = rows.withColumn("number", F.row_number().over(order)).join(starts, ["conv", "block"])
    placed = placed.withColumn("place", (F.col("start") + F.col("number")).cast("long"))
    hashed = placed.select(
        "conv", "conv_id", "block", "turn", "mark", "place",
        F.xxhash64("place", "mark").alias("h1"), F.xxhash64("mark", F.lit("second"), "place").alias("h2"),
    )
    sums = hashed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    sums = sums.select("conv", "block", *[F.coalesce(F.bit_xor(s).over(earlier), F.lit(0)).cast("long").alias(s) for s in ("s1", "s2")])
    upto = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    within = hashed.withColumns({"r1": F.bit_xor("h1").over(upto), "r2": F.bit_xor("h2").over(upto)})
    joined = within.join(sums, ["conv", "block"])
    return joined.select(
        "conv", "conv_id", "turn", "mark", "place", F.col("r1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("s2")).alias("p2")
    )


def maximal_conversations(rolling: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that are no beginning of a longer one, one of each content.

    A content is continued if more conversations pass through its prefix hash than end there. Both counts are made
    with partial aggregation, so a first turn that most conversations share, or one conversation logged a million
    times, is a handful of rows before it is shuffled."""
    last = F.max(F.struct("place", "p1", "p2")).alias("last")
    whole = rolling.groupBy("conv").agg(last, F.max("conv_id").alias("conv_id"))
    kept = F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), F.col("conv_id"), F.col("conv"))).alias("kept")
    ends = whole.groupBy("last.place", "last.p1", "last.p2").agg(F.count("*").alias("n_copies"), kept)
    through = rolling.groupBy("place", "p1", "p2").agg(F.count("*").alias("n_through"))
    continued = ends.join(through, ["place", "p1", "p2"]).where(F.col("n_through") > F.col("n_copies")).select("place", "p1", "p2")
    maximal = ends.join(continued, ["place", "p1", "p2"], "left_anti")
    return maximal.select("kept.conv", F.col("place").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """Rendered maximal conversations: ``conv_id``, ``segment``, ``n_turns``, ``n_copies``, ``text``.

    ``turns``: ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored. Turns are ordered by number, those
    of one number by content; a turn logged twice counts once. Conversations that begin another one are left out; of
    equal ones the smallest id stays (``n_copies`` tells how many there were). Texts are joined only for what stays,
    ``TURNS_A_SEGMENT`` turns to a row. A null role or text is rendered empty but is not equal to an empty one; turns
    without number come first; rows without ``conv_id`` are one conversation; markers within texts are broken up."""
    keyed = _keyed(turns)
    rolling = materialize(rolling_hashes(keyed), "prefixes")
    kept = materialize(maximal_conversations(rolling), "maximal")
    places = rolling.join(kept, "conv").select("conv", "turn", "mark", "place", "n_turns", "n_copies")
    same = [keyed[c].eqNullSafe(places[c]) for c in ("conv", "turn", "mark")]
    joined = keyed.join(places, same[0] & same[1] & same[2]).select(
        places["conv"], "conv_id", "place", "n_turns", "n_copies", "role", keyed["text"], F.floor((F.col("place") - 1) / TURNS_A_SEGMENT).alias("segment")
    )
    once = joined.dropDuplicates(["conv", "segment", "place"])

    def shown(column: str):
        return F.replace(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))

    piece = F.concat(F.lit("<|im_start|>"), shown("role"), F.lit("\n"), shown("text"), F.lit("<|im_end|>\n"))
    collected = once.groupBy("conv", "segment").agg(
        F.max("conv_id").alias("conv_id"), F.max("n_turns").alias("n_turns"), F.max("n_copies").alias("n_copies"),
        F.array_sort(F.collect_list(F.struct("place", piece.alias("piece")))).alias("pieces"),
    )
    return collected.select("conv_id", "segment", "n_turns", "n_copies", F.array_join("pieces.piece", "").alias("text"))
