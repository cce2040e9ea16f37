"""Referrers and seeds: following ``via`` from capture to capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SEED_WALK_STEPS
from ..sources.scratch import materialize


#: Rows of a block in ``_before``.
BLOCK_ROWS = 1_000_000


def lookup(facts: DataFrame, key: str, dim: DataFrame, dim_key: str, at: tuple[str, str] | None = None) -> DataFrame:
    """Left join to a table with one row per key, balanced whatever the keys of ``facts``.

    One shuffle join, or a broadcast where the planner finds ``dim`` small enough. A key with very many facts makes a
    large partition of facts, which adaptive execution splits while it repeats the one row of ``dim``; there is no look
    at the facts before. Facts without key get one that matches nothing and spreads them evenly. ``at`` names a second
    column on either side that belongs to the key; there a null equals a null."""
    at_fact, at_dim = at or (None, None)
    values = [c for c in dim.columns if c not in (dim_key, at_dim)]
    places = [F.col(at_dim).alias("_dim_at")] if at else []
    other = dim.select(F.col(dim_key).alias("_dim_key"), *places, *[F.col(v).alias(f"_dim_{v}") for v in values])
    spread = F.concat(F.lit("\u0000"), F.hex(F.xxhash64(F.monotonically_increasing_id())))
    keyed = facts.withColumn("_join_key", F.coalesce(F.col(key), spread))
    same = F.col("_join_key") == F.col("_dim_key")
    joined = keyed.join(other, same & F.col(at_fact).eqNullSafe(F.col("_dim_at")) if at else same, "left")
    return joined.select(*facts.columns, *[F.col(f"_dim_{v}").alias(v) for v in values])


def _at(captures: DataFrame, column: str) -> tuple[str, str] | None:
    return ("crawl_time", column) if "crawl_time" in captures.columns else None


def _visits(captures: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Captures that are referrers (``uri``, ``time``, ``row`` of the columns), one per URI and time, ties decided by the
    values; and the referrers that captures ask for (``uri``, ``time`` of the asking capture). Captures are read once."""
    time = F.col("crawl_time") if "crawl_time" in captures.columns else F.lit(None).cast("timestamp_ntz")
    narrow = captures.select("uri", "via", time.alias("time"), F.struct(*columns).alias("row"))
    visits = materialize(narrow, "visits")
    asked = visits.where(F.col("via").isNotNull()).select(F.col("via").alias("uri"), "time").distinct()
    referrers = visits.select(F.col("via").alias("uri")).where(F.col("uri").isNotNull()).distinct()
    # only the visits of referrers: most captures are leaves
    known = visits.join(referrers, "uri", "left_semi").groupBy("uri", "time").agg(F.max("row").alias("row"))
    return known, asked


def _before(known: DataFrame, asked: DataFrame) -> DataFrame:
    """The ``row`` of the last capture of a URI before the time asked for, of its latest one where none is before.

    ``known``: ``uri``, ``time``, ``row``; ``asked``: ``uri``, ``time``; both without repetition. Both are laid in one order and
    cut into blocks of about equal rows, of at most some ``BLOCK_ROWS`` each, so a URI with any number of captures or of
    children is spread over many tasks: what a block does not hold comes from the ends of the blocks before it."""
    spark = known.sparkSession
    kind = known.schema["row"].dataType
    points = known.withColumn("known", F.lit(True)).unionByName(
        asked.withColumns({"row": F.lit(None).cast(kind), "known": F.lit(False)})
    )
    points = materialize(points, "points")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-points.count() // BLOCK_ROWS))
    # of equal times the question comes first: a capture is not its own referrer
    ranges = points.repartitionByRange(n, "uri", "time", "known")
    blocked = materialize(ranges.withColumn("block", F.spark_partition_id()), "blocks")
    last = F.max(F.when(F.col("known"), F.struct("time", "row"))).alias("last")
    ends = blocked.groupBy("uri", "block").agg(last)
    of_uri = Window.partitionBy("uri")
    earlier = of_uri.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        F.col("uri").alias("_uri"),
        F.col("block").alias("_block"),
        F.last("last", ignorenulls=True).over(earlier).alias("_start"),
        F.max("last").over(of_uri).alias("_latest"),
    )
    inside = Window.partitionBy("uri", "block").orderBy("time", "known").rowsBetween(Window.unboundedPreceding, 0)
    found = blocked.withColumn("_inside", F.last("row", ignorenulls=True).over(inside)).where(~F.col("known"))
    joined = found.join(starts, (F.col("uri") == F.col("_uri")) & (F.col("block") == F.col("_block")))
    row = F.coalesce(F.col("_inside"), F.col("_start.row"), F.col("_latest.row"))
    return joined.select("uri", "time", row.alias("row")).where(F.col("row").isNotNull())


def via_join(
    captures: DataFrame,
    columns: tuple[str, ...] = ("status", "content_type", "crawl_time"),
) -> DataFrame:
    """Attach columns of the referring capture as ``via_<column>``, null if it is not there.

    Of several captures of the referrer it is the last one before the capture's own time; where none is before, or
    there are no times, the latest. Ask for narrow columns: a parent's values are repeated for each of its children.
    ``captures`` are read twice: once for these columns, which are written out, and once for the join."""
    found = materialize(_before(*_visits(captures, columns)), "referrers")
    parents = found.select(
        F.col("uri").alias("_parent"), F.col("time").alias("_time"), *[F.col(f"row.{c}").alias(f"via_{c}") for c in columns]
    )
    at = _at(captures, "_time")
    return lookup(captures, "via", parents if at else parents.drop("_time"), "_parent", at)


def _seeds_above(nodes: DataFrame, max_distance: int) -> DataFrame:
    """Nearest seed at or above each node, by pointer doubling.

    ``nodes``: ``node``, its ``uri``, ``next`` and ``is_seed``, one row per node. After round k a
    node knows its nearest seed if that is less than 2^k steps away, else the node
    2^k steps up. Each round is one join whose result is written out, so neither the
    plan nor the work to redo after a lost executor grows from round to round."""
    state = nodes.select(
        "node",
        F.when(F.col("is_seed"), F.col("uri")).alias("seed"),
        F.when(F.col("is_seed"), F.lit(0)).alias("distance"),
        F.when(~F.col("is_seed"), F.col("next")).alias("next"),
    )
    jump = 1
    while jump <= max_distance:
        state = materialize(state, "seeds")
        if state.where(F.col("next").isNotNull()).isEmpty():
            break
        above = state.select(
            F.col("node").alias("_node"),
            F.col("seed").alias("_seed"),
            F.col("distance").alias("_distance"),
            F.col("next").alias("_next"),
        )
        joined = lookup(state, "next", above, "_node")
        state = joined.select(
            "node",
            F.coalesce("seed", "_seed").alias("seed"),
            F.coalesce(F.col("distance"), F.col("_distance") + jump).alias("distance"),
            F.col("_next").alias("next"),
        )
        jump *= 2
    return state.where(F.col("seed").isNotNull() & (F.col("distance") <= max_distance)).select("node", "seed")


def resolve_seed(captures: DataFrame, to: str = "seed_url", steps: int = SEED_WALK_STEPS) -> DataFrame:
    """Add the URI of the seed that a capture was reached from, '' if there is none.

    The walk starts at the referrer and may take ``steps`` steps past it; it ends at the first seed. Each step goes from a
    capture to its referrer's last capture before it, or to the latest where none is before or there are no times.
    ``captures`` are read twice: once for a narrow table of who was reached from where, which is written out and serves
    all that follows, and once for the last join. Only captures that are referrers take part in the doubling; the mass of
    leaves looks its referrer's seed up once, at the end."""
    known, asked = _visits(captures, ("is_seed", "via"))
    known = materialize(known.withColumn("node", F.monotonically_increasing_id().cast("string")), "known")
    found = _before(known.select("uri", "time", F.col("node").alias("row")), asked)
    found = materialize(found.select(F.col("uri").alias("_parent"), F.col("time").alias("_time"), F.col("row").alias("next")), "referrers")
    reached = known.select("node", "uri", "time", F.coalesce("row.is_seed", F.lit(False)).alias("is_seed"), F.col("row.via").alias("via"))
    seeds = _seeds_above(lookup(reached, "via", found, "_parent", ("time", "_time")), steps)
    seeds = materialize(found.join(seeds, F.col("next") == F.col("node")).select("_parent", "_time", F.col("seed").alias("_seed")), "seeds")
    base = captures.drop(to)
    at = _at(captures, "_time")
    out = lookup(base, "via", seeds if at else seeds.drop("_time"), "_parent", at)
    return out.select(*base.columns, F.coalesce("_seed", F.lit("")).alias(to))
