"""Crawl reports: counts of charsets, types and links, and bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.links import hosted_links
from ..sources.scratch import materialize

#: Records of a block in ``running_bytes``.
BLOCK_ROWS = 1_000_000


def count_charsets(captures: DataFrame) -> DataFrame:
    """Captures per charset; null for those that declare none."""
    return captures.groupBy("charset").agg(F.count("*").alias("documents"))


def count_mime_types(captures: DataFrame) -> DataFrame:
    """Captures per content type; null for those that declare none."""
    return captures.groupBy("content_type").agg(F.count("*").alias("documents"))


def count_links(captures: DataFrame, url: str = "url", body: str = "body", by: Column | None = None) -> DataFrame:
    """Internal, external and unresolvable links per group of pages, by default per host.

    Counts are taken per task before the shuffle, so a host with most of the links
    arrives as one row per task."""
    links = hosted_links(captures, url, body, keep_unresolved=True)
    group = F.col("src_host").alias("host") if by is None else by
    return links.groupBy(group).agg(
        F.count_if("is_internal").alias("internal"),
        F.count_if(~F.col("is_internal")).alias("external"),
        F.count_if(F.col("target_url").isNull()).alias("unresolved"),
    )


def bytes_written(raw: DataFrame, *by: str) -> DataFrame:
    """Records and framed document bytes, in all or per group."""
    size = (F.octet_length("doc") + 4).cast("bigint")
    return raw.groupBy(*by).agg(F.count("*").alias("records"), F.sum(size).alias("bytes"))


def running_bytes(
    raw: DataFrame, shard: str, order: tuple[str, ...], blocks: int | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Bytes appended to a shard up to and including each record, as ``position``.

    Each shard is cut along its order into blocks of about equal rows, so a shard of
    any size is spread over many tasks, of at most about ``BLOCK_ROWS`` rows each: the sum inside a block plus the total of the
    blocks before it. The block numbers are written out, because both sums have to
    see the same ones. Records that are equal in ``order`` are told apart by a row id
    and may lie in different blocks; which of them comes first is open."""
    spark = raw.sparkSession
    names = list(dict.fromkeys([shard, *order, *keep]))
    size = (F.octet_length("doc") + 4).cast("bigint")
    narrow = raw.select(*names, size.alias("bytes"), F.monotonically_increasing_id().alias("_row"))
    narrow = materialize(narrow, "sizes")
    n = blocks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-narrow.count() // BLOCK_ROWS))
    ranges = narrow.repartitionByRange(n, shard, *order, "_row")
    blocked = materialize(ranges.withColumn("_block", F.spark_partition_id()), "blocks")
    sums = blocked.groupBy(shard, "_block").agg(F.sum("bytes").alias("_sum"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(shard).alias("_shard"),
        F.col("_block").alias("_start_block"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(shard, "_block").orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, 0)
    running = blocked.withColumn("_inside", F.sum("bytes").over(inside))
    return running.join(
        starts,
        running[shard].eqNullSafe(F.col("_shard")) & (F.col("_block") == F.col("_start_block")),
    ).select(*names, "bytes", (F.col("_start") + F.col("_inside")).alias("position"))


def output_text(counts: DataFrame, path: str, name: str, count: str = "documents", no_name: str = "null", one_file: bool = False) -> None:
    """Write a count report as text files of ``name<TAB>count`` lines, by name within and across the files.

    ``one_file`` merges them in one task: for reports known to be small."""
    lines = counts.select(
        F.concat_ws("\t", F.coalesce(F.col(name), F.lit(no_name)), F.col(count).cast("string")).alias("value")
    )
    ordered = lines.orderBy("value")
    (ordered.coalesce(1) if one_file else ordered).write.text(path)
