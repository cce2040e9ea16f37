"""Capture tables: the same records as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import annotate_size
from ..schema import MAX_CONTENT_BYTES
from .archive import Written, finished_files_glob
from .counted import WriteCount, content_bytes, counts

DATE = "crawl_date"
DISPOSITION = "disposition"


def sink_table(
    captures: DataFrame,
    path: str,
    mode: str = "errorifexists",
    rebalance: bool = False,
    compression: str = "zstd",
    max_records_per_file: int = 0,
) -> Written:
    """Write captures as Parquet partitioned by crawl date; returns records and content bytes, counted by the write.

    A crawl arrives about in time order, so by default the rows stay where they are
    and nothing is shuffled. For input in another order, ``rebalance`` brings the rows
    of a date together and splits dates that hold much into several files."""
    dated = captures.withColumn(DATE, F.to_date("crawl_time"))
    if rebalance:
        dated = dated.hint("rebalance", DATE)
    seen = WriteCount(content_bytes(captures))
    writer = seen.of(dated).write.mode(mode).partitionBy(DATE).option("compression", compression)
    if max_records_per_file > 0:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    return seen.written()


def sink_split(captures: DataFrame, path: str, max_bytes: int = MAX_CONTENT_BYTES, mode: str = "errorifexists", compression: str = "zstd") -> dict[str, Written]:
    """Write captures and, apart from them, a note on those that are too large, in one pass over the input.

    The table is partitioned by ``disposition`` and crawl date. Rows of ``disposition=written`` are whole captures; those
    of ``disposition=rejected`` have their ``annotation`` and the size of the content as ``content_bytes``, but not the
    content itself. Returns records and content bytes of both."""
    annotated = annotate_size(captures, max_bytes).withColumn(DATE, F.to_date("crawl_time"))
    is_kept = F.col("annotation").isNull()
    rows = annotated.withColumns({DISPOSITION: F.when(is_kept, "written").otherwise("rejected"), "content_bytes": F.octet_length("body").cast("bigint")})
    rows = rows.withColumns({c: F.when(is_kept, F.col(c)) for c in ("request", "response", "body") if c in captures.columns})
    seen, kinds = Observation(), {"written": is_kept, "rejected": ~is_kept}
    counted = [
        metric.alias(f"{kind}_{what}") for kind, chosen in kinds.items()
        for what, metric in zip(("records", "bytes"), counts(F.when(chosen, F.col("content_bytes")), chosen))
    ]
    rows.observe(seen, *counted).write.mode(mode).partitionBy(DISPOSITION, DATE).option("compression", compression).parquet(path)
    return {kind: Written(seen.get[f"{kind}_records"], seen.get[f"{kind}_bytes"]) for kind in kinds}


def scan_split(spark: SparkSession, path: str, disposition: str = "written") -> DataFrame:
    """The written captures of a split table, or the notes on the rejected ones; nothing of the other kind is read."""
    rows = scan_table(spark, path).where(F.col(DISPOSITION) == disposition).drop(DISPOSITION)
    return rows.drop("annotation", "content_bytes") if disposition == "written" else rows.drop("request", "response", "body")


def scan_table(spark: SparkSession, *paths: str) -> DataFrame:
    """Captures of one or more tables; filters on ``crawl_date`` prune directories."""
    return spark.read.option("pathGlobFilter", finished_files_glob()).parquet(*paths)
