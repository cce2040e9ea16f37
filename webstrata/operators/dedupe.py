"""One capture per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sources.scratch import materialize


#: Estimated size from which bodies of captures are fetched after ranking; below, the extra jobs cost more than they save.
LATE_BYTES = 1 << 30
#: Steps that pass on each row of a file at most once.
_ROW_BY_ROW = {"Project", "Filter", "CollectMetrics", "SubqueryAlias", "View"}


def _row_in_file(captures: DataFrame) -> list[Column] | None:
    """What tells the rows of Parquet files apart: file and place; None if the rows don't come straight from such files.

    They do if each was selected from one row of them, by conditions that give the same result each time."""
    plan = captures._jdf.queryExecution().analyzed()
    hidden = plan.metadataOutput()
    found = [hidden.apply(i) for i in range(hidden.size())]
    if not any(x.name() == "_metadata" and "row_index" in list(x.dataType().fieldNames()) for x in found):
        return None
    while plan.children().size() == 1 and plan.getClass().getSimpleName() in _ROW_BY_ROW and plan.deterministic():
        plan = plan.children().apply(0)
    if plan.children().size() or plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def _ranked(captures: DataFrame) -> DataFrame:
    newest = Window.partitionBy("canonical_url").orderBy(F.col("crawl_time").desc_nulls_last(), "uri")
    return captures.withColumn("_rank", F.row_number().over(newest))


def _with_page(captures: DataFrame, url: str) -> DataFrame:
    return U.with_canonical_url(captures, url).withColumn("canonical_url", F.coalesce("canonical_url", url, "uri"))


def dedupe_captures(captures: DataFrame, url: str = "url", late_bytes: int = LATE_BYTES) -> DataFrame:
    """Latest capture of each canonical URL, with that URL as ``canonical_url``.

    URLs without canonical form are told apart by themselves. Of captures with the
    same time the one with the smaller URI is kept.

    Captures that come straight from Parquet files (``scan_table`` and what was
    selected or filtered from it), of at least ``late_bytes`` by the planner's estimate,
    are ranked by their narrow columns and their place
    in the files; only these are sorted and shuffled, and written out. Bodies are then
    fetched by one join on the places that are needed less often, those that stay or
    those that go: a broadcast if they are small by their size on disk.

    All others are ranked as whole rows. The row number limit runs before the shuffle
    too, so each task sends on at most one capture per page and a page that was
    fetched very often does not pile up in one task."""
    large = captures._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= late_bytes
    place = _row_in_file(captures) if large else None
    if place is None:
        return _ranked(_with_page(captures, url)).where("_rank = 1").drop("_rank")
    names = list(dict.fromkeys([url, "uri", "crawl_time"]))
    ranked = _ranked(_with_page(captures.select(*names, *place), url))
    ranked = materialize(ranked.select("_file", "_row", (F.col("_rank") == 1).alias("_stays")), "places")
    stay, all_rows = ranked.agg(F.count_if("_stays"), F.count(F.lit(1))).first()
    few = "left_semi" if 2 * stay <= all_rows else "left_anti"
    wanted = ranked.where(F.col("_stays") == (few == "left_semi")).select("_file", "_row")
    kept = captures.select("*", *place).join(wanted, ["_file", "_row"], few)
    return _with_page(kept.select(*captures.columns), url)
