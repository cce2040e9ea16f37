"""Records and bytes counted by the job that writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .archive import Written

#: Name of the counts in the progress of a stream.
WRITTEN = "written"


def content_bytes(df: DataFrame) -> Column:
    """Bytes of request and response of a capture, as far as it has these columns."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("request", "response") if c in df.columns]
    return sum(sizes, F.lit(0))


def counts(size: Column, chosen: Column | None = None) -> list[Column]:
    """Number and bytes of all rows, or of the chosen ones."""
    records = F.count(F.lit(1)) if chosen is None else F.count_if(chosen)
    return [records.alias("records"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes")]


class WriteCount:
    """Counts the rows that pass on their way into one write, without a job of its own."""

    def __init__(self, size: Column):
        self.size, self.seen = size, Observation()

    def of(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *counts(self.size))

    def written(self) -> Written:
        """The counts, once the write has ended."""
        return Written(self.seen.get["records"], self.seen.get["bytes"])


def stream_written(query: StreamingQuery) -> Written:
    """Counts of a stream's batches since its start, as far as its progress reports go back
    (``spark.sql.streaming.numRecentProgressUpdates``, 100 by default)."""
    seen = [p.observedMetrics[WRITTEN] for p in query.recentProgress if WRITTEN in p.observedMetrics]
    return Written(sum(r["records"] for r in seen), sum(r["bytes"] for r in seen))
