"""Captures as they arrive: parsed, filtered and appended to a capture table.

All steps work on one row at a time, so the stream keeps no state. The sink's
commit log publishes each batch as a whole, which takes the place of files that are
renamed when complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import URL_REJECT, filter_size, filter_url_reject
from ..operators.parse import parse_records
from ..schema import MAX_CONTENT_BYTES, RAW, FieldNames
from ..sources.archive import finished_files_glob
from ..sources.counted import WRITTEN, content_bytes, counts
from ..sources.table import DATE


def stream_rows(spark: SparkSession, path: str, schema: T.StructType = RAW, max_files: int | None = None) -> DataFrame:
    """Rows of the Parquet files that appear under a path, unfinished files left out."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", finished_files_glob())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_filter(captures: DataFrame, max_bytes: int = MAX_CONTENT_BYTES, reject: str = URL_REJECT) -> DataFrame:
    """The write rules on the stream: content size and URL pattern."""
    return filter_url_reject(filter_size(captures, max_bytes), reject)


def stream_ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    names: FieldNames = FieldNames(),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the ingest of a stream of RAW rows into a capture table.

    ``transform`` is applied to the parsed captures, ``stream_filter`` for example.
    Records with a bad envelope stay in the table with their ``error``. Each batch counts what it writes: see
    ``stream_written``."""
    captures = parse_records(raw, names)
    if transform is not None:
        captures = transform(captures)
    captures = captures.observe(WRITTEN, *counts(content_bytes(captures)))
    writer = (
        captures.withColumn(DATE, F.to_date("crawl_time"))
        .writeStream.format("parquet")
        .partitionBy(DATE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
