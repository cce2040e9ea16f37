"""Output files that roll over by size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ROLL_BYTES
from .archive import Written, check_roll_size
from .counted import WriteCount


def assign_files(df: DataFrame, max_bytes: int = ROLL_BYTES, size: Column | None = None, to: str = "file_no") -> DataFrame:
    """Number the output files of each task: a new one starts when the size so far is
    over the limit, so a file is at most one record larger.

    The rule starts anew with each file, which no running sum expresses. It is applied
    to the stream of sizes of a task with a single number as state; there is no
    shuffle, no group is held in memory, and only the sizes go through Python."""
    check_roll_size(max_bytes)
    size = F.octet_length("doc") if size is None else size
    if max_bytes == -1:
        return df.withColumn(to, F.lit(0))

    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        file_no, used = 0, 0
        for sizes in batches:
            total = used + np.cumsum(sizes.to_numpy(dtype=np.int64))
            numbers = np.empty(len(total), dtype=np.int32)
            start, before = 0, 0
            while start < len(total):
                # the record that takes the file over the limit is its last one
                over = int(np.searchsorted(total, before + max_bytes, side="right"))
                numbers[start : over + 1] = file_no
                start = over + 1
                if over < len(total):
                    file_no, before = file_no + 1, int(total[over])
            used = int(total[-1]) - before if len(total) else used
            yield pd.Series(numbers)

    sizes = F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))
    return df.withColumn(to, F.pandas_udf(number, "int").asNondeterministic()(sizes))


def sink_rolling(df: DataFrame, path: str, max_bytes: int = ROLL_BYTES, size: Column | None = None, mode: str = "errorifexists") -> Written:
    """Write Parquet files that hold at most ``max_bytes`` of documents plus one record; returns what was written.

    Each task writes its own files, one per file number."""
    seen = WriteCount(F.octet_length("doc") if size is None else size)
    seen.of(assign_files(df, max_bytes, size)).write.mode(mode).partitionBy("file_no").parquet(path)
    return seen.written()
