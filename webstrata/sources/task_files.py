"""Files that tasks write or read by themselves, through ``pyarrow.fs``: local and shared folders, HDFS, object stores."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

#: Rows that a writing worker holds as Python objects, and of its batches.
SLICE_ROWS = 256


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, by Hadoop's default file system: what Spark itself takes it for."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop_path).toString()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path on it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def is_reached(uri: str) -> bool:
    """Whether ``pyarrow.fs`` knows the file system of a qualified path and gets an answer from it."""
    try:
        system, path = file_system(uri)
        system.get_file_info(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send their rows to Python in batches of at most ``SLICE_ROWS``, so that what a worker holds does not
    grow with the rows of a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), SLICE_ROWS) if int(before) > 0 else SLICE_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values, of which few exist at a time; at the end free memory goes back to the system,
    because workers outlive their tasks."""
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield from zip(*(batch.column(c).slice(start, SLICE_ROWS).to_pylist() for c in columns))
            del batch  # else it lives on while the next one is read
    finally:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
