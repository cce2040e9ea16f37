"""Single documents kept as one file each."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bytesview as B
from .archive import MANIFEST_ROW, Written, finished_files_glob, give_names, manifest_batch, mark_success, new_folder
from .scratch import materialize
from .task_files import file_system, rows, small_batches

#: Files of one folder of ``sink_documents``.
FOLDER_FILES = 1000
#: Bytes of a task that reads documents, and such tasks at least for each core.
TASK_BYTES, TASKS_PER_CORE = 128 << 20, 4
#: The finished folders below the path given to ``sink_documents``.
FOLDERS = "part-*[0-9]"


def sink_documents(raw: DataFrame, path: str) -> Written:
    """Write the document of each RAW row, framed, as a file of its own; returns what was written.

    Tasks write their rows where they are, into folders of ``FOLDER_FILES`` files, whose names end in ``.open`` until the
    whole write has succeeded; so neither renames nor listings go file by file through the driver. The path has to be on a
    file system that ``pyarrow.fs`` knows and that renames folders. ``scan_documents`` reads ``<path>/part-*[0-9]``."""
    folder = new_folder(raw.sparkSession, path)
    framed = raw.select(B.frame(F.col("doc")).alias("doc"))
    with small_batches(raw.sparkSession):
        manifest = materialize(framed.mapInArrow(_document_writer(folder), MANIFEST_ROW), "manifest")
    n_folders, total = give_names(manifest, path)
    if not n_folders:  # for those who read it
        files, base = file_system(folder)
        files.create_dir(f"{base}/part-00000-00000")
    mark_success(raw.sparkSession, path)
    return total


def _document_writer(folder: str):
    """Writes a task's documents to folders of its own and tells their names, records and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        task, folders = TaskContext.get().partitionId(), []
        for (doc,) in rows(batches, "doc"):
            if not folders or folders[-1][2] == FOLDER_FILES:
                name = f"part-{task:05d}-{len(folders):05d}"
                folders.append([f"{name}.{uuid.uuid4().hex}.open", name, 0, 0])
                system.create_dir(f"{base}/{folders[-1][0]}")
            at = folders[-1]
            with system.open_output_stream(f"{base}/{at[0]}/{at[2]:05d}", compression=None) as file:
                file.write(doc or b"")
            at[2] += 1
            at[3] += len(doc or b"")
        yield manifest_batch(folders)

    return run


def _files(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("pathGlobFilter", finished_files_glob()).load(paths)
    # a file counts as 4 MB, or what spark.sql.files.openCostInBytes says, when files are dealt to tasks: tasks by their bytes
    stored = files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return files.coalesce(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-stored // TASK_BYTES)))


def scan_documents(spark: SparkSession, paths: str | Iterable[str], framed: bool = True) -> DataFrame:
    """One RAW row per file that holds one document; ``uri`` is the file's path.

    A framed document ends where its length says. If the file ends before that, the
    document is null, which parsing reports as truncated."""
    content = F.col("content")
    if framed:
        declared = F.conv(F.hex(F.substring(content, 1, 4)), 16, 10).cast("bigint")
        whole = F.octet_length(content) >= declared + 4
        content = F.when(whole, B.first(B.unframe(content), declared.cast("int")))
    return _files(spark, paths).select(F.col("path").alias("uri"), content.alias("doc"))


def scan_pages(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per HTML file: ``url`` is the file's path, ``body`` its bytes."""
    return _files(spark, paths).select(F.col("path").alias("url"), F.col("content").alias("body"))
