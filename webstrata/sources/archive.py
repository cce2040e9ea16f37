"""SequenceFile archives of <Text URI, Text framed document>.

Keys and values travel as raw bytes: reading them as strings would destroy bodies
that are not UTF-8. Python only hands the pairs over; all unpacking is done by
Spark expressions. For repeated analysis, convert an archive to a table once
(``sources.table``): it is read without Python and without unneeded columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bytesview as B
from ..schema import ROLL_BYTES
from .scratch import materialize
from .sequence_file import HEADER_BYTES, SequenceFileWriter, compression_of
from .task_files import file_system, is_reached, qualified, rows, small_batches

_INPUT = "org.apache.hadoop.mapreduce.lib.input.SequenceFileAsBinaryInputFormat"
_OUTPUT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileAsBinaryOutputFormat"
_BYTES = "org.apache.hadoop.io.BytesWritable"
_TEXT = "org.apache.hadoop.io.Text"
_PAIR = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])

# Endings of files that are still being written or that a failed write left behind.
UNFINISHED = (".open", ".invalid")


class Written(NamedTuple):
    """What a sink's own job wrote: records, and document bytes (for archives with the 4-byte frames)."""

    records: int
    bytes: int


def finished_files_glob(suffixes: Iterable[str] = UNFINISHED) -> str:
    """A Hadoop glob for all file names that end in none of the suffixes.

    A name qualifies if, read from its end, it leaves the suffixes at some point:
    after each common tail the character before it is one that no suffix has there.
    The pattern is evaluated where the files are listed, so nothing is collected."""
    suffixes = [s for s in suffixes if s]
    if not suffixes:
        return "*"
    tails = sorted({s[i:] for s in suffixes for i in range(1, len(s) + 1)}, key=lambda t: (len(t), t))
    parts = []
    for tail in tails:
        if tail in suffixes:
            continue
        before = {s[len(s) - len(tail) - 1] for s in suffixes if s.endswith(tail) and len(s) > len(tail)}
        if before:
            parts.append(f"*[^{''.join(sorted(before))}]{tail}")
            parts.append(tail)  # the whole name is just this tail
    return "{" + ",".join(p for p in parts if p) + "}"


def _literal(name: str) -> str:
    """A Hadoop glob for just this name."""
    return "".join(f"\\{c}" if c in "\\*?[]{}^" else c for c in name)


def _shape(path: Column) -> Column:
    """A Hadoop glob for all paths that differ from this one in digits only."""
    escaped = F.regexp_replace(path, r"([\\*?\[\]{}^])", r"\\$1")
    return F.regexp_replace(escaped, "[0-9]", "[0-9]")


def _below(files: Column, roots: list[str]) -> Column:
    """The folder among ``roots`` that a file lies in, the innermost one if several do."""
    inner_first = F.array(*[F.lit(r) for r in sorted(roots, key=len, reverse=True)])
    return F.element_at(F.filter(inner_first, lambda r: F.startswith(files, F.concat(r, F.lit("/")))), 1)


def archive_patterns(spark: SparkSession, roots: list[str], skip_unfinished: bool = True) -> list[str]:
    """Globs for the files in folders (qualified paths) and in all folders below them.

    Spark lists the files. Names that differ in digits only share a pattern, so what comes to the driver grows with the
    naming schemes in use and not with the files. Hidden files and folders, and those with an unfinished name, are left
    out. Where a pattern also fits the path of a folder, which would read all that is in there, the files of that pattern
    are named one by one."""
    roots = [r for r in roots if not any(r.startswith(f"{o}/") for o in roots)]  # what lies in another is listed there
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([_literal(r) for r in roots])
    listed = listed.select("path").coalesce(spark.sparkContext.defaultParallelism)  # tasks by files, not by their bytes
    paths = listed.withColumn("root", _below(F.col("path"), roots))
    paths = paths.select("root", F.split(F.substring("path", F.length("root") + 2, F.length("path")), "/").alias("names"))
    left_out = F.exists("names", lambda n: F.startswith(n, F.lit("_")) | F.startswith(n, F.lit(".")))
    if skip_unfinished:
        left_out |= F.exists("names", lambda n: reduce(or_, [F.endswith(n, F.lit(s)) for s in UNFINISHED]))
    files = paths.where(~left_out).select("root", F.array_join("names", "/").alias("path"), F.lit(False).alias("is_folder"))
    depths = F.sequence(F.lit(1), F.size("names") - 1)
    above = F.transform(depths, lambda n: F.array_join(F.slice("names", F.lit(1), n), "/"))
    folders = paths.where(F.size("names") > 1).select("root", F.explode(above).alias("path"), F.lit(True).alias("is_folder"))
    shapes = files.unionByName(folders).groupBy("root", _shape(F.col("path")).alias("shape"))
    found = shapes.agg(F.bool_and("is_folder").alias("folders_only"), F.bool_or("is_folder").alias("folders")).where("not folders_only").collect()
    empty = set(roots) - {r["root"] for r in found}
    if empty:
        raise FileNotFoundError(f"no finished archive files in {', '.join(sorted(empty))}")
    patterns = [f"{_literal(r['root'])}/{r['shape']}" for r in found if not r["folders"]]
    mixed = [r["shape"] for r in found if r["folders"]]
    if mixed:
        single = files.where(_shape(F.col("path")).isin(mixed)).collect()
        patterns += [_literal(f"{r['root']}/{r['path']}") for r in single]
    return sorted(set(patterns))


def _pairs(spark: SparkSession, paths: str | Iterable[str], skip_unfinished: bool) -> tuple[DataFrame, list[str]]:
    """Stored pairs of all folders as one scan, and the folders' qualified paths."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no archive directory given")
    roots = [qualified(spark, p).rstrip("/") for p in paths]
    patterns = archive_patterns(spark, list(dict.fromkeys(roots)), skip_unfinished)
    # the list is split at commas; in a name they are escaped
    listed = ",".join(p.replace("\\", "\\\\").replace(",", "\\,") for p in patterns)
    conf = {"mapreduce.input.fileinputformat.inputdir": listed}
    pairs = spark.sparkContext.newAPIHadoopRDD(_INPUT, _BYTES, _BYTES, conf=conf)
    return spark.createDataFrame(pairs, _PAIR, verifySchema=False), roots


def _raw_columns() -> list[Column]:
    return [
        B.utf8(B.from_text_writable(F.col("key"))).alias("uri"),
        B.unframe(B.from_text_writable(F.col("value"))).alias("doc"),
    ]


def scan_archive(spark: SparkSession, paths: str | Iterable[str], skip_unfinished: bool = True) -> DataFrame:
    """RAW rows of the SequenceFiles in one or more directories, and in all directories below them.

    Names are taken as they are, whatever signs they hold; a file is read once, also where directories overlap."""
    return _pairs(spark, paths, skip_unfinished)[0].select(*_raw_columns())


def scan_multi(spark: SparkSession, paths: Iterable[str], skip_unfinished: bool = True) -> DataFrame:
    """RAW rows of several crawls, in one scan, with the directory each came from as ``crawl_dir``.

    The directory is that of the input split, the innermost one where directories overlap."""
    paths = list(paths)
    stored, roots = _pairs(spark, paths, skip_unfinished)
    given = F.create_map(*[F.lit(x) for pair in dict(zip(roots, paths)).items() for x in pair])
    return stored.select(*_raw_columns(), F.try_element_at(given, _below(F.input_file_name(), roots)).alias("crawl_dir"))


def _compression(kind: str, spark: SparkSession) -> str:
    kind = kind.upper()
    if kind == "DEFAULT":
        key = "io.seqfile.compression.type"
        of_cluster = spark.sparkContext._jsc.hadoopConfiguration().get(key)
        kind = (spark.conf.get(f"spark.hadoop.{key}", None) or of_cluster or "BLOCK").upper()
    if kind not in ("NONE", "RECORD", "BLOCK"):
        raise ValueError(f"unknown compression {kind!r}: DEFAULT, BLOCK, RECORD or NONE")
    return kind


def sink_archive(raw: DataFrame, path: str, compression: str = "DEFAULT", max_bytes: int = ROLL_BYTES) -> Written:
    """Write RAW rows as SequenceFiles where they are, without a shuffle; returns what was written.

    A task starts a new file when the framed documents in the last one are more than ``max_bytes``, so a file is at most
    one record larger. Files have names that end in ``.open`` until the whole write has succeeded; what a lost task leaves
    keeps that name and is never read. The path has to be on a file system that ``pyarrow.fs`` knows.

    With -1 there is no limit: one file per task, on any file system, and RECORD is refused. Where ``pyarrow.fs`` does not
    reach the file system, Hadoop's output format writes, through pickled batches whose bytes nothing bounds."""
    check_roll_size(max_bytes)
    kind = _compression(compression, raw.sparkSession)
    if max_bytes == -1:
        if kind == "RECORD":
            raise ValueError("RECORD compression is refused by Hadoop's binary output format: give a roll size, or BLOCK or NONE")
        if not is_reached(qualified(raw.sparkSession, path)):
            return _sink_by_hadoop(_stored(raw), path, kind)
    new_folder(raw.sparkSession, path)
    return publish_files(write_open_files(raw, path, kind, max_bytes), path)


def _stored(raw: DataFrame) -> DataFrame:
    return raw.select(
        B.to_text_writable(F.encode("uri", "UTF-8")).alias("key"),
        B.to_text_writable(B.frame(F.col("doc"))).alias("value"),
        (F.octet_length("doc") + 4).alias("size"),
    )


def _hadoop_folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def write_open_files(raw: DataFrame, path: str, compression: str = "DEFAULT", max_bytes: int = ROLL_BYTES) -> DataFrame:
    """The first half of ``sink_archive``: rolled files in a folder, all still ``.open``, and what to publish.

    Returns ``part``, ``file``, ``records``, ``bytes`` of the files that succeeded, written out."""
    check_roll_size(max_bytes)
    kind = _compression(compression, raw.sparkSession)
    system, folder = _hadoop_folder(raw.sparkSession, path)
    system.mkdirs(folder)
    with small_batches(raw.sparkSession):
        return materialize(_stored(raw).mapInArrow(_writer(qualified(raw.sparkSession, path), kind, max_bytes), MANIFEST_ROW), "manifest")


def publish_files(manifest: DataFrame, path: str) -> Written:
    """The second half: the files of a manifest get their final names, and the folder its mark of success."""
    n_files, total = give_names(manifest, path)
    if not n_files:  # an archive without records has one file
        files, base = file_system(qualified(manifest.sparkSession, path))
        SequenceFileWriter(files.open_output_stream(f"{base}/part-00000-00000", compression=None), "NONE").close()
    mark_success(manifest.sparkSession, path)
    return total


def give_names(manifest: DataFrame, path: str) -> tuple[int, Written]:
    """Final names for the files, or folders, of a manifest; their number and what they hold."""
    published = manifest.mapInArrow(_publisher(qualified(manifest.sparkSession, path)), "records bigint, bytes bigint")
    n_files, *total = published.agg(F.count("*"), *[F.coalesce(F.sum(c), F.lit(0)) for c in Written._fields]).first()
    return n_files, Written(*total)


def mark_success(spark: SparkSession, path: str) -> None:
    system, target = _hadoop_folder(spark, path)
    system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")).close()


def new_folder(spark: SparkSession, path: str) -> str:
    """Makes a folder that is not there yet; returns its qualified path."""
    system, folder = _hadoop_folder(spark, path)
    if system.exists(folder):
        raise FileExistsError(f"{path} exists")
    system.mkdirs(folder)
    return qualified(spark, path)


def stored_compression(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """(file, compression) of the files that ``scan_archive`` would read: NONE, RECORD or BLOCK, by their headers alone."""
    roots = [qualified(spark, p).rstrip("/") for p in ([paths] if isinstance(paths, str) else paths)]
    listed = spark.read.format("binaryFile").load(archive_patterns(spark, roots)).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, kinds = batch.column("path").to_pylist(), []
            for name in names:
                system, path = file_system(name)
                with system.open_input_file(path) as file:
                    kinds.append(compression_of(file.read(HEADER_BYTES)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.string())], names=["file", "compression"])

    return listed.mapInArrow(run, "file string, compression string")


MANIFEST_ROW = "part string, file string, records bigint, bytes bigint"


def manifest_batch(files: list[list]) -> pa.RecordBatch:
    """What a task has written, as rows of a manifest."""
    columns, kinds = list(zip(*files)) or [()] * 4, (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "file", "records", "bytes"])


def _writer(folder: str, kind: str, max_bytes: int):
    """Writes a task's pairs to files of its own and tells their names, records and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        task, out, files = TaskContext.get().partitionId(), None, []

        def opened() -> SequenceFileWriter:
            name = f"part-{task:05d}-{len(files):05d}"
            files.append([f"{name}.{uuid.uuid4().hex}.open", name, 0, 0])
            return SequenceFileWriter(system.open_output_stream(f"{base}/{files[-1][0]}", compression=None), kind)

        for key, value, size in rows(batches, "key", "value", "size"):
            out = out or opened()
            out.append(key, value)
            files[-1][2] += 1
            files[-1][3] += size
            if 0 < max_bytes < files[-1][3]:
                out.close()
                out = None
        if out:
            out.close()
        yield manifest_batch(files)

    return run


def _publisher(folder: str):
    """Gives the files of a manifest their final names; one that has it already was named by a task that was lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for part, name in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist()):
                if system.get_file_info(f"{base}/{part}").type != fs.FileType.NotFound:
                    system.move(f"{base}/{part}", f"{base}/{name}")
            yield batch.select(["records", "bytes"])

    return run


def _sink_by_hadoop(pairs: DataFrame, path: str, kind: str) -> Written:
    """One file per task. Accumulators of the only stage count each task once, however often it runs."""
    conf = {"mapreduce.output.fileoutputformat.compress": str(kind != "NONE").lower()}
    if kind != "NONE":
        conf["mapreduce.output.fileoutputformat.compress.type"] = kind
    context = pairs.sparkSession.sparkContext
    records, total = context.accumulator(0), context.accumulator(0)

    def pair(row) -> tuple[bytearray, bytearray]:
        records.add(1)
        total.add(row[2])
        return bytearray(row[0]), bytearray(row[1])

    text = {f"mapreduce.output.seqbinaryoutputformat.{x}.class": _TEXT for x in ("key", "value")}
    pairs.rdd.map(pair).saveAsNewAPIHadoopFile(path, _OUTPUT, _BYTES, _BYTES, conf={**text, **conf})
    return Written(records.value, total.value)


def check_roll_size(max_bytes: int) -> None:
    if max_bytes == 0 or max_bytes < -1:
        raise ValueError("the roll size must be positive, or -1 for no limit")
