"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A run holds the lines of one batch, or of several that were
compacted into it: a hash of the line, how many documents hold it, and the largest id among them, bucketed and sorted
by the hash. A new batch merge-anti-joins the runs: lines that a run already knows to be frequent are dropped from it,
as neither their standing nor their largest document can change any more; what is left becomes a run of the first
level. When a level has ``RUNS_A_LEVEL`` runs, they are merged into one of the next level."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import fresh_dir, materialize
from . import words as W
from .memory import tidy

#: Code points that a line has at least, and documents that hold it at least, to be dropped.
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Parts in which a table is taken in, and runs that a level may have before they are compacted.
BATCHES, RUNS_A_LEVEL = 4, 2
#: Frequent lines that tasks look up in memory (some 30 MB); more are joined.
LOOKUP_LINES = 200_000

#: White space that is stripped from lines. Fixed values.
_BLANKS = b" \t\n\v\f\r"
_HELD = "batch int, doc_id bigint, text_tag bigint, line binary"


def line_hashes(text: bytes, least_chars: int = LEAST_CHARS) -> list[bytes | None]:
    """A 128-bit hash of each line's key (stripped, A-Z lowered); None for lines that are too short to be dropped."""
    out: list[bytes | None] = []
    for line in text.lower().split(b"\n"):
        key = line.strip(_BLANKS)
        # a code point has one to four bytes
        long = len(key) >= least_chars and (len(key) > 4 * (least_chars - 1) or len(key.decode(errors="replace")) >= least_chars)
        out.append(blake2b(key, digest_size=16).digest() if long else None)
    return out


def _held_lines(docs: DataFrame, cuts: list[float], least_chars: int) -> DataFrame:
    """(batch, doc_id, text_tag, line): the different hashes of each document, written by batch."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + F.when(F.col("doc_id") < cut, 1).otherwise(0)
    batch = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(batch).cast("int")
    rows = docs.select(batch.alias("batch"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_tag"), text.alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for part in W.blocks([len(t) for t in texts]):
                lines = [list(set(line_hashes(t, least_chars)) - {None}) for t in texts[part]]
                at = pa.array(np.repeat(np.arange(part.start, part.stop), [len(x) for x in lines]))
                heads = [batch.column(c).take(at) for c in ("batch", "doc_id", "text_tag")]
                column = pa.array([x for own in lines for x in own], pa.binary())
                yield pa.RecordBatch.from_arrays([*heads, column], names=["batch", "doc_id", "text_tag", "line"])

    path = fresh_dir(docs.sparkSession, "lines")
    rows.mapInArrow(run, _HELD).write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(_HELD).parquet(path)


class Runs:
    """The levels of runs: tables of ``line``, ``n``, ``last_doc`` in the shared folder, bucketed and sorted by ``line``."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, runs_a_level: int = RUNS_A_LEVEL):
        self.spark, self.least_docs, self.runs_a_level = spark, least_docs, runs_a_level
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _run(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "line").sortBy("line").format("parquet")
        writer.option("path", fresh_dir(self.spark, "line-run")).saveAsTable(name)
        return name

    def _known(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Take in a batch of (doc_id, line), one row for each document and line; later batches have smaller ids."""
        new = batch.groupBy("line").agg(F.count("*").alias("n"), F.max("doc_id").alias("last_doc"))
        for run in self._known():
            new = new.join(run.where(F.col("n") >= self.least_docs).select("line"), "line", "left_anti")
        self._place(self._run(new), 0)

    def _place(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.runs_a_level > 1:
            merged = self._run(self._merged([self.spark.table(name) for name in self.levels[level]]))
            self._drop(self.levels[level])
            self.levels[level] = []
            self._place(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One run out of several: merge joins, of which the first brings equal buckets together without a shuffle."""
        out = runs[0]
        for run in runs[1:]:
            other = run.select("line", F.col("n").alias("_n"), F.col("last_doc").alias("_last_doc"))
            both = out.join(other, "line", "full_outer")
            none = F.lit(0).cast("long")
            out = both.select(
                "line", (F.coalesce("n", none) + F.coalesce("_n", none)).alias("n"), F.greatest("last_doc", "_last_doc").alias("last_doc")
            )
        return out

    def _drop(self, names: list[str]) -> None:
        """Forget tables; their files stay in the shared folder, as all intermediate results do."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def frequent(self) -> DataFrame:
        """(line, last_doc) of the lines in at least ``least_docs`` documents, written out; ends the runs."""
        runs = self._known()
        if not runs:
            return self.spark.createDataFrame([], "line binary, last_doc long")
        found = self._merged(runs).where(F.col("n") >= self.least_docs).select("line", "last_doc")
        found = materialize(found, "frequent-lines")
        self._drop([name for level in self.levels for name in level])
        self.levels = []
        return found


def frequent_lines(held: DataFrame, batches: int, least_docs: int = LEAST_DOCS, runs_a_level: int = RUNS_A_LEVEL) -> DataFrame:
    """(line, last_doc) of the frequent lines, from batches 0 to ``batches`` - 1 of ``held``."""
    runs = Runs(held.sparkSession, least_docs, runs_a_level)
    for number in range(batches):
        runs.add(held.where(F.col("batch") == number).select("doc_id", "line"))
    return runs.frequent()


def _dropped_lines(held: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, text_tag, drops): the lines that documents lose. Rows of one id and text lose the same ones.

    What each row loses is no more than its own text; a line that very many documents hold is a skewed key of the first
    join, which adaptive execution splits."""
    lost = held.join(frequent, "line").where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return lost.groupBy("doc_id", "text_tag").agg(F.collect_set("line").alias("drops"))


def drop_repeated_lines(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
    runs_a_level: int = RUNS_A_LEVEL,
    lookup_lines: int = LOOKUP_LINES,
) -> DataFrame:
    """The documents (``doc_id``, ``text``) without lines that the corpus repeats; with ``n_lines``, ``n_dropped`` (long).

    Lines end at LF. Lines are alike if they are equal once white space is stripped at both ends and A-Z lowered. A line
    of at least ``least_chars`` code points that at least ``least_docs`` documents hold is dropped from all of them but
    those with the largest id among its holders; those keep it wherever they have it. All other lines stay as they are,
    joined by LF.

    A null text is empty: one empty line. Each row counts as a document, repeated ones too; a null id is smaller than
    any other, and rows without id that are a line's only holders keep it. All other columns are returned unchanged,
    but for ``n_lines`` and ``n_dropped``, which are replaced; an empty table stays empty.

    Texts are read twice and never shuffled while the frequent lines are few enough to be looked up in tasks
    (``lookup_lines``, by count); beyond that the lines that each document loses are found by a join on the hash, and
    documents are joined with them once."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    quantiles = [1 - i / batches for i in range(1, batches)]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.approxQuantile("doc_id", quantiles, 0.01) if quantiles else []
    held = _held_lines(docs, cuts, least_chars)
    frequent = frequent_lines(held, len(cuts) + 1, least_docs, runs_a_level)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own) if c != "text"], F.lit(0).alias("none"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_tag"), text.alias("text"), rest.alias("rest"))
    looked_up = None
    if frequent.count() <= lookup_lines:
        known = frequent.toArrow()
        looked_up = spark.sparkContext.broadcast(dict(zip(known.column("line").to_pylist(), known.column("last_doc").to_pylist())))
        rows = rows.withColumn("drops", F.lit(None).cast("array<binary>"))
    else:
        lost = _dropped_lines(held, frequent).select(F.col("doc_id").alias("_id"), F.col("text_tag").alias("_tag"), "drops")
        rows = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_tag") == F.col("_tag")), "left")
    rows = rows.select("doc_id", "text", "drops", "rest")
    schema = T.StructType(
        [rows.schema["rest"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = looked_up.value if looked_up else None
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            ids, drops = batch.column("doc_id").to_pylist(), batch.column("drops")
            for part in W.blocks([len(t) for t in texts]):
                kept, counts = [], []
                for i in range(part.start, part.stop):
                    hashes = line_hashes(texts[i], least_chars)
                    if lines is None:
                        lost = set(drops[i].as_py() or ())
                    else:
                        lost = {x for x in hashes if x in lines and lines[x] != ids[i]}
                    stays = [line for line, x in zip(texts[i].split(b"\n"), hashes) if x not in lost] if lost else None
                    kept.append(texts[i] if stays is None else b"\n".join(stays))
                    counts.append((len(hashes), 0 if stays is None else len(hashes) - len(stays)))
                columns = [
                    batch.column("rest").slice(part.start, part.stop - part.start),
                    pa.array(kept, pa.binary()).cast(pa.string(), safe=False),
                    *(pa.array(x, pa.int64()) for x in zip(*counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    done = rows.mapInArrow(run, schema)
    columns = [F.col("text").alias(c) if c == "text" else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(own)]
    return done.select(*columns, "n_lines", "n_dropped")
