"""Filter interaction audit by incremental retraction streaming.

The files of a corpus come as micro-batches. Each document gets a mask of the filters that it fails; whether it is a copy
of a document with a smaller id depends on documents still to come. So the state of each text is the smallest id so
far and what was counted for it; when a smaller one arrives, what was counted is taken back from the part's counter of
that mask and added to the counter of the mask with the copy filter. The stream's output are changes of counters by
(part, mask); their sums are the counters, and all figures of the audit follow from these.

The states of some thousand texts lie together in a bucket of the stream's state store: a call of Python for each text
would cost more than all the rest. The number of buckets grows with the input, so that none does."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.scratch import fresh_dir, materialize
from ..sources.task_files import qualified
from . import words as W
from .memory import tidy

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
COPY = BIT["E"]
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Micro-batches that the files of a corpus are dealt into.
MICRO_BATCHES = 4
#: Bytes of files for each bucket of text states, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 128

#: Limits of the filters and the signs that D looks for. Fixed values.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 200, 50, 2
SIGNS = b"#$%&*|"
_UPPER = bytes(range(0x41, 0x5B))

_ROW = "text_key binary, mask int, least_id bigint, part string, good boolean, toxic boolean, at_least bigint, above bigint, no_id bigint"
_CHANGE = "part string, mask int, good boolean, toxic boolean, n bigint"
_STATE = "texts binary"


def text_mask(text: bytes) -> int:
    """Which of the filters A to D a text fails."""
    words = text.split()  # bytes are split at ASCII white space only
    mask = BIT["A"] if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words):
        mask |= BIT["B"]
    chars = len(text) if text.isascii() else len(text.decode(errors="replace"))
    if 100 * (len(text) - len(text.translate(None, _UPPER))) > MOST_UPPER_PERCENT * chars:
        mask |= BIT["C"]
    if len(text.translate(None, SIGNS)) < len(text):
        mask |= BIT["D"]
    return mask


def _masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_key, mask) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            keys = pa.array([blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            masks = pa.array(map(text_mask, texts), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), keys, masks], names=["doc_id", "part", "text_key", "mask"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, text)
    return rows.mapInArrow(run, "doc_id bigint, part string, text_key binary, mask int")


def _labelled(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic``. Documents without id, which have no labels, are spread over the tasks."""
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text_key", "part")).otherwise(0).alias("spread")
    rows = masked.select("*", spread)
    known = labels.select(F.col("doc_id").alias("_id"), F.lit(0).cast("long").alias("_spread"), "good", "toxic")
    joined = rows.join(known, (F.col("doc_id") == F.col("_id")) & (F.col("spread") == F.col("_spread")), "left")
    false = F.lit(False)
    return joined.select(
        "doc_id", "part", "text_key", "mask", F.coalesce("good", false).alias("good"), F.coalesce("toxic", false).alias("toxic")
    )


def combine(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each text, part and label: documents at the text's smallest id here, above it, and without id."""
    least = rows.groupby("text_key")["doc_id"].transform("min")
    no_id = rows["doc_id"].isna()
    at_least = (rows["doc_id"] == least).fillna(False).astype(bool)
    marked = rows.assign(least_id=least, at_least=at_least.astype(int), above=(~at_least & ~no_id).astype(int), no_id=no_id.astype(int))
    keys = ["text_key", "mask", "part", "good", "toxic"]
    counts = {"least_id": ("least_id", "first"), "at_least": ("at_least", "sum"), "above": ("above", "sum"), "no_id": ("no_id", "sum")}
    return marked.groupby(keys, sort=False, as_index=False).agg(**counts)


def _combined(rows: DataFrame) -> DataFrame:
    """Combine in each task, so that a text with a third of all documents sends on a few rows only."""
    order = [f.name for f in T.StructType.fromDDL(_ROW)]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("text_key", pa.binary()), ("mask", pa.int32()), ("least_id", pa.int64()), ("part", pa.string()), ("good", pa.bool_()),
                            ("toxic", pa.bool_()), ("at_least", pa.int64()), ("above", pa.int64()), ("no_id", pa.int64())])
        for batch in batches:
            if batch.num_rows:
                frame = pa.Table.from_batches([batch]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
                yield from pa.Table.from_pandas(combine(frame)[order], schema, preserve_index=False).to_batches()

    return rows.mapInArrow(run, _ROW)


class TextStates:
    """The smallest id of each text, and how many documents have it, by (part, good, toxic)."""

    def __init__(self, texts: dict[bytes, tuple[int, dict[tuple, int]]] | None = None):
        self.texts = texts or {}

    def take(self, rows: Iterator[tuple]) -> Counter:
        """Changes of the counters (part, mask, good, toxic) by combined rows, in any order."""
        changes: Counter = Counter()
        for text, mask, least_id, part, good, toxic, at_least, above, no_id in rows:
            copy = mask | COPY
            changes[part, mask, good, toxic] += no_id
            changes[part, copy, good, toxic] += above
            if least_id is None:
                continue
            known, held = self.texts.get(text, (None, {}))
            if known is None or least_id < known:
                for (other, g, t), n in held.items():  # retract what stood for the smallest id so far
                    changes[other, mask, g, t] -= n
                    changes[other, copy, g, t] += n
                self.texts[text] = known, held = least_id, {}
            if least_id > known:
                changes[part, copy, good, toxic] += at_least
            elif at_least:
                changes[part, mask, good, toxic] += at_least
                held[part, good, toxic] = held.get((part, good, toxic), 0) + at_least
        return changes


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    own = TextStates(pickle.loads(state.get[0]) if state.exists else None)
    total: Counter = Counter()
    for frame in frames:
        frame = frame.astype({"least_id": object})
        least = [None if pd.isna(x) else int(x) for x in frame["least_id"]]
        columns = [frame[c].tolist() for c in ("part", "good", "toxic", "at_least", "above", "no_id")]
        total.update(own.take(zip(map(bytes, frame["text_key"]), frame["mask"].tolist(), least, *columns)))
    state.update((pickle.dumps(own.texts),))
    yield pd.DataFrame([(*k, n) for k, n in total.items() if n], columns=["part", "mask", "good", "toxic", "n"])


def _size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files under a path and their bytes: a summary, not a list of them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    summary = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder)
    return summary.getFileCount(), summary.getLength()


@contextmanager
def _plain_file_manager(spark: SparkSession, folder: str) -> Iterator[None]:
    """On a local or mounted folder, streams started in here write their state without Hadoop's ``FileContext``, which starts
    several processes for each file there. A stream keeps the settings that it was started with."""
    name, before = "spark.sql.streaming.checkpointFileManagerClass", None
    on_disk = qualified(spark, folder).startswith("file:")
    if on_disk:
        before = spark.conf.get(name, None)
        spark.conf.set(name, "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(name, before)
        elif on_disk:
            spark.conf.unset(name)


def stream_counters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters of a mask.

    All Parquet files under ``path`` (``doc_id``, ``text``, ``source``) are processed as available-now micro-batches; the
    checkpoint and the changes are written to the shared folder. State is kept by the session's state store; for very
    many texts set it to RocksDB."""
    schema = spark.read.parquet(path).schema
    flags = [F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*flags)
    known = materialize(known, "labels")
    files, size = _size_of(spark, path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-files // micro_batches)))
    docs = reader.parquet(f"{path[:-1]}[{path[-1]}]")  # a glob names a single file as well as a folder
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    rows = _combined(_labelled(_masked(docs), known)).withColumn("bucket", F.pmod(F.xxhash64("text_key"), F.lit(buckets)))
    changes = rows.groupBy("bucket").applyInPandasWithState(_update, _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout)
    out = fresh_dir(spark, "counter-changes")
    writer = changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_dir(spark, "audit-checkpoint"))
    with _plain_file_manager(spark, out):
        query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    summed = spark.read.schema(_CHANGE).parquet(out).groupBy("part", "mask")
    return summed.agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(counters: DataFrame) -> DataFrame:
    """Figures of every filter at every step of every order, from counters by (part, mask); zeros included.

    One row for each part holds its counters, at most one for each mask; orders and steps are unfolded from it."""
    cells = counters.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = cells.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters):
        return sum((F.when(F.contains(letters, F.lit(f)), BIT[f]).otherwise(0) for f in FILTERS), F.lit(0))

    steps = steps.withColumn("own", bits(F.substring("filter_order", F.col("step"), F.lit(1))))
    steps = steps.withColumn("before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
    own, before = F.col("own"), F.col("before")

    def total(column, condition, weight=None):
        chosen = F.filter("cells", condition)
        value = (lambda x: x[column]) if weight is None else (lambda x: x[column] * weight(x))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda acc, x: acc + value(x))

    def fails(x):
        return x["mask"].bitwiseAND(own) != 0

    def gone(x):
        return x["mask"].bitwiseAND(before) != 0

    orders = F.lit(len(ORDERS))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda x: x["mask"].bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", lambda x: fails(x) & ~gone(x)).alias("removed"),
        total("n", lambda x: fails(x) & gone(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == own).alias("unique_fails"),
        total("good", lambda x: fails(x) & ~gone(x)).alias("good_lost"),
        total("toxic", lambda x: fails(x) & ~gone(x)).alias("toxic_lost"),
        # of the filters that a document fails, each comes first in equally many orders
        total("n", fails, lambda x: (orders / F.bit_count(x["mask"])).cast("long")).alias("shapley"),
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """What five filters remove from the documents under ``path`` in each of their 120 orders, by part (``source``).

    A: under 200 words; B: under half of them different; C: over 2 % capital letters A-Z; D: any of ``#$%&*|``; E: the
    text of a document with a smaller id. One row per ``part``, ``filter_order`` and ``step`` with counts: ``kept`` after
    the step, ``removed`` in it, ``redundant`` (fail its filter, removed before), ``unique_fails`` (fail no other),
    ``good_lost`` and ``toxic_lost`` (of the removed, by ``labels``), ``shapley`` (removed by its filter in all orders).

    Null texts are empty, null sources the part ''. Rows are documents, repeated ones too; of those with a text's smallest
    id none fails E, and a null id is neither smaller nor larger than others. A document is good (toxic) if any of its
    labels says so; null labels say nothing. Other columns are ignored. An empty table has no parts."""
    return audit(stream_counters(spark, path, labels, micro_batches))
