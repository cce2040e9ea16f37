"""Hard negatives of labelled vectors, scored by Kronecker-packed products.

The components that a shard's vectors have in one dimension are biased to be non-negative and laid side by side as
fields of one wide integer. Each component of an anchor is multiplied with the wide integer of its dimension, once for
all vectors of the shard; the fields of the sum are the products of the biased vectors, from which the bias is taken
off again. Fields are wide enough for the largest sum there can be, so none runs over into the next. Fields that go into
the 53 bits of a double are laid into doubles, as many as go into one, and multiplied for many anchors at a time."""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .memory import tidy
from .tiles import Best, Stored, dealt

#: Most rows of a shard, bytes of its fields, and anchors of a block on average; a tile is one block times a span of shards.
SHARD_ROWS = 4096
SHARD_BYTES = 4 << 20
ANCHOR_ROWS = 512
#: Bits of whole numbers that a double holds exactly.
DOUBLE = 53
#: Anchors of a tile that are scored at a time.
STRIP = 64
#: Lists merged into one in each round.
FAN_IN = 16

_SHARD = pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("fields", pa.binary())])
_BEST = pa.list_(pa.struct([("minus", pa.int64()), ("id", pa.int64())]))
_FOUND = pa.schema(
    [("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("part", pa.int64()), ("best", _BEST)]
)
_SHARD_ROW = "shard bigint, dim int, ids binary, labels binary, fields binary"
_FOUND_ROW = "anchor_id bigint, place int, positive_id bigint, positive_score bigint, part bigint, best array<struct<minus:bigint,id:bigint>>"


def usable(vectors: DataFrame, scale: int, vec_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, parts): the rows that take part, with components as ``floor(scale * x)``."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("parts")
    )
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("parts", lambda x: F.floor(F.lit(float(scale)) * x))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("parts").isNotNull() & finite).withColumn("parts", whole)


class Fields:
    """How components between ``low`` and ``high`` are laid into fields."""

    def __init__(self, low: int, high: int):
        self.low, self.span = low, high - low

    def width(self, dim: int) -> int:
        """Bytes of a field: room for a sum of ``dim`` products of biased components."""
        least = max(1, -(-(dim * max(1, self.span) ** 2).bit_length() // 8))
        return next((w for w in (1, 2, 4, 8) if w >= least), least)

    def pack(self, matrix: np.ndarray) -> bytes:
        """The biased components of one row per vector, as fields: all of the first dimension, then the next."""
        width = self.width(matrix.shape[1])
        if width <= 8:
            biased = matrix.astype(np.int64).astype(np.uint64) - np.uint64(self.low % (1 << 64))
            return biased.T.astype(f"<u{width}").tobytes()
        return b"".join((int(x) - self.low).to_bytes(width, "little") for x in matrix.T.ravel())

    def wide(self, fields: bytes, dim: int) -> list[int]:
        """One wide integer for each dimension."""
        size = len(fields) // dim
        return [int.from_bytes(fields[j * size : (j + 1) * size], "little") for j in range(dim)]

    def bits(self, dim: int) -> int:
        """Bits of a field of a double; 0 where a field or a score may not go into one."""
        bits = max(1, (dim * max(1, self.span) ** 2).bit_length())
        return bits if bits <= DOUBLE and dim * (self.span + abs(self.low)) ** 2 < 1 << DOUBLE else 0

    def doubles(self, fields: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """The fields of a shard as doubles, a line for each dimension, and the sums of its vectors' biased components."""
        biased = np.frombuffer(fields, f"<u{self.width(dim)}").reshape(dim, -1).astype(np.float64)
        bits, rows = self.bits(dim), biased.shape[1]
        size = -(-rows // (DOUBLE // bits))
        packed = np.zeros((dim, size))
        for i, begin in enumerate(range(0, rows, size)):
            part = biased[:, begin : begin + size]
            packed[:, : part.shape[1]] += part * 2.0 ** (bits * i)
        return packed, biased.sum(axis=0)

    def many_scores(self, anchors: np.ndarray, packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Inner products of anchors, a line each, with all vectors of a shard that is laid into doubles."""
        dim, bits, rows, size = anchors.shape[1], self.bits(anchors.shape[1]), len(sums), packed.shape[1]
        biased = (anchors - self.low).astype(np.float64)
        left = biased @ packed
        exact = np.empty((len(anchors), rows))
        for i, begin in reversed(list(enumerate(range(0, rows, size)))):
            one = np.floor(left * 2.0 ** (-bits * i)) if i else left
            exact[:, begin : begin + size] = one[:, : rows - begin]
            if i:
                left -= one * 2.0 ** (bits * i)
        exact += self.low * sums
        exact += self.low * biased.sum(axis=1)[:, None] + float(dim * self.low * self.low)
        return exact

    def unpack(self, number: int, rows: int, dim: int) -> np.ndarray:
        """The fields of a wide integer; exact Python numbers where 64 bits may not hold what is made of them."""
        width = self.width(dim)
        data = number.to_bytes(rows * width, "little")
        if width <= 8 and dim * (self.span + abs(self.low)) ** 2 < 1 << 62:
            return np.frombuffer(data, f"<u{width}").astype(np.int64)
        return np.array([int.from_bytes(data[i : i + width], "little") for i in range(0, len(data), width)], dtype=object)

    def scores(self, anchor: list[int], wide: list[int], sums: np.ndarray) -> np.ndarray:
        """Inner products of an anchor with all vectors of a shard; ``sums`` are those of their biased components."""
        dim, low = len(anchor), self.low
        biased = [a - low for a in anchor]
        products = self.unpack(sum(map(mul, biased, wide)), len(sums), dim)
        exact = products + low * (sums + sum(biased)) + dim * low * low
        if exact.dtype == object:  # a score beyond a long counts as the nearest one
            exact = np.array([max(1 - (1 << 63), min((1 << 63) - 1, x)) for x in exact], dtype=np.int64)
        return exact


def _shards(rows: DataFrame, fields: Fields) -> DataFrame:
    """Pack rows where they are into shards of vectors of equal length, sorted by id; no shuffle."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            parts = batch.column("parts")
            lengths = np.asarray(parts.value_lengths())
            begin = np.concatenate([[0], np.cumsum(lengths)])
            values = parts.flatten().to_numpy()
            for dim in np.unique(lengths):
                mine = np.flatnonzero(lengths == dim)
                mine = mine[np.argsort(ids[mine], kind="stable")]
                size = max(1, min(SHARD_ROWS, SHARD_BYTES // (fields.width(int(dim)) * max(1, int(dim)))))
                for i in range(0, len(mine), size):
                    part = mine[i : i + size]
                    matrix = values[begin[part][:, None] + np.arange(dim)[None, :]]
                    row = [number, int(dim), ids[part].tobytes(), labels[part].tobytes(), fields.pack(matrix)]
                    yield pa.RecordBatch.from_pylist([dict(zip(_SHARD.names, row))], _SHARD)
                    number += 1

    return rows.mapInArrow(run, _SHARD_ROW)


def _scored(anchors: list[dict], data: bytes, fields: Fields, rows: int, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of anchors, their scores with the vectors of a shard)"""
    if not dim:  # vectors without components score 0 with each other
        yield np.arange(len(anchors)), np.zeros((len(anchors), rows), np.int64)
    elif fields.bits(dim):
        packed, sums = fields.doubles(data, dim)
        for top in range(0, len(anchors), STRIP):
            some = anchors[top : top + STRIP]
            yield np.arange(top, top + len(some)), fields.many_scores(np.array([x["parts"] for x in some], np.int64), packed, sums)
    else:
        wide = fields.wide(data, dim)
        sums = fields.unpack(sum(wide), rows, dim)
        for place, anchor in enumerate(anchors):
            yield np.array([place]), fields.scores(anchor["parts"], wide, sums)[None, :]


def _window(positives: list[dict | None], window: tuple[int, int]) -> np.ndarray:
    """Least and largest score of a negative for each positive; nothing lies between those of none."""
    long = np.iinfo(np.int64)
    ends = [(long.max, long.min) if x is None else (-(window[0] * x["minus"] // 100), window[1] * -x["minus"] // 100) for x in positives]
    return np.array([[max(long.min, min(long.max, e)) for e in pair] for pair in ends], np.int64).reshape(-1, 2)


def _tile(row: dict, shards: Stored, spans: int, fields: Fields, k: int, window: tuple[int, int]) -> tuple[Best, list[tuple]]:
    """The best of one tile, and (anchor, place, positive, its score) of each of their rows.

    Anchors without ``positives`` look for those, others for negatives of each."""
    anchors = row["anchors"]
    lists = [x["positives"] for x in anchors]
    places = max(1 if x is None else len(x) for x in lists)
    asked = [[None] * places if x is None else x + [None] * (places - len(x)) for x in lists]
    ends = [_window([x[place] for x in asked], window) for place in range(places)]
    own, own_labels = np.array([x["id"] for x in anchors], np.int64), np.array([x["label"] for x in anchors], np.int64)
    best = Best(len(anchors) * places, k)
    for ids, labels, data in shards.read(row["part"], spans, row["dim"], "ids", "labels", "fields"):
        ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        left, until = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for at, scores in _scored(anchors, data, fields, len(ids), row["dim"]):
            kind = scores.dtype.type
            same = labels == own_labels[at][:, None]
            if lists[0] is None:
                fits = same & (scores >= best.least(at, kind))
                for line, a in enumerate(at):
                    fits[line, left[a] : until[a]] = False
                best.add(at, scores, fits, ids)
                continue
            for place in range(places):
                rows = at * places + place
                low, high = ends[place][at].T[:, :, None].astype(kind)
                fits = (scores >= np.maximum(low, best.least(rows, kind))) & (scores <= high) & ~same
                best.add(rows, scores, fits, ids)
    heads = [(x["id"], place, *((None, None) if p is None else (p["id"], -p["minus"]))) for x, ps in zip(anchors, asked) for place, p in enumerate(ps)]
    return best, heads


def _searched(shards: Stored, anchors: DataFrame, fields: Fields, k: int, window: tuple[int, int]) -> DataFrame:
    """The ``k`` best for each anchor, or for each of its positives, out of all tiles."""
    groups = max(1, -(-anchors.count() // ANCHOR_ROWS))
    parts = spans = shards.spans(groups)
    block = anchors.groupBy(F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group"), F.size("parts").alias("dim")).agg(
        F.collect_list(F.struct("id", "label", "parts", "positives")).alias("anchors")
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                best, heads = _tile(row, shards, spans, fields, k, window)
                found, begin, scores, ids = best.found()
                lists = pa.ListArray.from_arrays(
                    pa.array(begin, pa.int32()), pa.StructArray.from_arrays([pa.array(-scores), pa.array(ids)], fields=list(_BEST.value_type))
                )
                heads = [(*heads[x], row["part"]) for x in found]
                columns = [pa.array([h[c] for h in heads], t) for c, t in enumerate(_FOUND.types[:-1])]
                yield pa.RecordBatch.from_arrays([*columns, lists], schema=_FOUND)

    lists = dealt(block, groups, spans).mapInArrow(run, _FOUND_ROW)
    keys = ["anchor_id", "place", "positive_id", "positive_score"]
    while parts > 1:
        parts = -(-parts // FAN_IN)
        merged = lists.groupBy(*keys, F.floor(F.col("part") / FAN_IN).alias("part"))
        lists = merged.agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return lists


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Negatives that are nearly as close to an anchor as a positive: ``anchor_id``, ``positive_id``, ``rank`` (from 1),
    ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` says which rows of ``vectors`` are anchors. An anchor's positives are the first ``positives`` rows of its
    label by score; for each of them the first ``negatives`` rows of other labels are returned whose score is between
    ``window[0]`` and ``window[1]`` per cent of the positive's. Scores are whole inner products of ``floor(scale * x)``
    (one beyond a long counts as the nearest long), ties go to the smaller id.

    Rows without id or label, and null vectors or those with null or non-finite components, take no part; vectors of
    different lengths are never compared, those of no components score 0. Repeated rows are candidates as often as they
    come, but never of an anchor with their id; a repeated anchor asks once, with its smallest label and vector. Labels
    are whole numbers. Other columns are ignored; empty tables give no rows.

    All rows are packed into shards of bounded bytes, anchors are dealt into blocks. A tile is a block and a span of shards,
    which its task reads from the shared folder one at a time; rounds of merging ``FAN_IN`` lists follow where there are
    several spans. What is looked at is every row for every anchor, twice: for the positives, and, once their scores are
    known, for the negatives."""
    rows = usable(vectors, scale, vec_id, vector, label)
    ends = rows.agg(F.min(F.array_min("parts")), F.max(F.array_max("parts"))).first()
    fields = Fields(ends[0] or 0, ends[1] or 0)
    shards = Stored(_shards(rows, fields), "shards")
    asked = usable(vectors.where(is_anchor), scale, vec_id, vector, label)
    asked = asked.groupBy("id").agg(F.min(F.struct("label", "parts")).alias("row")).select("id", "row.*")
    asked = materialize(asked, "anchors")
    none = F.lit(None).cast("array<struct<minus:bigint,id:bigint>>")
    best = materialize(_searched(shards, asked.withColumn("positives", none), fields, positives, window), "positives")
    positive = best.select(F.col("anchor_id").alias("id"), F.col("best").alias("positives"))
    known = asked.join(positive.hint("merge"), "id")  # rows are many times as large as their files: no side is broadcast
    found = _searched(shards, known, fields, negatives, window)
    out = found.select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("at", "one"))
    return out.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("negative_id"),
        "positive_score", (-F.col("one.minus")).alias("negative_score"),
    )
