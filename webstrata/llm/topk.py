"""Exact top-k search by inner product, as tiles of a query block times a span of shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .memory import tidy
from .tiles import Best, Stored, dealt

#: Rows of a query block on average, most rows of a shard, and bytes of a matrix; a tile is one block times a span of shards.
QUERY_ROWS = 2048
SHARD_ROWS = 16384
MATRIX_BYTES = 8 << 20
#: Lists merged into one in each round.
FAN_IN = 16
#: Rows of a tile that are scored at a time.
STRIP = 64

_BLOCK = "block bigint, dim int, ids binary, matrix binary"
_LISTS = "query_id bigint, part bigint, best array<struct<minus:bigint,vec_id:bigint>>"
_KINDS = ("<i1", "<i2", "<i4", "<i8")


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, parts) of the rows that take part: with an id, and a vector without null or non-finite components."""
    parts = F.col(vector).cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), parts.alias("parts"))
    return rows.where(F.col("id").isNotNull() & F.col("parts").isNotNull() & F.forall("parts", lambda x: x.isNotNull()) & finite)


def _matrix(parts: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the vectors and all components as scaled whole numbers."""
    lengths = np.diff(parts.offsets.to_numpy())
    values = np.floor(scale * parts.flatten().to_numpy(zero_copy_only=False))
    return lengths, np.clip(values, -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def _bytes(matrix: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold the least and the largest."""
    low, high = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    return matrix.astype(next(k for k in _KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)).tobytes()


def _numbers(data: bytes, rows: int, dim: int) -> np.ndarray:
    """The matrix of such bytes; vectors without components score 0 with each other."""
    if not dim:
        return np.zeros((rows, 1), np.int8)
    return np.frombuffer(data, f"<i{len(data) // (rows * dim)}").reshape(rows, dim)


def _packed(batch: pa.RecordBatch, scale: int, rows: int, first: int) -> Iterator[tuple]:
    """Blocks of vectors of equal length, sorted by id."""
    parts = batch.column("parts")
    parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
    lengths, values = _matrix(parts, scale)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    ids = batch.column("id").to_numpy()
    number = first
    for dim in np.unique(lengths):
        mine = np.flatnonzero(lengths == dim)
        mine = mine[np.argsort(ids[mine], kind="stable")]
        size = max(1, min(rows, MATRIX_BYTES // (8 * max(1, int(dim)))))
        for i in range(0, len(mine), size):
            part = mine[i : i + size]
            matrix = values[begin[part][:, None] + np.arange(dim)[None, :]]
            yield number, int(dim), ids[part].tobytes(), _bytes(matrix)
            number += 1


def _blocks(rows: DataFrame, scale: int, most: int) -> DataFrame:
    """Pack rows where they are into blocks; no shuffle."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in _packed(batch, scale, most, number):
                number = block[0] + 1
                yield pa.RecordBatch.from_pylist([dict(zip(("block", "dim", "ids", "matrix"), block))], _schema())

    return rows.mapInArrow(run, _BLOCK)


def _schema() -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())])


def _largest(matrix: np.ndarray) -> int:
    return max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)))


def _search(best: Best, queries: np.ndarray, query_ids: np.ndarray, shard: np.ndarray, ids: np.ndarray) -> None:
    """Score one shard, which is sorted by id, for all queries of a block."""
    most = _largest(queries) * _largest(shard) * shard.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64  # exact below, and much faster
    right = shard.astype(kind).T
    left, until = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for top in range(0, len(queries), STRIP):
        rows = np.arange(top, min(top + STRIP, len(queries)))
        scores = queries[rows].astype(kind) @ right
        fits = scores >= best.least(rows, kind)
        for q in rows[left[rows] < until[rows]]:
            fits[q - top, left[q] : until[q]] = False
        best.add(rows, scores, fits, ids)


def _tiles(tiles: DataFrame, shards: Stored, spans: int, k: int) -> DataFrame:
    kind = pa.struct([("minus", pa.int64()), ("vec_id", pa.int64())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                query_ids = np.frombuffer(row["ids"], "<i8")
                queries = _numbers(row["matrix"], len(query_ids), row["dim"])
                best = Best(len(query_ids), k)
                for own, matrix in shards.read(row["part"], spans, row["dim"], "ids", "matrix"):
                    ids = np.frombuffer(own, "<i8")
                    _search(best, queries, query_ids, _numbers(matrix, len(ids), row["dim"]), ids)
                found, begin, scores, ids = best.found()
                lists = pa.ListArray.from_arrays(
                    pa.array(begin, pa.int32()), pa.StructArray.from_arrays([pa.array(-scores), pa.array(ids)], fields=list(kind))
                )
                part = pa.array([row["part"]] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[found]), part, lists], names=["query_id", "part", "best"])

    return tiles.mapInArrow(run, _LISTS)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` best candidates in ``vectors`` for each query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Components count as ``floor(scale * x)``, scores are whole inner products (exact while they fit a long), ties go to
    the smaller id. Every row of ``vectors`` but those with the query's own id is a candidate, repeated rows as often as
    they come; a query id that is repeated asks once, with its smallest vector. Rows without id, and null vectors or
    those with null or non-finite components, take no part; vectors of different lengths are never compared. Fewer
    candidates give shorter lists, empty tables none.

    Both sides are packed into blocks of bounded bytes. A tile is a query block and a span of shards, which its task reads
    from the shared folder one at a time, holding ``k`` rows a query. There is one span, so that nothing is merged, unless
    query blocks are few; rounds of merging ``FAN_IN`` lists then reduce those of the spans to one."""
    shards = Stored(_blocks(usable(vectors, vec_id, vector), scale, SHARD_ROWS), "shards")
    asked = usable(queries, vec_id, vector).groupBy("id").agg(F.min("parts").alias("parts"))
    asked = materialize(asked, "queries")
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    parts = shards.spans(groups)
    rows = 2 * QUERY_ROWS  # hashing makes groups a little larger or smaller than the mean

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        batch = table.select(["id", "parts"]).combine_chunks().to_batches()[0]
        packed = [(group, *b[1:]) for b in _packed(batch, scale, rows, 0)]
        return pa.Table.from_pylist([dict(zip(("block", "dim", "ids", "matrix"), b)) for b in packed], _schema())

    grouped = asked.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    asked = materialize(grouped.groupBy("group").applyInArrow(pack, _BLOCK), "queries")
    lists = _tiles(dealt(asked, groups, parts), shards, parts, k)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        merged = lists.groupBy("query_id", F.floor(F.col("part") / FAN_IN).alias("part"))
        lists = merged.agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    out = lists.select("query_id", F.posexplode("best").alias("place", "one"))
    return out.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.minus")).alias("score")
    )
