"""Best-two-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize
from . import words as W
from .memory import tidy
from .pretokens import encoder

#: Pieces that are packed together in one task. Each task leaves at most a few sequences
#: partly filled, so the waste is of the order of one in ten thousand.
PIECES_A_TASK = 65_536
END_ID = 0

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
PLACED = T.StructType(
    [*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens; only the first may be shorter."""
    if n <= size:
        return [(0, n)]
    head = n % size
    starts = ([0] if head else []) + list(range(head, n, size))
    return [(s, (head if head and s == 0 else size)) for s in starts]


def token_pieces(docs: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """The pieces of every document: ids of its whole text, then ``END_ID``, cut where longer than ``size``.

    ``tokenizer`` is the path of a byte-level BPE file. No null documents are lost: a null text is empty."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = W.texts_of(batch.column("text"))
            for part in W.blocks([len(t) for t in texts], W.BLOCK):
                rows = []
                tokens, first = encode(texts[part])
                for k, doc_id in enumerate(ids[part]):
                    own = np.append(tokens[first[k] : first[k + 1]], END_ID).astype("<u4")
                    for i, (start, length) in enumerate(cut(len(own), size)):
                        rows.append((doc_id, i, start, length, zlib.crc32(own[start : start + length].tobytes())))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.

    A bin is filled greedily: the longest unpacked item that fits, again and again. When nothing
    fits and a gap is left, the bin's shortest item goes back in exchange for the two unpacked items
    that fill the gap it leaves best, if they fill more of it. Items are told apart by length only,
    so all bins that come out alike are made in one step: the work follows the number of different
    bins, not of items."""
    stock = np.bincount(lengths, minlength=size + 1)
    order = np.argsort(lengths, kind="stable")
    begin = np.concatenate([[0], np.cumsum(stock)])[:-1].copy()  # the next unpacked item of each length
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    made = 0
    left = stock.copy()
    while left.any():
        chosen = _one_bin(left, size)
        kinds, uses = np.unique(chosen, return_counts=True)
        repeat = int((left[kinds] // uses).min())
        at = 0
        for kind, count in zip(kinds[::-1], uses[::-1]):
            items = order[begin[kind] : begin[kind] + count * repeat].reshape(repeat, count)
            bins[items] = made + np.arange(repeat)[:, None]
            offsets[items] = at + kind * np.arange(count)[None, :]
            at += kind * count
            begin[kind] += count * repeat
            left[kind] -= count * repeat
        made += repeat
    return bins, offsets


def _one_bin(left: np.ndarray, size: int) -> list[int]:
    """Lengths that go into the next bin, out of ``left`` items of each length."""
    left = left.copy()
    chosen: list[int] = []
    gap = size
    while gap > 0:
        fits = np.flatnonzero(left[1 : gap + 1])
        if not len(fits):
            break
        longest = int(fits[-1]) + 1
        times = min(int(left[longest]), gap // longest)
        chosen += [longest] * times
        left[longest] -= times
        gap -= longest * times
    if gap > 0 and chosen:
        smallest = chosen[-1]
        room = gap + smallest
        there = np.flatnonzero(left[: room + 1])
        if len(there):
            # the longest partner of each length: the last one there that fits beside it
            partner_at = np.searchsorted(there, room - there, side="right") - 1
            ok = partner_at >= 0
            first, second = there[ok], there[partner_at[ok]]
            same = (first == second) & (left[first] < 2)
            shorter = partner_at[ok] - 1
            second = np.where(same, np.where(shorter >= 0, there[np.maximum(shorter, 0)], -size), second)
            if len(first):
                best = int(np.argmax(first + second))
                if first[best] + second[best] > smallest:
                    chosen = [*chosen[:-1], int(first[best]), int(second[best])]
    return chosen


def pack(pieces: DataFrame, size: int, pieces_a_task: int = PIECES_A_TASK) -> DataFrame:
    """Place pieces of at most ``size`` tokens in sequences; adds ``sequence_id`` and ``offset``.

    ``pieces`` (narrow rows, no tokens) are written once and dealt evenly, whatever their ids, to tasks
    of about ``pieces_a_task``, each of which packs its own. Every piece is placed exactly once; an
    empty table stays empty."""
    pieces = materialize(pieces, "pieces")
    tasks = max(1, -(-pieces.count() // pieces_a_task))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = list(frames)
        if mine:
            frame = pd.concat(mine, ignore_index=True)
            bins, offsets = best_two_fit(frame["length"].to_numpy(), size)
            yield frame.assign(sequence_id=(TaskContext.get().partitionId() << 32) + bins, offset=offsets)

    return pieces.repartition(tasks).mapInPandas(run, PLACED)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """Tokenise and pack whole documents (``doc_id``, ``text``; other columns are ignored).

    One row per piece: ``doc_id``, ``piece``, ``start`` and ``length`` in tokens, ``ids_crc32`` of the
    piece's ids as little-endian 32-bit numbers, ``sequence_id`` and ``offset``. A null text is empty and
    so a single end token; repeated rows are packed as often as they come; null ids are kept."""
    return pack(token_pieces(docs, tokenizer, size), size)
