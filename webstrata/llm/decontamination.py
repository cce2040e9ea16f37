"""Benchmark decontamination: a Wu-Manber search for test strings, on words instead of letters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize
from . import words as W
from .memory import tidy

WINDOW = 13
#: Words of a block. One block decides how far the search may skip.
BLOCK = 2
#: Most bits of the shift tables' index, and the least.
MOST_SHIFT_BITS, LEAST_SHIFT_BITS = 24, 16
#: A document is contaminated if hit words make up at least one in so many of its words.
ONE_IN = 20
#: Bytes of benchmark texts that are searched for in one pass; their tables take about thirty times as much in a worker. A
#: larger benchmark takes several passes, each with its own tables, so what is broadcast stays bounded.
TABLE_BYTES = 8 << 20


def block_keys(hashes: np.ndarray, block: int) -> np.ndarray:
    """Hash of the block of words that ends at each position from ``block - 1`` on."""
    return W.mix(hashes) if block == 1 else W.mix(hashes[1:] + W.mix(hashes[:-1]))


def window_keys(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window of ``length`` words from each start."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for j in range(length):
        out = W.mix(out + hashes[starts + j] + np.uint64(j))
    return out


def window_text(words: W.Words, start: int, length: int) -> bytes:
    return b" ".join(words.data[words.starts[i] : words.ends[i]].tobytes() for i in range(start, start + length))


class Tables:
    """Search tables for windows of one length, the unit being the word.

    ``shift`` has, for each block of words (by hash), how far the window may move on when its last
    words are that block: no occurrence can end in between. Where it is 0, the windows of the items that end
    with such a block are in question: they are found in the order of ``keys``, hashes of the last block and the whole
    window, and compared word by word. Windows are places in the items' words; equal ones are one entry, with the
    numbers of their items in ``owners``."""

    def __init__(self, length: int, words: W.Words, starts: np.ndarray, items: np.ndarray):
        self.length, self.words = length, words
        self.block = min(BLOCK, length)
        ends = block_keys(words.hashes, self.block)
        bits = min(MOST_SHIFT_BITS, max(LEAST_SHIFT_BITS, (8 * len(starts)).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, min(255, length - self.block + 1), dtype=np.uint8)
        for j in range(self.block - 1, length):  # a shorter move is never wrong, so 255 is enough
            place = (ends[starts + j - self.block + 1] & self.mask).astype(np.int64)
            np.minimum.at(self.shift, place, np.uint8(min(255, length - 1 - j)))
        keys = self.keys_of(words, starts)
        order = np.lexsort((items, keys))
        keys, starts, items = keys[order], starts[order], items[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        for i in np.flatnonzero(~new):  # equal hashes of different words stay apart
            new[i] = window_text(words, starts[i], length) != window_text(words, starts[i - 1], length)
        first = np.flatnonzero(new)
        self.keys, self.starts, self.owners = keys[first], starts[first], np.split(items.astype(np.int32), first[1:]) if len(first) else []

    def keys_of(self, words: W.Words, starts: np.ndarray) -> np.ndarray:
        last = block_keys(words.hashes, self.block)[starts + self.length - self.block]
        return W.mix(last + window_keys(words.hashes, starts, self.length))

    def search(self, found: W.Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, first word, item numbers) of each occurrence in all texts."""
        if len(found.hashes) < self.length:
            return
        keys = block_keys(found.hashes, self.block)
        shifts = self.shift[(keys & self.mask).astype(np.int64)].tobytes()
        lead = self.block - 1
        candidates: list[int] = []
        for first, last in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
            at = first + self.length - 1  # the word that a window would end with
            while at < last:
                skip = shifts[at - lead]
                if skip:
                    at += skip
                else:
                    candidates.append(at - self.length + 1)
                    at += 1
        begins = np.array(candidates, dtype=np.int64)
        wanted = self.keys_of(found, begins)
        low, high = (np.searchsorted(self.keys, wanted, side) for side in ("left", "right"))
        for k in np.flatnonzero(high > low).tolist():
            begin = candidates[k]
            there = window_text(found, begin, self.length)
            for entry in range(low[k], high[k]):
                if window_text(self.words, int(self.starts[entry]), self.length) == there:
                    yield int(found.text[begin]), begin, self.owners[entry]


def tables_of(texts: list[bytes], window: int = WINDOW) -> list[Tables]:
    """Tables for the windows of the items' texts, one for each length that occurs.

    An item of fewer words than a window, but not none, is one window."""
    words = W.words_of(texts)
    counts = np.diff(words.first)
    lengths = np.minimum(counts, window)
    out = []
    for length in np.unique(lengths[lengths > 0]).tolist():
        mine = np.flatnonzero(lengths == length)
        each = counts[mine] - length + 1
        before = np.concatenate([[0], np.cumsum(each)])
        starts = np.arange(before[-1]) - np.repeat(before[:-1], each) + np.repeat(words.first[mine], each)
        out.append(Tables(length, words, starts.astype(np.int64), np.repeat(mine, each)))
    return out


def _matches(found: W.Words, tables: list[Tables], n_texts: int) -> tuple[list[list[tuple[int, int]]], list[set[int]]]:
    hits: list[list[tuple[int, int]]] = [[] for _ in range(n_texts)]
    items: list[set[int]] = [set() for _ in range(n_texts)]
    for table in tables:
        for text, begin, owners in table.search(found):
            begin -= int(found.first[text])
            own = hits[text]
            if own and own[-1][0] <= begin <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], begin + table.length))
            else:
                own.append((begin, begin + table.length))
            items[text].update(owners.tolist())
    return hits, items


def _pass(docs: DataFrame, items: list[tuple[str, bytes]], window: int, column: str) -> DataFrame:
    """Add what is found of the items: word intervals, item ids and the number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([*docs.schema.fields, T.StructField("_hits", T.ArrayType(T.ArrayType(T.IntegerType()))),
                           T.StructField("_items", T.ArrayType(T.StringType())), T.StructField("_n_words", T.LongType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = [name for name, _ in shared.value], None
        for batch in batches:
            tables = tables or tables_of([text for _, text in shared.value], window)
            texts = W.texts_of(batch.column(batch.schema.get_field_index(column)))
            for part in W.blocks([len(t) for t in texts]):
                found = W.words_of(texts[part])
                hits, numbers = _matches(found, tables, part.stop - part.start)
                own = batch.slice(part.start, part.stop - part.start)
                columns = [
                    *own.columns,
                    pa.array([[list(h) for h in x] for x in hits], pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted({names[i] for i in x}) for x in numbers], pa.list_(pa.string())),
                    pa.array(np.diff(found.first), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """Search the whole ``text`` of every document for the windows of the benchmark's ``item_id``, ``text``.

    Returns the columns ``keep`` with ``n_words``, ``n_hit`` (words inside any occurrence), ``items`` (ids
    of items with an occurring window, sorted as strings), ``hits`` (word intervals, for inspection) and
    ``contaminated``. Documents are only mapped, never shuffled: a passage that most documents share costs
    no more than finding it. The benchmark is broadcast after a look at its size; one of more than
    ``table_bytes`` is searched for in parts, one pass for each, with the documents' findings written
    out in between.

    Null and empty texts have no words and are clean; null items and those without words are never found;
    repeated rows each get their own result; items without id are called 'null'. Columns of ``keep`` that have the name of
    a result are replaced by it."""
    results = ("n_words", "n_hit", "items", "hits", "contaminated")
    found, columns = _found(docs, benchmark, keep, window, table_bytes)
    return found.select(*[c.alias(name) for name, c in columns.items() if name.lower() not in results], *results)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The documents that hold no more than a trace of the benchmark, with the columns they had, whatever their names."""
    found, columns = _found(docs, benchmark, docs.columns, window, table_bytes)
    return found.where(~F.col("contaminated")).select(*[c.alias(name) for name, c in columns.items()])


def _found(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, table_bytes: int) -> tuple[DataFrame, dict[str, Column]]:
    """The results beside ``kept``, and the kept columns out of it by name."""
    source = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // table_bytes))
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    kept = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.lit(0).alias("none")).alias("kept")
    state = docs.select(kept, F.col("text").cast("string").alias("_text"))
    state = state.withColumns({"_all_hits": F.array().cast("array<array<int>>"), "_all_items": F.array().cast("array<string>")})
    counted = F.lit(0).cast("long")
    for part in range(parts):
        rows = source.where(F.col("text").isNotNull() & (slot == part)).collect()
        items = [("null" if r.item_id is None else r.item_id, r.text.encode()) for r in rows]
        state = _pass(state, items, window, "_text")
        state = state.withColumns(
            {"_all_hits": F.concat("_all_hits", "_hits"), "_all_items": F.array_union("_all_items", "_items")}
        )
        if part < parts - 1:
            state = materialize(state.drop("_hits", "_items", "_n_words"), "decontamination")
        counted = F.col("_n_words")
    ordered = F.array_sort("_all_hits")
    covered = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("until")),
        lambda a, h: F.struct(
            (a["n"] + F.greatest(F.lit(0), h[1] - F.greatest(h[0], a["until"]))).alias("n"),
            F.greatest(a["until"], h[1]).alias("until"),
        ),
    )["n"]
    out = state.select(
        "kept",
        counted.alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.array_sort("_all_items").alias("items"),
        ordered.alias("hits"),
    )
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")))
    return out, {c: F.col(f"kept.c{i}") for i, c in enumerate(keep)}


def items_digest(items: list[str]) -> str:
    """SHA-256 of the ids, comma-joined; the digest that queries return."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
