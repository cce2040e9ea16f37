"""Near-duplicate documents by order min-hashing of five-word shingles, verified by banded alignment."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize
from . import words as W
from .components import components
from .memory import tidy

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches of a document. Two documents of similarity s agree in one with about s^PICKED, so at 0.8 they
#: share none of 16 in one of 100,000 cases. Short texts miss more often: 4 against 5 shingles
#: agree in one with 0.4, so in none in one of 3,500 cases.
SKETCHES = 16
#: Minimum shingles kept in each sketch, in text order.
PICKED = 3
#: Occurrences of a shingle in one text that count. The similarity asked for is that of the sets of shingles;
#: with more labels a line repeated within two texts would outweigh all that they differ in.
OCCURRENCES = 1
#: Rows of a bucket, in an order that puts likely matches side by side, that each row is compared with: the
#: nearest few at first, then more of those that are still of another class. Larger buckets that still hold
#: several classes are then compared whole, by tiles of two blocks.
NEAREST, NEIGHBOURS = 3, 12
#: Rows of a block of such a bucket, and shingles counted at once in a tile.
BLOCK, COLUMNS = 256, 4096

_SEEDS = W.mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))
_SKETCHED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.BinaryType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("sketches", T.ArrayType(T.LongType())),
    ]
)


def labelled(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles told apart by the number of their occurrence within the text, and the first of each text.

    Only labels below ``OCCURRENCES`` are kept, so every shingle of a text is there once for each."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    ordered, owner = hashes[order], text[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (owner[1:] != owner[:-1])
    run = np.flatnonzero(new)
    label = np.empty(len(order), dtype=np.uint64)
    label[order] = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
    kept = label < OCCURRENCES
    counts = np.bincount(text[kept], minlength=len(first) - 1)
    return np.where(label == 0, hashes, W.mix(hashes + W.mix(label)))[kept], np.concatenate([[0], np.cumsum(counts)])


def sketches_of(own: np.ndarray) -> np.ndarray:
    """Order min-hash sketches of one text's labelled shingles.

    For each seed the ``PICKED`` shingles with the smallest hashes are kept, in the order in which the
    text has them, and hashed together."""
    picked = min(PICKED, len(own))
    out = np.empty(SKETCHES, dtype=np.uint64)
    step = SKETCHES if len(own) < 100_000 else 1
    for i in range(0, SKETCHES, step):
        ranks = W.mix(own[None, :] ^ _SEEDS[i : i + step, None])
        least = np.argpartition(ranks, picked - 1, axis=1)[:, :picked] if picked < len(own) else np.tile(np.arange(picked), (step, 1))
        kept = own[np.sort(least, axis=1)]
        code = _SEEDS[i : i + step].copy()
        for j in range(picked):
            code = W.mix(code + kept[:, j])
        out[i : i + step] = code
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """One row per document: content key of the text, digest of its words, number of shingles, sketches.

    Texts of equal words have equal digests, whatever stands between the words. A text without words has
    the digest of its bytes, a null text none."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text").cast("binary").to_pylist()
            texts = [b"" if t is None else t for t in raw]
            for part in W.blocks([len(t) for t in texts]):
                found = W.words_of(texts[part])
                hashes, first = W.shingle_hashes(found, SHINGLE)
                marked, first = labelled(hashes, first)
                digests, rows = [], []
                for k in range(part.stop - part.start):
                    if raw[part][k] is None:
                        digests.append(None)
                    else:
                        words = found.hashes[found.first[k] : found.first[k + 1]]
                        digests.append(hashlib.blake2b(words.tobytes() if len(words) else texts[part][k], digest_size=16,
                                                       person=b"words" if len(words) else b"bytes").digest())
                    own = marked[first[k] : first[k + 1]]
                    rows.append(sketches_of(own).view(np.int64) if len(own) else np.zeros(0, dtype=np.int64))
                own = batch.slice(part.start, part.stop - part.start)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("text_key"),
                        pa.array(digests, pa.binary()),
                        pa.array(np.diff(first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows))),
                    ],
                    names=_SKETCHED.names,
                )

    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))
    return keyed.mapInArrow(run, _SKETCHED)


def text_key(text):
    """16 bytes that stand for the exact text."""
    return F.unhex(F.md5(text.cast("binary")))


def _pairs_schema() -> T.StructType:
    return T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _neighbours(values: np.ndarray, rows: list[np.ndarray], lags: range) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows so far apart with equal values that may be similar and aren't of one class."""
    node, n, label = rows
    left, right = [node[:0]], [node[:0]]
    for lag in lags:
        if lag >= len(values):
            break
        a, b = slice(0, len(values) - lag), slice(lag, len(values))
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        ok = (values[a] == values[b]) & (small >= SIMILARITY * large) & (label[a] != label[b])
        left.append(node[a][ok])
        right.append(node[b][ok])
    return np.concatenate(left), np.concatenate(right)


def candidate_pairs(entries: DataFrame, most: int) -> DataFrame:
    """Distinct pairs of nodes to be aligned, out of ``entries`` (``node``, ``n``, ``label``, ``value``, ``near``).

    Entries are sorted over all tasks by bucket and, within it, by further sketches (``near``), so that documents
    with more in common stand side by side; each is paired with up to ``most`` before it. The sort ends in the node,
    so a bucket of any size is dealt over as many tasks as it needs, and none holds more than a batch of rows.
    Documents of one class are not compared again, and documents whose numbers of shingles rule the similarity out
    are never paired. A node paired with itself only has candidates among ``NEIGHBOURS``. A row without ``b`` names
    in ``a`` a bucket at the edge of a task, whose rows may stand in two."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        edges: list[int] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            edges = [edges[0] if edges else batch.column("value")[0].as_py(), batch.column("value")[-1].as_py()]
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("value", "node", "n", "label")]
            if kept is not None:
                now = [np.concatenate([k, x]) for k, x in zip(kept, now)]
            left, right = _neighbours(now[0], now[1:], range(1, most + 1))
            near = np.unique(np.concatenate(_neighbours(now[0], now[1:], range(most + 1, NEIGHBOURS + 1))))
            kept = [x[-NEIGHBOURS:] for x in now]
            a, b = np.concatenate([np.minimum(left, right), near]), np.concatenate([np.maximum(left, right), near])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        yield pa.RecordBatch.from_arrays([pa.array(edges, pa.int64()), pa.nulls(len(edges), pa.int64())], names=["a", "b"])

    order = ["value", *[F.element_at("near", i) for i in (1, 2, 3)], "n", "node"]
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = entries.select("node", "n", "label", "value", *[c.alias(f"_o{i}") for i, c in enumerate(cols)])
    sort = [f"_o{i}" for i in range(len(cols))]
    ordered = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort)
    return ordered.select("value", "node", "n", "label").mapInArrow(run, _pairs_schema()).distinct()


def ordered_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Shingles that both texts have in the same order, as a share of all; 0 if below ``least``.

    An alignment of the labelled shingles in a band: as these are distinct within a text, the longest common
    subsequence is the longest run of matches rising in both texts. The band is as wide as two texts of that
    similarity may be shifted against each other."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    needed = least / (1 + least) * (len(a) + len(b))
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    match = b[order][at] == a
    if np.count_nonzero(match) < needed - 1e-9:
        return 0.0
    place, own = order[at][match], np.flatnonzero(match)
    band = len(a) + len(b) - 2 * needed
    inside = np.abs(place - own) <= band + 1
    place = place[inside]
    if np.all(place[1:] > place[:-1]):
        common = len(place)
    else:
        tails: list[int] = []
        for p in place.tolist():
            i = bisect_left(tails, p)
            if i == len(tails):
                tails.append(p)
            else:
                tails[i] = p
        common = len(tails)
    similar = common / (len(a) + len(b) - common)
    return similar if similar >= least - 1e-12 else 0.0


def _sequences(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles): the labelled shingles, 4 bytes each, of the nodes' texts."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for part in W.blocks([len(t) for t in texts]):
                marked, first = W.shingle_hashes(W.words_of(texts[part]), SHINGLE)
                marked, first = labelled(marked, first)
                marked = (marked >> np.uint64(32)).astype(np.uint32)
                rows = [marked[first[k] : first[k + 1]].tobytes() for k in range(part.stop - part.start)]
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([own.column("node"), pa.array(rows, pa.binary())], names=schema.names)

    text = F.col("text").cast("string")
    texts = docs.select(text_key(text).alias("text_key"), text.alias("text"))
    one_each = texts.join(nodes.select("text_key", "node"), "text_key").dropDuplicates(["text_key"])
    return one_each.select("node", "text").mapInArrow(run, schema)


def _verified(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """The pairs whose texts are similar."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            similar = [
                ordered_similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), SIMILARITY) >= SIMILARITY - 1e-9
                for x, y in zip(left, right)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(similar))

    a = sequences.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    b = sequences.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "left", "right").mapInArrow(run, _pairs_schema())


def _larger_buckets(entries: DataFrame, edges: DataFrame) -> DataFrame:
    """(value, top, tops, others): buckets that neighbours alone don't cover, by the sizes of their commonest class
    and of the rest. Buckets of a single class are left out."""
    classes = entries.groupBy("value", "label").agg(F.count("*").alias("c"))
    buckets = classes.groupBy("value").agg(F.sum("c").alias("rows"), F.max(F.struct("c", "label")).alias("top"))
    cut = edges.select(F.col("a").alias("value"), F.lit(True).alias("cut")).distinct()
    uncovered = buckets.join(cut, "value", "left").where((F.col("rows") > NEIGHBOURS + 1) | F.col("cut"))
    sizes = uncovered.select("value", F.col("top.label").alias("top"), F.col("top.c").alias("tops"), (F.col("rows") - F.col("top.c")).alias("others"))
    return sizes.where("others > 0")


def _tiles(entries: DataFrame, buckets: DataFrame) -> DataFrame:
    """(value, kind, x, y, node, label, is_left): the rows of every tile.

    The commonest class of a bucket and the rest are dealt over blocks by hash. Tiles set blocks of the class against
    those of the rest (kind 0), and those of the rest against each other (kind 1), so that a class of any size is not
    set against itself. A row goes to as many tiles as there are blocks opposite."""
    count = [F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("tops", "others")]
    counted = entries.join(buckets, "value").select("value", "node", "label", (F.col("label") == F.col("top")).alias("is_top"),
                                                    count[0].alias("nx"), count[1].alias("ny"))
    own = F.pmod(F.xxhash64("node", F.lit(BLOCK)), F.when(F.col("is_top"), F.col("nx")).otherwise(F.col("ny"))).cast("int")
    rows = counted.withColumn("own", own)

    def tile(kind: int, x, y, is_left):
        return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), is_left.alias("is_left"))

    mine, last_y = F.col("own"), F.col("ny") - 1
    across = F.transform(F.sequence(F.lit(0), last_y), lambda y: tile(0, mine, y, F.lit(True)))
    back = F.transform(F.sequence(F.lit(0), F.col("nx") - 1), lambda x: tile(0, x, mine, F.lit(False)))
    within = F.transform(F.sequence(F.lit(0), last_y), lambda y: tile(1, F.least(mine, y), F.greatest(mine, y), mine <= y))
    placed = rows.select("value", "node", "label", F.explode(F.when(F.col("is_top"), across).otherwise(F.concat(back, within))).alias("t"))
    return placed.select("value", "t.kind", "t.x", "t.y", "node", "label", "t.is_left")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of different shingles common to each text of ``left`` and each of ``right``, by products of 0/1 blocks."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for texts in (left, right):
        hashes, owner = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        at = np.searchsorted(common, hashes)
        known = at < len(common)
        known[known] = common[at[known]] == hashes[known]
        order = np.argsort(at[known], kind="stable")
        sides.append((at[known][order], owner[known][order], len(texts)))
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, len(common), COLUMNS):
        blocks = []
        for at, owner, n in sides:
            part = slice(*np.searchsorted(at, [start, start + COLUMNS]))
            block = np.zeros((n, min(COLUMNS, len(common) - start)), dtype=np.float32)
            block[owner[part], at[part] - start] = 1
            blocks.append(block)
        counts += blocks[0] @ blocks[1].T
    return counts


def tile_links(tile: pa.Table) -> pa.Table:
    """Links that join the classes of a tile's two blocks: similar pairs, none between classes that others joined."""
    node, label = tile.column("node").to_numpy(), tile.column("label").to_numpy()
    texts = [np.frombuffer(x, np.uint32) for x in tile.column("shingles").to_pylist()]
    is_left = tile.column("is_left").to_numpy()
    kind, x, y = (tile.column(c)[0].as_py() for c in ("kind", "x", "y"))
    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    if kind == 1 and x == y:
        left = right = np.arange(len(node))
    links: list[tuple[int, int]] = []
    if len(left) and len(right):
        size = np.array([len(t) for t in texts])
        shared = shared_shingles([texts[i] for i in left], [texts[i] for i in right])
        enough = shared >= SIMILARITY / (1 + SIMILARITY) * (size[left][:, None] + size[right][None, :]) - 1e-3
        enough &= label[left][:, None] != label[right][None, :]
        root = {int(v): int(v) for v in np.unique(label)}

        def find(v: int) -> int:
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        for i, j in zip(*np.nonzero(enough)):
            a, b = left[i], right[j]
            one, other = find(int(label[a])), find(int(label[b]))
            if one != other and ordered_similarity(texts[a], texts[b], SIMILARITY) >= SIMILARITY - 1e-9:
                root[max(one, other)] = min(one, other)
                links.append((int(node[a]), int(node[b])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document (``doc_id``, ``text``; other columns are ignored): ``doc_id``, ``class_id``, and
    ``text_key`` of the text and ``class_no``, which tells classes apart where ids are repeated.

    Documents are of one class if a chain of documents, each similar to the next, joins them: at least 0.8 of
    the different five-word shingles of both are common to them, in the same order of first occurrence. A text of
    fewer words is one shingle. ``class_id`` is the smallest ``doc_id`` of the class.

    Exact copies, and texts of equal words, are first merged by digest, so that a text copied a million times is
    sketched and compared like any other. Texts without words are similar only to equal ones; a null text is like
    no other (its class is its id); null ids are kept, and are ``class_id`` only where a class has no other; an
    empty table gives no rows."""
    sketched = materialize(sketch(docs), "sketches")
    merged = sketched.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("text_key", "n", "sketches")).alias("_row"), F.min("doc_id").alias("least_id")
    )
    numbered = merged.select("digest", "_row.*", "least_id").withColumn("node", F.monotonically_increasing_id())
    nodes = materialize(numbered, "nodes")

    # Compare nearest neighbours, then all neighbours that this left in different classes, and then the whole of
    # larger buckets as far as their rows still are in different classes.
    classes = None
    apart = _entries(nodes, None)
    first = materialize(candidate_pairs(apart, NEAREST), "pairs")
    if not first.isEmpty():
        rest = apart.join(_larger_buckets(apart, first.where("b is null")), "value", "left_semi")
        paired = first.where("b is not null").select(F.explode(F.array("a", "b")).alias("node"))
        involved = paired.unionByName(rest.select("node")).distinct()
        sequences = materialize(_sequences(docs, nodes.join(involved, "node", "left_semi")), "shingles")
        links = materialize(_verified(first.where("a != b"), sequences), "similar")
        classes = materialize(components(links), "classes")
        second = materialize(candidate_pairs(_entries(nodes, classes), NEIGHBOURS).join(first, ["a", "b"], "left_anti"), "pairs")
        classes = _joined(classes, materialize(_verified(second, sequences), "similar"))
        now = _entries(nodes, classes)
        tiles = _tiles(now, _larger_buckets(now, second.where("b is null"))).join(sequences, "node")
        found = tiles.groupBy("value", "kind", "x", "y").applyInArrow(tile_links, _pairs_schema())
        classes = _joined(classes, materialize(found, "similar"))
    labels = nodes.select("digest", "node", "least_id")
    if classes is not None:
        labels = labels.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        labels = labels.withColumn("root", F.col("node"))
    least = labels.groupBy("root").agg(F.min("least_id").alias("class_id"))
    of_digest = labels.join(least, "root").select("digest", "class_id", F.col("root").alias("class_no"))
    out = sketched.select("doc_id", "text_key", "digest").join(of_digest, "digest", "left")
    class_id = F.coalesce("class_id", F.when(F.col("digest").isNull(), F.col("doc_id")))
    return out.select("doc_id", class_id.alias("class_id"), "text_key", "class_no")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after further links."""
    if links.isEmpty():
        return classes
    stars = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return materialize(components(stars.unionByName(links)), "classes")


def _entries(nodes: DataFrame, classes: DataFrame | None) -> DataFrame:
    """One row per node and sketch: the bucket, the sketches that follow in turn, and the node's class so far."""
    if classes is None:
        state = nodes.withColumn("label", F.col("node"))
    else:
        state = nodes.join(classes, "node", "left").withColumn("label", F.coalesce("root", "node"))
    rotated = F.concat(F.slice("sketches", F.col("i") + 2, SKETCHES), F.slice("sketches", 1, F.col("i")))
    each = state.where(F.col("n") > 0).select("node", "n", "label", "sketches", F.posexplode("sketches").alias("i", "value"))
    return each.select("node", "n", "label", F.xxhash64("i", "value").alias("value"), rotated.alias("near"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with one of each class kept: the one with the smallest id. All columns are kept.

    Rows that repeat a kept one (same id, same text) are dropped with the rest of the class."""
    classes = near_duplicates(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key"))
    keep = classes.groupBy("class_id", "class_no").agg(first.alias("first")).select(F.col("first.doc_id").alias("a"), F.col("first.text_key").alias("b"))
    # the caller's columns are packed, so that no name of theirs can be taken for one of these
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("keep_id"), text_key(F.col("text").cast("string")).alias("keep_key"))
    kept = keyed.join(keep, F.col("keep_id").eqNullSafe(F.col("a")) & F.col("keep_key").eqNullSafe(F.col("b")), "left_semi")
    return kept.dropDuplicates(["keep_id", "keep_key"]).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
