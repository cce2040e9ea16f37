"""A toxicity classifier that is kept from reacting to mentions of groups of people."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialize
from . import words as W
from .memory import tidy

#: Labelled rows that the classifier is fitted on: those with the smallest hashes of their ids. The bound of
#: what training may cost; counts for choosing features are taken over the same rows.
TRAINING_ROWS = 20_000
#: Hashed features, and how many of them the classifier uses.
FEATURE_BITS = 20
FEATURES = 8192
#: A feature needs this many labelled rows to be used.
LEAST_ROWS = 2
#: Half the likelihood ratio statistic that a feature's counts must reach: about one feature in 16,000 does by chance.
EVIDENCE = 8.0
#: Strength of the penalty on score changes under swapped identity terms, and of the ridge penalty.
COUNTERFACTUAL = 1.0
RIDGE = 1e-5
STEPS = 300
PREFIXES = (3, 4, 5, 6)
GRAM = 5

#: Terms for groups of people; the terms of a line may be swapped for each other. Fixed values.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "turkish"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
_NEXT = {term: line[(i + 1) % len(line)] for line in IDENTITY_TERMS for i, term in enumerate(line)}
_IDENTITY = re.compile(rf"(?<![^\W_])(?:{'|'.join(sorted(_NEXT, key=len, reverse=True))})(?![^\W_])")


@dataclass
class Model:
    features: np.ndarray  # hashed features that have a weight
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        table = np.zeros(1 << FEATURE_BITS)
        table[self.features] = self.weights
        return table


def swapped(text: str) -> str | None:
    """The text with every identity term exchanged for the next of its kind; None if it has none."""
    out, n = _IDENTITY.subn(lambda m: _NEXT[m.group()], text)
    return out if n else None


def _features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, hashed feature) of all words, word beginnings and strings inside words."""
    found = W.words_of(texts)
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    yield found.text, ((found.hashes + np.uint64(1)) & mask).astype(np.int64)
    sizes = found.ends - found.starts
    for k in PREFIXES:
        long = sizes > k
        s = found.starts[long]
        hashes = _hashes(found.data, s, s + k)
        yield found.text[long], (W.mix(hashes + np.uint64(k)) & mask).astype(np.int64)
    grams = np.maximum(sizes - GRAM, 0)  # strings inside the word; the first is a beginning
    owner = np.repeat(np.arange(len(sizes)), grams)
    begin = found.starts[owner] + 1 + np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams)
    yield found.text[owner], (W.mix(_hashes(found.data, begin, begin + GRAM) + np.uint64(99)) & mask).astype(np.int64)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of short strings."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for i in range(int(ends[0] - starts[0]) if len(starts) else 0):
        out = out * np.uint64(0x100000001B3) + data[starts + i] + np.uint64(1)
    return out


def _present(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, of the features marked in ``known``."""
    parts = [(t[known[f]], f[known[f]]) for t, f in _features(texts)]
    both = np.unique(np.concatenate([(t.astype(np.int64) << FEATURE_BITS) | f for t, f in parts]))
    return both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no label is learned from; an id that is null belongs to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents outside the held-out fifth, one row per id.

    An id with several labels counts as toxic if one says so; null labels and texts are left out."""
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(most)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    labelled = texts.where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")  # at most ``most`` rows
    return labelled.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))


def _counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic rows, other rows) of all features that occur."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("feature", "toxic", "other")])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << FEATURE_BITS
        sums = np.zeros((2, size), dtype=np.int64)
        every = np.ones(size, dtype=bool)
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            toxic = batch.column("toxic").to_numpy() > 0
            for part in W.blocks([len(t) for t in texts]):
                text, feature = _present(texts[part], every)
                marks = toxic[part][text]
                sums[0] += np.bincount(feature[marks], minlength=size)
                sums[1] += np.bincount(feature[~marks], minlength=size)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=schema.names)

    return rows.select("text", "toxic").mapInArrow(run, schema).groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _best_features(counts: DataFrame, n_toxic: int, n_other: int, most: int) -> np.ndarray:
    """The features that tell the classes apart best, by the likelihood ratio of their counts."""
    a, b = F.col("toxic"), F.col("other")
    total = float(n_toxic + n_other)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both = a + b
    ratio = (
        part(a, both * n_toxic / total) + part(b, both * n_other / total)
        + part(n_toxic - a, (total - both) * n_toxic / total) + part(n_other - b, (total - both) * n_other / total)
    )
    best = counts.where((both >= LEAST_ROWS) & (both < total)).select("feature", ratio.alias("ratio")).where(F.col("ratio") >= EVIDENCE)
    rows = best.orderBy(F.desc("ratio"), "feature").limit(most).collect()  # at most ``most`` numbers
    return np.array(sorted(r.feature for r in rows), dtype=np.int64)


def _designs(rows: DataFrame, features: np.ndarray) -> pa.Table:
    """(toxic, features present, features present after the swap or None) of each training row."""
    schema = "toxic int, present array<int>, swapped array<int>"
    known = np.zeros(1 << FEATURE_BITS, dtype=bool)
    known[features] = True

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            others = [swapped(t.decode()) for t in texts]
            toxic = batch.column("toxic").to_numpy()
            for part in W.blocks([2 * len(t) for t in texts]):
                both = texts[part] + [t.encode() if t else b"" for t in others[part]]
                text, feature = _present(both, known)
                lists = np.split(np.searchsorted(features, feature), np.searchsorted(text, np.arange(1, len(both))))
                n = part.stop - part.start
                after = [lists[n + i].tolist() if t is not None else None for i, t in enumerate(others[part])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(toxic[part], pa.int32()),
                        pa.array([x.tolist() for x in lists[:n]], pa.list_(pa.int32())),
                        pa.array(after, pa.list_(pa.int32())),
                    ],
                    names=["toxic", "present", "swapped"],
                )

    return rows.select("text", "toxic").mapInArrow(run, schema).toArrow()  # at most TRAINING_ROWS short lists


def _matrix(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every entry."""
    whole = lists.combine_chunks()
    counts = pc.list_value_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(counts)), counts), whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def fit(designs: pa.Table, n_features: int, counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression, by Adam on all rows at once.

    The loss is the balanced log loss, a ridge penalty, and ``counterfactual`` times the mean squared change of
    the log odds between each text with identity terms and its swapped version."""
    y = (designs["toxic"].to_numpy() > 0).astype(float)
    row, col = _matrix(designs["present"])
    pairs = designs.filter(pc.is_valid(designs["swapped"]))
    row_a, col_a = _matrix(pairs["present"])
    row_b, col_b = _matrix(pairs["swapped"])
    share = np.where(y > 0, np.sqrt(max(1.0, (1 - y).sum()) / max(1.0, y.sum())), 1.0)
    share /= share.sum()
    weights, bias = np.zeros(n_features), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    mean, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        odds = bias + np.bincount(row, weights=weights[col], minlength=len(y))
        error = share * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - y)
        gradient = np.bincount(col, weights=error[row], minlength=n_features) + RIDGE * weights
        if len(pairs):
            gap = np.bincount(row_a, weights=weights[col_a], minlength=len(pairs)) - np.bincount(row_b, weights=weights[col_b], minlength=len(pairs))
            pull = 2 * counterfactual / len(pairs) * gap
            gradient += np.bincount(col_a, weights=pull[row_a], minlength=n_features) - np.bincount(col_b, weights=pull[row_b], minlength=n_features)
        gradient = np.append(gradient, error.sum())
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        change = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights -= change[:-1]
        bias -= change[-1]
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit the classifier. Without labelled rows of both kinds, every score is the share of toxic rows."""
    rows = materialize(training_rows(docs, labels, most), "training")
    n = {r.toxic > 0: r.n for r in rows.groupBy(F.col("toxic").cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        odds = 30.0 if n.get(True) else -30.0
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), odds if n else 0.0)
    features = _best_features(_counts(rows), n[True], n[False], FEATURES)
    weights, bias = fit(_designs(rows, features), len(features), counterfactual)
    return Model(features, weights, bias)


def toxicity_score(model: Model, text: Column) -> Column:
    """Score from 0 to 1 of whole texts, by their own words only; null counts as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        table = model.table()
        known = table != 0
        values = W.texts_of(texts)
        out = np.full(len(values), model.bias)
        for part in W.blocks([len(t) for t in values]):
            owner, feature = _present(values[part], known)
            out[part] += np.bincount(owner, weights=table[feature], minlength=part.stop - part.start)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score(F.coalesce(F.lower(text.cast("string")), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", most: int = TRAINING_ROWS) -> DataFrame:
    """All columns of ``docs`` and ``held_out``, ``score``, ``predicted`` (1 from 0.5 on).

    A map over the documents; only the bounded training rows are shuffled. Repeated rows get equal scores; an empty
    or null text gets the score of a text without any known word; an empty table stays empty. Columns of these three
    names in ``docs`` are replaced."""
    model = train(docs, labels, most)
    scored = docs.withColumns({"held_out": held_out(F.col("doc_id")), "score": toxicity_score(model, F.col(text))})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below 0.5, with the columns they had."""
    model = train(docs, labels)
    return docs.where(toxicity_score(model, F.col("text")) < 0.5)
