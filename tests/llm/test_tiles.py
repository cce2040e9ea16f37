"""All-pairs searches over many blocks and spans, against plain Python, and without copies of blocks for each tile."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webstrata.llm import hard_negatives, tiles, topk


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("scale", [1, 64, 1 << 22, 1 << 28])  # scores of single and double precision, and of longs
def test_topk_copies_no_block_for_each_tile(spark, monkeypatch, scale):
    dice = random.Random(7)
    vectors = [(dice.randrange(500), [float(np.float32(dice.uniform(-2, 2))) for _ in range(dim)]) for dim in (4, 4, 4, 9) for _ in range(150)]
    vectors += [(600 + i, [1.0] * 4) for i in range(60)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(5)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "SHARD_ROWS", 11)
    monkeypatch.setattr(tiles, "LEAST_TILES", 40)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    found = topk.top_k(frame, frame.where("vec_id % 9 = 0"), 5, scale)
    assert "Join" not in plan(found) and "Broadcast" not in plan(found)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    asked = {}
    for i, v in vectors:
        if i % 9 == 0:
            asked[i] = min(asked.get(i, v), v)
    assert len(asked) > 40
    whole = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in vectors]
    for q, v in asked.items():
        v = [int(np.floor(scale * x)) for x in v]
        best = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:5]
        assert sorted(got.pop(q)) == [(rank, i, -minus) for rank, (minus, i) in enumerate(best, 1)]
    assert not got


def test_best_keeps_the_first_of_equal_scores():
    rng = np.random.default_rng(3)
    for kind, least in ((np.float32, -5), (np.float64, -5), (np.int64, np.iinfo(np.int64).min)):
        best, seen = tiles.Best(6, 4), collections.defaultdict(list)
        for _ in range(12):
            ids = np.sort(rng.integers(0, 90, 40))
            rows = np.sort(rng.choice(6, 3, replace=False))
            scores = rng.integers(0, 5, (3, 40)).astype(kind) + kind(least)
            fits = rng.random((3, 40)) < rng.choice([0.05, 1])
            for row, one, here in zip(rows, scores, fits):
                seen[int(row)] += [(-int(s), int(i)) for s, i, f in zip(one, ids, here) if f]
            best.add(rows, scores, fits & (scores >= best.least(rows, kind)), ids)
        rows, begin, scores, ids = best.found()
        for row, a, b in zip(rows, begin, begin[1:]):
            assert [(-int(s), int(i)) for s, i in zip(scores[a:b], ids[a:b])] == sorted(seen.pop(int(row)))[:4]
        assert not any(seen.values())


def test_stored_blocks_are_read_once_by_the_spans(spark):
    blocks = spark.range(23).select(F.when(F.col("id") % 5 == 0, 3).otherwise(2).alias("dim"), F.col("id").cast("string").cast("binary").alias("ids"))
    stored = tiles.Stored(blocks.repartition(4).union(blocks.where("false")), "blocks")
    assert stored.count == 23 and stored.spans(1) == 23 and stored.spans(1000) == 1
    for spans in (1, 5, 23):
        for dim in (2, 3, 4):
            read = sorted(int(x) for span in range(spans) for (x,) in stored.read(span, spans, dim, "ids"))
            assert read == [i for i in range(23) if dim == (3 if i % 5 == 0 else 2)]


@pytest.mark.parametrize("low,high,dim,fields", [(0, 0, 1, 53), (-3, 4, 9, 5), (-159, 154, 64, 2), (5, 9, 64, 4), (-(1 << 20), 1 << 20, 9, 1)])
def test_fields_in_doubles_are_exact(low, high, dim, fields):
    rng = np.random.default_rng(8)
    for rows in (1, 2, 3, 40, 41, 107):
        matrix = rng.integers(low, high, (rows, dim), endpoint=True)
        matrix[0], matrix[-1] = high, low
        laid = hard_negatives.Fields(low, high)
        assert hard_negatives.DOUBLE // laid.bits(dim) == fields
        packed, sums = laid.doubles(laid.pack(matrix), dim)
        assert packed.shape == (dim, -(-rows // fields))
        assert (laid.many_scores(matrix[:5], packed, sums) == matrix[:5] @ matrix.T).all()
    assert hard_negatives.Fields(-(1 << 40), 1 << 40).bits(9) == 0


@pytest.mark.parametrize("scale", [1, 256, 1 << 14, 1 << 26])  # many fields a double, two, one, and wide integers
def test_hard_negatives_copy_no_block_for_each_tile(spark, monkeypatch, scale):
    dice = random.Random(9)
    vectors = [(i, [float(np.float32(dice.uniform(-1, 2))) for _ in range(dim)], dice.randrange(4)) for dim in (6, 6, 6, 3) for i in dice.sample(range(2000), 120)]
    vectors = list({i: (i, v, label) for i, v, label in vectors}.values()) + [(3000 + i, [0.5] * 6, i % 2) for i in range(60)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").repartition(5)
    for module, name, value in ((hard_negatives, "SHARD_ROWS", 11), (hard_negatives, "ANCHOR_ROWS", 7), (hard_negatives, "FAN_IN", 3), (tiles, "LEAST_TILES", 40)):
        monkeypatch.setattr(module, name, value)
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, 3, 4, (20, 95), scale)
    assert "Broadcast" not in plan(found)
    got = collections.Counter(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    whole, want = [(i, [int(np.floor(scale * x)) for x in v], label) for i, v, label in vectors], collections.Counter()
    for a, v, label in (x for x in whole if x[0] % 10 == 0):
        others = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, w, m in whole if i != a and len(w) == len(v)]
        for p, positive, _ in sorted(x for x in others if x[2] == label)[:3]:
            fit = sorted((s, i) for s, i, m in others if m != label and -20 * p <= -100 * s <= -95 * p)[:4]
            want.update((a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fit, 1))
    assert got == want and len(want) > 200
