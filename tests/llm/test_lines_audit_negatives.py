"""Line deduplication, the filter audit and hard negatives against plain Python."""

import collections
import itertools
import os
import random
import re
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from webstrata.llm import filter_audit, hard_negatives, line_dedup

BLANK = " \t\n\v\f\r"
COMMON = "This line stands in very many documents"


def line_texts():
    dice = random.Random(3)
    lines = [COMMON, "  this LINE stands in very many documents\t\r", "exactly 20 code pts..", "only nineteen chars", "é" * 20, "é" * 19, "É" * 20,
             "漢字" * 10, "", "   ", "two documents hold this line", f"long {'x' * 5_000}"]
    rows = [(i, "\n".join(dice.choices(lines[:10], k=dice.randrange(1, 12)))) for i in range(40)]
    rows += [(40, "two documents hold this line"), (41, "two documents hold this line\n" * 3), (42, None), (43, ""), (44, "\n\n"), (45, "\n".join(lines * 40))]
    rows += [(None, COMMON + "\nrow without id, one line\n"), (None, "row without id, one line"), (None, "row without id, one line"), (7, COMMON), (7, COMMON)]
    rows += [(90, "repeated row of one document")] * 4 + [(95, "two documents hold this line\r\n" + COMMON)]
    return rows


def without_repeats(rows):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))

    holders = collections.defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3 and len(k) >= 20}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("lookup_lines,batches,runs_a_level", [(1000, 4, 2), (0, 4, 2), (0, 7, 3), (1000, 1, 2), (0, 5, 1)])
def test_lines_in_runs_of_any_shape(spark, lookup_lines, batches, runs_a_level):
    rows = line_texts()
    docs = spark.createDataFrame([(i, t, "l", "d", 5) for i, t in rows], "doc_id long, text string, line string, drops string, n_lines int")
    kept = line_dedup.drop_repeated_lines(docs, batches=batches, runs_a_level=runs_a_level, lookup_lines=lookup_lines)
    assert kept.columns == ["doc_id", "text", "line", "drops", "n_lines", "n_dropped"]
    got = kept.collect()
    assert collections.Counter((r.doc_id, r.text, r["n_lines"], r["n_dropped"]) for r in got) == without_repeats(rows)
    assert {(r.line, r.drops) for r in got} == {("l", "d")}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_lines_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(docs).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in line_dedup.drop_repeated_lines(one).collect()] == [(1, "", 1, 0)]


def test_runs_are_merged_without_a_shuffle(spark):
    runs = line_dedup.Runs(spark, runs_a_level=9)
    for ids in ((30, 31, 32), (20,), (10,)):
        runs.add(spark.createDataFrame([(i, x) for i in ids for x in (b"a" * 16, b"b%d" % i)], "doc_id long, line binary"))
    first, *later = (spark.table(name) for name in runs.levels[0])
    assert {(bytes(r.line)[:1], r.n, r.last_doc) for r in first.collect()} >= {(b"a", 3, 32)}
    assert all(bytes(r.line)[:1] == b"b" for t in later for r in t.collect())  # the frequent line was settled by the first run
    plan = runs._merged([first, later[0]])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert [(bytes(r.line), r.last_doc) for r in runs.frequent().collect()] == [(b"a" * 16, 32)]


# The audit ---------------------------------------------------------------------------


def audit_rows():
    dice = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words[:230])
    kinds = [long, " ".join(words[:20] * 12), long.upper(), long + " #", "short", "", None, "A" * 5_000, "x y " * 300, long.title() + " $ a" * 300, "ÀÉ " * 250]
    rows = [(dice.randrange(30), dice.choice(kinds), dice.choice(["s", "s", "s", "t", None, ""])) for _ in range(160)]
    return rows + [(None, long, "s"), (None, long, "t"), (None, "only without id", "s"), (3, "tie", "s"), (3, "tie", "t"), (3, "tie", "t"), (2, "tie", "u")]


def plain_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search(r"[#$%&*|]", text)), i is not None and i > least[text])) if bad}
        docs.append((source or "", fails, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part in {d[0] for d in docs}:
        mine = [d[1:] for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [d for d in mine if f in d[0] and not d[0] & before]
                kept = sum(1 for d in mine if not d[0] & (before | {f}))
                redundant = sum(1 for d in mine if f in d[0] and d[0] & before)
                shapley[part, f] += len(removed)
                out[part, "".join(order), step] = [kept, len(removed), redundant, sum(1 for d in mine if d[0] == {f}),
                                                   sum(d[1] for d in removed), sum(d[2] for d in removed)]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def written(spark, tmp_path, rows, files):
    path = str(tmp_path / "documents.parquet")
    frame = spark.createDataFrame([(i, t, s, "m", 3) for i, t, s in rows], "doc_id long, text string, source string, mask string, part int")
    frame.repartition(files).write.parquet(path)
    return path


@pytest.mark.parametrize("micro_batches", [1, 5])
def test_audit(spark, tmp_path, micro_batches):
    rows = audit_rows()
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 30, 2)] + [(4, 1, None), (6, None, 1), (None, 1, 1), (8, 0, 0)]
    frame = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit_filters(spark, written(spark, tmp_path, rows, 9), frame, micro_batches)
    assert dict(got.dtypes)["shapley"] == "bigint" and dict(got.dtypes)["step"] == "int"
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, labels) and got.count() == 600 * 4


def test_audit_of_nothing(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(spark, written(spark, tmp_path, [], 1), labels).count() == 0
    path = written(spark, tmp_path / "b", [(1, None, None)], 1)
    got = filter_audit.audit_filters(spark, path, labels).collect()
    assert len(got) == 600 and {(r.kept, r.removed) for r in got if r.filter_order == "ABCDE"} == {(0, 1), (0, 0)}


def test_smaller_ids_retract_what_was_counted():
    state = filter_audit.TextStates()

    def change(*row):
        return {k: n for k, n in state.take([(b"k", 1, *row), (b"other", 2, 5, "p", False, False, 0, 0, 0)]).items() if n}

    assert change(9, "p", True, False, 2, 3, 0) == {("p", 1, True, False): 2, ("p", 17, True, False): 3}
    assert change(9, "q", False, False, 1, 0, 1) == {("q", 1, False, False): 2}
    assert change(12, "p", False, False, 1, 1, 0) == {("p", 17, False, False): 2}
    assert change(4, "p", True, False, 1, 0, 0) == {
        ("p", 1, True, False): -1, ("p", 17, True, False): 2, ("q", 1, False, False): -1, ("q", 17, False, False): 1}
    assert state.texts[b"k"] == (4, {("p", True, False): 1})


def test_any_split_of_the_rows_gives_the_same_counters():
    dice = random.Random(2)
    for _ in range(60):
        rows = [(dice.choice([None, 1, 2, 3, 4]), dice.choice("pq"), dice.random() < 0.5, dice.random() < 0.3) for _ in range(dice.randrange(1, 30))]
        least = min((i for i, *_ in rows if i is not None), default=None)
        want = collections.Counter((p, 2 | (16 if i is not None and i > least else 0), g, t) for i, p, g, t in rows)
        state, got = filter_audit.TextStates(), collections.Counter()
        while rows:
            cut = dice.randrange(1, len(rows) + 1)
            frame = pd.DataFrame(rows[:cut], columns=["doc_id", "part", "good", "toxic"]).astype({"doc_id": "Int64"})
            frame["text_key"], frame["mask"] = b"k", 2
            both = filter_audit.combine(frame)
            assert both[["at_least", "above", "no_id"]].to_numpy().sum() == cut
            least_id = [None if pd.isna(x) else int(x) for x in both["least_id"]]
            counts = (both[c].tolist() for c in ("part", "good", "toxic", "at_least", "above", "no_id"))
            got.update(state.take(zip(both["text_key"], both["mask"], least_id, *counts)))
            rows = rows[cut:]
        assert {k: n for k, n in got.items() if n} == want


# Hard negatives ----------------------------------------------------------------------


def mined(vectors, anchors, positives, negatives, scale):
    good = [(i, l, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, l in vectors
            if None not in (i, l, v) and None not in v and np.isfinite(v).all()]
    asked = {}
    for i, l, v in good:
        if anchors(i):
            asked[i] = min(asked.get(i, (l, v)), (l, v))
    out = collections.Counter()
    for a, (l, v) in asked.items():
        others = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in good if i != a and len(w) == len(v)]
        for p, pid, _ in sorted(x for x in others if x[2] == l)[:positives]:
            fit = sorted((s, i) for s, i, m in others if m != l and -30 * p <= -100 * s <= -90 * p)[:negatives]
            out.update((a, pid, k, i, -p, -s) for k, (s, i) in enumerate(fit, 1))
    return out


def test_hard_negatives(spark, monkeypatch):
    dice = random.Random(4)
    vectors = [(i, [dice.uniform(-1, 2) for _ in range(6)], dice.randrange(3)) for i in range(150)] + [
        (200, None, 1), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, 1), (204, [1.0] * 6, None),
        (None, [1.0] * 6, 1), (205, [], 1), (210, [], 1), (215, [], 2), (206, [1.0], 0), (220, [2.0], 0), (207, [1.5], 1), (20, [1.0] * 6, 1),
    ]
    vectors += [(300 + i // 2, [0.5] * 6, i % 2) for i in range(60)]
    frame = spark.createDataFrame([(*v, "k", 1) for v in vectors], "vec_id long, embedding array<float>, label int, id string, part int").repartition(5)
    want = mined(vectors, lambda i: i % 10 == 0, 5, 10, 256)
    assert len({k[0] for k in want}) > 10
    for shard, block in ((4096, 512), (7, 3)):
        monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard)
        monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", block)
        got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
        assert collections.Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                                   for r in got.collect()) == want
    assert hard_negatives.hard_negatives(frame.where("false"), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(frame, F.lit(False)).count() == 0


@pytest.mark.parametrize("low,high", [(0, 0), (-3, 4), (-159, 154), (5, 9), (-(1 << 20), 1 << 20), (-(1 << 40), 1 << 40), (-(1 << 63), (1 << 63) - 1)])
def test_packed_products_are_exact(low, high):
    rng = np.random.default_rng(6)
    matrix = np.array([[int(rng.integers(low, high, endpoint=True)) for _ in range(9)] for _ in range(40)], dtype=np.int64)
    matrix[0], matrix[1] = low, high
    fields = hard_negatives.Fields(low, high)
    wide = fields.wide(fields.pack(matrix), 9)
    assert len(wide) == 9 and all(isinstance(x, int) for x in wide)
    sums = fields.unpack(sum(wide), 40, 9)
    for anchor in matrix.tolist():
        want = [sum(x * y for x, y in zip(anchor, row)) for row in matrix.tolist()]
        top = (1 << 63) - 1
        assert fields.scores(anchor, wide, sums).tolist() == [max(-top, min(top, x)) for x in want]
