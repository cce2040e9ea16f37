"""The pipeline's stages on the smallest tables: what each keeps, against plain Python."""

import collections
import os
import sys
import zlib

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import pytest
import tokenizers
from test_operators import classes, words

from tests.check_queries import compare, connect
from webstrata.llm import near_duplicates, packing, toxicity
from webstrata.llm.queries import ORACLES, QUERIES, SEQUENCE, TOKENIZER, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    names = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        before, after = docs.select("doc_id").collect(), out.select("doc_id").distinct().collect()
        assert {r.doc_id for r in after} <= {r.doc_id for r in before}
        if name == "toxicity":
            scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
            assert {r.doc_id for r in after} == {r.doc_id for r in scored.where("predicted = 0").collect()}
        if name == "near_duplicates":
            classes = near_duplicates.near_duplicates(docs).select("class_no").distinct().count()
            assert out.count() == classes == len(after)
        if name in ("pii", "packing"):
            assert len(after) == len(before)
        if name != "packing":
            assert out.columns == columns
        names.append(name)
        docs = out
    assert names == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]


def test_near_duplicates_stage_keeps_one_of_each_class(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = [r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf_dir).collect()]
    groups = classes([(r.doc_id, r.text) for r in docs.collect()])
    assert len(kept) == len(groups) < docs.count() and all(len(set(kept) & set(g)) == 1 for g in groups)


def test_decontamination_stage_keeps_exactly_the_clean(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = [r.doc_id for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, sf_dir).collect()]
    windows = set()
    for r in table(spark, sf_dir, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[j : j + 13]) for j in range(max(1, len(w) - 12) if w else 0)}
    clean, sizes = [], {len(x) for x in windows}
    for r in docs.collect():
        w = words(r.text)
        hit = {k for n in sizes for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows for k in range(j, j + n)}
        if not hit or 20 * len(hit) < len(w):
            clean.append(r.doc_id)
    assert sorted(kept) == sorted(clean) and 0 < len(clean) < docs.count()


def test_packing_stage_has_the_ids_of_the_pii_stage(spark, sf_dir):
    stages, docs = dict(corpus_pipeline.STAGES), table(spark, sf_dir, "documents")
    masked = stages["pii"](spark, docs, sf_dir)
    coder, want = tokenizers.Tokenizer.from_file(TOKENIZER), collections.Counter()
    for r in masked.collect():
        ids = np.array(coder.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids), SEQUENCE)):
            want[r.doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in stages["packing"](spark, masked, sf_dir).collect()) == want


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.count() > 0 and packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()} and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert name in QUERIES
    assert compare(spark, connect(sf_dir), sf_dir, name) is None
