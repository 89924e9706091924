"""The pipeline's stages in a row on a small table, each against a plain version of its decision."""

from collections import Counter

from pyspark.sql import functions as F

import brute
import corpus_pipeline as cp
from brute import SF_SMALL
from riskframe.llm import line_crf
from riskframe.llm.common import store, table
from riskframe.llm.queries import GOOD, usable


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_decide_like_plain_versions(spark):
    docs = table(spark, SF_SMALL, "documents")

    good = store(cp.quality(spark, docs, SF_SMALL), "test-good")
    model = line_crf.train(docs, table(spark, SF_SMALL, "labels"), usable())
    scores = {r.doc_id: r.score for r in line_crf.quality_scores(docs, model).collect()}
    assert sorted(i for i, _ in pairs(good)) == sorted(i for i, s in scores.items() if s >= GOOD)

    single = store(cp.near_duplicates(spark, good, SF_SMALL), "test-single")
    assert sorted(i for i, _ in pairs(single)) == sorted(r[0] for r in brute.op2(pairs(good)) if r[0] == r[2])

    clean = store(cp.decontamination(spark, single, SF_SMALL), "test-clean")
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    assert sorted(i for i, _ in pairs(clean)) == sorted(r[0] for r in brute.op5(pairs(single), items) if not r[5])

    mixed = store(cp.mixture(spark, clean, SF_SMALL), "test-mixed")
    assert good.columns == single.columns == clean.columns == mixed.columns == docs.columns
    sizes = {i: len(brute.words(t)) for i, t in pairs(clean)}
    taken = Counter()
    for i, t in pairs(mixed):
        taken[i] += len(brute.words(t))
    assert all(n <= 2 * sizes[i] for i, n in taken.items())

    out = cp.token_output(spark, mixed, SF_SMALL)
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in out.select("doc_id", "n_tokens", "ids_crc32").collect())
    assert got == sorted((r[0], r[2], r[3]) for r in brute.op10(pairs(mixed)))
    assert out.where(F.col("start") == 0).count() == 1
