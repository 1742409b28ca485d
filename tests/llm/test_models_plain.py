"""The trained models against plain versions that see all rows at once."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from benelake.llm import quality, toxicity
from benelake.llm.tables import table

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_pools_are_the_isotonic_fit(counts):
    n = np.array([c for c, _ in counts], float)
    good = np.array([min(c, g) for c, g in counts], float)
    bins = np.arange(len(n)) / 7
    mean = lambda a, b: good[a : b + 1].sum() / n[a : b + 1].sum()
    level = [max(min(mean(a, b) for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))]
    x, y = quality._isotonic(bins, n, good)
    want = sorted(set(np.round(level, 9)))
    assert np.allclose(y, want)
    assert np.allclose(x, [np.average(bins[np.isclose(level, v)], weights=n[np.isclose(level, v)]) for v in want])


def test_ridge_is_the_least_squares_of_all_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = quality.with_statistics(docs).join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id")
    model = quality.fit_quality(rows.repartition(5))
    seen = rows.collect()
    s, y = np.array([r["statistics"] for r in seen], float), np.array([r["quality"] for r in seen], float)
    assert np.allclose(model.mean, s.mean(0)) and np.allclose(model.scale, np.where(s.std(0) > 1e-6, s.std(0), 1), rtol=1e-6, atol=1e-9)
    phi = model.features(s)
    n, width = phi.shape
    penalty = math.sqrt(quality.RIDGE * n / (width - 1)) * np.eye(width)
    plain = np.linalg.lstsq(np.concatenate((phi, penalty)), np.concatenate((y, np.zeros(width))), rcond=None)[0]
    assert np.allclose(phi @ model.weights, phi @ plain, atol=1e-6)


def test_noisy_or_of_the_sentences(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, SF, "labels").select("doc_id", "toxic"))
    some = 0
    for r in toxicity.score_toxicity(docs, model, score="p").collect():
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        _, z = model.sentences(toxicity._Bags(data, np.array([0, len(data)])))
        clean = 1.0
        for x in z.tolist():
            clean *= 1 - 1 / (1 + math.exp(-x))
        assert math.isclose(r["p"], 1 - clean, abs_tol=1e-9)
        assert len(r["offending"]) == sum(1 / (1 + math.exp(-x)) >= toxicity.OFFENDING for x in z.tolist())
        some += len(z) > 0
    assert some
