"""The estimator on drawn votes, and the whole classifier against the labels that it never saw."""

import numpy as np
import pytest

from ferrywright.llm import common, quality


def test_estimate_finds_drawn_accuracies():
    rng = np.random.default_rng(0)
    n, k = 20000, 6
    good = rng.random(n) < 0.85
    votes = np.where(good[:, None], np.where(rng.random((n, k)) < 0.6, 1, np.where(rng.random((n, k)) < 0.02, 2, 0)), np.where(rng.random((n, k)) < 0.5, 2, np.where(rng.random((n, k)) < 0.3, 1, 0)))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, share, table = quality.estimate(patterns, counts.astype(float))
    lookup = {tuple(p): q for p, q in zip(patterns.tolist(), posterior, strict=True)}
    guess = np.array([lookup[tuple(v)] >= 0.5 for v in votes.tolist()])
    assert (guess == good).mean() > 0.97 and abs(share - 0.85) < 0.02
    assert np.abs(table[:, 0, 2] - 0.5).max() < 0.1


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.01"), reason="needs the given tables")
def test_held_out_labels(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rows = quality.score_documents(docs).join(labels, "doc_id").select("keep", "quality").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_edge_rows(spark, data):
    rows = [(1, None), (2, ""), (None, "Some prose without an id, of a few words."), (3, "a b " * 50000), (4, "x"), (4, "x"), (5, "\t\n ")]
    docs = common.table(spark, data, "documents").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("doc_id", "text", "1 as score", "'k' as keep")
    weights = quality.fit(docs)
    scored = quality.score_documents(docs, weights)
    assert scored.columns == ["doc_id", "score", "keep"] and scored.count() == docs.count()
    kept = quality.keep_good(docs, weights)
    assert kept.columns == docs.columns and kept.count() == scored.where("keep").count()
    empty = docs.limit(0)
    assert quality.score_documents(empty).collect() == [] and quality.keep_good(empty).collect() == []


def plain_features(text):
    raw = (text or "").encode()
    shape = [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in raw]
    out = [0.0] * quality.BUCKETS
    for a, b, c, d in zip(shape, shape[1:], shape[2:], shape[3:]):
        out[((((a * 31 + b) * 31 + c) * 31 + d) * 2654435761 >> 12) % quality.BUCKETS] += 1 / (len(shape) - 3 + quality.SHORT)
    words = raw.split()
    if len(words) > 1:
        out[0] += sum(a == b for a, b in zip(words, words[1:])) / (len(words) - 1 + quality.SHORT / 6)
    return [x**0.5 for x in out]


def test_scores_match_a_plain_computation_over_documents(spark, data):
    """Expectation-maximisation document by document and the scorer in double precision, without Spark, patterns or packed numbers."""
    docs = common.table(spark, data, "documents")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    voted = {}
    for d, text in rows.items():
        m = quality.measures(text)
        voted[d] = [(2 if m[k] >= bad else 1 if good is not None and m[k] <= good else 0) if m else 0 for k, good, bad in quality.LABELLERS]
    belief = {0: quality.PRIOR_BAD_ROW, 1: quality.PRIOR_GOOD_ROW}
    table = {(k, c): list(belief[c]) for k in range(len(quality.LABELLERS)) for c in (0, 1)}
    prior, good = quality.PRIOR_GOOD, {}
    for _ in range(quality.EM_ROUNDS):
        for d, v in voted.items():
            a, b = prior, 1 - prior
            for k, x in enumerate(v):
                a, b = a * table[k, 1][x], b * table[k, 0][x]
            good[d] = a / (a + b) if any(v) else prior
        heard = [d for d, v in voted.items() if any(v)]
        for k in range(len(quality.LABELLERS)):
            for c in (0, 1):
                tally = [quality.PRIOR_SHARE * len(rows) * belief[c][x] * (prior if c else 1 - prior) for x in range(3)]
                for d in heard:
                    tally[voted[d][k]] += good[d] if c else 1 - good[d]
                table[k, c] = [x / sum(tally) for x in tally]
            table[k, 1][2] = min(table[k, 1][2], table[k, 0][2] / quality.BETTER_THAN_CHANCE)
        prior = min(0.95, max(0.05, sum(good[d] for d in heard) / max(1, len(heard))))
    names = sorted(rows)
    x = np.array([[*plain_features(rows[d]), 1.0] for d in names])
    y = np.array([good[d] for d in names])
    weight = np.where(y >= 0.5, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for k in range(quality.TRAIN_STEPS):
        p = 1 / (1 + np.exp(-(x @ ahead)))
        following = ahead - 2.0 * (x.T @ (weight * (p - y)) + 1e-5 * ahead)
        ahead, w = following + k / (k + 3) * (following - w), following
    want = dict(zip(names, (1 / (1 + np.exp(-(x @ w)))).tolist(), strict=True))
    got = {r.doc_id: r for r in quality.score_documents(docs).collect()}
    assert set(got) == set(want) and max(abs(got[d].score - want[d]) for d in want) < 0.01
    assert all(got[d].keep == (want[d] >= quality.KEEP_FROM) for d in want if abs(want[d] - quality.KEEP_FROM) > 0.01)
