"""The positive-unlabelled classifier: its risk against sums over rows, its odd rows, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from shelfcast.llm import positive_unlabelled as pu

KIND = "doc_id long, text string, quality int, score string, x long"


def test_risk_equals_sums_over_rows_and_is_least():
    rng = np.random.default_rng(1)
    positive = np.hstack([np.ones((300, 1)), rng.normal(1, 1, (300, 3))])
    unlabelled = np.hstack([np.ones((900, 1)), np.vstack([rng.normal(1, 1, (600, 3)), rng.normal(-1.5, 1, (300, 3))])])
    m = pu.Moments(unlabelled.T @ unlabelled, positive.T @ positive, 2 / 3)
    for w in rng.normal(0, 0.5, (5, 4)):
        r = [np.mean((1 - side * (rows @ w)) ** 2) / 4 for rows, side in ((positive, 1), (unlabelled, -1), (positive, -1))]
        assert m.risk(w) == pytest.approx(2 / 3 * r[0] + max(0, r[1] - 2 / 3 * r[2]))
    best = m.minimise()
    assert all(m.risk(best) <= m.risk(best + d) for d in rng.normal(0, 0.05, (200, 4)))
    assert np.mean(unlabelled[:600] @ best > 0) > 0.9 and np.mean(unlabelled[600:] @ best < 0) > 0.9


def test_negative_risk_is_bounded():
    """With a prior that is too large the unbiased risk of the negatives falls below 0; the bounded one does not follow."""
    rng = np.random.default_rng(2)
    positive, unlabelled = (np.hstack([np.ones((n, 1)), rng.normal(size=(n, 20))]) for n in (15, 40))
    m = pu.Moments(unlabelled.T @ unlabelled, positive.T @ positive, 0.9, 1e-3)
    free = np.linalg.solve(m.u + m.ridge, 2 * m.prior * m.p[0] - m.u[0])
    assert m.negative_part(free) < 0 and m.risk(m.minimise()) < m.risk(free)


def test_prior_without_negatives():
    rng = np.random.default_rng(3)
    positive, negative = rng.normal(2, 0.3, (4000, 2)), rng.normal(-2, 0.3, (4000, 2))
    one = lambda x: np.hstack([np.ones((len(x), 1)), x, np.tanh(x)])
    p, u = one(positive[:2000]), np.vstack([one(positive[2000:]), one(negative[:1000])])
    assert pu.prior_bound(u.T @ u, p.T @ p, 1e-3) == pytest.approx(2 / 3, abs=0.07)


def corpus(n=600):
    rng, rows, labels = random.Random(6), [], []
    for i in range(n):
        bad, size = rng.random() < 0.25, rng.randint(20, 200)
        words = ["".join(rng.choice("abcdeioult") for _ in range(rng.randint(2, 9))) for _ in range(size)]
        text = " ".join(w.upper() + "!!" if bad and i % 2 else f"{w} |" if bad else w for w in words)
        rows.append((i, text))
        if rng.random() < 0.5:
            labels.append((i, int(not bad)))
    return rows, labels, {i: int("|" not in t and "!!" not in t) for i, t in rows}


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels, truth = corpus()
    odd = [(None, None), (None, "text without an id"), (700, ""), (701, None), rows[0], rows[0], (702, "word " * 300000), (703, " \n\t ")]
    docs = spark.createDataFrame([(*r, 9, "x", 1) for r in rows + odd], KIND).repartition(3)
    marks = spark.createDataFrame([(a, None, b, None, None) for a, b in [*labels, labels[0], (None, 1), (5, None), (9999, 1)]], KIND)
    found = pu.score_quality(docs, marks).collect()
    assert len(found) == len(rows) + len(odd)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    again = pu.score_quality(docs.repartition(5), marks.repartition(2)).collect()
    assert np.allclose(sorted(r.score for r in found), sorted(r.score for r in again), atol=1e-9)


def test_labels_of_held_out_rows_are_not_used(spark):
    rows, labels, _ = corpus(200)
    docs = spark.createDataFrame([(*r, 9, "x", 1) for r in rows], KIND)
    flip = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in labels]
    a, b = (sorted((r.doc_id, r.score) for r in pu.score_quality(docs, spark.createDataFrame(m, "doc_id long, quality int").coalesce(1)).collect()) for m in (labels, flip))
    assert np.allclose([x[1] for x in a], [x[1] for x in b], atol=1e-12)


def test_nothing_to_learn_from(spark):
    none, some = spark.createDataFrame([], KIND), spark.createDataFrame([(1, "a text", None, None, None), (4, None, None, None, None)], KIND)
    assert pu.score_quality(none, none).count() == 0
    assert {r.score for r in pu.score_quality(some, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in pu.score_quality(some, one).collect())


def test_accuracy_on_the_given_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = pu.score_quality(docs, labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id")
    right = [r.predicted == r.quality for r in held.collect()]
    assert np.mean(right) > 0.8
