import zlib

import numpy as np
import pytest

from gridmix.llm import quality as q, queries
from llm_data import DOCS, EDGES, SF

LABELS = "doc_id long, quality int, toxic int, score string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], LABELS)


def made(n):
    """Good and bad texts by turns."""
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        rows.append((i, " ".join(f"word{(i * j) % 50} and so on." for j in range(20)) if good else "BUY!! | NOW!! | " * (i % 7 + 5)))
        labels.append((i, int(good)))
    return rows, labels


def test_edges(spark, docs):
    rows, labels = made(200)
    frame = docs([(i + 1000, t) for i, t in rows] + EDGES, "predicted")
    marks = table(spark, [(i + 1000, y) for i, y in labels] + [(None, 0), (8, None), (1, 7), (1000, 1)])
    got = q.digest(q.score(frame, marks)).collect()
    assert len(got) == len(rows) + len(EDGES)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    want = dict((i + 1000, y) for i, y in labels)
    assert all(r.predicted == want[r.doc_id] for r in got if r.doc_id in want and r.doc_id >= 1000)
    by_text = {}
    texts = dict(EDGES)
    for r in got:
        if r.doc_id is not None and r.doc_id in texts:
            assert by_text.setdefault(texts[r.doc_id], r.score) == r.score


def test_no_labels_and_no_rows(spark, docs):
    none = table(spark, [])
    assert [r.score for r in q.score(docs(EDGES[:3]), none).collect()] == [q.PRIOR] * 3
    assert q.score(spark.createDataFrame([], DOCS), table(spark, made(50)[1])).collect() == []
    assert q.keep_good(docs(EDGES), none).count() == len(EDGES)


def test_normal_equations_against_brute_force(spark, docs):
    rows, labels = made(120)
    model = q.fit(q.statistics_of(docs(rows)), table(spark, labels))
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, _ in rows])
    x, y = np.array([q.statistics(t) for _, t in rows]), np.array([y for _, y in labels], float)
    train = fold > 0
    mean, scale = x[train].mean(0), x[train].std(0)
    scale[scale <= 1e-9] = 1
    assert np.allclose(mean, model.mean) and np.allclose(scale, model.scale)
    z = q.fourier(x, mean, scale)
    ridge = fold > 1
    a = z[ridge].T @ z[ridge] + q.RIDGE * np.eye(z.shape[1])
    a[0, 0] -= q.RIDGE
    assert np.allclose(z @ np.linalg.solve(a, z[ridge].T @ y[ridge]), z @ model.weights, atol=1e-6)
    assert (np.diff(model.chance) >= 0).all() and (np.diff(model.raw) > 0).all()


def test_fourier_features_approximate_the_kernel(monkeypatch):
    monkeypatch.setattr(q, "DIMENSIONS", 20_000)
    x = np.random.default_rng(0).normal(size=(30, 10))
    z = q.fourier(x, np.zeros(10), np.ones(10))[:, 11:]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * q.WIDTH ** 2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_isotonic():
    assert q.isotonic(np.array([1.0, 0.0, 0.5, 2.0]), np.array([1.0, 1.0, 2.0, 1.0])).tolist() == [0.5, 0.5, 0.5, 2.0]
    assert len(q.isotonic(np.empty(0), np.empty(0))) == 0


def test_held_out_accuracy_and_no_leak(spark):
    sf = SF.replace("0.001", "0.01")
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, marks[i]) for i, r in got.items() if r.held_out and i in marks]
    assert sum(p == y for p, y in held) / len(held) > 0.93
    # other labels of held-out rows change nothing
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    from pyspark.sql import functions as F
    from gridmix.llm import common

    flipped = labels.withColumn("quality", F.when(common.crc_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    other = q.score(spark.read.parquet(f"{sf}/documents.parquet").withColumn("lang", F.lit("zz")), flipped).collect()
    assert all(r.score == pytest.approx(got[r.id].score, abs=1e-9) for r in other)


def test_keep_good(spark, docs):
    rows, labels = made(150)
    frame = docs(rows, "x")
    kept = q.keep_good(frame, table(spark, labels))
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, y in labels if y}
