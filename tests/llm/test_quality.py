"""The scorer by held-out accuracy, its parts against plain versions, and odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventbase.llm import quality as Q
from eventbase.llm.queries import op8_fourier_ridge

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op8_fourier_ridge(spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert got.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows) and len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    measured = Q.measure(docs.withColumn("x", F.lit(1)).withColumn("fold", F.lit("f")))
    held = F.expr("crc32(cast(doc_id as string)) % 4 = 2")
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(measured, labels), Q.train(measured, other)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.levels, b.levels)


def test_pooling_against_the_definition():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = r.integers(1, 9, 8).astype(float)
        p = np.floor(r.random(8) * (n + 1)).clip(0, n)
        got = Q.pool(p, n)
        # the max-min formula of isotonic regression
        want = [max(min(p[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, 8)) for i in range(k + 1)) for k in range(8)]
        assert np.allclose(got, want)


def test_features_approximate_the_kernel():
    r = np.random.default_rng(0)
    many = 20000
    s = Q.Scorer(np.zeros(3), np.ones(3), r.normal(0, 0.5, (3, many)), r.uniform(0, 2 * np.pi, many), None, None, None)
    x = r.normal(0, 1, (6, 3))
    f = s.features(x)[:, :-1] * np.sqrt(Q.FEATURES / many)
    want = np.exp(-0.125 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(f @ f.T - want).max() < 0.03


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, 1, 0), (3, 0, 0), (4, 5, 0), (None, 1, 0)]])
def test_odd_input(spark, labelled):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "x"), (9, "word " * 60000)], "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    measured = Q.measure(docs)
    rows = Q.score(measured, Q.train(measured, labels)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert Q.score(Q.measure(docs.limit(0)), 0.5).count() == 0
