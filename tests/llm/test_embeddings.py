"""Links against all pairs: on the given vectors, on vectors around the threshold, and on odd ones."""

import numpy as np
import pytest

from eventbase.llm import embeddings
from eventbase.llm.queries import op7_quantised_codes

DATA = "/root/testdata/sf0.01"


def all_pairs(ids, x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    group = np.arange(len(ids))
    while True:
        new = np.array([min([group[i], *group[close[i]]]) for i in range(len(ids))])
        if (new == group).all():
            return close.sum(1), [min(ids[group == g]) for g in group]
        group = new


def test_given_vectors_and_moved_copies_equal_all_pairs(spark):
    given = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    x = np.stack(given.embedding).astype(float)
    r = np.random.default_rng(3)
    moved = [x[i] + r.normal(size=x.shape[1]) * np.linalg.norm(x[i]) * 0.02 for i in range(60) for _ in range(1 + i % 7)]
    x = np.concatenate([x, moved])
    ids = np.arange(len(x)) * 3 % 5003
    links, groups = all_pairs(ids, x)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x)]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = [got[v].n_links for v in ids]
    assert all(f <= n for f, n in zip(found, links)) and sum(found) >= 0.98 * sum(links) > 0
    assert [got[v].component_id for v in ids] == groups
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_the_query_returns_every_vector(spark):
    assert op7_quantised_codes(spark, DATA).count() == spark.read.parquet(f"{DATA}/embeddings.parquet").count()


@pytest.mark.parametrize("dimensions", [16, 100])
def test_recall_at_the_threshold(spark, dimensions):
    r = np.random.default_rng(dimensions)
    base = r.normal(size=(400, dimensions))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = r.normal(size=base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = 0.951 * base + np.sqrt(1 - 0.951**2) * other
    x = np.concatenate([base, 3 * near, base[:50]])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    links, _ = all_pairs(np.arange(len(x)), x)
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, codes int")).collect()
    assert all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.n_links for r in got) >= 0.95 * links.sum()


@pytest.mark.parametrize("common", [0.5, 0.8])
def test_recall_where_vectors_share_a_direction(spark, common):
    r = np.random.default_rng(11)
    own = r.normal(size=(3000, 64))
    own[:, 0] = 0
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    aside = r.normal(size=own.shape)
    aside[:, 0] = 0
    aside -= (aside * own).sum(1, keepdims=True) * own
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    like = 1 - (1 - 0.952) / (1 - common)
    both = np.concatenate([own, like * own[:400] + np.sqrt(1 - like**2) * aside[:400]]) * np.sqrt(1 - common)
    both[:, 0] = np.sqrt(common)
    links, _ = all_pairs(np.arange(len(both)), both)
    rows = [(i, v.tolist()) for i, v in enumerate(both)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(x.n_links <= links[x.vec_id] for x in got)
    assert links.sum() >= 800 and sum(x.n_links for x in got) >= 0.95 * links.sum()


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [inf, 1.0]), (7, [nan, 1.0]),
        (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-30, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()), key=str)
    want = [(0, 0, None, None), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (11, 3, 1, False)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert got == sorted(want, key=str)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert embeddings.near_duplicates(df.filter("vec_id in (3, 5)")).count() == 2
