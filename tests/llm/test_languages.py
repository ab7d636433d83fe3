"""Presence sets, kernels and the fit against plain Python, and held-out accuracy on the given documents."""

import os
import random

import numpy as np
import pytest

from eventbase.llm import languages as L

SMALL = "/root/testdata/sf0.01"


def plain_runs(text):
    line = " " + " ".join("".join(c if L._letters()[ord(c)] else " " for c in (text or "").lower()).split()) + " "
    return {line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)}


def as_text(number):
    out = ""
    while number:
        out, number = out + chr(number & 0x1FFFFF), number >> 21
    return out


def test_runs(monkeypatch):
    for size in (L.SLICE, 4):
        monkeypatch.setattr(L, "SLICE", size)
        for text in ("a", "Ab, cD!", " ñandú\n\nÜber  x", "日本語 テキスト", "हिन्दी भाषा", "1a2b3", "aa aa aa aa " * 30):
            assert {as_text(x) for x in L.runs(text).tolist()} == plain_runs(text), (size, text)
    for text in (None, "", " \n", "123 +-", "😀", "́"):
        assert not len(L.runs(text))


def test_kernel_features_and_fit():
    r = random.Random(4)
    texts = ["".join(r.choice("abcde ") for _ in range(r.randrange(1, 60))) + "a" for _ in range(30)]
    sets = [L.runs(t) for t in texts]
    points = L.landmarks(sets[:12])
    plain = [set(plain_runs(t)) for t in texts]
    want = np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in plain[:12]] for x in plain])
    assert np.allclose(points.kernel(sets), want)
    features = points.features(sets)[:, :-1]
    assert np.allclose(features @ features[:12].T, want @ np.linalg.pinv(want[:12], rcond=1e-9, hermitian=True) @ want[:12].T)


DOCS = "doc_id long, text string, lang string, held_out string, Score double"


def test_odd_rows(spark):
    rows = [(i, f"{'der und die' if i % 2 else 'the and of'} {i}", "de" if i % 2 else "en", None, 0.0) for i in range(40)]
    odd = [(100, None, "en", None, 0.0), (101, "", None, None, 0.0), (102, "12 %", "xx", None, 0.0), (None, "the of", "en", None, 0.0)]
    odd += [(103, "und " * 100_000, None, None, 0.0), (0, "the the", "en", None, 0.0), (0, "the the", "en", None, 0.0)]
    docs = spark.createDataFrame([*rows, *odd], DOCS)
    model = L.train(docs)
    assert model.names == ["de", "en"]
    got = L.predict(docs, model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: (x.lang_pred, x.score) for x in got}
    assert all(by[i][0] == ("de" if i % 2 else "en") for i in range(1, 40))
    assert by[100] == by[101] == by[102] == ("und", 0.0) and by[103][0] == "de" and by[None][0] == "en"
    none = docs.limit(0)
    assert L.train(none) is None and L.predict(none, model).count() == 0
    assert {x.lang_pred for x in L.predict(docs, None).collect()} == {"und"}


def test_one_row_of_an_id_is_learned_from(spark):
    rows = [(4, f"text {'abc'[i % 3]}", "en", None, 0.0) for i in range(500)] + [(5, "wort", "de", None, 0.0)]
    model = L.train(spark.createDataFrame(rows, DOCS), sample=3)
    assert len(model.points.rows) <= 6


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = L.predict(docs, L.train(docs)).filter("held_out").join(docs.filter("lang is not null").select("doc_id", "lang"), "doc_id")
    right, n = got.selectExpr("sum(int(lang_pred = lang))", "count(*)").first()
    assert n > 200 and right >= 0.99 * n
