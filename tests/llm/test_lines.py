"""Base counts against a plain count, Viterbi and the fit against all labellings, verdicts on labelled documents."""

import itertools
import random
import re

import numpy as np
import pytest

from eventbase.llm import lines
from eventbase.llm.queries import op9_line_labels

SCHEMA = "doc_id long, text string, kept string, n_words int"
WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    parts = text.split("\n")
    dup = sum(bool(re.search(WORD, p)) and p in parts[:i] for i, p in enumerate(parts))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def texts():
    r = random.Random(8)
    pool = ["a", "b", "é", "x#y", "$$", "\x85", "漢字", "end.", "W"]
    out = [None, "", " \n\t\n", "#", "a\n a\na\n", "a b c d e a b c d e", "a a a a a a", "\n".join(["one two"] * 9), "x" * 5000]
    for _ in range(120):
        out.append("".join(r.choice(pool) + r.choice([" ", " ", "\n", "\r\n", "\x0b", "  "]) for _ in range(r.randrange(60))))
    return out


def test_base_counts(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in lines.judge(spark.createDataFrame(rows, SCHEMA), None).collect()}
    for i, t, *_ in rows:
        want, r = plain_counts(t), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)


def score(field, features, marks):
    total = field.start[marks[0]] + sum(features[i] @ field.weights for i, m in enumerate(marks) if m)
    return total + sum(field.pairs[a, b] for a, b in zip(marks, marks[1:]))


def test_viterbi_against_all_labellings():
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 8):
        field = lines.Field(r.normal(size=3), r.normal(size=(2, 2)), r.normal(size=2))
        x = r.normal(size=(n, 3))
        best = max(itertools.product((0, 1), repeat=n), key=lambda m: score(field, x, m))
        assert field.marks(x).astype(int).tolist() == list(best)


def test_fit_reaches_the_maximum_of_the_likelihood():
    r = np.random.default_rng(4)
    sequences = [r.normal(size=(n, 2)) for n in (1, 3, 4, 2, 4, 3)]
    marks = [0, 1, 1, 0, 1, 0]

    def likelihood(theta):
        field = lines.Field(theta[:2], theta[2:6].reshape(2, 2), theta[6:])
        total = -0.5 * (theta**2).sum()
        for x, m in zip(sequences, marks):
            every = [score(field, x, way) for way in itertools.product((0, 1), repeat=len(x))]
            total += score(field, x, [m] * len(x)) - np.logaddexp.reduce(every)
        return total

    field = lines.fit_field(sequences, marks, rounds=3000)
    theta = np.concatenate([field.weights, field.pairs.ravel(), field.start])
    for step in np.eye(8) * 0.03:
        assert likelihood(theta) > max(likelihood(theta + step), likelihood(theta - step))


def test_held_out_verdicts(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    rows = op9_line_labels(spark, at).join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 4 = 2 and n_words >= 10").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad) and good and bad


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(None, 0, 0), (2, 7, 0), (3, None, 0)]])
def test_few_labels_and_odd_rows(spark, labelled):
    docs = spark.createDataFrame([(1, "w " * 30, "x", 0), (1, "v x " * 3, None, 0), (None, None, None, 0), (4, " ".join(map(str, range(40))), "", 0)], SCHEMA)
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    field = lines.train(docs, labels)
    assert field is None
    assert lines.judge(docs, field).count() == 4
    kept = lines.keep_good(docs, field).collect()
    assert [r.doc_id for r in kept] == [4] and lines.keep_good(docs.limit(0), field).count() == 0
    assert lines.train(docs.limit(0), labels) is None


def prose(r, n):
    return [" ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(r.randrange(8, 16))).capitalize() + "." for _ in range(n)]


def junk(r, n):
    return [" ".join(r.choice(["$$", "|", "BUY", "<<", "50%", "Menu", "#1", "***"]) for _ in range(r.randrange(3, 9))) for _ in range(n)]


def test_lines_of_one_text_are_told_apart(spark):
    r = random.Random(6)
    docs, labels = [], []
    for i in range(120):
        good = i % 2 == 0
        body = prose(r, r.randrange(4, 12)) if good else junk(r, r.randrange(4, 12))
        docs.append((i, "\n".join(body), None, 0))
        labels.append((i, int(good), 0))
    docs.append((500, "\n".join(prose(r, 3000)), None, 0))  # long documents are learned from as well
    labels.append((500, 1, 0))
    field = lines.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    article, menu = prose(r, 9), junk(r, 4)
    marks = field.marks(lines.look("\n".join(article[:3] + menu + article[3:])).features)
    assert marks.tolist() == [True] * 3 + [False] * 4 + [True] * 6
    page = lines.look("\n".join(junk(r, 8) + prose(r, 2) + junk(r, 8)))
    marks = field.marks(page.features)
    assert marks.tolist() == [False] * 8 + [True] * 2 + [False] * 8
    assert lines.verdict(field, page)[1:] == (field.content_share(page) >= 0.5 and not lines.base_failed(page.base), field.content_share(page))


def test_marks_of_labelled_documents_follow_their_quality():
    field = lines.Field(np.array([1.0]), np.zeros((2, 2)), np.zeros(2))
    x = np.array([[3.0], [3.0], [-9.0], [-9.0], [3.0]])
    assert lines.marks_towards(field, x, True).tolist() == [True, True, False, False, True]
    assert lines.marks_towards(field, np.full((3, 1), -99.0), True).all()
    assert not lines.marks_towards(field, np.full((3, 1), 99.0), False).any()


def test_texts_of_thousands_of_lines_and_empty_tables(spark):
    r = random.Random(1)
    field = lines.fit_lines([lines.look("\n".join(f(r, 300))).features for f in (prose, junk)], [1, 0])
    docs = spark.createDataFrame([(1, "\n".join(prose(r, 5000)), None, 0), (2, "\n".join(junk(r, 5000)), None, 0)], SCHEMA)
    got = {x.doc_id: x for x in lines.judge(docs, field).collect()}
    assert got[1].content_share > 0.99 and got[2].content_share < 0.01
    assert lines.judge(docs.limit(0), field).count() == 0
