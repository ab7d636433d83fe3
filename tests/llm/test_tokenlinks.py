"""Links, groups and counts against a merge of two lists in plain Python, and pieces of long texts against the whole."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from eventbase.llm import tokenlinks as L

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    return L.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())


def texts(seed, n=60):
    r = random.Random(seed)
    words = ["the", "naïve", "Ünïcode", "日本語", "😀", "don't", "1234567", "\t", "\n\n", "  ", "<|endoftext|>", "</s>", "...", " ", "x" * 40, "é", "\x00"]
    made = [r.choice([" ", "", "  "]).join(r.choice(words) for _ in range(r.randrange(0, 30))) for _ in range(n)]
    return [*made, None, "", " ", "a", "a ▁ b", "same text", "same text", "é" * 5]


def plain(tools, rows):
    whole = []
    for text in rows:
        a = tools.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tools.b.encode(text) if text else []
        ba, bb = [tools.side_a.tokens[i] for i in a], [tools.side_b.tokens[i] for i in b]
        if b"".join(ba) != b"".join(bb) or b"".join(ba) != (" " + (text or "")).encode():
            a, b, ba, bb = [], [], [], []
        ends_a = {sum(map(len, ba[: i + 1])): i for i in range(len(a))}
        links = [(ends_a[e], j) for j in range(len(b)) if (e := sum(map(len, bb[: j + 1]))) in ends_a]
        groups, i0, j0 = [], 0, 0
        for i, j in links:
            groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
            i0, j0 = i + 1, j + 1
        assert (i0, j0) == (len(a), len(b))
        whole.append((a, b, [(a[i], b[j]) for i, j in links], hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    count = Counter(p for *_, pairs, _ in whole for p in pairs)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(n, most.get(j, 0))
    return [
        (len(a), len(b), len(pairs), len(pairs), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs), digest)
        for a, b, pairs, digest in whole
    ]


@pytest.mark.parametrize("heavy", [L.HEAVY, 8])
def test_against_a_plain_merge(spark, tools, heavy):
    rows = texts(5)
    table = spark.createDataFrame([(i, t, i % 3, "x") for i, t in enumerate(rows)], "doc_id long, text string, pair int, Row string")
    got = L.measure(table.repartition(3), A, B, heavy=heavy)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = plain(tools, rows)
    assert [tuple(x)[1:] for x in sorted(got.collect())] == want
    assert sum(w[0] == 0 for w in want) >= 3  # null, empty, and a text that B does not give back


def test_odd_tables(spark, tools):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.measure(none, A, B).count() == 0
    same = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two"), (None, None)], "doc_id long, text string")
    got = sorted(L.measure(same, A, B).collect(), key=str)
    assert [(x.doc_id, x.n_links, x.n_best, x.count_sum) for x in got] == [(1, 2, 2, 6), (1, 2, 2, 6), (None, 0, 0, 0), (None, 2, 2, 6)]


def test_long_texts_in_pieces(tools, monkeypatch):
    r = random.Random(9)
    long = [" ".join(t or "-" for t in texts(s, 40)).replace("▁", "") for s in range(6)]
    want = [(tools.a.encode(" " + t, add_special_tokens=False).ids, tools.b.encode(t)) for t in long]
    for size in (1, 7, 100):
        monkeypatch.setattr(L, "PIECE", size)
        assert list(zip(*tools.encode(long))) == want
    assert len(L.cuts(long[0])) > 5 and r


def test_both_libraries_agree_on_a(tools, monkeypatch):
    assert tools.fast
    r = random.Random(2)
    vocabulary = [t.decode("utf-8", "replace") for t in tools.side_a.tokens]
    made = ["".join(r.choice(vocabulary) for _ in range(20)) for _ in range(2000)]
    made += [r.choice("aA =-_\n\té日😀\x85") * r.randrange(1, 300) for _ in range(300)]
    assert [tools.encode_a(t) for t in made] == [tools.a.encode(t, add_special_tokens=False).ids for t in made]
    assert tools.encode_a(" " * 3_000_000) == tools.a.encode(" " * 3_000_000, add_special_tokens=False).ids


def test_lanes_of_every_size_meet_the_same_ends():
    r = np.random.default_rng(1)
    a, b = (np.unique(np.append(r.integers(1, 5000, n), 5000)) for n in (900, 1400))
    for span in (1, 13, 512, 9000):
        at_a, at_b = L.lockstep(a, b, np.append(np.arange(0, 5000, span), 5000))
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_no_piece_has_a_space_inside(tools):
    # long texts are cut before single spaces: no token of B may lie across
    assert not any(b" " in t.lstrip(b" ") for t in tools.side_b.tokens)
