"""Passages planted in random text, exact and with changes, against what was planted."""

import random

import numpy as np
import pytest

from eventbase.llm import passages as P

SCHEMA = "doc_id long, text string, start_word string, n_chars long"


def words(r, n):
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 7))) for _ in range(n)]


def changed(r, passage, share):
    out = []
    for w in passage:
        x = r.random()
        if x < share / 3:
            continue
        out.append("new" + w if x < 2 * share / 3 else w)
        if 2 * share / 3 <= x < share:
            out.append("more" + w)
    return out


@pytest.fixture(scope="module")
def planted():
    r = random.Random(11)
    exact, fuzzy, short = words(r, 60), words(r, 120), words(r, 30)
    docs, at = {}, {}
    for i in range(60):
        body = words(r, r.randrange(80, 200))
        kind = ("exact", "fuzzy", "short", "none")[i % 4]
        piece = {"exact": exact, "fuzzy": changed(r, fuzzy, 0.04), "short": short, "none": []}[kind]
        where = r.randrange(len(body))
        docs[i] = body[:where] + piece + body[where:]
        at[i] = (kind, where, len(piece))
    docs[60] = list(docs[3])  # a whole copy
    at[60] = ("copy", 0, len(docs[3]))
    return docs, at


def table(spark, docs):
    rows = [(i, " \n".join(d).upper() if i % 2 else "  ".join(d), None, -1) for i, d in docs.items()]
    return spark.createDataFrame([*rows, (100, None, None, 0), (101, "", None, 0), (102, "a b", None, 0), (None, "x y z", None, 0)], SCHEMA)


def test_planted_passages_are_found_and_nothing_else(spark, planted):
    docs, at = planted
    found = P.passages(table(spark, docs)).collect()
    got = {}
    for f in found:
        assert f.first_doc_id < f.doc_id and f.n_words >= 50 and f.similarity >= 0.8
        got.setdefault(f.doc_id, set()).update(range(f.start_word, f.start_word + f.n_words))
    kinds = {}
    for i, (kind, where, n) in at.items():
        want = set(range(where, where + n))
        have = got.get(i, set())
        if kind in ("none", "short") or kind not in kinds and kind != "copy":
            assert not have
        else:
            assert len(want & have) >= (0.9 if kind == "fuzzy" else 1) * len(want) and len(have - want) <= 4, (i, kind, len(want), len(have))
        kinds.setdefault(kind, i)


def test_removal(spark, planted):
    docs, at = planted
    before = table(spark, docs)
    after = {r.doc_id: r for r in P.remove_repeats(before).collect()}
    assert set(after) == {*range(60), 100, 101, 102, None}
    assert after[0].text == "  ".join(docs[0]) and after[100].text is None and after[101].text == ""
    kind, where, n = at[4]
    assert after[4].text.split() == docs[4][:where] + docs[4][where + n :] and after[4].n_chars == len(after[4].text)
    assert P.remove_repeats(before.limit(0)).count() == 0


def test_fenwick_tree_against_a_scan():
    r = random.Random(2)
    tree, all_ = P.PrefixMax(40), []
    for i in range(300):
        place, value = r.randrange(40), (float(r.randrange(100)), i)
        tree.put(place, value)
        all_.append((place, value))
        ask = r.randrange(40)
        assert tree.upto(ask) == max((v for p, v in all_ if p <= ask), default=(float("-inf"), -1))


def test_chain_scores_against_all_orders():
    r = random.Random(4)
    for _ in range(200):
        parts = sorted({(r.randrange(60), r.randrange(60), r.randrange(6, 10)) for _ in range(r.randrange(1, 8))})
        best = [0.0] * len(parts)
        for i, (p, o, n) in enumerate(parts):
            best[i] = n + max(
                [0.0] + [best[j] - P.GAP_COST * (p - q - m + o - s - m) for j, (q, s, m) in enumerate(parts) if q + m <= p and s + m <= o]
            )
        chain = P.chains(parts)[0]
        score = sum(n for *_, n in chain)
        for (q, s, m), (p, o, _) in zip(chain, chain[1:]):
            assert q + m <= p and s + m <= o
            score -= P.GAP_COST * (p - q - m + o - s - m)
        assert score == pytest.approx(max(best))


def test_cut_out():
    assert P.cut_out("a  b\nc d é", [(1, 2)]) == "a  d é"
    assert P.cut_out(" a b", [(0, 9)]) == " "
    assert P.cut_out(None, []) == ""
    assert P.seeds(np.zeros(3, np.uint64))[0].size == 0


def test_words_and_lines_said_again_and_again(spark):
    r = random.Random(8)
    line, passage = words(r, 20), words(r, 60)
    rows = [
        (1, " ".join(line * 300)), (2, " ".join([*words(r, 40), *line * 200])), (3, "thor " * 5000), (4, "x " + "thor " * 4000),
        (5, " ".join(passage)), (6, " ".join([*passage, *words(r, 70), *passage, *words(r, 5), *passage])), (7, " ".join(line)),
    ]
    got = {}
    for x in P.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault((x.doc_id, x.first_doc_id), set()).update(range(x.start_word, x.start_word + x.n_words))
    assert set(got) == {(2, 1), (4, 3), (6, 5)}
    assert got[2, 1] == set(range(40, 4040)) and got[4, 3] == set(range(1, 4001))
    assert got[6, 5] == {*range(60), *range(130, 190), *range(195, 255)}


def test_passages_whose_parts_have_other_holders(spark):
    r = np.random.default_rng(17)
    text = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**9, n))
    rows = []
    for k in range(40):
        parts = [text(60 // (2 + k % 2)) for _ in range(2 + k % 2)]
        for i, part in enumerate(parts):
            rows.append((10 * k + i, f"{text(40)} {part} {text(40)}"))
        whole = " ".join(parts)
        rows += [(10 * k + 8, f"{text(30)} {whole} {text(30)}"), (10 * k + 9, f"{text(45)} {whole} {text(20)}")]
    got = P.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, x.first_doc_id, x.start_word, x.n_words) for x in got} == {(10 * k + 9, 10 * k + 8, 45, 60) for k in range(40)}


def test_word_hashes_follow_the_words_alone():
    long = "x" * (3 * P.PIECE + 5)
    texts = ["a b\x00 \x00b a", "Äb äB Ab aB", f"{long} a {long} {long}y", "ab " * P.PIECE, "\x1c\x85 \t", f"{'c' * (P.PIECE - 1)} ab {long}"]
    known = {}
    for text in [*texts, *(" " * i + texts[2] for i in range(3)), None, "", " \n"]:
        words = (text or "").encode().lower().split()
        hashes = P.word_hashes(text).tolist()
        assert len(words) == len(hashes)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes))
    assert len(set(known.values())) == len(known)


def test_a_seed_is_the_first_least_shingle_of_a_window():
    rnd = np.random.default_rng(3)
    for n in [*range(P.SHINGLE, 20), 400]:
        words = rnd.integers(0, 3, n).astype(np.uint64)
        hashes = np.zeros(n - P.SHINGLE + 1, np.uint64)
        for i in range(P.SHINGLE):
            hashes = P._mixed(hashes, words[i : i + len(hashes)])
        hashes = P._stirred(hashes).tolist()
        width = min(P.WINDOW, len(hashes))
        wanted = {i + hashes[i : i + width].index(min(hashes[i : i + width])) for i in range(len(hashes) - width + 1)}
        at, _, again = P.seeds(words)
        assert at[~again].tolist() == sorted(wanted)
