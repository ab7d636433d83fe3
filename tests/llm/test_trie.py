"""The trie against one built in plain Python, with small groups so that every round and stripe is taken."""

import hashlib
import random
import zlib

import pytest

from eventbase.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, Node int"


def plain(rows):
    """Nodes by their definition: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, digest)."""
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)]
        ends = sorted(c for c in convs if built[c] == path)
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(p) == len(path) + 1 for p in below), len(leaves),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(seed, n=60):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(100, 480), n):
        for t in range(r.randrange(0, 9)):
            rows.append((c, r.choice([None, t, t, 3]), r.choice(["user", "assistant", None, ""]), r.choice(["a", "bb", "é😀", "", None]), "x", 7))
    rows += [(200, t, "user", "deep", None, None) for t in range(60)]  # a long conversation that others borrow from
    rows += [(333, 5, "user", "same", None, None)] * 3 + [(None, 1, "user", "lost", None, None)]
    return rows


@pytest.mark.parametrize("seed,small,stripe", [(1, 4, 7), (2, 1 << 13, 1 << 16)])
def test_against_a_plain_trie(spark, seed, small, stripe):
    rows = made(seed)
    got = trie.measure(spark.createDataFrame(rows, SCHEMA).repartition(3), small, stripe)
    assert got.columns[:4] == ["conv_id", "depth", "parent_conv_id", "n_convs"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain(rows)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.measure(none).count() == 0
    # 1 borrows from a conversation that is not there and has no turn after its first h
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0)
    got = trie.measure(spark.createDataFrame([(lone, 0, "user", "x", None, None)], SCHEMA)).collect()
    assert [(x.conv_id, x.depth, x.n_convs, x.n_leaves, x.saved_tokens) for x in got] == [(lone, 0, 1, 1, 0)]
    assert got[0].ends_sha256 == hashlib.sha256(str(lone).encode()).hexdigest()


def test_list_rank_and_running_sums(spark):
    order = list(range(0, 700, 7))
    random.Random(3).shuffle(order)
    rows = [(a, order[i - 1] if i else None, order[i + 1] if i + 1 < len(order) else None) for i, a in enumerate(order)]
    ranks = trie.list_rank(spark.createDataFrame(rows, "arc long, prev long, next long").repartition(4), small=3)
    assert {x.arc: x.rank for x in ranks.collect()} == {a: i for i, a in enumerate(order)}
    sums = trie.running(ranks, ["arc"], stripe=9).collect()
    assert {x.arc: x.upto_arc for x in sums} == {a: sum(order[: i + 1]) for i, a in enumerate(order)}


def test_digest_of_many_ids_over_parts(spark):
    rows = spark.range(20000).selectExpr("id % 2 as node", "id as conv_id").repartition(5)
    got = {x.node: x.ends_sha256 for x in trie.end_digests(rows).collect()}
    assert got == {n: hashlib.sha256(",".join(str(i) for i in range(20000) if i % 2 == n).encode()).hexdigest() for n in (0, 1)}
