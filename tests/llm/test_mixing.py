"""The mix against its laws, its targets worked out by hand, and the tree's draws."""

import random

import pytest
from pyspark.sql import functions as F

from eventbase.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int"


def rows(n=400, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source = None if i % 11 == 0 else f"s{min(r.randrange(12), 5)}"
        out.append((i, None if i % 50 == 7 else " ".join("w" for _ in range(r.randrange(0, 40))), source, -1))
    return out


def by_hand(sizes):
    """Targets by repeated sharing, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, full = 1.5 * sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in full]
        level = (left - sum(2 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


@pytest.fixture(scope="module")
def mixed(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    return mixing.mix(docs, block_words=60, shard_words=500).cache()


def test_targets_and_words_taken(mixed):
    got = mixing.taken(mixed).join(mixed.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = by_hand(sizes)
    assert len(got) == 400 and {r.doc_id for r in got} == set(range(400))
    words = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        words[r.source] = words.get(r.source, 0) + r.taken
    for s, n in words.items():
        assert want[s] - 40 <= n <= want[s] + 1e-6


def test_shards_hold_disjoint_blocks_of_exact_quotas(mixed):
    uses = mixed.select("doc_id", "source", F.explode("uses").alias("u")).select("doc_id", "source", "u.*").collect()
    assert len({(r.doc_id, r["pass"]) for r in uses}) == len(uses)
    assert len({r.shard for r in uses}) >= 8
    assert len({r.order_key for r in uses}) == len(uses)


def test_reruns_agree_and_extra_columns_do_not_matter(spark, mixed):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(7).withColumn("target", F.lit("x")).withColumn("block", F.lit(1))
    again = mixing.mix(docs, block_words=60, shard_words=500)
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.collect()))


def test_small_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.taken(mixing.mix(empty)).count() == 0
    odd = spark.createDataFrame([(None, None, None, 0), (1, "", "a", 0), (1, "", "a", 0)], SCHEMA)
    assert [(r.target, r.taken) for r in mixing.taken(mixing.mix(odd)).collect()] == [(0.0, 0)] * 3
    twice = spark.createDataFrame([(1, "a b c", None, 0)] * 2, SCHEMA)
    assert sorted(r.taken for r in mixing.taken(mixing.mix(twice)).collect()) == [3, 6]


def greedy(docs, rest, seed, block_words):
    """Documents of a source in the mix's order, each taken if it fits: how often each size is taken in the last pass."""
    import hashlib

    total = sum(n for _, n in docs)
    n_blocks = max(1, -(-total // block_words))
    key = lambda i: int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:13], 16)
    taken = set()
    for i, n in sorted(docs, key=lambda d: (n_blocks * (d[1] <= min(block_words, rest / 8)) + key(d[0]) * n_blocks // (1 << 52), key(d[0]))):
        if 0 < n <= rest:
            rest -= n
            taken.add(i)
    return taken, rest


def test_every_draw_comes_near_its_target(spark):
    # twenty draws each of a source of which one text is more than half, one of texts that hardly fit, and two of small texts
    kinds = {"a": [1] * 200, "b": [1500] + [4] * 250, "c": [700, 800, 900, 650], "d": [30, 1, 2, 500]}
    sizes = {f"{k}{n}": kinds[k] for k in kinds for n in range(20)}
    rows_ = [(i, s, n) for i, (s, n) in enumerate((s, n) for s in sizes for n in sizes[s])]
    docs = spark.createDataFrame(rows_, "doc_id long, source string, n int").selectExpr("doc_id", "source", "repeat('w ', n) AS text")
    found = mixing.taken(mixing.mix(docs, block_words=256, shard_words=1 << 16))
    by_source = {}
    for r in found.join(docs.select("doc_id", "source"), "doc_id").collect():
        by_source.setdefault(r.source, []).append(r)
    assert by_source.keys() == sizes.keys()
    for s, mine in by_source.items():
        total, target = mine[0].source_size, mine[0].target
        passes, taken = int(target // total), sum(r.taken for r in mine)
        untaken = [r.size for r in mine if r.taken == passes * r.size]
        assert taken <= target and target - taken < min(untaken, default=1), (s, target, taken)
        want, left = greedy([(r.doc_id, r.size) for r in mine], target - passes * total, 17, 256)
        assert {r.doc_id for r in mine if r.taken > passes * r.size} == want and taken == pytest.approx(target - left)
        if s[0] == "b" and target - passes * total > 1500:
            assert target - taken < 4


def test_very_long_texts_and_many_blocks(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "repeat('w ', if(id = 7, 30000, int(id % 50))) AS text")
    mixed = mixing.mix(docs, block_words=64, shard_words=1 << 14)
    got = mixing.taken(mixed).agg(F.sum("taken"), F.max("target"), F.count("*")).first()
    assert got[2] == 3000 and 0 <= got[1] - got[0] < 50


def test_hypergeometric_draws_have_the_right_distribution(spark):
    u = (F.col("id") + 0.5) / 4000
    got = spark.range(4000).select(mixing._hypergeometric(F.lit(30), F.lit(12), F.lit(10), u).alias("k")).groupBy("k").count()
    from math import comb

    for k, n in got.collect():
        assert n / 4000 == pytest.approx(comb(12, k) * comb(18, 10 - k) / comb(30, 10), abs=2e-3)
