"""Shards against their law: near-equal bytes, gapless slots, groups together, reruns alike."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventbase.llm import sharding
from eventbase.llm.queries import op5_sampled_splitters

SCHEMA = "doc_id long, text string, shard string, size int"


def rows(n, seed=1):
    r = random.Random(seed)
    hot = "the same text " * 20
    return [(i, hot if i % 3 == 0 else r.choice(["é", "ab"]) * r.randrange(200) if i % 10 else f"group {i // 50}" * 9, None, 0) for i in range(n)]


def check(got, given, n_shards, slack):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in given
    )
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(n_shards))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    total = sum(r.size for r in got)
    for s in range(n_shards):
        assert abs(sum(r.size for r in by[s]) - total / n_shards) <= slack * total / n_shards + max((r.size for r in got), default=0)


@pytest.mark.parametrize("range_rows", [50, 20000])
def test_law_and_groups(spark, range_rows):
    given = rows(4000)
    df = spark.createDataFrame(given, SCHEMA)
    got = sharding.shards(df, range_rows=range_rows).collect()
    check(got, given, 16, 0.02)
    text = {d: t for d, t, *_ in given}
    where = defaultdict(set)
    size = defaultdict(int)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
        size[text[r.doc_id]] += r.size
    share = sum(size.values()) / 16
    assert all(len(w) == 1 for t, w in where.items() if size[t] <= 0.01 * share)
    again = sharding.shards(df.repartition(5).withColumn("key", F.lit(1)), range_rows=range_rows).collect()
    assert sorted(again) == sorted(got)


def test_small_and_odd(spark):
    for given in ([], [(None, None, None, 0)], [(1, "a", None, 0)] * 5, rows(100), [(i, "x", None, 0) for i in range(1000)], [(i, None, None, 0) for i in range(300)]):
        check(sharding.shards(spark.createDataFrame(given, SCHEMA)).collect(), given, 16, 0.02)


def test_query(spark):
    at = "/root/testdata/sf0.001"
    got = op5_sampled_splitters(spark, at)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    check(got.collect(), given, 16, 0.02)
