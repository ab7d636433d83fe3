"""Operators over time and order against plain Python, on hot keys, ties, nulls and many small parts."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from eventbase.operators.coverage import offset_gaps
from eventbase.operators.intervals import interval_join
from eventbase.operators.ordered import enrich_asof, ranked
from eventbase.operators.quantiles import exact_quantiles, heavy_hitters, merged, sketched
from eventbase.streaming.joins import join_streams, without_repeats

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


@pytest.fixture
def many_parts(spark):
    """Many small ranges, so that one key lies in several."""
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def seconds(r):
    return r.choice([None, *range(40)] * 3 + [r.randrange(40)])


def test_asof(spark, many_parts):
    r = random.Random(1)
    events = [(i, r.choice([None, "a", "a", "a", "b", "c"]), seconds(r), i % 3) for i in range(600)]
    versions = [(r.choice([None, "a", "a", "b", "z"]), seconds(r), r.choice([None, "x", "y"]), r.randrange(5)) for _ in range(300)]
    left = spark.createDataFrame([(i, k, at(t), v) for i, k, t, v in events], "id int, key string, at timestamp, name int")
    right = spark.createDataFrame([(k, at(t), n, v) for k, t, n, v in versions], "key string, since timestamp, label string, n int")
    got = {x.id: (x.name, x.label, x.n) for x in enrich_asof(left, right, {"key": "key"}, "at", "since", ["label", "n"]).collect()}
    want = {}
    for i, k, t, v in events:
        known = [(s, n is not None, n or "", m) for q, s, n, m in versions if q == k and k is not None and s is not None and t is not None and s <= t]
        best = max(known, default=None)
        want[i] = (v, best[2] if best and best[1] else None, best[3] if best else None)
    assert got == want
    none = enrich_asof(left, right.limit(0), {"key": "key"}, "at", "since", ["n"])
    assert none.count() == 600 and none.filter("n is not null").count() == 0
    assert enrich_asof(left.limit(0), right, {"key": "key"}, "at", "since", ["n"]).count() == 0


def test_ranked_equals_windows(spark, many_parts):
    r = random.Random(2)
    rows = [(i, r.choice([None, 1, 1, 1, 1, 2]), r.choice([None, *range(15)]), r.choice([None, *range(9)])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k int, o int, v long")
    got = ranked(df, ["k"], ["o", "id"], number="nth", sums={"total": "v"}, lags={"was": "v"})
    assert got.columns == ["id", "k", "o", "v", "nth", "total", "was"]
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql(
        "SELECT *, row_number() OVER w AS nth, sum(v) OVER w AS total, lag(v) OVER (PARTITION BY k ORDER BY o, id) AS was "
        "FROM ranked_rows WINDOW w AS (PARTITION BY k ORDER BY o, id ROWS UNBOUNDED PRECEDING)"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert ranked(df.limit(0), ["k"], ["o"], number="n").count() == 0


def test_a_hot_key_is_many_parts(spark, many_parts):
    df = spark.range(20000).selectExpr("if(id % 10 < 9, 0, id) AS k", "id AS o")
    rows = ranked(df, ["k"], ["o"], number="n")
    assert rows.filter("k = 0").agg(F.max("n")).first()[0] == 18000
    from eventbase.operators.ordered import _in_parts

    sizes = [x["count"] for x in _in_parts(df, ["k", "o"]).groupBy("__part").count().collect()]
    assert max(sizes) < 6000


def full(rows):
    return [x for x in rows if x[2] is not None and x[3] is not None and x[2] < x[3]]


@pytest.mark.parametrize("rungs", [(0.5, 0.9, 0.99), (), (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)])
def test_intervals(spark, rungs):
    r = random.Random(3)

    def side(n):
        rows = []
        for i in range(n):
            s = r.choice([None, *range(-50, 50)])
            length = r.choice([None, -3, 0, 1, 1, 2, 5, 40, 3000])
            rows.append((i, r.choice([None, "a", "a", "b"]), s, None if s is None or length is None else s + length))
        return rows

    a, b = side(120), side(130)
    left, right = (spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in x], "id int, k string, s timestamp, e timestamp") for x in (a, b))
    pairs = interval_join(left, right, {"k": "k"}, ("s", "e"), ("s", "e"), rungs)
    got = sorted((x.left.id, x.right.id) for x in pairs.collect())
    assert got == sorted((i, j) for i, k, s, e in full(a) for j, q, t, f in full(b) if k and k == q and s < f and t < e)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(left, right, {}, ("s", "e"), ("s", "e"), rungs).count() == sum(s < f and t < e for _, _, s, e in full(a) for _, _, t, f in full(b))
    assert interval_join(left.limit(0), right, {"k": "k"}, ("s", "e"), ("s", "e"), rungs).count() == 0


@pytest.mark.parametrize("bins", [2, 1024])
def test_quantiles(spark, bins):
    r = random.Random(4)
    odd = [None, float("nan"), float("inf"), -1e308, 1e308, 5e-324]
    rows = [(r.choice([None, "a", "a", "b"]), r.choice([*odd, r.random(), 3.0, 3.0, -7.25])) for _ in range(400)] + [("none", None)]
    got = exact_quantiles(spark.createDataFrame(rows, "k string, v double").repartition(3), ["k"], "v", [0.0, 0.5, 0.9, 1.0], bins).collect()
    want = {}
    for k, v in rows:
        want.setdefault(k, [])
        if v is not None and math.isfinite(v):
            want[k].append(v)
    assert {x.k: (x.n, x.quantiles) for x in got} == {
        k: (len(v), [sorted(v)[max(1, math.ceil(p * len(v))) - 1] for p in (0.0, 0.5, 0.9, 1.0)] if v else None) for k, v in want.items()
    }
    assert exact_quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", [0.5]).count() == 0


def test_heavy_hitters(spark):
    r = random.Random(5)
    rows = [(r.choice([None, "a", "b"]), r.choice([None, 1, 1, 1, *range(40)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int")
    for k, bins in ((15, 1), (20, 64), (60, 1)):
        got = {(x.g, x.x): x.n for x in heavy_hitters(df, "g", "x", k, bins).collect()}
        sizes = {g: sum(h == g for h, _ in rows) for g in (None, "a", "b")}
        want = {p: rows.count(p) for p in set(rows) if rows.count(p) * k > sizes[p[0]]}
        assert got == want and want
    assert heavy_hitters(df.limit(0), "g", "x", 5).count() == 0


def test_merged_sketches(spark):
    df = spark.range(50000).selectExpr("id % 40 AS part", "if(id % 7 = 0, null, double(id * 7919 % 50000)) AS v")
    stored = sketched(df, ["part"], "v")
    (row,) = merged(stored, [], [0.1, 0.5, 0.99]).collect()
    values = sorted(i * 7919 % 50000 for i in range(50000) if i % 7)
    assert row.n == len(values)
    for p, q in zip((0.1, 0.5, 0.99), row.quantiles):
        assert abs(sum(v <= q for v in values) / len(values) - p) < 0.02


def test_offset_gaps(spark):
    rows = [("t", 0, 0, 9), ("t", 0, 10, 19), ("t", 0, 25, 40), ("t", 0, 30, 35), ("t", 0, 38, 50), ("t", 0, 51, 51), ("t", 1, 5, 6), ("t", 1, None, 9), ("t", 1, 9, 8)]
    got = offset_gaps(spark.createDataFrame(rows, "topic string, partition int, min_offset long, max_offset long")).collect()
    assert sorted(tuple(x)[1:] for x in got) == [(0, "missing", 20, 24), (0, "repeated", 30, 35), (0, "repeated", 38, 40)]


def run(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_streams_joined_over_a_restart(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "checkpoint"))
    schema = "id int, user int, at timestamp, kind string"
    batches = [
        [(1, 7, at(0), "l"), (2, 7, at(10), "l"), (3, 8, at(20), "l"), (4, None, at(20), "l"), (5, 9, None, "l"), (10, 7, at(30), "r"), (11, 7, at(61), "r")],
        [(12, 7, at(65), "r"), (13, 8, at(500), "r"), (6, 8, at(500), "l"), (7, 9, at(1000), "l"), (14, 6, at(1000), "r")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        left = stream.filter("kind = 'l'").selectExpr("id", "user", "at")
        right = stream.filter("kind = 'r'").selectExpr("id AS rid", "user AS ruser", "at AS rat")
        run(join_streams(left, right, {"user": "ruser"}, "at", "rat", "60 SECONDS", watermark="30 seconds").select("id", "rid"), out, checkpoint)
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    # the first left row is at 0: what comes 61 seconds later is too late; 7 is not yet final
    assert [x for x in got if x[0] != 5] == [(1, 10), (2, 10), (2, 11), (2, 12), (3, None), (4, None), (6, 13)]
    with pytest.raises(ValueError, match="id"):
        join_streams(left, left, {}, "at", "at", "1 SECOND", watermark="1 second")


def test_repeats_over_a_restart(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "checkpoint"))
    schema = "p int, o long, at timestamp"
    first = [(0, 1, at(0)), (0, 2, at(5)), (1, 1, at(3)), (None, 1, at(4)), (0, 1, at(0))]
    for rows in (first, [*first, (0, 3, at(50)), (0, 3, at(51))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run(without_repeats(spark.readStream.schema(schema).parquet(src), ["p", "o"], "at", "1 day"), out, checkpoint)
    assert sorted((str(x.p), x.o) for x in spark.read.parquet(out).collect()) == [("0", 1), ("0", 2), ("0", 3), ("1", 1), ("None", 1)]
