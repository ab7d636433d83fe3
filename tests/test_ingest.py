import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventbase.operators.keyed_table import ORDER, KeyedTable, latest_by_key
from eventbase.operators.registry import EventConfig, struct_from_pairs
from eventbase.operators.store import EventStore
from eventbase.sources.envelope import ENVELOPE, stream_envelope_folder
from eventbase.streaming import ingest
from eventbase.streaming.ingest import BadRecords, IngestOptions, ingest_batch, print_stream, run_ingest

def fields(**types):
    return struct_from_pairs(types.items())


ORDERS = EventConfig(
    "shop", "order", fields(id="long", amount="double", at="timestamp"), ["id"],
    column_map={"amount": "total"}, epoch_unit="s",
)
VISITS = EventConfig("shop", "visit", fields(id="long", page="string"), ["id"])


def message(key, body, partition, offset):
    return (key, body if isinstance(body, str) else json.dumps(body), "events", partition, offset, None)


def messages(spark, rows):
    return spark.createDataFrame([message(*r) for r in rows], ENVELOPE)


@pytest.fixture
def store(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"), buckets=4)
    store.register([ORDERS, VISITS])
    return store


def content(store, config):
    return sorted(tuple(r) for r in store.table(config).read().collect())


ROWS = [
    ("shop|order", {"id": 1, "amount": 5}, 0, 1),
    ("shop|order", {"id": 1, "amount": 7, "at": 60}, 0, 2),
    ("shop|order", {"id": 2, "amount": 1.5}, 1, 1),
    ("shop|order", {"id": 3, "amount": "x"}, 1, 2),
    ("shop|order", {"amount": 4}, 1, 3),
    ("shop|order", "{bad", 1, 4),
    ("shop|visit", {"id": 1, "page": "p"}, 0, 3),
    ("shop|other", {"id": 1}, 0, 4),
    (None, {"id": 1}, 0, 5),
]


def test_batch_goes_to_tables_and_quarantine(spark, store):
    ingest_batch(messages(spark, ROWS), "b1", store)
    orders = store.table(ORDERS).read()
    assert orders.columns == ["id", "total", "at"]
    assert sorted(tuple(r) for r in orders.select("id", "total", F.unix_timestamp("at")).collect()) == [
        (1, 7.0, 60), (2, 1.5, None),
    ]
    assert content(store, VISITS) == [(1, "p")]
    bad = store.quarantine()
    assert sorted((r["reason"], r["offset"], r["bad_fields"]) for r in bad.collect()) == [
        ("bad_value", 2, ["amount"]), ("malformed", 4, []), ("null_key", 3, []),
        ("unregistered", 4, []), ("unregistered", 5, []),
    ]
    assert bad.filter("reason = 'malformed'").first()["value"] == "{bad"
    covered = store.progress().select("partition", "key", "min_offset", "max_offset", "messages").collect()
    assert sorted(map(str, map(tuple, covered))) == sorted(
        map(str, [(0, "shop|order", 1, 2, 2), (0, "shop|visit", 3, 3, 1), (0, None, 4, 5, 2), (1, "shop|order", 1, 4, 4)])
    )


def test_repeating_a_batch_changes_nothing(spark, store):
    for _ in range(2):
        ingest_batch(messages(spark, ROWS), "b1", store)
    assert len(content(store, ORDERS)) == 2
    assert store.quarantine().count() == 5
    assert store.progress().count() == 4


def test_a_repeated_batch_takes_back_what_is_no_longer_good(spark, store):
    batch = messages(spark, [("shop|visit", {"id": 1, "page": "p"}, 0, 1)])
    ingest_batch(batch, "b1", store)
    assert content(store, VISITS) == [(1, "p")]
    blank = messages(spark, [("shop|visit", "", 0, 1)])
    ingest_batch(blank, "b1", store)
    assert content(store, VISITS) == [] and store.quarantine().count() == 1


def test_a_repeated_batch_forgets_what_is_no_longer_bad(spark, store):
    batch = messages(spark, [("shop|late", {"id": 1, "page": "p"}, 0, 1)])
    ingest_batch(batch, "b1", store)
    assert store.quarantine().count() == 1
    late = EventConfig("shop", "late", fields(id="long", page="string"), ["id"])
    store.register([late])
    ingest_batch(batch, "b1", store)
    assert store.quarantine().count() == 0 and content(store, late) == [(1, "p")]


@pytest.mark.parametrize("cuts", [1, 3, 9])
@pytest.mark.parametrize("compact_every", [2, 50])
def test_result_does_not_depend_on_batch_boundaries(spark, store, cuts, compact_every):
    options = IngestOptions(compact_every=compact_every)
    for n in range(cuts):
        ingest_batch(messages(spark, ROWS[n::cuts]), f"b{n}", store, options)
    assert [r[:2] for r in content(store, ORDERS)] == [(1, 7.0), (2, 1.5)]
    assert content(store, VISITS) == [(1, "p")]
    assert store.quarantine().count() == 5


@pytest.mark.parametrize("land_above", [1, 32])
@pytest.mark.parametrize("cache", [True, False])
def test_ways_of_staging_agree(spark, store, land_above, cache):
    ingest_batch(messages(spark, ROWS), "b1", store, IngestOptions(land_above=land_above, cache=cache))
    assert store.quarantine().count() == 5
    assert store.files.names(f"{store.root}/landing") == []
    assert [r[:2] for r in content(store, ORDERS)] == [(1, 7.0), (2, 1.5)]
    assert content(store, VISITS) == [(1, "p")]


def test_fail_mode_commits_nothing(spark, store):
    with pytest.raises(BadRecords):
        ingest_batch(messages(spark, ROWS), "b1", store, IngestOptions(on_bad="fail"))
    assert content(store, ORDERS) == []


def test_schema_change_between_batches(spark, store):
    ingest_batch(messages(spark, ROWS), "b1", store)
    wider = EventConfig("shop", "visit", fields(id="long", page="string", ms="integer"), ["id"])
    store.register([wider])
    ingest_batch(messages(spark, [("shop|visit", {"id": 2, "page": "q", "ms": 9}, 0, 9)]), "b2", store)
    assert content(store, wider) == [(1, "p", None), (2, "q", 9)]
    store.register([EventConfig("shop", "visit", fields(id="long", page="integer"), ["id"])])
    ingest_batch(messages(spark, [("shop|visit", {"id": 3, "page": 1}, 0, 10)]), "b3", store)
    assert store.quarantine().filter("reason = 'schema_conflict'").count() == 1
    assert content(store, wider) == [(1, "p", None), (2, "q", 9)]


def test_types_may_widen_and_not_narrow(spark, tmp_path):
    def config(**types):
        return EventConfig("a", "t", fields(id="integer", **types), ["id"])

    store = EventStore(spark, str(tmp_path / "s4"), buckets=2)
    old, new = config(n="byte", m="integer", x="float", d="decimal(5,2)"), config(n="long", m="double", x="double", d="decimal(12,4)")
    store.register([old])
    ingest_batch(messages(spark, [("a|t", {"id": i, "n": -i, "m": i, "x": 0.5, "d": 1.25}, 0, i) for i in range(1, 4)]), "b0", store)
    store.table(old).compact(fold_share=0.0)
    store.register([new])
    rows = [("a|t", {"id": 2, "n": 1 << 40, "m": 0.1, "x": 1e300, "d": 12345678.1234}, 0, 9), ("a|t", {"id": 4}, 0, 10)]
    ingest_batch(messages(spark, rows), "b1", store)
    want = [(1, -1, 1.0, 0.5, 1.25), (2, 1 << 40, 0.1, 1e300, 12345678.1234), (3, -3, 3.0, 0.5, 1.25), (4, None, None, None, None)]

    def found(rows):
        return sorted((*r[:4], r.d if r.d is None else float(r.d)) for r in rows.select("id", "n", "m", "x", "d").collect())

    table = store.table(new)
    assert found(table.read()) == found(table.read(broadcast_limit=0)) == want
    assert found(table.read().filter("n > 1000")) == want[1:2]  # pushed to files of either type
    table.compact(fold_share=0.0)
    assert found(table.read()) == want
    wider_key = EventConfig("a", "t", fields(id="long", n="long", m="double", x="double", d="decimal(12,4)"), ["id"])
    for n, refused in enumerate((old, wider_key, config(n="long", m="double", x="double", d="decimal(12,2)"))):
        store.register([refused])
        ingest_batch(messages(spark, [("a|t", {"id": 5, "n": 5}, 0, 20 + n)]), f"c{n}", store)
    assert store.quarantine().filter("reason = 'schema_conflict'").count() == 3
    assert found(table.read()) == want


def test_declared_order_overrides_arrival(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "s2"), buckets=2)
    config = EventConfig("a", "t", fields(id="integer", v="integer"), ["id"], order_by=["v"])
    store.register([config])
    ingest_batch(messages(spark, [("a|t", {"id": 1, "v": 9}, 0, 1), ("a|t", {"id": 1, "v": 3}, 0, 2)]), "b", store)
    assert content(store, config) == [(1, 9)]


def test_stream_restart_loses_and_repeats_nothing(spark, store, tmp_path):
    source = str(tmp_path / "in")
    checkpoint = str(tmp_path / "cp")

    def run():
        run_ingest(
            stream_envelope_folder(spark, source, max_files_per_trigger=1), store,
            checkpoint=checkpoint, available_now=True,
        ).awaitTermination()

    messages(spark, ROWS[:4]).repartition(2).write.parquet(source)
    run()
    messages(spark, ROWS[4:]).repartition(2).write.mode("append").parquet(source)
    run()
    run()
    assert [r[:2] for r in content(store, ORDERS)] == [(1, 7.0), (2, 1.5)]
    assert store.quarantine().count() == 5
    assert store.progress().agg(F.sum("messages")).first()[0] == len(ROWS)


def test_key_and_order_of_a_table_cannot_change(spark, store):
    ingest_batch(messages(spark, ROWS), "b1", store)
    for changed in (dict(primary_key=["page"]), dict(primary_key=["id"], order_by=["page"])):
        store.register([EventConfig("shop", "visit", fields(id="long", page="string"), **changed)])
        ingest_batch(messages(spark, [("shop|visit", {"id": 9, "page": "z"}, 0, 99)]), f"c{len(changed)}", store)
    assert store.quarantine().filter("reason = 'schema_conflict'").count() == 2
    assert content(store, VISITS) == [(1, "p")]


def test_another_sink_can_take_the_tables(spark, store):
    seen = {}
    sink = lambda config, rows, batch: seen.update({config.table_name: (batch, rows.count(), rows.columns)})
    ingest_batch(messages(spark, ROWS), "b1", store, IngestOptions(sink=sink, parse_partitions=3))
    assert seen == {
        "shop_order": ("b1", 3, ["id", "total", "at", "__order"]), "shop_visit": ("b1", 1, ["id", "page", "__order"]),
    }
    assert store.quarantine().count() == 5


def test_a_failed_table_fails_the_batch(spark, store):
    def sink(config, rows, batch):
        raise OSError("database gone")

    with pytest.raises(OSError, match="database gone"):
        ingest_batch(messages(spark, ROWS), "b1", store, IngestOptions(sink=sink))


def test_a_crash_between_two_tables_is_made_good_by_the_restart(spark, store, tmp_path, monkeypatch):
    """The stream dies after one table is written; its restart repeats the batch."""
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    messages(spark, ROWS).coalesce(1).write.parquet(source)
    whole_upsert = KeyedTable.upsert

    def dies_on_visits(table, rows, batch):
        if table.path.endswith("shop_visit"):
            raise OSError("executor lost")
        return whole_upsert(table, rows, batch)

    def run():
        stream = stream_envelope_folder(spark, source)
        run_ingest(stream, store, checkpoint=checkpoint, available_now=True).awaitTermination()

    monkeypatch.setattr(KeyedTable, "upsert", dies_on_visits)
    with pytest.raises(StreamingQueryException):
        run()
    assert content(store, VISITS) == [] and len(content(store, ORDERS)) == 2
    monkeypatch.setattr(KeyedTable, "upsert", whole_upsert)
    run()
    assert [r[:2] for r in content(store, ORDERS)] == [(1, 7.0), (2, 1.5)]
    assert content(store, VISITS) == [(1, "p")]
    assert store.quarantine().count() == 5
    assert len(store.table(ORDERS).state().deltas) == 1


def test_a_hot_key_is_reduced_before_the_shuffle(spark, store):
    """A key with most of the rows crosses the shuffle once per task."""
    rows = spark.range(2000).select(
        F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("id"), F.struct(F.col("id").alias("n")).alias(ORDER)
    )
    latest = latest_by_key(rows.repartition(4), ["id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    partial_limit, shuffle = plan.index("Partial"), plan.index("Exchange hashpartitioning(id")
    assert shuffle < partial_limit  # printed from the top: the limit feeds the shuffle
    assert latest.count() == 501
    assert latest.filter("id = 7").select(f"{ORDER}.n").first()[0] == 1499


def test_messages_can_be_shown_on_the_console(spark, tmp_path):
    messages(spark, ROWS).write.parquet(str(tmp_path / "in"))
    shown = print_stream(stream_envelope_folder(spark, str(tmp_path / "in")))
    try:
        shown.processAllAvailable()
        assert sum(p["numInputRows"] for p in shown.recentProgress) == len(ROWS)
    finally:
        shown.stop()


def test_many_like_tables_in_one_job(spark, store):
    configs = [EventConfig("many", f"t{n}", fields(id="long", v="double"), ["id"]) for n in range(12)]
    store.register(configs)
    batch = [(f"many|t{n}", {"id": i, "v": n + i / 10}, 0, 100 * n + i) for n in range(11) for i in (1, 2, 1)]
    for _ in range(2):  # a repeated batch replaces itself
        ingest_batch(messages(spark, batch), "b1", store)
    for n in range(11):
        assert sorted(r[:2] for r in content(store, configs[n])) == [(1, n + 0.1), (2, n + 0.2)]
    ingest_batch(messages(spark, [("many|t0", {"id": 1, "v": 9.0}, 0, 5000), ("many|t3", {"id": 3, "v": 9.0}, 0, 5001)]), "b2", store)
    ingest_batch(messages(spark, batch[:3]), "b1", store)  # now without the other tables' records
    assert sorted(r[:2] for r in content(store, configs[0])) == [(1, 9.0), (2, 0.2)]
    for config in configs[:11]:
        store.table(config).compact(fold_share=0.0)
        store.table(config).expire(keep_hours=0.0)
    assert sorted(r[:2] for r in content(store, configs[0])) == [(1, 9.0), (2, 0.2)]
    assert (3, 9.0) in [r[:2] for r in content(store, configs[3])]
    left = [n for d in store.files.names(f"{store.root}/deltas") for n in store.files.names(f"{store.root}/deltas/{d}") if n.startswith("__slot")]
    assert left == []


def test_progress_and_landing_of_a_failed_batch(spark, store):
    with pytest.raises(BadRecords):
        ingest_batch(messages(spark, ROWS), "b1", store, IngestOptions(on_bad="fail"))
    assert store.progress().count() == 0 and store.files.names(f"{store.root}/landing") == []


def test_root_lists_keep_their_order(spark, store):
    body = [{"id": 1, "amount": float(n)} for n in range(20)]
    batch = messages(spark, [("shop|order", body, 0, 0), ("shop|order", [], 0, 1)])
    ingest_batch(batch, "b1", store, IngestOptions(explode_root_array=True))
    assert [r[:2] for r in content(store, ORDERS)] == [(1, 19.0)]
    assert [r["reason"] for r in store.quarantine().collect()] == ["empty_list"]


def test_only_rejected_records_land_with_their_message(spark, store, monkeypatch):
    """Good records are read back by their row and place alone: the text they came from is not written again."""
    landed = {}
    laid_out = ingest._laid_out

    def kept(*args):
        parts = laid_out(*args)
        for part in parts:
            for r in part.collect() if part is not None else []:
                landed[r.partition, r.offset] = r
        return parts

    monkeypatch.setattr(ingest, "_laid_out", kept)
    ingest_batch(messages(spark, ROWS), "b1", store)
    assert {at for at, r in landed.items() if r.value is None} == {(0, 1), (0, 2), (1, 1), (0, 3)}
    assert {at for at, r in landed.items() if r.value is not None} == {(1, 2), (1, 3), (1, 4)}
    assert all((r.key is None) == (r.reason is None) and (r.row is None) == (r.key is not None) for r in landed.values())
    assert {(r.partition, r.offset): (r.key, r.value) for r in store.quarantine().collect()} == {
        (p, n): message(k, v, p, n)[:2] for k, v, p, n in ROWS if (p, n) in {(1, 2), (1, 3), (1, 4), (0, 4), (0, 5)}
    }


def test_like_tables_are_sorted_by_key_before_slot(spark, tmp_path, monkeypatch):
    """The few slots in front would leave every comparison of a sort to whole rows; the same key may be in two tables."""
    windows = []
    latest = ingest.latest_by_key

    def seen(rows, *keys):
        windows.append(keys)
        return latest(rows, *keys)

    monkeypatch.setattr(ingest, "latest_by_key", seen)
    configs = [EventConfig("app", name, fields(id="long", n="long"), ["id"]) for name in ("a", "b")]
    store = EventStore(spark, str(tmp_path / "like"), buckets=4)
    store.register(configs)
    rows = [(f"app|{name}", {"id": i % 3, "n": 10 * i + t}, t, i) for t, name in enumerate("ab") for i in range(9)]
    ingest_batch(messages(spark, rows), "b1", store)
    assert windows == [(["id", "__slot"],)]
    assert [content(store, c) for c in configs] == [[(0, 60 + t), (1, 70 + t), (2, 80 + t)] for t in (0, 1)]
