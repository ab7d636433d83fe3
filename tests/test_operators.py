import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions import app_key_of, application_key, event_type_of, message_key
from eventbase.functions.keys import data_key
from eventbase.operators import analysis, gateway, jdbc, registry
from eventbase.operators.keyed_table import ORDER, KeyedTable, check_columns
from eventbase.operators.publish import to_messages
from eventbase.operators.registry import EventConfig, storable, struct_from_pairs
from eventbase.operators.store import EventStore
from eventbase.session import shared_folder
from eventbase.sources import kafka, tables
from eventbase.sources.envelope import envelope
from eventbase.streaming.ingest import IngestOptions, ingest_batch
from eventbase.streaming.job import job_options
from eventbase.streaming.windows import read_appended, windowed, write_results


def fields(**types):
    return struct_from_pairs(types.items())


# -- keys --------------------------------------------------------------------------------


def test_message_keys(spark):
    df = spark.createDataFrame([("a", "t"), ("a", "t|u"), (None, "t"), ("a", None)], "a string, t string")
    keys = df.select(message_key(F.col("a"), F.col("t")).alias("k"))
    back = keys.select("k", app_key_of(F.col("k")), event_type_of(F.col("k"))).collect()
    assert [tuple(r) for r in back] == [("a|t", "a", "t"), ("a|t|u", "a", "t|u"), (None,) * 3, (None,) * 3]
    odd = spark.createDataFrame([("noseparator",)], "k string").select(data_key(F.col("k")).alias("d")).first()
    assert tuple(odd["d"]) == (None, None)


def test_application_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c")], "x string, y string")
    assert df.select(application_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 2


# -- registry ----------------------------------------------------------------------------


def test_schema_from_pairs_takes_nested_types():
    schema = struct_from_pairs([("a", "integer"), ("b", {"type": "array", "elementType": "long", "containsNull": True})])
    assert schema == T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.LongType()))])


class Point(T.UserDefinedType):
    @classmethod
    def sqlType(cls):
        return T.ArrayType(T.DoubleType())

    @classmethod
    def module(cls):
        return "tests"


def test_user_defined_types_become_their_sql_type():
    assert storable(T.StructType([T.StructField("p", Point())]))["p"].dataType == T.ArrayType(T.DoubleType())


@pytest.mark.parametrize(
    "dtype",
    [T.TimestampNTZType(), T.VariantType(), T.CharType(3), T.VarcharType(3), T.DayTimeIntervalType(), T.MapType(T.IntegerType(), T.StringType())],
    ids=str,
)
def test_types_without_a_rule_are_refused(dtype):
    with pytest.raises(ValueError):
        storable(T.StructType([T.StructField("f", dtype)]))


def test_config_checks():
    ok = fields(id="long", name="string")
    for wrong in (
        dict(app_key="a|b"), dict(primary_key=[]), dict(primary_key=["nope"]), dict(epoch_unit="d"),
        dict(column_map={"nope": "x"}), dict(column_map={"id": "NAME"}), dict(order_by=["nope"]),
    ):
        with pytest.raises(ValueError):
            EventConfig(**({"app_key": "a", "event_type": "t", "schema": ok, "primary_key": ["id"]} | wrong))
    with pytest.raises(ValueError):
        EventConfig("a", "t", fields(id="long", ID="long"), ["id"])


def test_column_types_may_only_widen(spark):
    schema = fields(id="integer", at="timestamp")
    config = EventConfig("a", "t", schema, ["id"], column_types={"id": "bigint", "at": "date"})
    assert config.table_schema.simpleString() == "struct<id:bigint,at:date>"
    with pytest.raises(ValueError):
        EventConfig("a", "t", schema, ["id"], column_types={"id": "smallint"}).columns


def test_registry_round_trip_and_uniqueness(spark, tmp_path):
    config = EventConfig("a", "t", fields(id="long"), ["id"], column_map={"id": "key"} and {}, epoch_unit="us")
    frame = registry.registry_frame(spark, [config])
    registry.save_registry(frame, str(tmp_path / "r"))
    registry.save_registry(frame, str(tmp_path / "r"))
    assert registry.configs_of(registry.load_registry(spark, str(tmp_path / "r"))) == [config]
    twice = frame.union(frame)
    assert [tuple(r) for r in registry.duplicate_keys(twice).collect()] == [("a", "t", 2)]
    with pytest.raises(ValueError, match="registered twice"):
        registry.save_registry(twice, str(tmp_path / "r"))


def test_routing_uses_no_forced_broadcast(spark, tmp_path):
    config = EventConfig("a", "t", fields(id="long"), ["id"])
    registry.save_registry(registry.registry_frame(spark, [config]), str(tmp_path / "r"))
    stored = registry.load_registry(spark, str(tmp_path / "r"))
    df = spark.createDataFrame([("a|t",), ("a|u",), (None,)], "key string")
    assert {tuple(r) for r in registry.route(df, stored).collect()} == {("a|t", "a_t"), ("a|u", None), (None, None)}
    assert registry.registered(df, stored).count() == 1
    assert registry.unregistered(df, stored).count() == 2


# -- keyed tables ------------------------------------------------------------------------

ORDER_SCHEMA = T.StructType([T.StructField("n", T.LongType())])


def rows(spark, data):
    df = spark.createDataFrame(data, "id int, v string, n long")
    return df.select("id", "v", F.struct("n").alias(ORDER))


@pytest.fixture
def table(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    return KeyedTable(spark, str(tmp_path / "t")).create(schema, ["id"], ORDER_SCHEMA, buckets=4)


@pytest.mark.parametrize("limit", [0, 64 << 20], ids=["one_shuffle", "small_deltas"])
@pytest.mark.parametrize("compact_after", [set(), {0}, {1}, {0, 1, 2}])
def test_last_write_wins(spark, table, limit, compact_after):
    want = {}
    batches = [
        [(n, f"a{n}", n) for n in range(20)] + [(3, "b", 50), (3, "c", 40), (None, "x", 1)],
        [(5, "late", 1), (6, "new", 70), (21, "z", 71), (None, "y", 72)],
        [(3, "old", 45), (21, "zz", 73)],
    ]
    for n, batch in enumerate(batches):
        for key, v, order in batch:
            if key not in want or order > want[key][1]:
                want[key] = (v, order)
        for _ in range(2):
            table.upsert(rows(spark, batch), f"b{n}")
        if n in compact_after:
            table.compact()
        got = {r["id"]: r["v"] for r in table.read(broadcast_limit=limit).collect()}
        assert got == {k: v for k, (v, _) in want.items()}
        assert table.read(broadcast_limit=limit).count() == len(want)


def test_one_delta_is_read_as_it_is(spark, table):
    table.upsert(rows(spark, [(n % 5, "a", n) for n in range(100)]), "b0")
    plan = table.read().filter("v = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(v,a)" in plan
    assert table.read().count() == 5


def test_small_deltas_do_not_shuffle_the_base(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(100)]), "b0")
    table.compact()
    table.upsert(rows(spark, [(1, "b", 500)]), "b1")
    plan = table.read().filter("v = 'a'")._jdf.queryExecution().executedPlan().toString()
    base_scan = plan[plan.index("LeftAnti") :]
    assert "BroadcastHashJoin" in plan and "EqualTo(v,a)" in base_scan.split("Union")[0]


def test_a_compaction_rewrites_touched_buckets_only(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(100)]), "b0")
    table.compact()
    before = table.state().base
    table.upsert(rows(spark, [(1, "b", 500)]), "b1")
    table.compact()
    assert table.state().base == before and len(table.state().deltas) == 1  # too few rows to fold in
    table.compact(fold_share=0.0)
    after = table.state().base
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 100


def test_small_deltas_are_joined_first(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(100)]), "b0")
    table.compact()
    before = table.state().base
    for n in range(3):
        table.upsert(rows(spark, [(1, f"b{n}", 500 + n), (n, "c", 600)]), f"b{n + 1}")
    table.compact()
    assert table.state().base == before and len(table.state().deltas) == 1
    assert {r["id"]: r["v"] for r in table.read().collect()} | {0: "c", 1: "c", 2: "c"} == {n: "c" if n < 3 else "a" for n in range(100)}
    table.compact(fold_share=0.0)
    assert not table.state().deltas and table.read().count() == 100


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_buckets_double_and_are_split_over_tasks(spark, table, limit):
    for n in range(4):
        table.upsert(rows(spark, [(i, f"v{n}", n) for i in range(n * 50, n * 50 + 60)]), f"b{n}")
        table.compact(fold_share=0.0, bucket_rows=20, task_rows=7)
    state = table.state()
    assert state.buckets == 16 and len(state.base) > 8
    table.upsert(rows(spark, [(0, "late", 9)]), "b9")
    assert table.state().deltas["b9"].buckets is not None
    got = {r["id"]: r["v"] for r in table.read(broadcast_limit=limit).collect()}
    assert got == {i: "late" if i == 0 else f"v{min(3, i // 50)}" for i in range(210)}


def test_each_part_of_a_bucket_is_a_task(spark, table):
    def tasks(version):
        found = set()
        for bucket in table.files.names(f"{table.path}/base/{version}"):
            found |= {f[:10] for f in table.files.names(f"{table.path}/base/{version}/{bucket}") if f.startswith("part-")}
        return len(found)

    data = [(n, "x", n) for n in range(2000)]
    table.upsert(rows(spark, data), "b1")
    buckets = table.state().buckets
    table.compact(task_rows=500)
    parts = -(-2000 // (500 * buckets))
    assert tasks(next(iter(table.state().base.values()))) == buckets * parts
    table.upsert(rows(spark, [(n, "y", n + 5000) for n in range(0, 2000, 2)]), "b2")
    table.compact(task_rows=100)
    assert tasks(next(iter(table.state().base.values()))) == buckets * -(-3000 // (100 * buckets))
    assert table.read().groupBy().count().first()[0] == 2000


def test_untouched_buckets_are_not_merged(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(100)]), "b0")
    table.compact()
    table.upsert(rows(spark, [(1, "b", 500)]), "b1")
    state = table.state()
    (touched,) = state.deltas["b1"].buckets
    plan = table.read(broadcast_limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 1
    assert len(table._base_folders(state, {touched})) == 1 and table.read(broadcast_limit=0).count() == 100


def test_a_reader_outlives_compactions_until_files_expire(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(50)]), "b0")
    table.compact()
    table.upsert(rows(spark, [(1, "b", 100)]), "b1")
    seen = table.read()
    for n in range(12):
        table.upsert(rows(spark, [(n, f"c{n}", 200 + n)]), f"b{n + 2}")
        table.compact(fold_share=0.0 if n % 3 == 0 else 0.5)
        table.expire()
    assert {r["id"]: r["v"] for r in seen.collect()} == {n: "b" if n == 1 else "a" for n in range(50)}
    table.expire(keep_hours=0.0)
    assert table.files.names(f"{table.path}/_states") == [f"{max(table._sequence()):012d}.json"]
    assert set(table.files.names(f"{table.path}/base")) == set(table.state().base.values())
    assert table.read().count() == 50


def test_a_batch_that_may_be_repeated_is_not_folded(spark, table):
    table.upsert(rows(spark, [(1, "a", 1)]), "b0")
    table.upsert(rows(spark, [(2, "bad", 2)]), "b1")
    table.compact(keep=["b1"])
    table.drop_batch("b1")
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")]


def test_a_reader_keeps_its_version(spark, table):
    table.upsert(rows(spark, [(1, "a", 1)]), "b0")
    seen = table.read()
    table.upsert(rows(spark, [(1, "b", 2)]), "b1")
    table.compact()
    assert [tuple(r) for r in seen.collect()] == [(1, "a")]


def test_columns_are_bound_by_name(spark, table):
    with pytest.raises(ValueError, match="missing"):
        table.upsert(rows(spark, [(1, "a", 1)]).drop("v"), "b0")
    check_columns(rows(spark, [(1, "a", 1)]), [ORDER, "v", "id"])


# -- gateway -----------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"), buckets=2)
    store.register([
        EventConfig("a", "t", fields(id="long", v="integer"), ["id"]),
        EventConfig("a", "u", fields(id="long", w="integer"), ["id"]),
        EventConfig("b", "t", fields(id="long"), ["id"]),
    ])
    source = spark.range(10).select("id", (F.col("id") * 2).alias("v"), (F.col("id") * 3).alias("w"))
    for kind, column in (("t", "v"), ("u", "w")):
        out = to_messages(source, F.lit("a"), F.lit(kind), ["id", column], "id")
        ingest_batch(envelope(out, F.col("key"), F.col("value"), F.lit(0), F.col("id")), f"b{kind}", store)
    return store


def test_query_sees_the_given_tables_only(spark, store):
    assert gateway.query(store, "a", "t", "SELECT sum(v) AS s FROM t").first()["s"] == 90
    joined = gateway.query(store, "a", ["t", "u"], "SELECT count(*) AS n FROM a_t JOIN a_u USING (id) WHERE w > v")
    assert joined.first()["n"] == 9
    with pytest.raises(AnalysisException):
        gateway.query(store, "a", "t", "SELECT * FROM u")
    with pytest.raises(PermissionError):
        gateway.query(store, "a", ["t", "zzz"], "SELECT 1")
    with pytest.raises(PermissionError):
        gateway.query(store, "b", "u", "SELECT 1")
    spark.range(1).createOrReplaceTempView("private_view")
    with pytest.raises(AnalysisException):
        gateway.query(store, "a", "t", "SELECT * FROM private_view")


def test_query_refuses_files_and_commands(store):
    with pytest.raises(AnalysisException):
        gateway.query(store, "a", "t", f"SELECT * FROM parquet.`{store.root}/quarantine`")
    for command in ("DROP TABLE t", "SET x = 1", "CREATE TABLE q AS SELECT 1", "INSERT INTO t SELECT 1, 2", "SHOW TABLES"):
        with pytest.raises((ParseException, AnalysisException)):
            gateway.query(store, "a", "t", command)


def test_registered_but_empty_table_can_be_queried(store):
    assert gateway.query(store, "b", "t", "SELECT count(*) AS n FROM t").first()["n"] == 0


def test_query_stays_within_its_tables(spark, store, tmp_path_factory):
    for call in ("reflect", "java_method", "try_reflect", "system.builtin.reflect"):
        with pytest.raises((AnalysisException, PermissionError)):
            gateway.query(store, "a", "t", f"SELECT {call}('java.lang.System', 'getProperty', 'user.name') FROM t").collect()
    spark.range(3).createOrReplaceGlobalTempView("secret")
    for sql in ("SELECT * FROM global_temp.secret", "SELECT id FROM t WHERE id IN (SELECT id FROM global_temp.secret)"):
        with pytest.raises((PermissionError, AnalysisException)):
            gateway.query(store, "a", "t", sql)
    stored = tmp_path_factory.mktemp("outside") / "x"
    spark.range(3).write.parquet(str(stored))
    spark.read.parquet(str(stored)).createOrReplaceGlobalTempView("files")
    with pytest.raises((PermissionError, AnalysisException)):
        gateway.query(store, "a", "t", "SELECT (SELECT max(id) FROM global_temp.files) AS m FROM t")
    assert gateway.query(store, "a", "t", "WITH x AS (SELECT v FROM t) SELECT count(*) AS n FROM x WHERE v >= (SELECT min(v) FROM t)").first()["n"] > 0


def test_catalog_copy(spark, store):
    gateway.publish_to_catalog(store, store.configs()[0], "analysis_copy")
    assert spark.table("analysis_copy").count() == 10


# -- analysis ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def facts(spark):
    data = [("x", 1, 2.0), ("x", 2, 3.0), ("y", 1, 4.0), (None, 1, None), ("y", None, 5.0)]
    return spark.createDataFrame(data, "a string, b int, v double")


MEASURES = {"n": ("count", "*"), "nv": ("count", "v"), "s": ("sum", "v"), "m": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "v")}


@pytest.mark.parametrize("shape", ["cube", "rollup", "sets"])
def test_summaries_equal_the_plain_ones(spark, facts, shape):
    facts.createOrReplaceTempView("facts")
    clause = {"cube": "CUBE (a, b)", "rollup": "ROLLUP (a, b)", "sets": "GROUPING SETS ((a), (b), ())"}[shape]
    plain = spark.sql(
        f"SELECT a, b, grouping_id(a, b) grouping_id, count(*) n, count(v) nv, sum(v) s, avg(v) m, min(v) lo, max(v) hi FROM facts GROUP BY {clause}"
    )
    got = {
        "cube": lambda: analysis.cube(facts, ["a", "b"], MEASURES),
        "rollup": lambda: analysis.rollup(facts, ["a", "b"], MEASURES),
        "sets": lambda: analysis.grouping_sets(facts, [["a"], ["b"], []], ["a", "b"], MEASURES),
    }[shape]()
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_distinct_measures_need_the_rows(facts):
    got = analysis.cube(facts, ["a"], {"d": ("count_distinct", "b"), "ad": ("approx_count_distinct", "b")})
    assert {(r["a"], r["grouping_id"]): r["d"] for r in got.collect()} == {("x", 0): 2, ("y", 0): 1, (None, 0): 1, (None, 1): 2}
    with pytest.raises(ValueError):
        analysis.aggregate(facts, ["a"], {"x": ("median", "v")})


def test_enrichment_keeps_unmatched_events(spark, facts):
    dim = spark.createDataFrame([("x", "X")], "code string, label string")
    got = analysis.enrich(facts, dim, {"a": "code"}, ["label"])
    assert got.columns == ["a", "b", "v", "label"]
    assert sorted(str(r["label"]) for r in got.collect()) == ["None", "None", "None", "X", "X"]


def test_windows_late_and_session(spark, tmp_path):
    schema = "at timestamp_ntz, k string"
    source = str(tmp_path / "in")

    def add(*times):
        spark.createDataFrame([(t, "k") for t in times], "at string, k string").selectExpr(
            "cast(at as timestamp_ntz) at", "k"
        ).coalesce(1).write.mode("append").parquet(source)

    (tmp_path / "in").mkdir()

    def stream():
        return spark.readStream.schema(schema).parquet(source)

    measures = {"n": ("count", "*")}
    result = windowed(stream(), "at", measures, size="10 minutes", watermark="5 minutes", keys=["k"])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for times in (["2024-01-01 00:01:00", "2024-01-01 00:31:00"], ["2024-01-01 00:02:00", "2024-01-01 01:31:00"], ["2024-01-01 03:00:00"]):
        add(*times)
        write_results(result, out, checkpoint=cp, available_now=True).awaitTermination()
    got = read_appended(spark, out, result.schema)
    # the late event of 00:02 came after its window was final
    shown = {(r["window_start"].strftime("%H:%M"), r["n"]) for r in got.collect()}
    assert shown == {("00:00", 1), ("00:30", 1), ("01:30", 1)}

    sessions = windowed(spark.read.schema(schema).parquet(source), "at", measures, session_gap="2 minutes", keys=["k"])
    assert sorted(r["n"] for r in sessions.collect()) == [1, 1, 1, 2]
    with pytest.raises(ValueError):
        windowed(got, "at", measures, size="1 minute", session_gap="1 minute")


# -- options -----------------------------------------------------------------------------


def test_kafka_options():
    got = kafka.kafka_options("h:9092", "events", saved_offsets="0:120,1:98", min_partitions=64)
    assert got == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "events", "fetchOffset.numRetries": "3",
        "startingOffsets": '{"events": {"0": 120, "1": 98}}', "minPartitions": "64",
    }
    assert kafka.kafka_options("h", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.kafka_options("", "t")


def test_offsets_text(spark):
    df = spark.createDataFrame([(1, 98), (0, 120)], "p int, o long")
    text = df.agg(kafka.offsets_text(F.col("p"), F.col("o")).alias("t")).first()["t"]
    assert text == "0:120,1:98" and kafka.parse_offsets(text) == {0: 120, 1: 98}


def test_job_options():
    given = ["-Dkafka.brokers=h:9092", "-Dkafka.topics=t", "-Dstore.path=/s", "-Dcheckpoint.path=/c", "-Dspark.x=a=b"]
    assert job_options(given)["spark.x"] == "a=b"
    with pytest.raises(ValueError, match="kafka.brokers"):
        job_options(given[1:])


def test_ingest_options():
    with pytest.raises(ValueError):
        IngestOptions(on_bad="drop")


def test_jdbc_statements(spark):
    assert jdbc.merge_statement("t", "s", ["id", "v"], ["id"]) == (
        'MERGE INTO t t USING s s ON t."id" = s."id" WHEN MATCHED THEN UPDATE SET "v" = s."v"'
        ' WHEN NOT MATCHED THEN INSERT ("id", "v") VALUES (s."id", s."v")'
    )
    assert "UPDATE" not in jdbc.merge_statement("t", "s", ["id"], ["id"])
    ordered = jdbc.merge_statement("t", "s", ["id", "v", "p", "o"], ["id"], ["p", "o"])
    assert 'WHEN MATCHED AND ((s."p" > t."p" OR' in ordered and 's."o" > t."o"' in ordered
    with pytest.raises(ValueError):
        jdbc.merge_statement("t", "s", ["v"], ["id"])
    df = spark.createDataFrame([(1, [1, 2])], "id int, xs array<int>")
    assert jdbc.storable_columns(df).first()["xs"] == "[1,2]"
    options = tables.jdbc_options("jdbc:x", "t", split_column="id", lower=0, upper=9, partitions=4)
    assert options["numPartitions"] == "4" and options["lowerBound"] == "0"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", split_column="id")


def test_sizes_of_deltas_are_known(spark, table):
    table.upsert(rows(spark, [(n, "a", n) for n in range(100)] + [(5, "b", 200)]), "b0")
    table.upsert(rows(spark, []), "b1")
    sizes = {b: (d.rows, d.key_bytes) for b, d in table.state().deltas.items()}
    assert sizes == {"b0": (100, 100 * 32 + 10 + 180), "b1": (0, 0)}
    table.compact()
    assert table.state().key_bytes == 0 and table.read().count() == 100


def test_odd_column_names(spark, tmp_path):
    schema = T.StructType([T.StructField("i`d", T.IntegerType()), T.StructField("a.b", T.StringType())])
    table = KeyedTable(spark, str(tmp_path / "odd")).create(schema, ["i`d"], ORDER_SCHEMA, buckets=2)
    data = rows(spark, [(1, "a", 1), (1, "b", 2)]).toDF("i`d", "a.b", ORDER)
    for batch in ("b0", "b1"):
        table.upsert(data, batch)
        table.compact()
        table.upsert(data, batch)
    assert [tuple(r) for r in table.read().collect()] == [(1, "b")]


class _Session:
    """Only what ``shared_folder`` looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()


def test_shared_folder():
    assert shared_folder(_Session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/eventbase-")
    local = _Session("local[2]")
    a, b = shared_folder(local), shared_folder(local)
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("local-cluster[2,1,1024]"))
