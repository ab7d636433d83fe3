"""One query per capability, each over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions.json_records import parse_events
from eventbase.functions.keys import app_key_of, application_key, event_type_of
from eventbase.operators import analysis, gateway, registry
from eventbase.operators.keyed_table import ORDER, KeyedTable
from eventbase.operators.registry import EventConfig
from eventbase.plans import timeline
from eventbase.plans.inputs import (
    APP, EVENT_SCHEMA, ORDER_SCHEMA, event_body, event_configs, event_messages, fields,
    filled_store, new_store, no_zone, order_messages, parsed, table, time_text,
)
from eventbase.session import shared_folder
from eventbase.operators.sinks import order_schema
from eventbase.sources.envelope import envelope, read_envelope_folder, stream_envelope_folder
from eventbase.sources.kafka import offsets_text
from eventbase.streaming.ingest import IngestOptions, ingest_batch, run_ingest
from eventbase.streaming.windows import read_appended, windowed, write_results


def _event_columns() -> list:
    return ["eventid", no_zone("eventtime").alias("eventtime"), "eventtype", "userid", "value", "props.k"]


# -- parsing -----------------------------------------------------------------------------


def ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as JSON and back into typed columns."""
    messages = event_messages(table(spark, sf_dir, "events"))
    rows = parse_events(messages, EVENT_SCHEMA).filter("reason is null").select("row.*")
    return rows.select(*_event_columns())


def ingest_fields_missing_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent, null, unknown and repeated fields."""
    events = table(spark, sf_dir, "events")
    n = F.col("event_id") % 4
    value = (
        F.when(n == 0, F.lit(""))
        .when(n == 1, F.lit(',"value":null'))
        .when(n == 2, F.concat(F.lit(',"value":-1,"value":'), F.col("value").cast("string")))
        .otherwise(F.concat(F.lit(',"value":'), F.col("value").cast("string")))
    )
    body = F.concat(
        F.lit('{"eventid":'), F.col("event_id"), F.lit(',"extra":{"value":[1,{"value":2}]},"EVENTID":0'),
        value, F.lit(',"eventtype":"'), F.col("event_type"), F.lit('"}'),
    )
    schema = fields(eventid="long", value="double", eventtype="string", never="date")
    return parsed(events, body, schema).filter("reason is null").select("row.*")


def ingest_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected records by reason and field, with defects planted by event number."""
    events = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct(*event_body()))
    n = F.col("event_id") % 12
    body = (
        F.when(n == 0, F.lit("  "))
        .when(n == 1, F.expr("substr(whole, 1, length(whole) - 1)"))
        .when(n == 2, F.concat(F.lit("["), F.col("whole"), F.lit("]")))
        .when(n == 3, F.lit("null"))
        .when(n == 4, F.regexp_replace("whole", '"value":[^,]*', '"value":"1.5"'))
        .when(n == 5, F.regexp_replace("whole", '"userid":[^,]*', '"userid":"10"'))
        .when(n == 6, F.regexp_replace("whole", '"userid":[^,]*', '"userid":""'))
        .when(n == 7, F.regexp_replace("whole", '"eventtime":"[^"]*"', '"eventtime":"soon"'))
        .when(n == 8, F.regexp_replace("whole", '"props":\\{[^}]*\\}', '"props":[1]'))
        .when(n == 9, F.regexp_replace("whole", '"k":', '"k":1.'))
        .when(n == 10, F.concat(F.col("whole"), F.lit(" and more")))
        .otherwise(F.col("whole"))
    )
    outcome = parsed(events.select(whole.alias("whole"), "event_id"), body, EVENT_SCHEMA)
    return outcome.groupBy(
        F.coalesce("reason", F.lit("good")).alias("outcome"),
        F.array_join("bad_fields", ",").alias("bad_field_names"),
    ).agg(F.count("*").alias("records"), F.count("row.userid").alias("with_user"))


def ingest_epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same moments as seconds, milliseconds and microseconds."""
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    result = None
    for unit, number in (("s", F.unix_seconds("at")), ("ms", F.unix_millis("at")), ("us", F.unix_micros("at"))):
        body = F.to_json(F.struct(number.alias("t")))
        rows = parsed(events, body, fields(t="timestamp"), "event_id", epoch_unit=unit)
        rows = rows.select(F.lit(unit).alias("unit"), "event_id", no_zone("row.t").alias("t"))
        result = rows if result is None else result.unionByName(rows)
    return result


def ingest_epoch_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, as date-time text, as a count of days in text, and as a bare number."""
    events = table(spark, sf_dir, "events")
    n = F.col("event_id") % 4
    days = F.unix_date(F.to_date("ts"))
    token = (
        F.when(n == 0, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
        .when(n == 1, F.concat(F.lit('"'), time_text("ts"), F.lit('"')))
        .when(n == 2, F.concat(F.lit('"'), days, F.lit('"')))
        .otherwise(days.cast("string"))
    )
    rows = parsed(events, F.concat(F.lit('{"d":'), token, F.lit("}")), fields(d="date"), "event_id")
    return rows.select("event_id", F.col("row.d").alias("d"), "reason")


def ingest_integers_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    body = F.to_json(
        F.struct(
            (F.col("event_id") % 256).alias("b"),
            (F.col("event_id") % 40000).alias("s"),
            (F.col("event_id") * 1000003).alias("i"),
            (F.col("event_id") * 3000000000).alias("l"),
            (F.col("event_id") % 2 == 0).alias("f"),
        )
    )
    schema = fields(b="byte", s="short", i="integer", l="long", f="boolean")
    rows = parsed(events, body, schema, "event_id")
    return rows.select("event_id", "row.*", F.array_join("bad_fields", ",").alias("bad_field_names"))


def ingest_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third decimal place is rounded half up; too many digits reject the record."""
    events = table(spark, sf_dir, "events")
    text = F.concat(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("5"))
    token = F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    body = F.concat(F.lit('{"wide":'), token, F.lit(',"narrow":'), token, F.lit("}"))
    schema = fields(wide="decimal(12,2)", narrow="decimal(4,2)")
    rows = parsed(events, body, schema, "event_id")
    return rows.select("event_id", F.col("row.wide").cast("double").alias("wide"), "reason")


def ingest_special_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    spellings = ['"NaN"', '"Infinity"', '"-Infinity"', '"nan"', '"INF"', '"-inf"', '"+Infinity"', '"1.5"', '""', "NaN"]
    token = F.get(F.array(*map(F.lit, spellings)), (F.col("event_id") % 11).cast("int"))
    token = F.coalesce(token, F.col("value").cast("string"))
    body = F.concat(F.lit('{"v":'), token, F.lit("}"))
    result = None
    for name, lenient in (("strict", False), ("lenient", True)):
        rows = parsed(events, body, fields(v="double"), "event_id", lenient_floats=lenient)
        v = F.col("row.v")
        kind = (
            F.when(F.col("reason").isNotNull(), F.lit("rejected"))
            .when(v.isNull(), F.lit("null"))
            .when(F.isnan(v), F.lit("nan"))
            .when(v == float("inf"), F.lit("inf"))
            .when(v == float("-inf"), F.lit("-inf"))
            .otherwise(v.cast("decimal(18,2)").cast("string"))
        )
        rows = rows.select(F.lit(name).alias("mode"), "event_id", kind.alias("kind"))
        result = rows if result is None else result.unionByName(rows)
    return result


def ingest_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object, a number or a list under a text field stays as its JSON text."""
    events = table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"props": '), F.col("props"), F.lit(', "num": '), F.col("event_id"),
        F.lit(', "list": [ '), F.col("user_id"), F.lit(', "'), F.col("event_type"), F.lit('", null ]}'),
    )
    schema = fields(props="string", num="string", list="string")
    return parsed(events, body, schema, "event_id").select("event_id", "row.*")


def ingest_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs, lists, maps and bytes; empty text inside a list or map is a null element."""
    events = table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"s":{"a":'), F.col("user_id"), F.lit(',"at":"'), time_text("ts"), F.lit('","in":{"d":"'),
        F.unix_date(F.to_date("ts")), F.lit('"}},"xs":[1,"",'), F.col("event_id"), F.lit('],"m":{"x":'),
        F.col("value").cast("string"), F.lit(',"y":""},"ds":["'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('"],"b":"'), F.base64(F.col("event_type").cast("binary")), F.lit('"}'),
    )
    schema = T.DataType.fromDDL(
        "s struct<a: bigint, at: timestamp, `in`: struct<d: date>>, xs array<bigint>, "
        "m map<string, double>, ds array<date>, b binary"
    )
    rows = parsed(events, body, schema, "event_id").filter("reason is null")
    return rows.select(
        "event_id",
        F.col("row.s.a").alias("a"),
        no_zone("row.s.at").alias("at"),
        F.col("row.s.in.d").alias("d"),
        F.size("row.xs").alias("xs_size"),
        F.get("row.xs", F.lit(1)).isNull().alias("xs_gap"),
        F.get("row.xs", F.lit(2)).alias("xs_last"),
        F.size("row.m").alias("m_size"),
        F.try_element_at("row.m", F.lit("x")).alias("m_x"),
        F.get("row.ds", F.lit(0)).alias("ds_first"),
        F.col("row.b").cast("string").alias("b"),
    )


def ingest_object_as_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object where a list is expected becomes a list of one, if the elements allow it."""
    events = table(spark, sf_dir, "events")
    item = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"at":"'), time_text("ts"), F.lit('"}'))
    single = F.col("event_id") % 2 == 0
    token = F.when(single, item).otherwise(F.concat(F.lit("["), item, F.lit(","), item, F.lit("]")))
    numbers = F.when(F.col("event_id") % 3 == 0, F.lit('{"id":1}')).otherwise(F.lit("[1]"))
    body = F.concat(F.lit('{"xs":'), token, F.lit(',"ns":'), numbers, F.lit("}"))
    schema = T.DataType.fromDDL("xs array<struct<id: bigint, at: timestamp>>, ns array<int>")
    rows = parsed(events, body, schema, "event_id")
    last = F.element_at("row.xs", -1)
    return rows.select(
        "event_id",
        F.when(F.col("reason").isNull(), F.size("row.xs")).alias("items"),
        last["id"].alias("last_id"),
        last["at"].cast("timestamp_ntz").alias("last_at"),
        F.array_join("bad_fields", ",").alias("bad_field_names"),
    )


def ingest_root_array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body that is a list gives one record per element, good or bad on its own."""
    events = table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('[{"id":'), F.col("event_id"), F.lit(',"v":'), F.col("value").cast("string"),
        F.lit('}, {"id":'), F.col("event_id"), F.lit(',"v":"x"}, {"id":'), F.col("user_id"), F.lit("}, 7]"),
    )
    body = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"id":'), F.col("event_id"), F.lit("}"))).otherwise(body)
    rows = parsed(events, body, fields(id="long", v="double"), "event_id", explode_root_array=True)
    return rows.select("event_id", F.col("row.id").alias("id"), F.col("row.v").alias("v"), "reason")


def ingest_repeated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that stand twice in an object, at the root and inside: the last counts, any bad one rejects."""
    events = table(spark, sf_dir, "events")
    n, a = F.col("event_id") % 12, F.col("event_id").cast("string")
    body = (
        F.when(n == 0, F.concat(F.lit('{"a":1,"a":'), a, F.lit("}")))
        .when(n == 1, F.concat(F.lit('{"a":'), a, F.lit(',"a":"x"}')))
        .when(n == 2, F.concat(F.lit('{"a":"x","a":'), a, F.lit("}")))
        .when(n == 3, F.concat(F.lit('{"a":'), a, F.lit(',"a":""}')))
        .when(n == 4, F.concat(F.lit('{"a":'), a, F.lit(',"a":null}')))
        .when(n == 5, F.concat(F.lit('{"s":{"x":1},"s":5,"a":'), a, F.lit("}")))
        .when(n == 6, F.concat(F.lit('{"a":'), a, F.lit(',"s":{"x":1,"x":"q"}}')))
        .when(n == 7, F.concat(F.lit('{"s":{"x":1,"x":""},"a":"","a":'), a, F.lit("}")))
        .when(n == 8, F.concat(F.lit('{"t":"zz","t":"2018-02-01 12:00:00","a":'), a, F.lit("}")))
        .when(n == 9, F.concat(F.lit('{"d":"2018-02-01","d":true,"a":'), a, F.lit("}")))
        .when(n == 10, F.concat(F.lit('{"t":"2018-02-01 12:00:00","t":"2019-01-01 00:00:00","d":"","d":"2018-02-01","a":'), a, F.lit("}")))
        .otherwise(F.concat(F.lit('{"s":{"x":1},"s":{"x":'), a, F.lit("}}")))
    )
    schema = fields(a="long", s=fields(x="long").jsonValue(), t="timestamp", d="date")
    rows = parsed(events, body, schema, "event_id")
    return rows.select(
        "event_id", "reason", F.col("row.a").alias("a"), F.col("row.s.x").alias("x"), no_zone("row.t").alias("t"), F.col("row.d").alias("d")
    )


def ingest_times_without_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with a time alone is no timestamp, whatever its zone."""
    events = table(spark, sf_dir, "events")
    n = F.col("event_id") % 5
    text = (
        F.when(n == 0, F.lit("12:30:00-08:00"))
        .when(n == 1, F.lit("T10:00:00-05:00"))
        .when(n == 2, F.lit("12:30:00"))
        .when(n == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-08:00")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    rows = parsed(events, F.to_json(F.struct(text.alias("t"))), fields(t="timestamp"), "event_id")
    return rows.select("event_id", "reason", no_zone("row.t").alias("t"))


def ingest_syntax_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient JSON syntax is refused unless the options allow it; text after the root is ignored."""
    events = table(spark, sf_dir, "events")
    n, a = F.col("event_id") % 6, F.col("event_id").cast("string")
    body = (
        F.when(n == 0, F.concat(F.lit("{'a':"), a, F.lit("}")))
        .when(n == 1, F.concat(F.lit("{a:"), a, F.lit("}")))
        .when(n == 2, F.concat(F.lit('{"a":00'), a, F.lit("}")))
        .when(n == 3, F.concat(F.lit('{/* note */"a":'), a, F.lit("}")))
        .when(n == 4, F.concat(F.lit('{"a":'), a, F.lit("} trailing")))
        .otherwise(F.concat(F.lit('{"a":'), a, F.lit(",}")))
    )
    lenient = {"allowUnquotedFieldNames": "true", "allowNumericLeadingZeros": "true", "allowComments": "true"}
    result = None
    for name, options in (("default", {}), ("lenient", lenient)):
        rows = parsed(events, body, fields(a="long"), "event_id", json_options=options)
        rows = rows.select(
            F.lit(name).alias("mode"), "event_id", F.col("row.a").alias("a"), "reason",
            F.when(F.col("reason").isNotNull(), F.length("value")).alias("kept_chars"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def ingest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, pages and conversation turns through JSON bodies."""
    sources = [
        table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).alias("turn"), "text"),
        table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.lit(0).alias("turn"), F.col("html").alias("text")),
        table(spark, sf_dir, "conversations").select(F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), F.col("turn"), "text"),
    ]
    texts = sources[0].unionByName(sources[1]).unionByName(sources[2])
    rows = parsed(texts, F.to_json(F.struct("kind", "id", "turn", "text")), fields(kind="string", id="long", turn="long", text="string"))
    good = rows.filter("reason is null")
    return good.select("row.kind", "row.id", "row.turn", F.md5("row.text").alias("digest"), F.length("row.text").alias("chars"))


def ingest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of floats, one row per element again at the end."""
    vectors = table(spark, sf_dir, "embeddings")
    schema = T.DataType.fromDDL("vec_id bigint, embedding array<float>, label int")
    rows = parsed(vectors, F.to_json(F.struct("vec_id", "embedding", "label")), schema).filter("reason is null")
    return rows.select("row.vec_id", "row.label", F.posexplode("row.embedding").alias("pos", "x")).select(
        "vec_id", "label", "pos", F.col("x").cast("double").alias("x")
    )


# -- keys, registry, routing, publishing -------------------------------------------------


def _stored_registry(spark: SparkSession, leave_out: str) -> DataFrame:
    return new_store(spark, [c for c in event_configs() if c.event_type != leave_out]).registry()


def route_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(table(spark, sf_dir, "events"), to_parse=False)
    routed = registry.route(messages, _stored_registry(spark, "view"))
    return routed.groupBy("table_name").agg(F.count("*").alias("messages"))


def registered_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(table(spark, sf_dir, "events"), to_parse=False)
    return registry.registered(messages, _stored_registry(spark, "view")).select("key", "partition", "offset")


def unregistered_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(table(spark, sf_dir, "events"), to_parse=False)
    return registry.unregistered(messages, _stored_registry(spark, "view")).select("key", "partition", "offset")


def registry_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration requests taken from the events: which keys were asked for twice?"""
    requests = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id").alias("app_key"), F.col("event_type")
    )
    return registry.duplicate_keys(requests)


def application_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", application_key(F.col("c_name"), F.col("c_mktsegment")).alias("app_key"))


def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed and widened columns in the stored table."""
    config = EventConfig(
        APP, "order", ORDER_SCHEMA, ["order_id"],
        column_map={"o_orderkey": "order_id", "o_totalprice": "price", "o_orderpriority": "Priority class"},
        column_types={"price": "string", "o_custkey": "double"},
    )
    store = new_store(spark, [config])
    ingest_batch(order_messages(table(spark, sf_dir, "orders")), "b", store)
    return store.table(config).read().withColumn("price", F.col("price").cast("double"))


def mapped_nested_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields inside structs as columns, other fields left out, a nested key."""
    schema = fields(id="long", who=fields(user="long", kind="string").jsonValue(), props=fields(k="integer").jsonValue(), value="double")
    config = EventConfig(
        APP, "nested", schema, ["user_id", "who_kind"], fields=["who.user", "who.kind", "props.k", "id"],
        column_map={"who.user": "user_id", "id": "event_id"}, order_by=["event_id"],
    )
    store = new_store(spark, [config])
    events = table(spark, sf_dir, "events")
    who = F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind"))
    body = F.to_json(F.struct(F.col("event_id").alias("id"), who.alias("who"), F.from_json("props", "k int").alias("props"), "value"))
    ingest_batch(envelope(events, F.lit(config.key), body, F.lit(0), -F.col("event_id")), "b", store)
    return store.table(config).read()


def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish to a folder, read the messages back, split the keys and parse."""
    path = shared_folder(spark)
    event_messages(table(spark, sf_dir, "events")).write.parquet(path)
    rows = parse_events(read_envelope_folder(spark, path), EVENT_SCHEMA)
    return rows.select(
        app_key_of(F.col("key")).alias("app_key"), event_type_of(F.col("key")).alias("event_type"),
        "topic", "partition", "offset", "row.userid", "row.value",
    )


# -- tables ------------------------------------------------------------------------------


def _users_store(spark: SparkSession):
    configs = event_configs(primary_key=("userid", "eventtype"))
    return new_store(spark, configs), configs


def _union_tables(store, configs) -> DataFrame:
    result = None
    for config in configs:
        rows = store.table(config).read()
        result = rows if result is None else result.unionByName(rows)
    return result.select(*_event_columns())


def _halves(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All messages in two interleaved batches, by the hour in their body."""
    hour = F.coalesce(F.substring(F.get_json_object("value", "$.eventtime"), 12, 2), F.lit(""))
    return messages.filter(hour < "12"), messages.filter(~(hour < "12"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type."""
    store, configs = _users_store(spark)
    ingest_batch(event_messages(table(spark, sf_dir, "events")), "b", store)
    return _union_tables(store, configs)


def upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result from interleaved batches, one repeated, with a compaction between."""
    store, configs = _users_store(spark)
    messages = event_messages(table(spark, sf_dir, "events"))
    early, late = _halves(messages)
    ingest_batch(late, "b0", store, IngestOptions(compact_every=1))
    for _ in range(2):
        ingest_batch(early, "b1", store, IngestOptions(compact_every=1))
    return _union_tables(store, configs)


def read_base_and_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result read from a base under two deltas, merged in either way of reading."""
    store, configs = _users_store(spark)
    early, late = _halves(event_messages(table(spark, sf_dir, "events")))
    ingest_batch(late, "b0", store)
    for config in configs:
        store.table(config).compact(fold_share=0.0)
    even = F.col("offset") % 2 == 0
    ingest_batch(early.filter(even), "b1", store)
    ingest_batch(early.filter(~even), "b2", store)
    result = None
    for n, config in enumerate(configs):
        rows = store.table(config).read(broadcast_limit=0 if n % 2 else 64 << 20)
        result = rows if result is None else result.unionByName(rows)
    return result.select(*_event_columns())


def read_during_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees who opened the tables before later batches and two compactions."""
    store, configs = _users_store(spark)
    messages = event_messages(table(spark, sf_dir, "events"))
    ingest_batch(messages, "b0", store)
    opened = _union_tables(store, configs)
    later = messages.withColumn("offset", F.col("offset") + 1_000_000_000)
    for n in range(2):
        ingest_batch(later.filter(F.col("offset") % 2 == n), f"b{n + 1}", store)
        for config in configs:
            store.table(config).compact(fold_share=0.0)
            store.table(config).expire()
    return opened


def ingest_many_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of forty event types, one table each, written in one job."""
    configs = [EventConfig(APP, f"u{n}", EVENT_SCHEMA, ["userid"]) for n in range(40)]
    store = new_store(spark, configs)
    messages = event_messages(table(spark, sf_dir, "events"))
    key = F.concat(F.lit(f"{APP}|u"), F.get_json_object("value", "$.userid").cast("long") % 40)
    ingest_batch(messages.withColumn("key", key), "b", store)
    return _union_tables(store, [c for c in configs if store.table(c).exists()])


def upsert_root_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are lists of records: of one key the last in the list stays, empty lists are quarantined."""
    config = EventConfig(APP, "visit", fields(userid="long", eventid="long", n="integer"), ["userid"])
    store = new_store(spark, [config])
    events = table(spark, sf_dir, "events")
    first = F.to_json(F.struct(F.col("user_id").alias("userid"), F.col("event_id").alias("eventid"), F.lit(1).alias("n")))
    last = F.to_json(F.struct(F.col("user_id").alias("userid"), F.col("event_id").alias("eventid"), F.lit(2).alias("n")))
    body = F.when(F.col("event_id") % 5 == 0, F.lit("[ ]")).otherwise(F.concat(F.lit("["), first, F.lit(","), last, F.lit("]")))
    messages = envelope(events, F.lit(f"{APP}|visit"), body, F.lit(0), F.col("event_id"))
    ingest_batch(messages, "b", store, IngestOptions(explode_root_array=True))
    kept = store.table(config).read().select("userid", "eventid", "n", F.lit(None).cast("string").alias("reason"))
    refused = store.quarantine().select(
        F.lit(None).cast("long").alias("userid"), F.col("offset").alias("eventid"), F.lit(None).cast("int").alias("n"), "reason"
    )
    return kept.unionByName(refused)


def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine table after a batch with every kind of message that is not stored."""
    good = EventConfig(APP, "good", fields(id="long", v="double"), ["id"])
    taken = EventConfig(APP, "taken", fields(id="long", v="long"), ["id"])
    store = new_store(spark, [good, taken])
    store.table(taken).create(fields(id="long", v="string"), ["id"], order_schema(taken), buckets=1)
    events = table(spark, sf_dir, "events")
    n, whole = F.col("event_id") % 8, F.to_json(F.struct(F.col("event_id").alias("id"), F.col("value").alias("v")))
    key = F.when(n == 5, F.lit(f"{APP}|unknown")).when(n == 6, F.lit(None)).when(n == 7, F.lit(taken.key)).otherwise(F.lit(good.key))
    body = (
        F.when(n == 0, F.lit(" "))
        .when(n == 1, F.concat(whole, F.lit("]")).substr(F.lit(2), F.length(whole)))
        .when(n == 2, F.lit('{"id":"x","v":"y"}'))
        .when(n == 3, F.lit('{"v":1.5}'))
        .otherwise(whole)
    )
    ingest_batch(envelope(events, key, body, F.lit(0), F.col("event_id")), "b", store)
    found = store.quarantine().select(
        "offset", "key", "reason", F.array_join("bad_fields", ",").alias("bad_field_names"), F.length("value").alias("chars")
    )
    stored = store.table(good).read()
    return found.unionByName(
        stored.select(
            F.col("id").alias("offset"), F.lit(good.key).alias("key"), F.lit("stored").alias("reason"),
            F.lit("").alias("bad_field_names"), F.lit(None).cast("int").alias("chars"),
        )
    )


def widened_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one event type, the second with wider types, and a third with narrower ones that is quarantined."""
    def config(**types: str) -> EventConfig:
        return EventConfig(APP, "score", fields(id="long", **types), ["id"])

    narrow, wide = config(who="integer", score="float", amount="decimal(9,2)"), config(who="long", score="double", amount="decimal(18,2)")
    store = new_store(spark, [narrow])
    events, id_, amount = table(spark, sf_dir, "events"), F.col("event_id").alias("id"), F.col("value").cast("decimal(18,2)")

    def ingest(rows: DataFrame, who: Column, amount: Column, nth: int) -> None:
        body = F.to_json(F.struct(id_, who.alias("who"), F.col("value").alias("score"), amount.alias("amount")))
        # The partition says which batch came later: offsets are the events' numbers in all of them.
        ingest_batch(envelope(rows, F.lit(narrow.key), body, F.lit(nth), F.col("event_id")), f"b{nth}", store)

    ingest(events.filter("event_id % 3 < 2"), F.col("user_id"), amount, 0)
    store.register([wide])
    ingest(events.filter("event_id % 3 > 0"), F.col("user_id") + 10_000_000_000, amount + 100_000_000, 1)
    store.register([narrow])
    ingest(events.filter("event_id % 100 = 0"), F.col("user_id"), amount, 2)
    refused = store.quarantine().select(F.col("offset").alias("id"), "reason")
    stored = store.table(wide).read().withColumn("amount", F.col("amount").cast("double"))
    return stored.unionByName(refused, allowMissingColumns=True)


def sink_types_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of column, nulls included, through a keyed table."""
    gap = F.col("event_id") % 7 == 0

    def sometimes(column):
        return F.when(~gap, column)

    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    rows = events.select(
        F.col("event_id").alias("id"),
        sometimes(F.to_date("at")).alias("d"),
        sometimes(F.col("at")).alias("t"),
        sometimes((F.col("event_id") % 100).cast("byte")).alias("b"),
        sometimes(F.col("value").cast("decimal(12,2)")).alias("dec"),
        sometimes(F.col("event_type").cast("binary")).alias("bin"),
        sometimes(F.col("user_id") > 50).alias("flag"),
        sometimes(F.array(F.col("user_id"), F.lit(None), F.col("event_id"))).alias("xs"),
        sometimes(F.create_map(F.lit("v"), F.col("value"))).alias("m"),
        sometimes(F.struct(F.col("props").alias("p"))).alias("s"),
        F.struct(F.col("event_id").alias("n")).alias(ORDER),
    )
    order = rows.schema[ORDER].dataType
    stored = KeyedTable(spark, shared_folder(spark)).create(rows.drop(ORDER).schema, ["id"], order, buckets=4)
    stored.upsert(rows, "b")
    stored.compact()
    return stored.read().select(
        "id", "d", no_zone("t").alias("t"), F.col("b").cast("int").alias("b"), F.col("dec").cast("double").alias("dec"),
        F.col("bin").cast("string").alias("bin"), "flag", F.get("xs", F.lit(0)).alias("xs0"), F.get("xs", F.lit(2)).alias("xs2"),
        F.try_element_at("m", F.lit("v")).alias("mv"), F.col("s.p").alias("p"),
    )


# -- streams -----------------------------------------------------------------------------


def _stream_folder(spark: SparkSession, messages: DataFrame) -> str:
    path = shared_folder(spark)
    messages.repartitionByRange("offset").write.parquet(path)
    return path


def _run_stream(spark: SparkSession, source: str, store, checkpoint: str, batches: int = 1) -> None:
    """Read a folder in about so many batches, each of as many files as that takes."""
    files = [n for n in store.files.names(source) if n.endswith(".parquet")]
    messages = stream_envelope_folder(spark, source, max_files_per_trigger=max(1, -(-len(files) // batches)))
    run_ingest(messages, store, checkpoint=checkpoint, available_now=True).awaitTermination()


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per user and type, arriving as a stream of three batches."""
    store, configs = _users_store(spark)
    source = _stream_folder(spark, event_messages(table(spark, sf_dir, "events")))
    _run_stream(spark, source, store, shared_folder(spark), batches=3)
    return _union_tables(store, configs)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped half way and started again from its checkpoint."""
    store, configs = _users_store(spark)
    messages = event_messages(table(spark, sf_dir, "events"))
    source, checkpoint = shared_folder(spark), shared_folder(spark)
    for half in _halves(messages):
        half.write.mode("append").parquet(source)
        _run_stream(spark, source, store, checkpoint)
    return _union_tables(store, configs)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the progress table of a stream says it has covered."""
    store, _ = _users_store(spark)
    source = _stream_folder(spark, event_messages(table(spark, sf_dir, "events")))
    _run_stream(spark, source, store, shared_folder(spark), batches=2)
    return store.progress().groupBy("topic", "partition").agg(
        F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset"), F.sum("messages").alias("messages")
    )


def saved_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starting positions of a batch as one line of text, from which a first run can be seeded."""
    messages = event_messages(table(spark, sf_dir, "events"), to_parse=False)
    first = messages.groupBy("topic", "partition").agg(F.min("offset").alias("first_offset"))
    return first.groupBy("topic").agg(offsets_text(F.col("partition"), F.col("first_offset")).alias("offsets"))



def _amount():
    return F.col("value").cast("decimal(18,2)")


STREAM_MEASURES = {"n": ("count", "*"), "total": ("sum", "amount"), "top": ("max", "amount")}


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return files.withColumn("amount", _amount())


def _windows(spark: SparkSession, result: DataFrame, mode: str, *keys: str) -> DataFrame:
    path = shared_folder(spark)
    write_results(
        result, path, checkpoint=shared_folder(spark), keys=keys, mode=mode, available_now=True
    ).awaitTermination()
    rows = KeyedTable(spark, path).read() if mode == "update" else read_appended(spark, path, result.schema)
    return _window_columns(rows, *keys)


def _window_columns(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(
        no_zone("window_start").alias("window_start"), no_zone("window_end").alias("window_end"), *keys, "n",
        F.col("total").cast("double").alias("total"), F.col("top").cast("double").alias("top"),
    )


def agg_stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = windowed(
        _event_stream(spark, sf_dir), "ts", STREAM_MEASURES, size="6 hours", watermark="31 days", keys=["event_type"]
    )
    return _windows(spark, result, "update", "event_type")


def agg_stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of half of the events, then of all by a stream with a new checkpoint over the same table."""
    path, events = shared_folder(spark), _event_stream(spark, sf_dir)
    for stream in (events.filter("event_id % 2 = 0"), events):
        result = windowed(stream, "ts", STREAM_MEASURES, size="6 hours", watermark="31 days", keys=["event_type"])
        write_results(
            result, path, checkpoint=shared_folder(spark), keys=["event_type"], mode="update", available_now=True
        ).awaitTermination()
    return _window_columns(KeyedTable(spark, path).read(), "event_type")


def append_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own add to one folder; neither replaces the other's batches."""
    path, events = shared_folder(spark), _event_stream(spark, sf_dir).select("event_id", "event_type")
    for n in range(2):
        part = events.filter(F.col("event_id") % 2 == n)
        write_results(part, path, checkpoint=shared_folder(spark), available_now=True).awaitTermination()
    return read_appended(spark, path, events.schema)


def agg_stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = windowed(
        _event_stream(spark, sf_dir), "ts", STREAM_MEASURES, size="1 day", slide="6 hours", watermark="31 days", keys=["event_type"]
    )
    return _windows(spark, result, "update", "event_type")


def agg_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final windows only: those the watermark has passed."""
    result = windowed(
        _event_stream(spark, sf_dir), "ts", STREAM_MEASURES, size="1 hour", watermark="10 minutes", keys=["event_type"]
    )
    return _windows(spark, result, "append", "event_type")


def agg_stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, closed by a pause of two hours."""
    result = windowed(
        _event_stream(spark, sf_dir), "ts", STREAM_MEASURES, session_gap="2 hours", watermark="10 minutes", keys=["user_id"]
    )
    return _windows(spark, result, "append", "user_id")


def enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream joined with a stored dimension."""
    customers = table(spark, sf_dir, "customer")
    result = analysis.enrich(
        _event_stream(spark, sf_dir), customers, {"user_id": "c_custkey"}, ["c_name", "c_mktsegment"]
    ).select("event_id", "event_type", "c_name", "c_mktsegment")
    path = shared_folder(spark)
    write_results(result, path, checkpoint=shared_folder(spark), available_now=True).awaitTermination()
    return read_appended(spark, path, result.schema)


# -- analysis ----------------------------------------------------------------------------


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_typed(spark, sf_dir).withColumn("amount", _amount())


def agg_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "n": ("count", "*"), "total": ("sum", "amount"), "lowest": ("min", "amount"), "highest": ("max", "amount"),
        "users": ("count_distinct", "userid"),
    }
    rows = analysis.aggregate(_typed_events(spark, sf_dir), ["eventtype"], measures)
    return rows.select(
        "eventtype", "n", "users", *[F.col(c).cast("double").alias(c) for c in ("total", "lowest", "highest")],
        (F.col("total").cast("double") / F.col("n")).alias("mean"),
    )


def agg_approx_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct users per type, as a verdict on its error."""
    measures = {"approx": ("approx_count_distinct", "userid"), "users": ("count_distinct", "userid")}
    rows = analysis.aggregate(_typed_events(spark, sf_dir), ["eventtype"], measures)
    # The default standard error is 5 %; four of them are hardly ever exceeded.
    close = F.abs(F.col("approx") - F.col("users")) <= F.greatest(F.lit(1.0), 0.2 * F.col("users"))
    return rows.select("eventtype", "users", close.alias("within_a_fifth"))


def enrich_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    with_customer = analysis.enrich(
        events, table(spark, sf_dir, "customer"), {"user_id": "c_custkey"}, ["c_name", "c_nationkey"]
    )
    with_nation = analysis.enrich(
        with_customer, table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]
    )
    return analysis.enrich(with_nation, table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"])


CUBE_MEASURES = {"n": ("count", "*"), "total": ("sum", "amount"), "lowest": ("min", "amount"), "highest": ("max", "amount")}
CUBE_DIMS = ["eventtype", "day", "segment"]


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _typed_events(spark, sf_dir).withColumn("day", F.to_date("eventtime"))
    return analysis.enrich(
        events, table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment"), {"userid": "c_custkey"}, ["segment"]
    )


def _summary(rows: DataFrame) -> DataFrame:
    return rows.select(
        *CUBE_DIMS, F.col("grouping_id").cast("long").alias("grouping_id"), "n",
        *[F.col(c).cast("double").alias(c) for c in ("total", "lowest", "highest")],
    )


def cube_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(analysis.cube(_facts(spark, sf_dir), CUBE_DIMS, CUBE_MEASURES))


def cube_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users for every combination of the dimensions."""
    rows = analysis.cube(_facts(spark, sf_dir), CUBE_DIMS, {"n": ("count", "*"), "users": ("count_distinct", "userid")})
    return rows.select(*CUBE_DIMS, F.col("grouping_id").cast("long").alias("grouping_id"), "n", "users")


def rollup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(analysis.rollup(_facts(spark, sf_dir), CUBE_DIMS, CUBE_MEASURES))


def grouping_sets_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [["eventtype", "segment"], ["day"], []]
    return _summary(analysis.grouping_sets(_facts(spark, sf_dir), sets, CUBE_DIMS, CUBE_MEASURES))


# -- SQL over ingested tables ------------------------------------------------------------


def sql_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.query(
        filled_store(spark, sf_dir), APP, "purchase",
        "SELECT eventid, userid, value * 2 AS doubled, upper(eventtype) AS kind FROM purchase WHERE value >= 10 AND props.k < 50",
    )


def sql_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.query(
        filled_store(spark, sf_dir), APP, "click",
        "SELECT eventid, userid, row_number() OVER w AS visit, value - lag(value) OVER w AS change "
        "FROM app_click WINDOW w AS (PARTITION BY userid ORDER BY eventtime, eventid)",
    )


def sql_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.query(
        filled_store(spark, sf_dir), APP, "order",
        "SELECT o_orderkey, o_custkey, o_totalprice FROM `order` ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    )


def sql_setops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.query(
        filled_store(spark, sf_dir), APP, ["click", "view", "error", "signup"],
        "(SELECT userid, cast(eventtime AS date) AS d FROM click INTERSECT SELECT userid, cast(eventtime AS date) FROM view) "
        "EXCEPT (SELECT userid, cast(eventtime AS date) FROM error UNION SELECT userid, cast(eventtime AS date) FROM signup)",
    )


def sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gateway.query(
        filled_store(spark, sf_dir), APP, ["purchase", "order"],
        # Counts per user are joined, not the pairs of a user's purchases and orders.
        "SELECT o.o_orderstatus, sum(p.n * o.n) AS pairs, count(*) AS users "
        "FROM (SELECT userid, count(*) AS n FROM purchase GROUP BY userid) p "
        "JOIN (SELECT o_custkey, o_orderstatus, count(*) AS n FROM `order` GROUP BY o_custkey, o_orderstatus) o "
        "ON p.userid = o.o_custkey GROUP BY o.o_orderstatus",
    )


def sql_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors within the hour after a signup of the same user."""
    return gateway.query(
        filled_store(spark, sf_dir), APP, ["signup", "error"],
        # Rows meet by user and hour: a signup looks in its own hour and the next.
        "WITH s AS (SELECT eventid, userid, eventtime, floor(unix_seconds(eventtime) / 3600) + next AS hour "
        "FROM signup LATERAL VIEW explode(array(0, 1)) AS next), "
        "e AS (SELECT eventid, userid, eventtime, floor(unix_seconds(eventtime) / 3600) AS hour FROM error), "
        "found AS (SELECT s.eventid, count(*) AS n FROM s JOIN e USING (userid, hour) "
        "WHERE e.eventtime >= s.eventtime AND e.eventtime < s.eventtime + INTERVAL 1 HOUR GROUP BY s.eventid) "
        "SELECT signup.eventid AS signup_id, coalesce(n, 0) AS errors FROM signup LEFT JOIN found USING (eventid)",
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in as JSON messages, stored in their tables, summed up by type with SQL."""
    store = filled_store(spark, sf_dir)
    parts = " UNION ALL ".join(f"SELECT eventtype, value FROM {c.table_name}" for c in event_configs())
    return gateway.query(
        store, APP, [c.event_type for c in event_configs()],
        f"SELECT eventtype, count(*) AS events, cast(sum(cast(value AS decimal(18,2))) AS double) AS total FROM ({parts}) GROUP BY eventtype",
    )


QUERIES = [
    flagship, ingest_typed, ingest_fields_missing_unknown, ingest_quarantine_counts, ingest_epoch_units, ingest_epoch_days,
    ingest_integers_bool, ingest_decimal, ingest_special_floats, ingest_json_text, ingest_nested, ingest_object_as_array,
    ingest_root_array_explode, ingest_syntax_options, ingest_texts, ingest_vectors, route_table_counts, registered_semi,
    unregistered_anti, registry_duplicates, application_keys, mapped_columns, publish_envelope, upsert_latest,
    upsert_two_batches, read_base_and_deltas, read_during_compaction, upsert_root_lists, quarantine_table, widened_columns, mapped_nested_columns,
    ingest_many_types, ingest_repeated_fields, ingest_times_without_dates, agg_stream_new_checkpoint, append_two_streams, cube_users, sink_types_roundtrip, stream_ingest, stream_resume, stream_progress, saved_offsets,
    agg_stream_tumbling, agg_stream_sliding, agg_stream_late, agg_stream_session, enrich_stream, agg_batch, agg_approx_users,
    enrich_dimension, cube_events, rollup_events, grouping_sets_events, sql_filter_project, sql_window, sql_topk, sql_setops,
    sql_join, sql_range_join, *timeline.QUERIES,
]
