"""Messages derived from the given tables, and stores filled with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions.json_records import parse_events
from eventbase.operators.publish import to_messages
from eventbase.operators.registry import EventConfig, struct_from_pairs
from eventbase.operators.store import EventStore
from eventbase.session import prepare, shared_folder
from eventbase.sources.envelope import envelope, spread
from eventbase.streaming.ingest import IngestOptions, ingest_batch

APP = "app"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fields(**types: object) -> T.StructType:
    return struct_from_pairs(types.items())


EVENT_SCHEMA = fields(
    eventid="long", eventtime="timestamp", eventtype="string", userid="long", value="double",
    props=fields(k="integer").jsonValue(),
)
ORDER_SCHEMA = fields(
    o_orderkey="long", o_custkey="long", o_orderstatus="string", o_totalprice="double",
    o_orderdate="date", o_orderpriority="string",
)


def time_text(column: str) -> Column:
    return F.date_format(column, TIME_TEXT)


def event_body() -> list[Column]:
    return [
        F.col("event_id").alias("eventid"),
        time_text("ts").alias("eventtime"),
        F.col("event_type").alias("eventtype"),
        F.col("user_id").alias("userid"),
        F.col("value"),
        F.from_json("props", "k int").alias("props"),
    ]


def event_messages(events: DataFrame, to_parse: bool = True) -> DataFrame:
    """One message per event: partition by user, offset by event."""
    events = spread(events) if to_parse else events
    keyed = to_messages(
        events, F.lit(APP), F.col("event_type"), event_body(), "event_id", "user_id"
    )
    return envelope(keyed, F.col("key"), F.col("value"), F.col("user_id") % 4, F.col("event_id"))


def order_messages(orders: DataFrame) -> DataFrame:
    body = [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    ]
    keyed = to_messages(spread(orders), F.lit(APP), F.lit("order"), body, "o_orderkey")
    return envelope(keyed, F.col("key"), F.col("value"), F.lit(0), F.col("o_orderkey"))


def event_configs(primary_key: tuple[str, ...] = ("eventid",)) -> list[EventConfig]:
    return [EventConfig(APP, e, EVENT_SCHEMA, primary_key) for e in EVENT_TYPES]


ORDER_CONFIG = EventConfig(APP, "order", ORDER_SCHEMA, ["o_orderkey"])


def new_store(spark: SparkSession, configs: list[EventConfig], buckets: int = 8) -> EventStore:
    store = EventStore(prepare(spark), shared_folder(spark), buckets=buckets)
    store.register(configs)
    return store


_filled: dict[tuple[str, str], EventStore] = {}


def filled_store(spark: SparkSession, sf_dir: str) -> EventStore:
    """All events and orders, ingested once per application and folder."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _filled:
        store = new_store(spark, [*event_configs(), ORDER_CONFIG])
        messages = event_messages(table(spark, sf_dir, "events")).unionByName(
            order_messages(table(spark, sf_dir, "orders"))
        )
        ingest_batch(messages, "all", store, IngestOptions())
        _filled[known] = store
    return _filled[known]


def parsed(df: DataFrame, body: Column, schema: T.StructType, *carried: str, **options) -> DataFrame:
    """Parse a body made from each row of a table, keeping the named columns."""
    return parse_events(spread(df).select(*carried, body.alias("value")), schema, **options)


def no_zone(column: str) -> Column:
    """Timestamps leave queries without a zone, as they came."""
    return F.col(column).cast("timestamp_ntz")
