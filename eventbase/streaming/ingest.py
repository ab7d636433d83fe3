"""The ingest job: messages in, typed tables out, one micro-batch at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventbase.functions.json_records import parse_events
from eventbase.operators import sinks
from eventbase.operators.keyed_table import Delta, KeyedTable, bucket_of, key_width, latest_by_key
from eventbase.operators.registry import EventConfig, configs_of, unregistered, with_key
from eventbase.operators.store import EventStore
from eventbase.session import prepare
from eventbase.sources.envelope import ENVELOPE

# Fixed value: time between micro-batches when none is given.
DEFAULT_BATCH_MS = 4000


class BadRecords(RuntimeError):
    """Raised by ``on_bad="fail"``; the batch is then not committed."""


@dataclass(frozen=True)
class IngestOptions:
    on_bad: str = "quarantine"  # or "fail"
    lenient_floats: bool = False
    explode_root_array: bool = False
    json_options: Mapping[str, str] = field(default_factory=dict)
    # Keep the messages of a batch in memory (spilling to local disk). They are passed over four
    # times: for files, whose columns are read apart, that costs little; for Kafka it is a fetch.
    cache: bool = False
    # Number of partitions to split a batch into before parsing; None leaves it to the source.
    # Worth setting for a source with few partitions that has no splitting of its own.
    parse_partitions: int | None = None
    # With more distinct schemas in one batch than this, it is first laid out by schema: each
    # schema otherwise scans the whole batch.
    land_above: int = 4
    # Writes the rows of one table instead of the file tables: (config, rows, batch).
    sink: Callable[[EventConfig, DataFrame, str], None] | None = None
    # Tables written side by side.
    parallel_tables: int = 8
    # Compact a table when a batch finds this many deltas of earlier ones; None leaves it to another job.
    compact_every: int | None = 50
    # To be raised when a topic is made anew, so that its offsets, which start again, count as later.
    source_epoch: int = 0

    def __post_init__(self):
        if self.on_bad not in ("quarantine", "fail"):
            raise ValueError("on_bad is 'quarantine' or 'fail'")


def ingest_batch(
    messages: DataFrame, batch: str, store: EventStore, options: IngestOptions | None = None
) -> None:
    """Parse, route and store one batch. Safe to repeat with the same batch name.

    The registry is read here, so a change of schema takes effect at a batch boundary. Records
    are parsed once: the result is written to the shared folder, laid out by table, and each
    table reads its own part. Losing an executor then costs no second parse.
    """
    options = options or IngestOptions()
    landing = f"{store.root}/landing/{batch}"
    messages = messages.select(*ENVELOPE.fieldNames())
    if options.parse_partitions:
        messages = messages.repartition(options.parse_partitions)
    if options.cache:
        messages.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        registry = store.registry()
        covered = _settled(store, sinks.progress(messages, registry), f"{landing}/progress")
        counts = store.keys_in(covered)
        present = configs_of(with_key(registry).filter(F.col("key").isin([k for k in counts if k])))

        usable, conflicting = (present, []) if options.sink else _split_by_schema(store, present)
        bad: list[DataFrame] = []
        if None in counts:
            bad.append(sinks.all_rejected(unregistered(messages, registry), sinks.UNREGISTERED))
        if conflicting:
            refused = messages.filter(F.col("key").isin([c.key for c in conflicting]))
            bad.append(sinks.all_rejected(refused, sinks.SCHEMA_CONFLICT))

        groups: dict[tuple, list[EventConfig]] = {}
        for config in usable:
            groups.setdefault(config.parse_group, []).append(config)
        inputs = _inputs_by_group(messages, list(groups.values()), landing, store, options)

        rows: list[tuple[EventConfig, DataFrame]] = []
        together: list[tuple[str, list[tuple[int, EventConfig]], T.StructType]] = []
        parts: dict[int, list[DataFrame | None]] = {}

        def parse(n: int, configs: list[EventConfig], group_messages: DataFrame) -> None:
            parsed = parse_events(
                group_messages,
                configs[0].schema,
                epoch_unit=configs[0].epoch_unit,
                lenient_floats=options.lenient_floats,
                explode_root_array=options.explode_root_array,
                json_options=options.json_options,
            )
            parsed = sinks.reject_null_keys(parsed, configs)
            parts[n] = _laid_out(parsed, configs, f"{landing}/parsed-{n}", store)

        pairs = enumerate(zip(groups.values(), inputs))
        _at_once(store.spark, [partial(parse, n, g, m) for n, (g, m) in pairs], options.parallel_tables)
        for n, configs in enumerate(groups.values()):
            failed, *by_table = parts[n]
            if failed is not None:
                bad.append(sinks.rejected(failed))
            alike = [] if options.sink else _alike(configs, by_table)
            together += [(f"{landing}/parsed-{n}", some, by_table[some[0][0]].schema) for some in alike]
            done = {slot for some in alike for slot, _ in some}
            for slot, (config, part) in enumerate(zip(configs, by_table)):
                if slot in done:
                    continue
                if part is not None:
                    rows.append((config, sinks.table_rows(part, config, options.source_epoch)))
                elif not options.sink:
                    store.table(config).drop_batch(batch)

        if bad and options.on_bad == "fail":
            first = bad[0].select("reason", "key").first()
            raise BadRecords(f"batch {batch}: {first.reason} under key {first.key!r}")

        def quarantine() -> None:
            if bad:
                store.write_batch("quarantine", reduce(DataFrame.unionByName, bad), batch)
            else:
                store.drop_batch("quarantine", batch)

        def upsert(config: EventConfig, table_rows: DataFrame) -> None:
            if options.sink:
                options.sink(config, table_rows, batch)
                return
            _compact_if_due(store.table(config), batch, options).upsert(table_rows, batch)

        writes = [quarantine, *[partial(upsert, c, r) for c, r in rows]]
        writes += [partial(_upsert_together, store, batch, options, *some) for some in together]
        _at_once(store.spark, writes, options.parallel_tables)
        # Last, so that what it says is covered has been stored.
        store.write_batch("progress", covered, batch)
    finally:
        store.files.delete(landing)
        if options.cache:
            messages.unpersist()


def _compact_if_due(table: KeyedTable, batch: str, options: IngestOptions) -> KeyedTable:
    if options.compact_every and len(table.state().deltas) >= options.compact_every:
        # All batches but this one are committed; only they may be folded.
        table.compact(keep=[batch])
    return table


def _alike(configs: list[EventConfig], by_table: list[DataFrame | None]) -> list[list[tuple[int, EventConfig]]]:
    """Event types of one parse group whose tables have the same columns, keys and order, with their slots."""
    found: dict[tuple, list[tuple[int, EventConfig]]] = {}
    for slot, (config, part) in enumerate(zip(configs, by_table)):
        if part is not None:
            shape = (config.table_schema.json(), tuple(config.columns_from), config.primary_key, config.order_by)
            found.setdefault(shape, []).append((slot, config))
    return [some for some in found.values() if len(some) > 1]


def _upsert_together(
    store: EventStore,
    batch: str,
    options: IngestOptions,
    path: str,
    some: list[tuple[int, EventConfig]],
    schema: T.StructType,
) -> None:
    """Upsert the parsed records of many like tables in one job, whose output has a folder for each.

    Another small job counts rows and buckets for the tables' states; what is left per table are a few file calls.
    """
    spark, config = store.spark, some[0][1]
    folders = [f"{path}/__slot={slot}" for slot, _ in some]
    with_slot = T.StructType([*schema.fields, T.StructField("__slot", T.IntegerType())])
    records = spark.read.schema(with_slot).option("basePath", path).parquet(*folders)
    rows = sinks.table_rows(records, config, options.source_epoch, "__slot")
    # The key comes first: rows are sorted by it, and the few slots would tell hardly any two of them apart.
    latest = latest_by_key(rows, [*config.primary_key, "__slot"])
    if len(some) > 8:
        latest = latest.hint("rebalance", "__slot")  # as in _laid_out
    target = f"{store.root}/deltas/{batch}-{uuid.uuid4().hex[:8]}"
    latest.write.option("partitionOverwriteMode", "static").partitionBy("__slot").parquet(target)

    tables = {slot: store.table(c) for slot, c in some}
    numbers = {slot: table.state().buckets for slot, table in tables.items()}
    buckets = F.lit(store.buckets)
    for slot, number in numbers.items():
        if number != store.buckets:
            buckets = F.when(F.col("__slot") == slot, number).otherwise(buckets)
    written = spark.read.schema(T.StructType([*rows.schema.fields])).parquet(target)
    counted = written.groupBy("__slot").agg(
        F.count("*").alias("rows"),
        F.sum(key_width(config.primary_key)).alias("key_bytes"),
        F.collect_set(bucket_of(config.primary_key, buckets)).alias("buckets"),
    )
    found = {r["__slot"]: r for r in counted.collect()}  # one row per table

    def publish(slot: int) -> None:
        r = found[slot]
        delta = Delta(f"{target}/__slot={slot}", r["rows"], r["key_bytes"], sorted(r["buckets"]))
        _compact_if_due(tables[slot], batch, options).add_delta(batch, delta)

    _at_once(spark, [partial(publish, slot) for slot in tables], options.parallel_tables)


def _settled(store: EventStore, rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def _at_once(spark: SparkSession, jobs: list[Callable[[], None]], limit: int) -> None:
    """Run independent jobs side by side, so that small ones do not wait for large ones.

    The first failure is raised once all have ended; the batch is then not committed.
    """
    if not jobs:
        return
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, min(limit, len(jobs)))) as pool:
        running = [pool.submit(inherit(job)) for job in jobs]
    for job in running:
        job.result()


def _split_by_schema(
    store: EventStore, configs: list[EventConfig]
) -> tuple[list[EventConfig], list[EventConfig]]:
    """Event types whose table takes their registered columns, and those whose does not."""
    usable, conflicting = [], []
    for config in configs:
        try:
            store.ready_table(config)
            usable.append(config)
        except ValueError:
            conflicting.append(config)
    return usable, conflicting


def _inputs_by_group(
    messages: DataFrame,
    groups: list[list[EventConfig]],
    landing: str,
    store: EventStore,
    options: IngestOptions,
) -> list[DataFrame]:
    """The messages of each parse group.

    A few groups each filter the batch, which is at hand. Many would read it as many times,
    so it is written once, laid out by group, and each group reads its own folder. The
    rebalance splits a group that holds much of the batch and joins small ones.
    """
    if len(groups) <= options.land_above:
        return [messages.filter(F.col("key").isin([c.key for c in g])) for g in groups]
    numbered = pa.table(
        {
            "key": [c.key for g in groups for c in g],
            "__group": [n for n, g in enumerate(groups) for _ in g],
        }
    )
    group_of = store.spark.createDataFrame(numbered)  # local data of known size
    landed = messages.join(group_of, "key").hint("rebalance", "__group")
    landed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("__group").parquet(f"{landing}/messages")
    return [_folder(store, f"{landing}/messages/__group={n}", ENVELOPE) for n in range(len(groups))]


def _laid_out(
    parsed: DataFrame, configs: list[EventConfig], path: str, store: EventStore
) -> list[DataFrame | None]:
    """Parsed records written once: the rejected ones, then those of each event type.

    None stands for a part without records.
    """
    slot = F.when(F.col("reason").isNotNull(), F.lit(-1))
    for n, config in enumerate(configs):
        slot = slot.when(F.col("key") == config.key, F.lit(n))
    numbered = parsed.withColumn("__slot", slot)
    # The message itself is read again only where it was rejected.
    for c in ("key", "value", "topic", "timestamp"):
        numbered = numbered.withColumn(c, F.when(F.col("reason").isNotNull(), F.col(c)))
    if len(configs) > 8:
        # Otherwise every task would write a small file for each of many tables.
        numbered = numbered.hint("rebalance", "__slot")
    # Read once and deleted: dictionaries would cost more than they save.
    options = {"partitionOverwriteMode": "static", "parquet.enable.dictionary": "false"}
    numbered.write.mode("overwrite").options(**options).partitionBy("__slot").parquet(path)
    slots = range(-1, len(configs))
    return [_folder(store, f"{path}/__slot={n}", parsed.schema) for n in slots]


def _folder(store: EventStore, path: str, schema: T.StructType) -> DataFrame | None:
    """A folder just written; None where there was nothing to write."""
    if not store.files.exists(path):
        return None
    return store.spark.read.schema(schema).parquet(path)


def stream_of(batch: DataFrame) -> str:
    """A name for the stream a micro-batch belongs to: it stays the same for as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")[:8]


def run_ingest(
    messages: DataFrame,
    store: EventStore,
    *,
    checkpoint: str,
    options: IngestOptions | None = None,
    batch_ms: int = DEFAULT_BATCH_MS,
    available_now: bool = False,
    name: str = "ingest",
) -> StreamingQuery:
    """Start the ingest stream.

    Delivery is at least once: after a crash the last batch is repeated. Batches are named
    after the stream, so a repeated one replaces itself and a new stream never does.
    """
    prepare(store.spark)
    def one_batch(batch_messages: DataFrame, batch_id: int) -> None:
        # Unique per checkpoint, and sorted by time within one.
        session = prepare(batch_messages.sparkSession)
        bound = EventStore(session, store.root, store.buckets)
        ingest_batch(batch_messages, f"{stream_of(batch_messages)}-{batch_id:09d}", bound, options)

    writer = messages.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{batch_ms} milliseconds")
    return writer.foreachBatch(one_batch).start()


def print_stream(messages: DataFrame) -> StreamingQuery:
    """Show messages on the driver's console, for debugging only."""
    return messages.writeStream.format("console").option("truncate", "false").start()
