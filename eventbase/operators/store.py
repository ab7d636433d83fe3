"""Where an installation keeps its data: registry, tables, quarantine and progress."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.operators import registry as reg
from eventbase.operators.keyed_table import KeyedTable, empty
from eventbase.operators.registry import EventConfig
from eventbase.operators.sinks import order_schema
from eventbase.sources.envelope import ENVELOPE
from eventbase.sources.files import Files

QUARANTINE = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField("reason", T.StringType()),
        T.StructField("bad_fields", T.ArrayType(T.StringType())),
        T.StructField("batch", T.StringType()),
    ]
)
PROGRESS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("min_offset", T.LongType()),
        T.StructField("max_offset", T.LongType()),
        T.StructField("messages", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


class EventStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.files = Files(spark, self.root)

    # -- registry --------------------------------------------------------------------

    def register(self, configs: Iterable[EventConfig]) -> None:
        """Add event types, or change known ones; takes effect at the next batch."""
        new = {c.key: c for c in configs}
        known = {c.key: c for c in self.configs()} if self.files.exists(f"{self.root}/registry") else {}
        merged = list((known | new).values())
        if len({c.table_name for c in merged}) < len(merged):
            raise ValueError("two event types name the same table")
        # Keys are unique by construction here.
        reg.write_registry(reg.registry_frame(self.spark, merged), f"{self.root}/registry")

    def registry(self) -> DataFrame:
        return reg.load_registry(self.spark, f"{self.root}/registry")

    def configs(self) -> list[EventConfig]:
        return reg.configs_of(self.registry())

    # -- tables ----------------------------------------------------------------------

    def table(self, config: EventConfig, spark: SparkSession | None = None) -> KeyedTable:
        return KeyedTable(spark or self.spark, f"{self.root}/tables/{config.table_name}")

    def ready_table(self, config: EventConfig) -> KeyedTable:
        """The table of an event type, created or widened to its registered columns.

        Any other change, of the key or the order of writes too, is a ValueError.
        """
        table = self.table(config)
        state = table.find_state()
        if state:
            if state.primary_key != list(config.primary_key):
                raise ValueError(f"{config.table_name} has the primary key {state.primary_key}")
            if state.order_schema != order_schema(config).json():
                raise ValueError(f"{config.table_name} orders its writes by {state.order_schema}")
            if state.schema != config.table_schema.json():
                table.add_columns(config.table_schema)
            return table
        return table.create(
            config.table_schema, config.primary_key, order_schema(config), buckets=self.buckets
        )

    # -- append-only records ---------------------------------------------------------

    def write_batch(self, name: str, rows: DataFrame, batch: str) -> None:
        """One folder per batch, replaced as a whole when the batch is replayed."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def drop_batch(self, name: str, batch: str) -> None:
        """Nothing to keep for this batch, whatever an earlier attempt at it wrote."""
        self.files.delete(f"{self.root}/{name}/batch={batch}")

    def keys_in(self, covered: DataFrame) -> dict[str | None, int]:
        """Messages per registered key, from progress rows; None stands for all that are not registered."""
        counts = covered.groupBy("key").agg(F.sum("messages").alias("n"))
        return {r["key"]: r["n"] for r in counts.collect()}  # one row per registered key

    def maintain(self, keep_hours: float = 48.0, compact: bool = True) -> None:
        """Upkeep of all tables, to be run beside readers but not beside a writer."""
        for config in self.configs():
            table = self.table(config)
            if table.exists():
                if compact:
                    table.compact()
                table.expire(keep_hours)

    def _read_batches(self, name: str, schema: T.StructType) -> DataFrame:
        if not self.files.names(f"{self.root}/{name}"):
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def quarantine(self) -> DataFrame:
        return self._read_batches("quarantine", QUARANTINE)

    def progress(self) -> DataFrame:
        return self._read_batches("progress", PROGRESS)
