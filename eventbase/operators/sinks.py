"""From parsed messages to what is written: table rows, quarantine and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions.json_records import ELEMENT
from eventbase.operators.keyed_table import ORDER
from eventbase.operators.registry import EventConfig, with_key
from eventbase.sources.envelope import ENVELOPE

# Reasons for messages that never reach, or do not fit, a table.
UNREGISTERED = "unregistered"
NULL_KEY = "null_key"
SCHEMA_CONFLICT = "schema_conflict"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _column(name: str, column: str, dtype: T.DataType, config: EventConfig) -> str:
    """SQL of one table column taken from the parsed row."""
    value = ".".join(["row", *map(_quoted, config.path_of(name))])
    if config.type_of(name) != dtype:
        value = f"CAST({value} AS {dtype.simpleString()})"
    return value


def order_schema(config: EventConfig) -> T.StructType:
    types = {column: dtype for _, column, dtype in config.columns}
    return T.StructType(
        [
            *[T.StructField(c, types[c]) for c in config.order_by],
            T.StructField("__epoch", T.IntegerType()),
            T.StructField("__partition", T.IntegerType()),
            T.StructField("__offset", T.LongType()),
            T.StructField("__element", T.IntegerType()),
        ]
    )


def table_rows(records: DataFrame, config: EventConfig, source_epoch: int = 0, *kept: str) -> DataFrame:
    """Good records of one event type as typed table columns, bound by name.

    The order column says which write of a key is the later one: by the declared columns,
    then by arrival: the epoch of the source, partition, offset, and the place in a list of records.
    """
    values = {column: _column(name, column, dtype, config) for name, column, dtype in config.columns}
    declared = [f"{values[c]} AS {_quoted(c)}" for c in config.order_by]
    element = f"`{ELEMENT}`" if ELEMENT in records.columns else "0"
    arrival = [f"{source_epoch:d} AS __epoch", "`partition` AS __partition", "`offset` AS __offset", f"{element} AS __element"]
    order = ", ".join([*declared, *arrival])
    return records.selectExpr(
        *[f"{value} AS {_quoted(column)}" for column, value in values.items()],
        f"struct({order}) AS {ORDER}",
        *kept,
    )


def null_key(config: EventConfig) -> Column:
    """True for a record without a full primary key."""
    fields = {column: name for name, column, _ in config.columns}
    found = F.lit(False)
    for column in config.primary_key:
        value = F.col("row")
        for step in config.path_of(fields[column]):
            value = value.getField(step)
        found = found | value.isNull()
    return F.col("reason").isNull() & found


def reject_null_keys(parsed: DataFrame, configs: list[EventConfig]) -> DataFrame:
    """Turn records that lack a primary key value into rejected ones."""
    lacks_key = F.lit(False)
    for config in configs:
        lacks_key = lacks_key | ((F.col("key") == config.key) & null_key(config))
    return parsed.withColumn("__lacks", lacks_key).select(
        *[c for c in parsed.columns if c not in ("row", "reason")],
        F.when(~F.col("__lacks"), F.col("row")).alias("row"),
        F.when(F.col("__lacks"), F.lit(NULL_KEY)).otherwise(F.col("reason")).alias("reason"),
    )


def rejected(parsed: DataFrame) -> DataFrame:
    """Quarantine rows: the message as it came, the reason and the fields at fault."""
    return parsed.filter("reason is not null").select(*ENVELOPE.fieldNames(), "reason", "bad_fields")


def all_rejected(messages: DataFrame, reason: str) -> DataFrame:
    return messages.select(
        *ENVELOPE.fieldNames(),
        F.lit(reason).alias("reason"),
        F.array().cast("array<string>").alias("bad_fields"),
    )


def progress(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """What a batch covers: offsets per partition and registered key (null: not registered).

    For people to read, and for the batch itself to know which event types are in it; the
    checkpoint is what restarts use.
    """
    known = with_key(registry).select(F.col("key").alias("__known"))
    marked = messages.select("key", "topic", "partition", "offset").join(
        known, F.col("key") == F.col("__known"), "left"
    )
    return marked.groupBy("topic", "partition", F.col("__known").alias("key")).agg(
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count("*").alias("messages"),
    )
