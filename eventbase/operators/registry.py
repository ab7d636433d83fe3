"""Registered applications and event types: schema, target table and column mapping."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventbase.functions.json_records import EPOCH_UNITS
from eventbase.functions.keys import KEY_SEPARATOR, message_key
from eventbase.sources.files import Files

REGISTRY = T.StructType(
    [
        T.StructField("app_key", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("schema_json", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("primary_key", T.ArrayType(T.StringType(), False), False),
        T.StructField("column_map", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("column_types", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("epoch_unit", T.StringType(), False),
        T.StructField("order_by", T.ArrayType(T.StringType(), False), False),
        T.StructField("fields", T.ArrayType(T.StringType(), False), False),
    ]
)

_SCALARS = (
    T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.FloatType, T.DoubleType, T.DecimalType,
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType,
)
_WIDER = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def struct_from_pairs(pairs: Iterable[tuple[str, object]]) -> T.StructType:
    """A schema from (field, type) pairs; a type is a Spark type name or its JSON object."""
    fields = [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in pairs]
    return T.StructType.fromJson({"type": "struct", "fields": fields})


def storable(dtype: T.DataType) -> T.DataType:
    """The type as events can hold it: user-defined types give way to their SQL type."""
    if isinstance(dtype, T.UserDefinedType):
        return storable(dtype.sqlType())
    if isinstance(dtype, T.StructType):
        lowered = [f.name.lower() for f in dtype]
        if len(set(lowered)) < len(lowered):
            raise ValueError(f"field names must differ by more than case: {dtype.fieldNames()}")
        return T.StructType([T.StructField(f.name, storable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(storable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        if type(dtype.keyType) is not T.StringType:
            raise ValueError("map keys must be strings")
        return T.MapType(T.StringType(), storable(dtype.valueType))
    if type(dtype) in _SCALARS:  # exact types: char and varchar are kinds of string
        return dtype
    raise ValueError(f"events cannot hold values of type {dtype.simpleString()}")


def _keeps_values(source: T.DataType, target: T.DataType) -> bool:
    """Whether a column type can take every value of a field type."""
    if source == target or isinstance(target, T.StringType):
        return True
    a, b = source.simpleString(), target.simpleString()
    if a in _WIDER and b in _WIDER:
        return _WIDER.index(a) < _WIDER.index(b)
    return isinstance(source, T.TimestampType) and isinstance(target, T.DateType)


@dataclass(frozen=True)
class EventConfig:
    """One registered (application key, event type)."""

    app_key: str
    event_type: str
    schema: T.StructType
    primary_key: Sequence[str]
    table_name: str = ""
    column_map: dict[str, str] = field(default_factory=dict)
    column_types: dict[str, str] = field(default_factory=dict)
    epoch_unit: str = "ms"
    # Columns that decide which write of a key is the last; arrival order when empty.
    order_by: Sequence[str] = ()
    # Fields that are stored, in the order of the table's columns; all of the schema when empty. A field inside
    # structs is named by its path ("props.k"); its column is the path with "_" unless mapped.
    fields: Sequence[str] = ()

    def __post_init__(self):
        if not self.app_key or not self.event_type or KEY_SEPARATOR in self.app_key:
            raise ValueError(f"an application key is not empty and has no {KEY_SEPARATOR!r} in it")
        if self.epoch_unit not in EPOCH_UNITS:
            raise ValueError(f"epoch_unit must be one of {sorted(EPOCH_UNITS)}")
        object.__setattr__(self, "schema", storable(self.schema))
        object.__setattr__(self, "primary_key", tuple(self.primary_key))
        object.__setattr__(self, "order_by", tuple(self.order_by))
        object.__setattr__(self, "fields", tuple(self.fields))
        if not self.table_name:
            object.__setattr__(self, "table_name", f"{self.app_key}_{self.event_type}")
        for name in self.fields:
            self.type_of(name)
        unknown = set(self.column_map) - set(self.stored)
        if unknown:
            raise ValueError(f"mapped fields are not stored: {sorted(unknown)}")
        columns = self.table_schema
        if len({c.lower() for c in columns.fieldNames()}) < len(columns):
            raise ValueError("two fields map to one column")
        for name in (*self.primary_key, *self.order_by):
            if name not in columns.fieldNames() or not isinstance(columns[name].dataType, _SCALARS):
                raise ValueError(f"key or order column {name!r} must be a scalar column of the table")
        if not self.primary_key:
            raise ValueError("a primary key is required")

    @property
    def key(self) -> str:
        return f"{self.app_key}{KEY_SEPARATOR}{self.event_type}"

    @property
    def stored(self) -> tuple[str, ...]:
        """The fields that are stored, those inside structs by their path."""
        return self.fields or tuple(self.schema.fieldNames())

    def path_of(self, name: str) -> list[str]:
        """The names to follow to a stored field; a top-level field may have dots in its name."""
        return [name] if name in self.schema.fieldNames() else name.split(".")

    def type_of(self, name: str) -> T.DataType:
        dtype: T.DataType = self.schema
        for step in self.path_of(name):
            if not isinstance(dtype, T.StructType) or step not in dtype.fieldNames():
                raise ValueError(f"stored field is not in the schema: {name!r}")
            dtype = dtype[step].dataType
        return dtype

    @property
    def columns(self) -> list[tuple[str, str, T.DataType]]:
        """(stored field, table column, column type) in the order of the table."""
        found = []
        for name in self.stored:
            column = self.column_map.get(name, "_".join(self.path_of(name)))
            own = dtype = self.type_of(name)
            if column in self.column_types:
                dtype = T.DataType.fromDDL(self.column_types[column])
                if not _keeps_values(own, dtype):
                    raise ValueError(f"column {column!r}: {dtype.simpleString()} cannot hold every {own.simpleString()}")
            found.append((name, column, dtype))
        return found

    @property
    def columns_from(self) -> list[tuple[str, str]]:
        """(stored field, table column)"""
        return [(name, column) for name, column, _ in self.columns]

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType([T.StructField(column, dtype) for _, column, dtype in self.columns])

    @property
    def parse_group(self) -> tuple[str, str]:
        """Event types with equal parsing rules are parsed together."""
        return self.schema.json(), self.epoch_unit

    def as_row(self) -> tuple:
        return (
            self.app_key, self.event_type, self.schema.json(), self.table_name, list(self.primary_key),
            dict(self.column_map), dict(self.column_types), self.epoch_unit,
            list(self.order_by), list(self.fields),
        )

    @classmethod
    def from_row(cls, row: T.Row) -> EventConfig:
        return cls(
            row["app_key"], row["event_type"], T.StructType.fromJson(json.loads(row["schema_json"])),
            row["primary_key"], row["table_name"], dict(row["column_map"]), dict(row["column_types"]),
            row["epoch_unit"], row["order_by"], row["fields"],
        )


def registry_frame(spark: SparkSession, configs: Iterable[EventConfig]) -> DataFrame:
    # As an Arrow table it is local data of a size Spark knows, so joins can broadcast it.
    rows = [dict(zip(REGISTRY.fieldNames(), c.as_row())) for c in configs]
    for row in rows:
        row["column_map"] = list(row["column_map"].items())
        row["column_types"] = list(row["column_types"].items())
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(REGISTRY)), REGISTRY)


def duplicate_keys(registry: DataFrame) -> DataFrame:
    """Keys registered more than once; a registry must have none."""
    return registry.groupBy("app_key", "event_type").agg(F.count("*").alias("entries")).filter("entries > 1")


def write_registry(registry: DataFrame, path: str) -> None:
    """Add a version; it lies beside the one in use until it is complete."""
    latest = max(_versions(Files(registry.sparkSession, path), path), default=0)
    registry.coalesce(1).write.mode("overwrite").parquet(f"{path}/{latest + 1}")


def _versions(files: Files, path: str) -> list[int]:
    return [int(n) for n in files.names(path) if n.isdigit() and files.exists(f"{path}/{n}/_SUCCESS")]


def save_registry(registry: DataFrame, path: str) -> None:
    """Replace the stored registry, after a check that no key is in it twice."""
    clash = duplicate_keys(registry).first()
    if clash:
        raise ValueError(f"registered twice: {clash['app_key']}{KEY_SEPARATOR}{clash['event_type']}")
    write_registry(registry, path)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    versions = _versions(Files(spark, path), path)
    if not versions:
        raise FileNotFoundError(f"no registry at {path}")
    return spark.read.schema(REGISTRY).parquet(f"{path}/{max(versions)}")


def configs_of(registry: DataFrame) -> list[EventConfig]:
    """Registry rows as objects. Bounded by what administrators registered, not by data."""
    return [EventConfig.from_row(r) for r in registry.collect()]


def with_key(registry: DataFrame) -> DataFrame:
    return registry.withColumn("key", message_key(F.col("app_key"), F.col("event_type")))


def registered(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages whose key is registered."""
    return messages.join(with_key(registry).select("key"), "key", "left_semi")


def unregistered(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Messages whose key is not registered, those without a key included."""
    return messages.join(with_key(registry).select("key"), "key", "left_anti")


def route(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``table_name``; null where the key is not registered.

    The registry is read from files whose size Spark knows, so a small one is broadcast
    and a large one is shuffled; no hint forces either.
    """
    tables = with_key(registry).select("key", "table_name")
    return messages.join(tables, "key", "left")
