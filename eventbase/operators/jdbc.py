"""Keyed tables in a relational database: stage with Spark's writer, then one MERGE."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.operators.keyed_table import ORDER, latest_by_key
from eventbase.operators.registry import EventConfig


def storable_columns(rows: DataFrame) -> DataFrame:
    """Lists, maps and structs as JSON text; everything else in its own type."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return rows.select(
        *[
            (F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
            for f in rows.schema
        ]
    )


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _later(columns: Sequence[str]) -> str:
    """SQL: the staged row's order is greater than the target's, or equal (a batch that is repeated)."""
    first, *rest = columns
    s, t = f"s.{_quoted(first)}", f"t.{_quoted(first)}"
    tie = f"({s} = {t} OR ({s} IS NULL AND {t} IS NULL))"
    after = f"({s} > {t} OR ({t} IS NULL AND {s} IS NOT NULL))"
    return f"({after} OR ({tie} AND {_later(rest)}))" if rest else f"({after} OR {tie})"


def merge_statement(
    target: str, staging: str, columns: Sequence[str], primary_key: Sequence[str], order_by: Sequence[str] = ()
) -> str:
    """Standard SQL upsert of a staging table, values bound by name.

    With ``order_by`` a row replaces another only if it is the later one; its columns are then part of the target.
    """
    missing = [k for k in primary_key if k not in columns]
    if missing or not primary_key:
        raise ValueError(f"primary key columns not among the columns: {missing}")
    match = " AND ".join(f"t.{_quoted(k)} = s.{_quoted(k)}" for k in primary_key)
    others = [c for c in columns if c not in primary_key]
    update = ""
    if others:
        assignments = ", ".join(f"{_quoted(c)} = s.{_quoted(c)}" for c in others)
        later = f" AND {_later(order_by)}" if order_by else ""
        update = f" WHEN MATCHED{later} THEN UPDATE SET {assignments}"
    names = ", ".join(_quoted(c) for c in columns)
    values = ", ".join(f"s.{_quoted(c)}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {staging} s ON {match}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def upsert_jdbc(
    rows: DataFrame,
    url: str,
    target: str,
    staging: str,
    primary_key: Sequence[str],
    *,
    statement: str | None = None,
    batch_size: int = 1000,
    connections: int = 16,
    **options: str,
) -> None:
    """Upsert rows (with an order column) into ``target``, which has the parts of the order as columns of their own.

    Executors fill the staging table over a bounded number of connections; the database
    merges it in one transaction. Any failure, that of the commit included, fails the batch.
    ``statement`` replaces the generated MERGE for databases with another syntax.
    """
    spark = rows.sparkSession
    latest = latest_by_key(rows, primary_key) if ORDER in rows.columns else rows
    order_by: list[str] = []
    if ORDER in rows.columns:
        order_by = latest.schema[ORDER].dataType.fieldNames()
        own = [F.col(f"{ORDER}.`{c}`").alias(c) for c in order_by if c not in rows.columns]
        latest = latest.select(*[F.col(f"`{c}`") for c in latest.columns if c != ORDER], *own)
    staged = storable_columns(latest)
    (
        staged.write.format("jdbc")
        .options(**{"url": url, "dbtable": staging, "batchsize": str(batch_size), **options})
        .option("numPartitions", connections)
        .mode("overwrite")
        .save()
    )
    sql = statement or merge_statement(target, staging, staged.columns, primary_key, order_by)
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    with contextlib.closing(connection):
        connection.setAutoCommit(False)
        with contextlib.closing(connection.createStatement()) as merge:
            merge.executeUpdate(sql)
        connection.commit()


def jdbc_sink(
    url: str, *, statements: Mapping[str, str] | None = None, **options
) -> Callable[[EventConfig, DataFrame, str], None]:
    """Sink of the ingest job that keeps every table in a database.

    ``statements`` maps table names, in any case, to a MERGE of the user's own.
    """
    own = {table.upper(): sql for table, sql in (statements or {}).items()}

    def write(config: EventConfig, rows: DataFrame, batch: str) -> None:
        table = config.table_name
        upsert_jdbc(
            rows, url, _quoted(table), _quoted(f"{table}__staging"), config.primary_key,
            statement=own.get(table.upper()), **options,
        )

    return write
