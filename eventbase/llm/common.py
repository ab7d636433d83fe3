"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventbase.session import shared_folder
from eventbase.sources.files import Files

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# Spark's setting by which the shuffle files of a statement go when it ends, and not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and read it again: what follows never computes it twice.

    The shuffle files it took are deleted: only the statement that writes reads them.
    """
    path = shared_folder(df.sparkSession)
    before = df.sparkSession.conf.get(_CLEANUP, None)
    df.sparkSession.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            df.sparkSession.conf.unset(_CLEANUP)
        else:
            df.sparkSession.conf.set(_CLEANUP, before)
    settled = df.sparkSession.read.parquet(path)
    _written[settled] = path
    return settled


def discard(*settled: DataFrame) -> None:
    """Delete what ``settle`` wrote. Only for results of which all that was made is settled itself."""
    for df in settled:
        if path := _written.pop(df, None):
            Files(df.sparkSession, path).delete(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that a table does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_rows(
    df: DataFrame, rows: Callable[[list[list]], Iterator[tuple]], schema: str | T.StructType, at_once: int = 64
) -> DataFrame:
    """Apply ``rows`` to the columns of a few rows at a time, as Python lists, and make rows of the tuples it yields.

    Few rows are held as Python objects at once, so one batch of long texts does not fill a worker.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                made = list(rows([c.to_pylist() for c in part.columns]))
                if made:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*made), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def arrow_filter(df: DataFrame, columns: list[str], keep: Callable[[list[list]], list[bool]], at_once: int = 64) -> DataFrame:
    """The rows for which ``keep`` says so, seeing the named columns of a few rows at a time."""
    places = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                kept = part.filter(pa.array(keep([part.column(i).to_pylist() for i in places]), pa.bool_()))
                if kept.num_rows:
                    yield kept

    return df.mapInArrow(run, df.schema)
