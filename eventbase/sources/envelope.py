"""Message envelopes: the columns every source delivers and every step expects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Rows that one task parses, about.
TASK_ROWS = 250_000


def decode(df: DataFrame) -> DataFrame:
    """Key and body as text; partition and offset kept, as they give the order of writes."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in ENVELOPE])


def envelope(
    df: DataFrame, key: Column, body: Column, partition: Column, offset: Column, topic: str = "events"
) -> DataFrame:
    """Build envelopes from any table."""
    return df.select(
        key.alias("key"),
        body.alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def read_envelope_folder(spark: SparkSession, path: str) -> DataFrame:
    return decode(spark.read.schema(ENVELOPE).parquet(path))


def stream_envelope_folder(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same messages as a stream of parquet files."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode(reader.parquet(path))


def spread(scan: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Split an input that has fewer partitions than tasks can run at once, or partitions of too many rows.

    Parsing is bound by the processor: a single file or a topic with one partition would keep it on one core, and
    a few million rows of a well compressed file would make a task last for half an hour. An input with enough partitions
    is left as it is. Meant for plain scans, whose partitions and rows are known from the files' footers.
    """
    wanted = max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // task_rows))
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    # A scan gives its rows in the same order each time, so they can be dealt by their numbers; without a number
    # Spark sorts them first, lest a repeated task deals them otherwise.
    number = F.monotonically_increasing_id() % wanted
    return scan.withColumn("__number", number.cast("int")).repartitionById(wanted, F.col("__number")).drop("__number")
