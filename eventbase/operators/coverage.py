"""Which offsets of a topic the batches of a stream have covered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def offset_gaps(ranges: DataFrame) -> DataFrame:
    """Rows (topic, partition, kind, first_offset, last_offset) from rows (topic, partition, min_offset, max_offset).

    ``missing`` lies between ranges and in none; ``repeated`` is the part of a range that ranges starting no later have covered.
    Rows are batches, as ``EventStore.progress`` gives them: a window per partition of a topic holds few. Rows without
    bounds or with a start beyond the end say nothing.
    """
    known = ranges.filter("min_offset <= max_offset")
    earlier = Window.partitionBy("topic", "partition").orderBy("min_offset", "max_offset").rowsBetween(Window.unboundedPreceding, -1)
    seen = known.withColumn("upto", F.max("max_offset").over(earlier))
    hole = F.struct(F.lit("missing").alias("kind"), (F.col("upto") + 1).alias("first_offset"), (F.col("min_offset") - 1).alias("last_offset"))
    again = F.struct(
        F.lit("repeated").alias("kind"), F.col("min_offset").alias("first_offset"), F.least("max_offset", "upto").alias("last_offset")
    )
    found = F.when(F.col("min_offset") > F.col("upto") + 1, hole).when(F.col("min_offset") <= F.col("upto"), again)
    return seen.select("topic", "partition", found.alias("found")).filter("found is not null").select("topic", "partition", "found.*")
