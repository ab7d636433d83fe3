"""Joins of two streams, and streams without what they deliver twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_streams(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    left_time: str,
    right_time: str,
    within: str,
    *,
    watermark: str,
    right_watermark: str | None = None,
    how: str = "left_outer",
) -> DataFrame:
    """Rows of ``left`` with those of ``right`` of the same key from the same moment on, up to and including ``within`` later.

    Both sides carry a watermark, so rows leave the state once nothing that can meet them may come any more. With "left_outer"
    a row that met nothing is given once, with nulls, when that is certain. Columns of both sides must have different names;
    ``on`` maps columns of the left to those of the right, both of which stay.
    """
    if clash := sorted(set(left.columns) & set(right.columns)):
        raise ValueError(f"columns of both sides: {clash}")
    left = left.withColumn(left_time, F.col(left_time).cast("timestamp")).withWatermark(left_time, watermark)
    right = right.withColumn(right_time, F.col(right_time).cast("timestamp")).withWatermark(right_time, right_watermark or watermark)
    met = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    for a, b in on.items():
        met = met & (F.col(a) == F.col(b))
    return left.join(right, met, how)


def without_repeats(stream: DataFrame, keys: Sequence[str], event_time: str, watermark: str) -> DataFrame:
    """A stream whose rows with equal ``keys`` are given once, however often and in whatever run they come.

    Keys are held until the watermark has passed the time of their first row by ``watermark``; a repeat that comes later than that is
    late and is dropped as such, so a sink that appends may be fed twice. State is as large as the keys of that span.
    Null keys are a key; rows without a time do not expire keys and count as a row of the key.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    return timed.dropDuplicatesWithinWatermark(list(keys))
