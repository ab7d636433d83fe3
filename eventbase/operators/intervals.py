"""Joins of intervals that overlap, as joins on equal bins.

Two intervals overlap if and only if one starts inside the other. So each side is once a set of starting points and
once a set of intervals. An interval lies on the lowest rung of a ladder of bin widths that is not narrower than it,
in the one or two bins it touches there; a point is looked up on every rung, in its one bin. A point and an interval
meet at most once, and long intervals are in a few wide bins instead of many narrow ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNGS = (0.5, 0.9, 0.99)  # quantiles of the lengths that are widths of bins; the greatest length is the last one


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def ladder(df: DataFrame, start: str, end: str, rungs: tuple[float, ...] = RUNGS) -> list[int]:
    """Widths in microseconds, ascending; the last is the greatest length. Empty if no interval has a length."""
    length = (_micros(end) - _micros(start)).alias("length")
    lengths = df.select(length).filter("length > 0")
    found = lengths.agg(F.max("length"), *(F.percentile_approx("length", q) for q in rungs)).first()
    return sorted({*found}) if found[0] else []


def _cast_on(df: DataFrame, side: str, columns: list[str], start: str, end: str) -> DataFrame:
    """Non-empty intervals with their keys, bounds and row under names of one side."""
    keys = [F.col(c).alias(f"__key_{n}") for n, c in enumerate(columns)]
    rows = df.select(*keys, _micros(start).alias(f"__{side}_start"), _micros(end).alias(f"__{side}_end"), F.struct(*df.columns).alias(f"__{side}"))
    return rows.filter(F.col(f"__{side}_start") < F.col(f"__{side}_end"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    rungs: tuple[float, ...] = RUNGS,
) -> DataFrame:
    """All pairs (``left``, ``right``: structs of the rows) whose keys agree and whose intervals [start, end) overlap.

    ``on`` maps columns of the left to those of the right and may be empty. Rows with a null key or bound and intervals
    that end at or before their start overlap with nothing. A key that holds most rows is spread over its bins.
    """
    a = _cast_on(left, "left", list(on), *left_interval)
    b = _cast_on(right, "right", list(on.values()), *right_interval)
    keys = [f"__key_{n}" for n in range(len(on))]

    def points_in(points: DataFrame, intervals: DataFrame, point: str, inside: str, widths: list[int], strict: bool) -> DataFrame:
        """Pairs of which the point side starts in the other's interval; strictly after its start if ``strict``."""
        start, end, at = F.col(f"__{inside}_start"), F.col(f"__{inside}_end"), F.col(f"__{point}_start")

        def bin_of(x: Column, width: int) -> Column:
            return F.floor(x / F.lit(width)).cast("long")

        rung = F.lit(len(widths) - 1)
        for n, width in reversed(list(enumerate(widths[:-1]))):
            rung = F.when(end - start <= width, n).otherwise(rung)
        bins = F.lit(None).cast("array<long>")
        for n, width in enumerate(widths):
            bins = F.when(F.col("__rung") == n, F.sequence(bin_of(start, width), bin_of(end - 1, width))).otherwise(bins)
        held = intervals.withColumn("__rung", rung).withColumn("__bin", F.explode(bins))
        each = F.array(*(F.struct(F.lit(n).alias("__rung"), bin_of(at, width).alias("__bin")) for n, width in enumerate(widths)))
        asked = points.select("*", F.inline(each))
        met = asked.join(held, [*keys, "__rung", "__bin"])
        return met.filter(((at > start) if strict else (at >= start)) & (at < end))

    # Without any interval of some length there are no pairs, whatever the width.
    in_right, in_left = ladder(right, *right_interval, rungs) or [1], ladder(left, *left_interval, rungs) or [1]
    pairs = [points_in(a, b, "left", "right", in_right, False), points_in(b, a, "right", "left", in_left, True)]
    found = [p.select(F.col("__left").alias("left"), F.col("__right").alias("right")) for p in pairs]
    return found[0].unionByName(found[1])
