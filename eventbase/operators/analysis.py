"""Aggregation, multi-dimensional summaries and enrichment of ingested tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measure name -> (function, column); the column of "count" may be "*".
Measures = Mapping[str, tuple[str, str]]

_FUNCTIONS = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
}
# How partial results of a measure combine; the others need the rows themselves.
_COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _measure(function: str, column: str) -> Column:
    if function not in _FUNCTIONS:
        raise ValueError(f"unknown measure {function!r}; known: {sorted(_FUNCTIONS)}")
    return _FUNCTIONS[function]("*" if column == "*" else F.col(column))


def aggregate(df: DataFrame, keys: Sequence[str | Column], measures: Measures) -> DataFrame:
    """Grouped aggregation; Spark combines per task before it shuffles."""
    return df.groupBy(*keys).agg(*[_measure(f, c).alias(name) for name, (f, c) in measures.items()])


def _at_finest_grain(
    df: DataFrame, dims: Sequence[str], measures: Measures
) -> tuple[DataFrame, list[Column]] | None:
    """Measures summed up once per combination of all dimensions, and how to combine them.

    Summaries over many grouping sets copy every input row once per set. Starting from the
    finest grain, the copies are of groups and not of rows.
    """
    parts: dict[str, Column] = {}
    combined = []
    counted = sorted({column for function, column in measures.values() if function == "count_distinct"})
    own = {column: f"__distinct_{n}" for n, column in enumerate(counted)}
    for name, (function, column) in measures.items():
        if function in _COMBINE:
            parts[f"__{name}"] = _measure(function, column)
            combined.append(_COMBINE[function](f"__{name}").alias(name))
        elif function == "avg":
            parts[f"__{name}_sum"] = F.sum(column)
            parts[f"__{name}_n"] = F.count(column)
            average = F.try_divide(F.sum(f"__{name}_sum"), F.sum(f"__{name}_n"))
            combined.append(average.alias(name))
        elif function == "count_distinct":
            combined.append(F.count_distinct(own[column]).alias(name))
        elif function == "approx_count_distinct":
            parts[f"__{name}"] = F.hll_sketch_agg(F.col(column).cast("string"))
            combined.append(F.hll_sketch_estimate(F.hll_union_agg(f"__{name}")).alias(name))
        else:
            _measure(function, column)
            return None
    # Values counted as distinct join the grain: rows become one per combination and value.
    grain = [*dims, *(F.col(column).alias(name) for column, name in own.items())]
    aggregates = [c.alias(n) for n, c in parts.items()] or [F.lit(1).alias("__row")]
    return df.groupBy(*grain).agg(*aggregates), combined


def _summary(df: DataFrame, dims: Sequence[str], measures: Measures, group) -> DataFrame:
    reduced = _at_finest_grain(df, dims, measures)
    if reduced:
        df, columns = reduced
    else:
        columns = [_measure(f, c).alias(name) for name, (f, c) in measures.items()]
    return group(df).agg(F.grouping_id().alias("grouping_id"), *columns)


def cube(df: DataFrame, dims: Sequence[str], measures: Measures) -> DataFrame:
    """Every combination of the dimensions; ``grouping_id`` tells a subtotal from a null."""
    return _summary(df, dims, measures, lambda d: d.cube(*dims))


def rollup(df: DataFrame, dims: Sequence[str], measures: Measures) -> DataFrame:
    return _summary(df, dims, measures, lambda d: d.rollup(*dims))


def grouping_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str], measures: Measures
) -> DataFrame:
    wanted = [[F.col(c) for c in s] for s in sets]
    return _summary(df, dims, measures, lambda d: d.groupingSets(wanted, *dims))


def enrich(
    df: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    columns: Sequence[str],
    how: str = "left",
    one_match: bool = False,
) -> DataFrame:
    """Add columns of a dimension table; ``on`` maps event columns to dimension columns.

    The dimension should have each key once: an event gets a row per match. ``one_match`` makes sure of that,
    keeping of the rows of a key the one with the smallest values in ``columns``, at the price of a shuffle of the dimension.

    No broadcast is forced: Spark broadcasts a dimension whose size it knows to be small
    and otherwise shuffles both sides, splitting partitions of a key that many events share.
    """
    renamed = dimension.select(
        *[F.col(d).alias(f"__{d}") for d in on.values()],
        *[c for c in columns],
    )
    if one_match:
        keys = [f"__{d}" for d in on.values()]
        least = renamed.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("__row"))
        renamed = least.select(*keys, *[F.col("__row").getField(c).alias(c) for c in columns])
    condition = F.lit(True)
    for event_column, dimension_column in on.items():
        condition = condition & (df[event_column] == renamed[f"__{dimension_column}"])
    return df.join(renamed, condition, how).drop(*[f"__{d}" for d in on.values()])
