"""Rows in order, without gathering a key in one task: enrichment by time, running numbers and sums.

Rows are laid out by range on key and order and written, so each *part* is a run of the whole order and a key that holds
most rows is many parts. Windows run inside a part; what a part must know of those before it (how many rows, which sums,
which last value) is one row per key and part, and only of keys that lie in several parts. Such keys are no more than
there are parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventbase.session import shared_folder


def written(df: DataFrame) -> DataFrame:
    """Write rows to the shared folder and read them again: later steps neither repeat nor change them."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _in_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    return written(numbered.repartitionByRange(*order, "__row").withColumn("__part", F.spark_partition_id()))


def _earlier(parts: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], lasts: Mapping[str, Column]) -> DataFrame:
    """For keys that lie in several parts: per part, the sums and last values of the parts before it."""
    measured = parts.groupBy(*keys, "__part").agg(*(c.alias(n) for n, c in {**sums, **lasts}.items()))
    spread = measured.withColumn("__parts", F.count("*").over(Window.partitionBy(*keys))).filter("__parts > 1")
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return spread.select(
        *(F.col(k).alias(f"__of_{k}") for k in keys), F.col("__part").alias("__of_part"),
        *(F.sum(n).over(before).alias(n) for n in sums), *(F.last(n, True).over(before).alias(n) for n in lasts),
    )


def _with_earlier(rows: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> DataFrame:
    met = rows["__part"] == earlier["__of_part"]
    for k in keys:
        met = met & rows[k].eqNullSafe(earlier[f"__of_{k}"])
    return rows.join(earlier, met, "left")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    sums: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add per key, in ascending ``order`` (nulls first): the row's ``number`` from 1, running ``sums`` and ``lags``.

    ``sums`` and ``lags`` map a new column to the one it is of. A running sum is null until a value has come. Rows that tie
    are taken in the order they are read. Null keys are a key.
    """
    sums, lags = dict(sums or {}), dict(lags or {})
    parts = _in_parts(df, [*keys, *order])
    place = Window.partitionBy("__part", *keys).orderBy(*order, "__row")
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.struct(*order, "__row", *(F.col(c).alias(f"__last_{n}") for n, c in lags.items())))
    earlier = _earlier(parts, keys, {"__n": F.count("*"), **{f"__sum_{n}": F.sum(c) for n, c in sums.items()}}, {"__last": last})
    within = parts.withColumn("__number", F.row_number().over(place))
    within = within.withColumns({f"__run_{n}": F.sum(c).over(upto) for n, c in sums.items()})
    within = within.withColumns({f"__lag_{n}": F.lag(c).over(place) for n, c in lags.items()})
    rows = _with_earlier(within, earlier, keys)
    added = [(F.col("__number") + F.coalesce("__n", F.lit(0))).alias(number)] if number else []
    for n in sums:
        run, before = F.col(f"__run_{n}"), F.col(f"__sum_{n}")
        added.append(F.coalesce(run + before, run, before).alias(n))
    for n in lags:
        lag = F.when(F.col("__number") > 1, F.col(f"__lag_{n}")).otherwise(F.col(f"__last.__last_{n}"))
        added.append(lag.alias(n))
    return rows.select(*(F.col(c) for c in df.columns), *added)


def enrich_asof(
    df: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str,
    valid_from: str,
    columns: Sequence[str],
) -> DataFrame:
    """Add columns of the version of a dimension that was valid at each event's time: the last with ``valid_from`` at or before it.

    ``on`` maps event columns to columns of the dimension. Both tables are merged into one order and every event takes the last
    version before it, so no event is compared with a version it does not get. Of versions of one key and time the one
    with the greatest values in ``columns`` counts. Events without a time, without a key or before any version get nulls;
    versions without a time or key are not looked at.
    """
    keys = [f"__key_{n}" for n in range(len(on))]
    event_keys, version_keys = [F.col(c) for c in on], [F.col(c) for c in on.values()]
    known = F.col(at).isNotNull()
    for c in event_keys:
        known = known & c.isNotNull()
    stated = F.col(valid_from).isNotNull()
    for c in version_keys:
        stated = stated & c.isNotNull()
    event, version = F.struct(*df.columns), F.struct(*columns)
    kinds = {"event": df.select(event.alias("e")).schema["e"].dataType, "version": versions.select(version.alias("v")).schema["v"].dataType}
    events = df.filter(known).select(
        *(c.alias(k) for c, k in zip(event_keys, keys)), F.col(at).cast("timestamp").alias("__at"), F.lit(1).alias("__is_event"),
        F.lit(None).cast(kinds["version"]).alias("__version"), event.alias("__event"),
    )
    stated_versions = versions.filter(stated).select(
        *(c.alias(k) for c, k in zip(version_keys, keys)), F.col(valid_from).cast("timestamp").alias("__at"), F.lit(0).alias("__is_event"),
        version.alias("__version"), F.lit(None).cast(kinds["event"]).alias("__event"),
    )
    order = ["__at", "__is_event", "__version"]
    parts = _in_parts(stated_versions.unionByName(events), [*keys, *order])
    place = Window.partitionBy("__part", *keys).orderBy(*order, "__row").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("__is_event") == 0, F.struct("__at", F.col("__version").alias("version"))))
    earlier = _earlier(parts, keys, {}, {"__last": last})
    within = parts.withColumn("__own", F.last("__version", True).over(place)).filter("__is_event = 1")
    rows = _with_earlier(within, earlier, keys)
    found = F.coalesce("__own", "__last.version")
    rows = rows.withColumn("__found", found)
    met = rows.select(*(F.col("__event").getField(c).alias(c) for c in df.columns), *(F.col("__found").getField(c).alias(c) for c in columns))
    nothing = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns]
    return met.unionByName(df.filter(~F.coalesce(known, F.lit(False))).select("*", *nothing))
