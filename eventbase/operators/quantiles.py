"""Quantiles and heavy keys per group, exact, without sorting or gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventbase.operators.ordered import written

BINS = 1024  # of a histogram


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], bins: int = BINS) -> DataFrame:
    """Rows (keys, ``n``, ``quantiles``): for each fraction p the value of rank ceil(p * n), at least 1, among the group's.

    Each round counts, per group and fraction, the rows between the bounds known so far in equal bins, with the least and the
    greatest value of each bin, and goes on inside the bin that holds the rank, until that has one value. Counts are summed up
    in each task first, so a group of any size costs a histogram; values that tie end at once. Nulls and values that are
    not finite are left out; a group without any other value has n = 0 and null quantiles.
    """
    number = F.col(value).cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    rows = df.select(*(F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)), F.when(finite, number).alias("__v"))
    own = [f"__key_{i}" for i in range(len(keys))]
    groups = written(rows.groupBy(*own).agg(F.count("__v").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high")))
    wanted = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(float(p)).alias("p")) for i, p in enumerate(fractions)))
    open_ = groups.filter("n > 0").select("*", F.inline(wanted))
    rank = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("n"))).cast("long")
    open_ = written(open_.select(*own, "nth", "low", "high", rank.alias("rank")))
    done = []
    while True:
        done.append(open_.filter("low = high").select(*own, "nth", F.col("low").alias("q")))
        open_ = open_.filter("low < high")
        if open_.isEmpty():
            break
        met = F.lit(True)
        bounds = open_.select(*(F.col(k).alias(f"__of{k}") for k in own), "nth", "low", "high", "rank")
        for k in own:
            met = met & rows[k].eqNullSafe(bounds[f"__of{k}"])
        inside = rows.join(bounds, met & rows["__v"].between(bounds["low"], bounds["high"]))
        # Halves of both ends: their difference is finite whatever they are.
        share = (F.col("__v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        bin_ = F.least(F.floor(share * bins), F.lit(bins - 1))
        counted = inside.groupBy(*own, "nth", "rank", bin_.alias("bin")).agg(
            F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high")
        )
        upto = Window.partitionBy(*own, "nth").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("upto", F.sum("n").over(upto))
        holds = (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))
        left = (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")
        open_ = written(counted.filter(holds).select(*own, "nth", "low", "high", left))
    values = done[0]
    for d in done[1:]:
        values = values.unionByName(d)
    listed = values.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("nth", "q"))).alias("listed"))
    listed = listed.select(*(F.col(k).alias(f"__of{k}") for k in own), F.transform("listed", lambda s: s["q"]).alias("quantiles"))
    met = F.lit(True)
    for k in own:
        met = met & groups[k].eqNullSafe(listed[f"__of{k}"])
    return groups.join(listed, met, "left").select(*(F.col(k).alias(c) for k, c in zip(own, keys)), "n", "quantiles")


def heavy_hitters(df: DataFrame, group: str, key: str, k: int, bins: int = 64) -> DataFrame:
    """Rows (group, key, n): the keys of more than a k-th of their group's rows, with exact counts.

    Rows are first counted by group and hash of the key, in ``bins`` * k places: a heavy key makes its place heavy, and a group has
    fewer than k of those. Only keys of heavy places are then counted one by one. Null keys and groups count as such.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bins * k)).alias("__place")
    rows = df.select(F.col(group).alias("__group"), F.col(key).alias("__key"), place)
    counted = written(rows.groupBy("__group", "__place").agg(F.count("*").alias("__n")))
    sizes = counted.withColumn("__all", F.sum("__n").over(Window.partitionBy("__group")))
    heavy = sizes.filter(F.col("__n") * k > F.col("__all")).select(F.col("__group").alias("__g"), F.col("__place").alias("__p"), "__all")
    found = rows.join(heavy, rows["__group"].eqNullSafe(heavy["__g"]) & (rows["__place"] == heavy["__p"]))
    each = found.groupBy("__group", "__key").agg(F.count("*").alias("n"), F.max("__all").alias("__all"))
    return each.filter(F.col("n") * k > F.col("__all")).select(F.col("__group").alias(group), F.col("__key").alias(key), "n")


def sketched(df: DataFrame, keys: Sequence[str | Column], value: str, size: int = 800) -> DataFrame:
    """Rows (keys, n, sketch) of mergeable quantile sketches; ``size`` bounds a sketch and its error."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str | Column], fractions: Sequence[float]) -> DataFrame:
    """Rows (keys, n, quantiles) from ``sketched`` rows: sketches of finer groups are merged, no value is read again."""
    union = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("__sketch"))
    asked = [F.kll_sketch_get_quantile_double("__sketch", F.lit(float(p))) for p in fractions]
    quantiles = F.when(F.col("n") > 0, F.array(*asked)).alias("quantiles")
    return union.select(*(c for c in union.columns if c not in ("n", "__sketch")), "n", quantiles)
