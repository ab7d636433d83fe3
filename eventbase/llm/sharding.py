"""Shards of near-equal bytes by sampled splitters. DataFrame functions only.

Records are put in the order of a key, here a hash of the text and then the id, so that equal texts are
neighbours. Records are drawn with a chance in proportion to their size; quantiles of the drawn keys split the order into many
more ranges than shards. Every range is counted; one that came out overfull is subdivided at equal steps of its
keys, and a text that overfills a range alone by a hash of the id. Running totals over the ranges, and within each over its
records, give every record its place in bytes, and the place gives the shard.

No range holds more than a few times RANGE_ROWS rows, whatever a text's share of all rows: no shard and no text is
one task's work. Texts are read once; only keys and sizes are shuffled.

The law is ``bytes``: shards differ by about the size of one record, or of one group of equal texts, as groups
of up to a hundredth of a shard are not cut.

Rules for odd input: a null text is a group of its own kind with size 1 and the crc of an empty text; rows that repeat an id are
each a record; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventbase.llm.common import settle

SHARDS = 16
RANGE_ROWS = 20_000  # rows per range, about
PER_RANGE = 32  # records drawn per range
OVERFULL = 3  # times its share, from which a range is subdivided
WHOLE_GROUP = 0.01  # of a shard: smaller groups of equal texts stay together


def _uniform(*parts: Column | str) -> Column:
    """In [0, 1), from a hash."""
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)


def _ranged(records: DataFrame, n_ranges: int, total: int) -> DataFrame:
    """Add ``range``: the number of splitters at or below the key."""
    chance = F.col("size") * (n_ranges * PER_RANGE / max(1, total))
    drawn = records.filter(_uniform(F.lit("draw"), "doc_id", "key") < chance)
    steps = [i / n_ranges for i in range(1, n_ranges)]
    if not steps:
        return records.withColumn("range", F.lit(0).cast("long"))
    cuts = drawn.agg(F.percentile_approx("key", steps, 100 * n_ranges).alias("cuts"))
    cuts = cuts.select(F.explode(F.array_distinct("cuts")).alias("cut"))
    # Splitters are looked up by the top 16 bits of the key: rows meet the few that share theirs.
    cell = F.shiftright(F.col("cut"), 48)
    cells = cuts.groupBy(cell.alias("cell")).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    every = records.sparkSession.range(-(1 << 15), 1 << 15).select(F.col("id").alias("cell"))
    cells = every.join(cells, "cell", "left")
    below = F.coalesce(F.sum(F.size("cuts")).over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = settle(cells.select("cell", F.coalesce("cuts", F.array().cast("array<bigint>")).alias("cuts")).withColumn("below", below))
    placed = records.withColumn("cell", F.shiftright(F.col("key"), 48)).join(cells, "cell")
    inside = F.size(F.filter("cuts", lambda c: c <= F.col("key")))
    return placed.withColumn("range", F.col("below") + inside).drop("cell", "cuts", "below")


def shards(docs: DataFrame, n_shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot): ``slot`` counts a shard's records from 0 in key order."""
    whole = F.coalesce(F.col(text), F.lit(""))
    records = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.xxhash64(F.col(text).isNull(), whole).alias("key"),
    )
    records = settle(records)
    n, total = records.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_ranges = max(8 * n_shards, -(-n // range_rows)) if n > 8 * n_shards else 1
    ranged = _ranged(records, n_ranges, total)
    most = F.greatest(F.lit(1), F.lit(OVERFULL * n / n_ranges))
    texts = ranged.groupBy("range", "key").agg(F.count("*").alias("rows"))
    frequent = F.when(F.col("rows") > most, F.struct("key", F.ceil(F.col("rows") / most).cast("long").alias("parts")))
    others = F.sum(F.when(F.col("rows") <= most, F.col("rows")))
    ranges = texts.groupBy("range").agg(
        F.sort_array(F.collect_list(frequent)).alias("frequent"), F.ceil(F.coalesce(others, F.lit(0)) / most).alias("parts"),
        F.min("key").cast("double").alias("low"), F.max("key").cast("double").alias("high"),
    )
    ranged = ranged.join(settle(ranges), "range")
    # Within an overfull range: equal steps of the key; a text that overfills it alone is split by a hash of the id.
    along = (F.col("key").cast("double") - F.col("low")) / F.greatest(F.lit(1.0), F.col("high") - F.col("low"))
    step = F.floor(along * F.col("parts") * 0.999999).cast("long")
    passed = F.size(F.filter("frequent", lambda f: f["key"] < F.col("key"))).cast("long")
    own = F.get(F.filter("frequent", lambda f: f["key"] == F.col("key")), F.lit(0))
    split = F.coalesce(1 + F.floor(_uniform(F.lit("part"), "doc_id") * own["parts"]).cast("long"), F.lit(0))
    ranged = settle(
        ranged.select("doc_id", "size", "text_crc32", "key", "range", F.struct(step.alias("a"), passed.alias("b"), split.alias("c")).alias("part"))
    )

    # Bytes and records before each part of a range: a row stands for about RANGE_ROWS records.
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    starts = settle(
        starts.select(
            "range", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    placed = ranged.join(starts, ["range", "part"])
    own = Window.partitionBy("range", "part")
    order = own.orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    group = Window.partitionBy("range", "part", "key")
    placed = placed.withColumn("upto", upto).withColumn("nth", F.row_number().over(order) - 1)
    placed = placed.withColumn("of_group", F.sum("size").over(group)).withColumn("group_end", F.max("upto").over(group))
    share = max(1, total) / n_shards
    middle = F.when(F.col("of_group") <= WHOLE_GROUP * share, F.col("group_end") - F.col("of_group") / 2).otherwise(
        F.col("upto") - F.col("size") / 2
    )
    shard = F.least(F.lit(n_shards - 1), F.floor((F.col("bytes_before") + middle) / share)).cast("int")
    placed = settle(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("nth")).alias("place")))
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    slot = (F.col("place") - F.col("first")).cast("long")
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
