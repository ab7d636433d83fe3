"""Mix sources to target weights, by a splitting tree of hypergeometric draws. DataFrame functions only.

1. Targets: sources share the wanted number of words by weight; what exceeds the most times a source may
   be repeated is shared again among the others. In closed form: with the sources in order of how soon they fill up, the
   full ones are a prefix.
2. Documents of a source are put in permuted order, by a hash of their ids; those that are large against a block or against what is
   wanted come first. Blocks of about equal size are ranges of that order. A target is a number of whole passes over all of the
   source's documents and a last pass that takes each document in order that still fits. The last pass goes by
   segments: from sums of blocks follows the block in which the room runs out, in it the document that does not fit; after it a
   new segment begins for what is at most as large as the room left, until no document is. The room shrinks below the size of
   a document each time, so segments are few, and no source passes through one task.
3. Shards: a binary tree splits the list of exact block quotas. At each node the quotas of its left half
   are a multivariate hypergeometric draw (one source after the other, by inverse distribution function from a hashed
   uniform), so the shards are what cutting one random order of all blocks would give. Each source's drawn
   blocks, in their permuted order, then go to the shards by those quotas: disjoint by construction.
4. Within a shard rows are shuffled by a hash, ``order_key``: a writer repartitions by shard and sorts by it.

All draws are hashes of ids and the seed, so runs agree. The tree holds one row per node with one number per source:
sources are few (a mixture has components, not keys of the data); shards grow with the words taken.

Rules for odd input: a null text has size 0; a null source is a source, last in order; rows that repeat an id are documents each,
next to each other in order;
a source without words has target 0 and its documents are taken 0 times; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventbase.llm.common import n_words, settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words wanted, as a part of all words
MOST_TIMES = 2  # a source may be taken
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 22
PLACES = 64  # uses of blocks in which a shard's range and a place are looked for
STRIPE = 1 << 12  # blocks of a source whose sums are formed in one group
LARGE = 8  # documents of more than this part of the words wanted come first


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_TIMES) -> DataFrame:
    """From rows (source, source_size) rows with a ``target``: min(most * size, level * weight), summing to the share."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.lit(list(weights)), nth + 1).cast("long"))
    weighed = weighed.withColumn("most", (F.col("source_size") * most).cast("double"))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    staged = weighed.withColumn("left", left).withColumn("weight_left", weight_left)
    # the first source that the shared level does not fill fixes the level of all that follow
    open_ = F.col("left") * F.col("weight") < F.col("most") * F.col("weight_left")
    at = F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), F.coalesce("source", F.lit("")))
    first = F.min(F.when(open_, F.struct(at.alias("at"), "left", "weight_left"))).over(everything)
    staged = staged.withColumn("first", first).withColumn("at", at)
    target = F.when(F.col("first").isNull() | (F.col("at") < F.col("first.at")), F.col("most")).otherwise(
        F.col("first.left") * F.col("weight") / F.col("first.weight_left")
    )
    return staged.select("source", "source_size", "weight", target.alias("target"))


def _hash(*parts: Column | int | str) -> Column:
    """52 bits of an MD5: a hash that other engines have as well."""
    texts = [F.lit(str(p)) if isinstance(p, (int, str)) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 13), 16, 10).cast("long")


def _uniform(*parts: Column | int | str) -> Column:
    """In (0, 1), from a hash."""
    return (_hash(*parts) + 0.5) / float(1 << 52)


def _hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``good``, at the quantile u.

    The distribution function is added up over 9 standard deviations around the mean; beyond lies less than 1e-15.
    """
    total, good, drawn = (x.cast("double") for x in (total, good, drawn))
    mean = drawn * good / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(mean * (total - good) * (total - drawn) / F.greatest(total * (total - 1), F.lit(1.0)))
    low = F.greatest(F.lit(0.0), drawn + good - total, F.floor(mean - 9 * spread - 9)).cast("long")
    high = F.least(good, drawn, F.ceil(mean + 9 * spread + 9)).cast("long")
    steps = F.sequence(low, F.greatest(low, high))

    def ratio(k: Column) -> Column:  # of the weight of k + 1 to that of k
        return (good - k) * (drawn - k) / ((k + 1.0) * (total - good - drawn + k + 1.0))

    start = F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"))
    mass = F.aggregate(
        steps, start, lambda s, k: F.struct((s["weight"] * ratio(k)).alias("weight"), (s["sum"] + s["weight"]).alias("sum")),
        lambda s: s["sum"],
    )
    start = F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("past"))
    past = F.aggregate(
        steps, start,
        lambda s, k: F.struct(
            (s["weight"] * ratio(k)).alias("weight"), (s["sum"] + s["weight"]).alias("sum"),
            (s["past"] + F.when(s["sum"] + s["weight"] < u * mass, 1).otherwise(0)).alias("past"),
        ),
        lambda s: s["past"],
    )
    return F.least(low + past, F.greatest(low, high))


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """From rows (source, blocks) rows (source, shard, first, last): ranks of a source's drawn blocks in each shard.

    ``shards`` is a power of two. One level of the tree after the other; each level is written, as the next one uses it twice.
    """
    key = F.struct(F.col("source").isNull().alias("is_null"), "source", "blocks")
    level = quotas.agg(F.sort_array(F.collect_list(key)).alias("left")).select(F.lit(0).alias("node"), "left")
    width = shards
    while width > 1:
        width //= 2
        counts = F.transform("left", lambda s: s["blocks"])
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
        start = F.struct(
            total.alias("total"), F.floor(total / 2).cast("long").alias("wanted"), F.array().cast("array<bigint>").alias("out")
        )

        def draw(state: Column, item: Column) -> Column:
            u = _uniform(seed, F.col("depth"), F.col("node"), item["source"])
            got = _hypergeometric(state["total"], item["blocks"], state["wanted"], u)
            return F.struct(
                (state["total"] - item["blocks"]).alias("total"), (state["wanted"] - got).alias("wanted"),
                F.concat(state["out"], F.array(got)).alias("out"),
            )

        drawn = settle(level.withColumn("depth", F.lit(width)).withColumn("got", F.aggregate("left", start, draw, lambda s: s["out"])))
        one = F.transform(F.arrays_zip("left", "got"), lambda z: z["left"].withField("blocks", z["got"]))
        two = F.transform(F.arrays_zip("left", "got"), lambda z: z["left"].withField("blocks", z["left"]["blocks"] - z["got"]))
        halves = F.array(F.struct((2 * F.col("node")).alias("node"), one.alias("left")), F.struct((2 * F.col("node") + 1).alias("node"), two.alias("left")))
        level = drawn.select(F.explode(halves).alias("h")).select("h.node", "h.left")
    flat = level.select(F.col("node").alias("shard"), F.explode("left").alias("s")).select("shard", "s.source", "s.blocks")
    upto = F.sum("blocks").over(Window.partitionBy("source").orderBy("shard"))
    return flat.withColumn("last", upto).select("source", "shard", (F.col("last") - F.col("blocks")).alias("first"), "last")


def _on_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def _with_sums(rows: DataFrame, value: str, upto: str) -> DataFrame:
    """Rows of (source, block, ...) with the sum of a value up to and including their block, in two levels; blocks are once per source."""
    striped = rows.withColumn("stripe", F.floor(F.col("block") / STRIPE))
    within = Window.partitionBy("source", "stripe").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    stripes = striped.groupBy(F.col("source").alias("of"), F.col("stripe").alias("at")).agg(F.sum(value).alias("sum"))
    stripes = stripes.select("of", "at", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    inside = striped.withColumn("inside", F.sum(value).over(within))
    met = inside.join(stripes, inside["source"].eqNullSafe(stripes["of"]) & (inside["stripe"] == stripes["at"]))
    return met.select(*(inside[c] for c in rows.columns), (F.col("inside") + F.col("before")).alias(upto))


def segments(placed: DataFrame, goal: DataFrame) -> DataFrame:
    """Rows (source, segments): per source the parts of its last pass, each (after, room): a place and the words still free after it.

    ``placed`` has source, block, place and size of each document; a source is open until a round takes all that fits.
    """
    everything = F.struct("block", "place")
    start = placed.select(everything.alias("after")).schema["after"].dataType
    state = goal.filter("rest > 0").select("source", F.col("rest").alias("room"), F.lit(None).cast(start).alias("after"))
    open_, rounds = settle(state), []
    while not open_.isEmpty():
        rounds.append(open_)
        now = open_.select(F.col("source").alias("of"), "room", "after")
        # what lies after the last document that did not fit, and is no larger than the room
        fits = placed.join(now, placed["source"].eqNullSafe(now["of"])).filter(F.col("size") <= F.col("room"))
        fits = fits.filter(F.col("size") > 0).filter(F.col("after").isNull() | (everything > F.col("after")))
        blocks = fits.groupBy("source", "block").agg(F.sum("size").alias("words"), F.max("room").alias("room"))
        summed = _with_sums(blocks, "words", "upto").filter("upto > room")
        cut = summed.groupBy("source").agg(F.min(F.struct("block", (F.col("room") - F.col("upto") + F.col("words")).alias("room"))).alias("cut"))
        cut = cut.select(F.col("source").alias("in"), F.col("cut.block").alias("cut"), F.col("cut.room").alias("free"))
        inside = fits.join(cut, fits["source"].eqNullSafe(cut["in"]) & (fits["block"] == cut["cut"]))
        order = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        inside = inside.withColumn("upto", F.sum("size").over(order))
        taken = F.coalesce(F.sum(F.when(F.col("upto") <= F.col("free"), F.col("size"))), F.lit(0))
        first = F.min(F.when(F.col("upto") > F.col("free"), everything))
        left = inside.groupBy("source").agg((F.max("free") - taken).alias("room"), first.alias("after"))
        open_ = settle(left)
    listed = rounds[0] if rounds else open_
    for r in rounds[1:]:
        listed = listed.unionByName(r)
    return listed.groupBy("source").agg(F.collect_list(F.struct("after", "room")).alias("segments"))


def _ranks(uses: DataFrame) -> DataFrame:
    """Rows (source, pass, block) with ``place``: numbers from 0 without gaps in each source, pass after pass."""
    blocks = _with_sums(uses.groupBy("source", "block").agg(F.count("*").alias("times"), F.sort_array(F.collect_list("pass")).alias("passes")), "times", "upto")
    each = blocks.select("source", "block", F.posexplode("passes").alias("nth", "pass"), "upto", "times")
    return each.select("source", "block", "pass", (F.col("upto") - F.col("times") + F.col("nth")).alias("place"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, and ``uses``.

    ``uses`` has an entry (pass, shard, order_key) for each time the mix takes the document.
    """
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    sizes = settle(sizes.withColumn("row", F.monotonically_increasing_id()))
    goal = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("passes", passes.cast("long")).select(
        "*", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"),
        F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / block_words)).alias("n_blocks"),
    )
    goal = settle(goal)
    placed = sizes.join(goal, _on_source(sizes, goal)).drop(goal["source"])
    key = _hash(seed, F.col("doc_id"))
    small = (F.col("size") <= F.least(F.lit(block_words), F.col("rest") / LARGE)).cast("long")
    block = small * F.col("n_blocks") + F.floor(key / float(1 << 52) * F.col("n_blocks")).cast("long")
    place = F.struct(key.alias("key"), F.col("doc_id").isNull().alias("is_null"), F.col("doc_id"), F.col("size"), F.col("row"))
    placed = settle(placed.withColumn("block", block).withColumn("place", place))

    # The last pass: of the segments a document lies in the last one that starts before it.
    parts = segments(placed.select("source", "block", "place", "size"), goal)
    parts = settle(parts.withColumnRenamed("source", "of"))
    own = F.struct("block", "place")
    free = F.array_min(F.transform(F.filter("segments", lambda s: s["after"].isNull() | (s["after"] < own)), lambda s: s["room"]))
    # the document a segment starts after did not fit into the one before
    missed = F.exists("segments", lambda s: s["after"].eqNullSafe(own))
    last = (F.col("size") > 0) & (F.col("size") <= free) & ~missed
    each = placed.join(parts, placed["source"].eqNullSafe(parts["of"]), "left").withColumn("last", F.coalesce(last, F.lit(False)))
    each = settle(each.select("doc_id", "source", "size", "source_size", "target", "passes", "block", "last"))

    # Quotas of blocks, their split among the shards, and the shard of each use of a block.
    wanted = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)) * SHARE).first()[0]
    shards = 1
    while shards * shard_words < wanted:
        shards *= 2
    blocks = each.filter("size > 0").groupBy("source", "block").agg(F.max("passes").alias("passes"), F.max("last").alias("last"))
    times = F.col("passes") + F.col("last").cast("long")
    uses = blocks.filter(times > 0).select("source", "block", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("pass"))
    uses = settle(_ranks(uses))
    cuts = shard_quotas(uses.groupBy("source").agg(F.count("*").alias("blocks")), shards, seed + 2).filter("first < last")
    # A shard's range of places and a place meet in steps of places.
    steps = F.sequence(F.floor(F.col("first") / PLACES), F.floor((F.col("last") - 1) / PLACES))
    cuts = cuts.select(F.col("source").alias("of"), "shard", "first", "last", F.explode(steps).alias("step"))
    asked = uses.withColumn("at", F.floor(F.col("place") / PLACES))
    met = asked["source"].eqNullSafe(cuts["of"]) & (asked["at"] == cuts["step"]) & asked["place"].between(cuts["first"], cuts["last"] - 1)
    drawn = asked.join(cuts, met).groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("uses"))
    drawn = drawn.withColumnsRenamed({"source": "of", "block": "in"})

    def keyed(u: Column) -> Column:
        order_key = _hash(seed + 4, u["shard"], F.col("doc_id"), u["pass"])
        return F.struct(u["pass"], u["shard"], order_key.alias("order_key"))

    rows = each.join(drawn, each["source"].eqNullSafe(drawn["of"]) & (each["block"] == drawn["in"]), "left")
    own_uses = F.filter("uses", lambda u: (F.col("size") > 0) & (F.col("last") | (u["pass"] < F.col("passes"))))
    uses = F.coalesce(F.transform(own_uses, keyed), F.array().cast("array<struct<pass:bigint,shard:int,order_key:bigint>>"))
    return rows.select("doc_id", "source", "size", "source_size", "target", uses.alias("uses"))


def taken(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` with the words taken in place of the uses."""
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("uses")).cast("long").alias("taken")
    )


def repeat(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """The documents as the mix takes them: each row as often as it has uses, columns unchanged.

    How often is joined back by id, source and size; of rows that agree in all three each is taken as the first of them.
    """
    mixed = mix(docs, doc_id, text, source, seed)
    times = mixed.groupBy("doc_id", "source", "size").agg(F.max(F.size("uses")).alias("times")).filter("times > 0")
    times = settle(times.select(*(F.col(c).alias(f"_{c}") for c in times.columns)))
    same = docs[doc_id].eqNullSafe(times["_doc_id"]) & docs[source].eqNullSafe(times["_source"])
    sized = docs.join(times, same & (n_words(docs[text]) == times["_size"]))
    row = F.struct(*(docs[c].alias(c) for c in docs.columns))
    return sized.select(F.explode(F.array_repeat(row, times["_times"])).alias("row")).select("row.*")
