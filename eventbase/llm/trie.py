"""Prefix trie of conversations, measured along its Euler tour.

1. Turns get their places by a range partition on (conversation, turn) and the counts of the parts before, so a
   conversation of any length is many tasks. The same two levels (parts, then rows) give running values below.
2. A prefix is known by its depth and 128 bits: the XOR of a hash of (place, role, text) over its turns. Equal
   prefixes of all conversations are one node; partial sums are formed before rows travel.
3. Each node has an arc that enters it and one that leaves it. An arc's successor follows from parent, first child and next
   sibling, which are found per (parent, bucket of children), then per parent over its buckets.
4. The tour is list-ranked by contraction: each round takes out every arc whose hash is smaller than both neighbours'
   (a third of them, no two adjacent), joins its neighbours, and remembers its distance from the arc before it. What is
   left when ``SMALL`` arcs remain is walked by one task; the rounds are then undone in reverse.
5. Leaves and savings of a subtree are differences of prefix sums at the places of its two arcs.

The ids of the conversations that end at a node are joined in parts, in order, and the parts are hashed one after the
other: a hash of a list is one sequence, so one task streams the joined parts of a node without holding them.

Rules for odd input: rows without a conversation id belong to none and are left out; turns that tie are ordered by role, then
by a hash of their text; equal rows are turns each; null role and text are empty; other columns are not read; an empty table has
an empty trie (no root).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventbase.llm.common import settle

GROUP = 100  # conversations whose ids share their hundreds borrow the first turns of the group's first
HEAD = 6  # fewer than these turns are borrowed
STRIPE = 1 << 16  # rows whose running values are formed in one group
SMALL = 1 << 13  # arcs that one task walks
CHUNK_IDS = 4096  # ids joined at a time


def placed(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, place, code, chars): turns numbered from 1 in their conversation's order."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.md5(text).alias("digest"), F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    parts = settle(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    numbered = parts.withColumn("within", within).join(before, ["conv_id", "part"])
    code = F.md5(F.concat_ws(":", F.length("role"), "role", "digest"))
    return numbered.select("conv_id", (F.col("before") + F.col("within")).alias("place"), code.alias("code"), "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``placed`` (settled): all conversations (conv_id, n), and their rebuilt turns (conv_id, depth, code, chars)."""
    known = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    known = known.select(
        "conv_id", "own", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")
    )
    theirs = known.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    heads = F.least("h", F.coalesce("base_own", F.lit(0)))
    known = settle(known.join(theirs, "base", "left").withColumn("head", heads))
    tail = turns.join(known.select("conv_id", "h", "head"), "conv_id").filter("place > h")
    tail = tail.select("conv_id", (F.col("head") + F.col("place") - F.col("h")).alias("depth"), "code", "chars")
    first = turns.filter(F.col("place") < HEAD).withColumnRenamed("conv_id", "base")
    head = known.filter("head > 0").select("conv_id", "base", "head").join(first, "base").filter("place <= head")
    head = head.select("conv_id", F.col("place").alias("depth"), "code", "chars")
    n = F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))
    return known.select("conv_id", n.alias("n")), head.unionByName(tail)


def prefixes(turns: DataFrame, stripe: int = STRIPE) -> DataFrame:
    """Rows (conv_id, depth, chars, x, y, px, py): the running hash of each prefix and of the one before it."""
    rows = settle(
        turns.withColumn("a", F.xxhash64("depth", "code")).withColumn("b", F.xxhash64("code", "depth"))
        .withColumn("stripe", F.floor((F.col("depth") - 1) / stripe))
    )
    # Only conversations of more than one stripe have a stripe with something before it.
    later = rows.filter("stripe > 0").select("conv_id").distinct()
    sums = rows.join(later, "conv_id", "left_semi").groupBy("conv_id", "stripe").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "stripe", F.bit_xor("a").over(earlier).alias("ba"), F.bit_xor("b").over(earlier).alias("bb"))
    upto = Window.partitionBy("conv_id", "stripe").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("x", F.bit_xor("a").over(upto)).withColumn("y", F.bit_xor("b").over(upto))
    run = run.join(sums, ["conv_id", "stripe"], "left")
    x = F.col("x").bitwiseXOR(F.coalesce("ba", F.lit(0).cast("long")))
    y = F.col("y").bitwiseXOR(F.coalesce("bb", F.lit(0).cast("long")))
    run = run.withColumn("x", x).withColumn("y", y)
    return run.select("conv_id", "depth", "chars", "x", "y", F.col("x").bitwiseXOR(F.col("a")).alias("px"), F.col("y").bitwiseXOR(F.col("b")).alias("py"))


def siblings(links: DataFrame, n_nodes: int) -> DataFrame:
    """From rows (node, parent) rows (node, parent, before, after): the children of a parent in some fixed order.

    Buckets are as many as the root of the number of nodes: no group has many more rows than that on either level.
    """
    buckets = math.isqrt(n_nodes) + 1
    rows = settle(links.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets))))
    inside = Window.partitionBy("parent", "bucket").orderBy("node")
    ends = rows.groupBy("parent", "bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    along = Window.partitionBy("parent").orderBy("bucket")
    ends = ends.select("parent", "bucket", F.lag("high").over(along).alias("earlier"), F.lead("low").over(along).alias("later"))
    rows = rows.withColumn("before", F.lag("node").over(inside)).withColumn("after", F.lead("node").over(inside))
    rows = rows.join(ends, ["parent", "bucket"])
    return rows.select("node", "parent", F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after"))


def tour(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows (arc, prev, next) of the Euler tour of ``nodes`` (node), ``linked`` being ``siblings`` of all but the root.

    The arc that enters a node is twice its number, the one that leaves it one more. The tour's ends have nulls.
    """

    def enter(c: str) -> Column:
        return F.col(c) * 2

    def leave(c: str) -> Column:
        return F.col(c) * 2 + 1

    first = linked.filter("before is null").select(F.col("parent").alias("node"), F.col("node").alias("first"))
    last = linked.filter("after is null").select(F.col("parent").alias("node"), F.col("node").alias("last"))
    known = nodes.join(linked, "node", "left").join(first, "node", "left").join(last, "node", "left")
    return known.select(F.inline(F.array(
        F.struct(
            enter("node").alias("arc"), F.coalesce(leave("before"), enter("parent")).alias("prev"),
            F.coalesce(enter("first"), leave("node")).alias("next"),
        ),
        F.struct(
            leave("node").alias("arc"), F.coalesce(leave("last"), enter("node")).alias("prev"),
            F.coalesce(enter("after"), leave("parent")).alias("next"),
        ),
    )))


def list_rank(arcs: DataFrame, small: int = SMALL) -> DataFrame:
    """Rows (arc, rank) from rows (arc, prev, next) of one list: places from 0, in logarithmically many rounds."""
    left = settle(arcs.withColumn("back", F.lit(1).cast("long")))
    n, taken, round_ = left.count(), [], 0
    while n > small:
        round_ += 1
        own, prev, next_ = (F.xxhash64(F.lit(round_), c) for c in ("arc", "prev", "next"))
        # The ends stay. Hashes of neighbours that tie take neither out.
        gone = F.coalesce((own < prev) & (own < next_) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))
        marked = settle(left.withColumn("gone", gone))
        out, stay = marked.filter("gone").drop("gone"), marked.filter("not gone").drop("gone")
        ahead = out.select(F.col("arc").alias("next"), F.col("next").alias("skip_to"))
        behind = out.select(F.col("arc").alias("prev"), F.col("prev").alias("skip_from"), F.col("back").alias("more"))
        left = settle(
            stay.join(ahead, "next", "left").join(behind, "prev", "left").select(
                "arc", F.coalesce("skip_from", "prev").alias("prev"), F.coalesce("skip_to", "next").alias("next"),
                (F.col("back") + F.coalesce("more", F.lit(0))).alias("back"),
            )
        )
        taken.append(out.select("arc", "prev", "back"))
        n = left.count()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        arc, prev, next_, back = (table.column(c).to_pylist() for c in ("arc", "prev", "next", "back"))
        step = {a: (to, b) for a, to, b in zip(arc, next_, back)}
        at, rank, ranks = next(a for a, p in zip(arc, prev) if p is None), 0, {}
        while at is not None:
            ranks[at] = rank
            at = step[at][0]
            rank += step[at][1] if at is not None else 0
        yield pa.RecordBatch.from_arrays([pa.array(list(ranks), pa.int64()), pa.array(list(ranks.values()), pa.int64())], names=["arc", "rank"])

    ranks = settle(left.coalesce(1).mapInArrow(walk, "arc long, rank long"))  # at most ``small`` rows
    for out in reversed(taken):
        before = ranks.withColumnsRenamed({"arc": "prev", "rank": "start"})
        back = out.join(before, "prev").select("arc", (F.col("start") + F.col("back")).alias("rank"))
        ranks = settle(ranks.unionByName(back))
    return ranks


def running(events: DataFrame, values: list[str], stripe: int = STRIPE) -> DataFrame:
    """``events`` with the sums of ``values`` up to and including each row's ``rank``, which counts from 0 without gaps."""
    rows = settle(events.withColumn("stripe", F.floor(F.col("rank") / stripe)))
    sums = rows.groupBy("stripe").agg(*(F.sum(v).alias(f"of_{v}") for v in values))
    # One row per stripe of 65,536 events.
    earlier = Window.orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("stripe", *(F.coalesce(F.sum(f"of_{v}").over(earlier), F.lit(0)).alias(f"of_{v}") for v in values))
    upto = Window.partitionBy("stripe").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *(F.sum(v).over(upto).alias(f"run_{v}") for v in values)).join(sums, "stripe")
    return rows.select(*events.columns, *((F.col(f"run_{v}") + F.col(f"of_{v}")).alias(f"upto_{v}") for v in values))


def end_digests(ends: DataFrame) -> DataFrame:
    """From rows (node, conv_id) rows (node, ends_sha256): SHA-256 of the ids in order, joined by commas."""
    parted = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, conv = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(node)) + 1
            starts = np.unique(np.concatenate([[0], cuts, np.arange(0, len(node), CHUNK_IDS)])).astype(int)
            texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(node)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[starts]), pa.array(conv[starts]), pa.array(texts)], names=["node", "first", "ids"]
            )

    pieces = settle(parted.mapInArrow(join, "node long, first long, ids string"))
    ordered = pieces.repartition("node").sortWithinPartitions("node", "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == at:
                    state.update(b",")
                else:
                    if at is not None:
                        nodes.append(at)
                        digests.append(state.hexdigest())
                    at, state = node, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    return ordered.mapInArrow(digest, "node long, ends_sha256 string")


def measure(conversations: DataFrame, small: int = SMALL, stripe: int = STRIPE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    known, turns = rebuilt(settle(placed(conversations)))
    zero = F.lit(0).cast("long")
    roots = known.select("conv_id", zero.alias("depth"), zero.alias("chars"), *(zero.alias(c) for c in ("x", "y", "px", "py")))
    rows = settle(roots.unionByName(prefixes(turns, stripe)))
    key = ["depth", "x", "y"]
    nodes = rows.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(c).alias(c) for c in ("chars", "px", "py")))
    nodes = settle(nodes.withColumn("node", F.monotonically_increasing_id()))
    n_nodes = nodes.count()

    up = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    links = settle(nodes.filter("depth > 0").join(up, ["depth", "px", "py"]).select("node", "parent", "parent_conv_id"))
    linked = settle(siblings(links.select("node", "parent"), n_nodes))
    ranks = list_rank(tour(nodes.select("node"), linked), small)

    n_children = links.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    whole = nodes.select("node", "conv_id", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    whole = whole.join(n_children, "node", "left").join(links.select("node", "parent_conv_id"), "node", "left")
    whole = settle(whole.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))

    is_leaf = (F.col("n_children") == 0).cast("long")
    entering = whole.select((F.col("node") * 2).alias("arc"), is_leaf.alias("leaf"), "saved")
    events = ranks.join(entering, "arc", "left").select(
        "arc", "rank", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved")
    )
    summed = running(events, ["leaf", "saved"], stripe)
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    subtree = summed.groupBy(F.floor(F.col("arc") / 2).alias("node")).agg(
        *(F.sum(sign * F.col(f"upto_{v}") + F.col(v)).alias(f"under_{v}") for v in ("leaf", "saved"))
    )

    last = rows.join(known, "conv_id").filter("depth = n").select("conv_id", *key)
    ends = end_digests(nodes.select("node", *key).join(last, key).select("node", "conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(subtree, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("under_leaf").alias("n_leaves"),
        F.col("under_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
