"""Near-duplicate vectors by iterative quantisation and multi-index hashing.

A rotation is learned that turns principal directions into balanced bits: on a bounded sample, codes and the best
rotation to them take turns. Every vector is then coded with all bits of a few such rotations (different starts
give different ones), cut into segments. Two vectors are candidates if they differ in at most one bit in
some segment: each looks up the ball around its own segments, the vector with a zero in the differing bit doing the
asking, and a pair counts in the first of its segments only. Candidates are compared by the cosine of the vectors themselves.

A bit differs with a chance of angle / pi, where the angle is that of the coded space: where vectors share a common
direction it is much larger after the centre is taken off. So it is measured there, on pairs made at the threshold from the
sample, both as far from the centre as vectors are. Bits and number of segments follow from that: so many segments that
such pairs are missed with a mean chance of at most MISS, with the bits for which lookups and chance candidates are fewest:
about log2(n), fewer where pairs are far apart, down to one bit, which compares all. Then the recall of the codes is
measured: QUERIES vectors are compared with all by cosine, and segments are added until at least 1 - MISS of their links
are among the candidates.

Equal vectors are one class with a count and are looked up once; their links are counted, not written out.

Rules for odd input: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do
rows without an id, whose component is null; vectors of different length do not link; rows with one id are one node.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventbase.llm.common import settle
from eventbase.llm.components import components

COSINE = 0.95
MISS = 0.02
SAMPLE = 4096  # vectors the rotations are learned on, those with the smallest hashes of their ids
DIRECTIONS = 64  # bits of one rotation at most
ROUNDS = 30
SEED = 5
QUERIES = 256  # vectors that are compared with all, to measure the recall: those with the smallest hashes of their ids
BLOCK = 8  # segments that a lookup carries


def plan(n: int, chances: np.ndarray) -> tuple[int, int]:
    """Bits of a segment and number of segments for n vectors; ``chances`` are those of a bit to differ, for pairs at the threshold."""
    best = (math.inf, 1, 1)
    for bits in range(1, 33):
        miss = 1 - (1 - chances) ** bits - bits * chances * (1 - chances) ** (bits - 1)
        segments = most = 1
        while most < 1 << 20 and (miss**most).mean() > MISS:
            segments, most = most + 1, most * 2
        while segments < most:
            middle = (segments + most) // 2
            segments, most = (segments, middle) if (miss**middle).mean() <= MISS else (middle + 1, most)
        best = min(best, (segments * (1 + bits / 2) * (1 + n / 2**bits), bits, segments))
    return best[1:]


def chances_at(sample: np.ndarray, centre: np.ndarray, directions: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Chances that a bit differs, for pairs of that cosine: a vector of the sample, and one as far from the centre, turned towards another."""
    r = np.random.default_rng(SEED)
    x = sample - centre
    far = np.linalg.norm(x, axis=1, keepdims=True)
    aside = x[r.permutation(len(x))] + 1e-6 * r.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) / np.maximum(far, 1e-12) ** 2 * x
    wide = np.linalg.norm(aside, axis=1, keepdims=True)
    good = (far[:, 0] > 1e-9) & (wide[:, 0] > 1e-12)
    if not good.any():
        return np.array([math.acos(cosine) / math.pi])
    x, far, base = x[good], far[good], sample[good]
    aside = aside[good] / wide[good] * far
    low, high = np.zeros(far.shape), np.full(far.shape, math.pi / 2)
    for _ in range(40):
        angle = (low + high) / 2
        y = centre + np.cos(angle) * x + np.sin(angle) * aside
        near = (base * y).sum(1, keepdims=True) >= cosine * np.linalg.norm(y, axis=1, keepdims=True)
        low, high = np.where(near, angle, low), np.where(near, high, angle)
    u, v = x @ directions, (np.cos(low) * x + np.sin(low) * aside) @ directions
    like = (u * v).sum(1) / np.maximum(np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1), 1e-300)
    return np.clip(np.arccos(np.clip(like, -1, 1)) / math.pi, 0, 0.5)


def principal(sample: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Centre and principal directions (dimensions x bits) of unit vectors."""
    centre = sample.mean(0)
    x = sample - centre
    _, directions = np.linalg.eigh(x.T @ x)
    return centre, directions[:, ::-1][:, :bits]


def learn(sample: np.ndarray, bits: int, rotations: int) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projections (rotations x dimensions x bits) of iterative quantisation, from unit vectors."""
    centre, directions = principal(sample, bits)
    y = (sample - centre) @ directions
    r = np.random.default_rng(SEED)
    out = []
    for _ in range(rotations):
        rotation, _ = np.linalg.qr(r.normal(size=(bits, bits)))
        for _ in range(ROUNDS):
            codes = np.where(y @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(codes.T @ y)
            rotation = (u @ v).T
        out.append(directions @ rotation)
    return centre, np.stack(out)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def coder(classes: DataFrame, n: int, cosine: float = COSINE) -> tuple[Callable[[np.ndarray], np.ndarray], int, int]:
    """What codes unit vectors (rows x segments), the length vectors are filled up to, and the bits of a segment."""
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    drawn = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector", "node").toArrow()
    column = drawn.column(0).combine_chunks()
    sample = _unit(_matrix(column, width))
    per_rotation = min(width, DIRECTIONS)
    bits, segments = plan(n, chances_at(sample, *principal(sample, per_rotation), cosine))
    powers = 1 << np.arange(bits, dtype=np.int64)
    asked, sizes = sample[:QUERIES], column.value_lengths().to_numpy(zero_copy_only=False)[:QUERIES]
    names = drawn.column(1).to_pylist()[:QUERIES]
    while True:
        centre, projections = learn(sample, per_rotation, math.ceil(bits * segments / per_rotation))

        def code(x: np.ndarray, centre=centre, projections=projections, segments=segments) -> np.ndarray:
            ones = np.concatenate([(x - centre) @ p >= 0 for p in projections], axis=1)[:, : bits * segments]
            return ones.reshape(len(x), segments, bits) @ powers

        def run(batches: Iterator[pa.RecordBatch], code=code) -> Iterator[pa.RecordBatch]:
            own, met, linked = code(asked), 0, 0
            for batch in batches:
                for start in range(0, batch.num_rows, 1000):
                    part = batch.slice(start, 1000)
                    x = _unit(_matrix(part.column(1), width))
                    same = part.column(1).value_lengths().to_numpy(zero_copy_only=False)[:, None] == sizes
                    links = (x @ asked.T >= cosine) & same & (part.column(0).to_numpy()[:, None] != np.array(names))
                    rows = np.flatnonzero(links.any(1))
                    codes = code(x[rows]) if len(rows) else None
                    for q in np.flatnonzero(links.any(0)):
                        few = np.bitwise_count(codes[links[rows, q]] ^ own[q]) <= 1
                        met, linked = met + int(few.any(1).sum()), linked + len(few)
            yield pa.RecordBatch.from_pydict({"met": [met], "linked": [linked]})

        met, linked = classes.select("node", "vector").mapInArrow(run, "met long, linked long").agg(F.sum("met"), F.sum("linked")).first()
        if (met or 0) >= (1 - MISS) * (linked or 0):
            return code, width, bits
        segments = math.ceil(1.5 * segments)


def coded(classes: DataFrame, code: Callable[[np.ndarray], np.ndarray], width: int) -> DataFrame:
    """Rows (node, block, codes): the segments of each class's code, as numbers, a few in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                codes = code(_unit(_matrix(part.column(1), width)))
                for block in range(0, codes.shape[1], BLOCK):
                    some = codes[:, block : block + BLOCK]
                    offsets = np.arange(0, some.size + 1, some.shape[1], dtype=np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(some.ravel()))
                    blocks = pa.array(np.full(len(some), block // BLOCK, np.int32))
                    yield pa.RecordBatch.from_arrays([part.column(0), blocks, lists], names=["node", "block", "codes"])

    return classes.select("node", "vector").mapInArrow(run, "node long, block int, codes array<long>")


def candidates(codes: DataFrame, bits: int, several: bool = True) -> DataFrame:
    """Pairs (a, b) of nodes that differ in at most one bit in some segment, each once."""
    table = codes.select("node", "block", "codes", F.posexplode("codes").alias("segment", "value"))
    zero_bits = F.filter(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.col("value").bitwiseAND(_bit(i)) == 0)
    ball = F.concat(F.array("value"), F.transform(zero_bits, lambda i: F.col("value").bitwiseXOR(_bit(i))))
    asks = table.select(F.col("node").alias("a"), F.col("codes").alias("own"), "block", "segment", F.col("value").alias("of"), F.explode(ball).alias("value"))
    holds = table.select(F.col("node").alias("b"), "codes", "block", "segment", "value")
    apart = F.zip_with("own", "codes", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    earlier = F.exists(F.slice(apart, F.lit(1), F.col("segment")), lambda d: d <= 1)
    met = asks.join(holds, ["block", "segment", "value"])
    once = (F.col("of") != F.col("value")) | (F.col("a") < F.col("b"))
    pairs = met.filter(once & ~earlier & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.distinct() if several else pairs  # a pair comes once from each block that it meets in


def verified(pairs: DataFrame, classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The pairs whose vectors, of one length, have at least the cosine."""
    left = classes.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = classes.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    both = pairs.join(left, "a").join(right, "b").filter(F.size("va") == F.size("vb")).select("a", "b", "va", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                width = int(batch.column(2).value_lengths().to_numpy(zero_copy_only=False).max())
                x, y = (_matrix(batch.column(i), width) for i in (2, 3))
                x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
                like = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(like >= cosine))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per vector."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("vector"))
    usable = _usable(F.col("vector")) & F.col("vec_id").isNotNull()
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    good = rows.filter("vector is not null")
    classes = settle(good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    n = classes.count()
    kept = F.col("vec_id") == F.col("component_id")
    if not n:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", kept)
    code, width, bits = coder(classes, n, cosine)
    codes = settle(coded(classes, code, width))
    several = codes.filter("block > 0").limit(1).count() > 0
    links = settle(verified(candidates(codes, bits, several), classes, cosine))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = classes.select(F.col("node").alias("b"), F.col("copies").alias("others"))
    further = both.join(counts, "b").groupBy("a").agg(F.sum("others").alias("others"))
    roots = components(links)
    told = classes.join(further.withColumnRenamed("a", "node"), "node", "left").join(roots, "node", "left").select(
        F.col("vector").alias("of"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    joined = rows.join(told, rows["vector"] == told["of"], "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id")
    ).withColumn("kept", kept)
