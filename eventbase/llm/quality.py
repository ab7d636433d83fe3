"""Quality scores by random Fourier features, ridge regression and isotonic calibration.

A text becomes a fixed list of statistics (shares of kinds of characters, lengths of words and lines, repetition).
These are standardised and mapped to cosines of random projections, whose inner products approximate a Gaussian
kernel. Every partition adds up its part of the normal equations; their sum, of a size that depends
on the number of features alone, is solved on the driver. The raw values of labelled rows that were not
fitted on, counted in narrow bins, are turned into probabilities by pooling adjacent violators.

Labels are taken from rows whose crc32(doc_id as text) mod 4 is not 2; of those, 3 calibrates and 0 and 1 are fitted on.
Neither ids, languages nor sources are inputs of a score.

Rules for odd input: null and empty texts have all statistics zero and are scored like any other; labels other than 0 and 1 are
not used; without labels of both kinds every score is the share of label 1, or 0.5 if there are none; rows that
repeat an id are scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.llm.common import arrow_rows, settle
from eventbase.llm.lines import DIGIT, LATER_BYTE, LETTER, SPACE, SYMBOL, UPPER

FEATURES = 256  # cosines
PENALTY = 1e-3  # per fitted row
BINS, LEAST, MOST = 1000, -1.0, 2.0  # of raw values, for calibration
THRESHOLD = 0.7
SEED = 20
SENTENCE_END = np.isin(np.arange(256), list(b".!?"))
MARKS = np.isin(np.arange(256), list(b"|!*$&%#"))
N_STATISTICS = 14
WIDTH = N_STATISTICS**-0.5  # standard deviation of the projections: standardised texts lie about sqrt(n) apart


def statistics(text: str | None) -> np.ndarray:
    """What a score sees of a text: numbers of about the size of one."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros(N_STATISTICS)
    octets = np.frombuffer(data, np.uint8)
    solid = ~SPACE[octets]
    n_solid, n_letters = int(solid.sum()), int(LETTER[octets].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    n = len(words)
    n_symbols, n_digits = int(SYMBOL[octets].sum()), int(DIGIT[octets].sum())
    closing = np.flatnonzero(MARKS[octets])
    doubled = int((np.diff(closing) == 1).sum()) if len(closing) > 1 else 0
    return np.array(
        [
            min(1.0, 4 * n_symbols / n_solid),
            int(UPPER[octets].sum()) / max(1, n_letters),
            min(1.0, 4 * n_digits / n_solid),
            min(1.0, 4 * (n_solid - n_letters - n_digits - n_symbols) / n_solid),
            min(1.0, 4 * doubled / n_solid),
            min(2.0, (n_solid - int(LATER_BYTE[octets].sum())) / n / 8),
            len(set(words)) / n,
            len(set(words)) / n ** 0.75 / 2,
            np.log1p(n) / 8,
            ends / len(lines),
            len(set(lines)) / len(lines),
            min(2.0, np.log1p(n / len(lines)) / 4),
            min(2.0, 8 * int(SENTENCE_END[octets].sum()) / n),
            1.0,
        ]
    )


def _fold(doc_id: object) -> int:
    """crc32 of the id as text, mod 4; -1 for a null id."""
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 4


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    projections: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw values at which the score steps up
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.hstack([np.cos(z @ self.projections + self.phases) * np.sqrt(2 / FEATURES), np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.levels)


def pool(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic regression: the rising shares closest to positive / total, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for p, n in zip(positive.tolist(), total.tolist()):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p1, n1, k1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p1, blocks[-1][1] + n1, blocks[-1][2] + k1]
    return np.concatenate([np.full(int(k), p / n) for p, n, k in blocks])


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fold, x): the statistics of every text, written once for fitting and scoring."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T._parse_datatype_string("fold int, x array<double>")])

    def rows(columns: list[list]) -> Iterator[tuple]:
        return ((d, _fold(d), statistics(t).tolist()) for d, t in zip(*columns))

    return settle(arrow_rows(docs.select(doc_id, text), rows, schema))


def _added(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``part(x, quality)`` over all rows: each partition adds up its own, Spark adds those place by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                more = part(x, batch.column(1).to_numpy(zero_copy_only=False).astype(float))
                total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("x", "quality").mapInArrow(run, "sums array<double>")
    added = parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect()
    return np.array([v for _, v in sorted(map(tuple, added))]) if added else None


def train(measured: DataFrame, labels: DataFrame) -> Scorer | float:
    """Fit on all labelled rows that are not held out. What reaches the driver has a fixed size."""
    known = labels.filter("quality in (0, 1)").select("doc_id", "quality")
    rows = settle(measured.filter("fold <> 2").join(known, "doc_id").select("fold", "quality", "x"))
    sums = _added(rows, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]))
    if sums is None or sums[1] in (0, sums[0]):
        return 0.5 if sums is None else float(sums[1] / sums[0])
    mean = sums[2 : 2 + N_STATISTICS] / sums[0]
    scale = np.sqrt(np.maximum(sums[2 + N_STATISTICS :] / sums[0] - mean**2, 0))
    r = np.random.default_rng(SEED)
    scorer = Scorer(
        mean, np.where(scale > 1e-6, scale, 1.0), r.normal(0, WIDTH, (N_STATISTICS, FEATURES)), r.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]),
    )

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = scorer.features(x)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y, [len(f)]])

    share = float(sums[1] / sums[0])
    sums = _added(rows.filter("fold in (0, 1)"), equations)
    if sums is None:
        return share
    size = FEATURES + 1
    ridge = np.eye(size) * PENALTY * sums[-1]
    ridge[-1, -1] = 1e-9  # the constant is not held back
    scorer.weights = np.linalg.solve(sums[: size * size].reshape(size, size) + ridge, sums[size * size : -1])

    def counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        places = np.clip((scorer.raw(x) - LEAST) / (MOST - LEAST) * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(places, y, BINS), np.bincount(places, minlength=BINS)])

    sums = _added(rows.filter("fold = 3"), counts)
    if sums is not None:
        used = np.flatnonzero(sums[BINS:])
        scorer.edges = LEAST + (used + 0.5) / BINS * (MOST - LEAST)
        scorer.levels = pool(sums[:BINS][used], sums[BINS:][used])
    return scorer


def score(measured: DataFrame, scorer: Scorer | float) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per measured document."""
    kind = measured.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *T._parse_datatype_string("held_out boolean, score double, predicted int")])

    def rows(columns: list[list]) -> Iterator[tuple]:
        x = np.array(columns[2])
        found = scorer.scores(x) if isinstance(scorer, Scorer) else np.full(len(x), scorer)
        for key, fold, s in zip(columns[0], columns[1], found.tolist()):
            yield key, fold == 2, s, int(s >= THRESHOLD)

    return arrow_rows(measured, rows, schema, at_once=1024)
