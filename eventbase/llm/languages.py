"""Language identification by a string kernel, Nyström landmarks and kernel ridge regression, one class against the rest.

1. A text is lower-cased, and every run of anything but letters and their marks becomes one space, also before and
   after it. Its presence set holds every distinct run of one, two and three of these characters (the blended spectrum).
2. The kernel of two texts is the number of runs both have, over the root of the product of how many each has.
3. Landmarks are a bounded number of labelled texts per language; their runs are the columns of a 0/1 matrix. A batch
   of texts is a matrix over the same columns, and its kernels with all landmarks are one matrix product; dividing by the
   root of the landmarks' own kernel matrix gives Nyström features.
4. Ridge regression of +1 / -1 targets per language on those features, over a bounded sample of labelled texts. The
   sums of the normal equations are formed per partition.
5. The language with the highest output wins; the score is its share of the outputs' soft maximum.

Rows with crc32(doc_id as text) mod 4 = 2 are never learned from. Samples are those with the smallest hashes of their ids,
whole texts of any length.

Rules for odd input: a null text, or one without a letter, is ``und`` with score 0; without any labelled text with a
letter every text is; rows with a null language or id are not learned from; rows that repeat an id are scored each on its own; equal
outputs are decided by the order of the languages' names; other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.llm.common import arrow_rows, settle

LONGEST = 3  # characters of a run: 21 bits each, so that a run is a number
LANDMARKS = 48  # per language
SAMPLE = 512  # labelled texts per language that are learned from, landmarks included
RIDGE = 1e-2  # per text of the sample
SHARPNESS = 8.0
SLICE = 1 << 18  # characters whose runs are made at once
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point 0, or 1 for marks, or 2 for letters."""
    kinds = {"L": 2, "M": 1}
    return np.array([kinds.get(unicodedata.category(chr(i))[0], 0) for i in range(sys.maxunicode + 1)], np.uint8)


def runs(text: str | None) -> np.ndarray:
    """The presence set of a text, as sorted numbers; empty if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    kinds = _letters()[points]
    if not (kinds == 2).any():
        return np.zeros(0, np.int64)
    inside = kinds > 0
    line = np.where(inside, points, 32).astype(np.int64)
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the first of a run of others stays as the space
    line = np.concatenate([[32], line[keep], [32]])
    if line[-2] == 32:
        line = line[:-1]
    found = []
    for start in range(0, len(line), SLICE):
        part = line[start : start + SLICE + LONGEST - 1]
        made = [part[:SLICE]]
        for n in range(1, LONGEST):
            made.append(made[-1][: len(part) - n] | part[n : n + len(made[-1])] << 21 * n)
        found.append(np.unique(np.concatenate(made)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@dataclass
class Landmarks:
    """Presence sets of some texts as a 0/1 matrix, and the inverse root of their kernel matrix."""

    columns: np.ndarray
    rows: np.ndarray
    sizes: np.ndarray
    root: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernels of a batch of presence sets with all landmarks, by one matrix product."""
        batch = np.zeros((len(sets), len(self.columns)), np.float32)
        for i, s in enumerate(sets):
            at = np.minimum(np.searchsorted(self.columns, s), len(self.columns) - 1)
            batch[i, at[self.columns[at] == s]] = 1
        sizes = np.maximum([len(s) for s in sets], 1)
        return (batch @ self.rows.T).astype(float) / np.sqrt(sizes[:, None] * self.sizes)

    def features(self, sets: list[np.ndarray]) -> np.ndarray:
        """Nyström features, and a constant."""
        return np.concatenate([self.kernel(sets) @ self.root, np.ones((len(sets), 1))], axis=1)


def landmarks(sets: list[np.ndarray]) -> Landmarks:
    columns = np.unique(np.concatenate(sets))
    rows = np.stack([np.isin(columns, s, assume_unique=True) for s in sets]).astype(np.float32)
    found = Landmarks(columns, rows, np.array([len(s) for s in sets], float), np.eye(len(sets)))
    values, vectors = np.linalg.eigh(found.kernel(sets))
    solid = values > 1e-9 * values[-1]
    found.root = vectors[:, solid] / np.sqrt(values[solid])
    return found


@dataclass
class Model:
    names: list[str]
    points: Landmarks
    weights: np.ndarray

    def outputs(self, sets: list[np.ndarray]) -> np.ndarray:
        return self.points.features(sets) @ self.weights

    def predict(self, sets: list[np.ndarray]) -> list[tuple[str, float]]:
        out = self.outputs(sets)
        best = out.argmax(axis=1)
        share = 1 / np.exp(SHARPNESS * (out - out.max(axis=1, keepdims=True))).sum(axis=1)
        return [(self.names[k], float(p)) if len(s) else (UNKNOWN, 0.0) for s, k, p in zip(sets, best.tolist(), share)]


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE, n_landmarks: int = LANDMARKS) -> Model | None:
    """Learn from text and lang of at most ``sample`` documents per language.

    The landmarks' sets come to the driver, and one matrix of sums per partition; the number of languages is that of the model.
    """
    keyed = docs.select("doc_id", "lang").filter("doc_id is not null and lang is not null").filter(~held_out("doc_id"))
    # Of a language with many rows only those with small hashes, about twice ``sample``, are put in order.
    sizes = keyed.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("doc_id").alias("n"))  # of ids: one that repeats is one
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    keyed = keyed.join(sizes, keyed["lang"] == sizes["of"]).filter(share * F.col("n") < 2 * sample).select("doc_id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), "doc_id")
    drawn = keyed.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample)
    drawn = drawn.groupBy("doc_id", "lang").agg(F.min("nth").alias("nth"))
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(drawn), ["doc_id", "lang"])  # bounded by ``sample``
    texts = texts.groupBy("doc_id", "lang").agg(F.min(F.struct("nth", "text")).alias("one"))  # rows that repeat an id count once
    texts = texts.select("lang", "one.text", "one.nth")

    def sets(columns: list[list]) -> Iterator[tuple]:
        for lang, text, nth in zip(*columns):
            found = runs(text)
            if len(found):
                yield lang, nth, found.tolist()

    known = settle(arrow_rows(texts, sets, "lang string, nth int, runs array<long>"))
    names = sorted(r.lang for r in known.select("lang").distinct().collect())
    if not names:
        return None
    chosen = sorted((r.lang, r.nth, r.runs) for r in known.filter(F.col("nth") <= n_landmarks).collect())
    if not chosen:  # the first of a language may be without letters
        chosen = sorted((r.lang, r.nth, r.runs) for r in known.orderBy("nth", "lang").limit(n_landmarks).collect())
    points = landmarks([np.array(s, np.int64) for *_, s in chosen])
    spread = docs.sparkSession.sparkContext.broadcast((points, names))  # sample-bounded: LANDMARKS texts per language

    def sums(columns: list[list]) -> Iterator[tuple]:
        points, names = spread.value
        x = points.features([np.array(s, np.int64) for s in columns[2]])
        y = np.array([[1.0 if lang == name else -1.0 for name in names] for lang in columns[0]])
        yield (len(x), (x.T @ x).ravel().tolist(), (x.T @ y).ravel().tolist())

    n_features = points.root.shape[1] + 1
    batches = arrow_rows(known, sums, "n long, xx array<double>, xy array<double>", at_once=256)
    total, xx, xy = 0, np.zeros(n_features * n_features), np.zeros(n_features * len(names))
    for r in batches.collect():
        total, xx, xy = total + r.n, xx + np.array(r.xx), xy + np.array(r.xy)
    xx, xy = xx.reshape(n_features, n_features), xy.reshape(n_features, len(names))
    return Model(names, points, np.linalg.solve(xx + RIDGE * total * np.eye(n_features), xy))


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per document."""
    spread = docs.sparkSession.sparkContext.broadcast(model)  # its size follows the sample's bound
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        *T._parse_datatype_string("held_out boolean, lang_pred string, score double"),
    ])

    def rows(columns: list[list]) -> Iterator[tuple]:
        keys, out, whole = columns
        model = spread.value
        sets = [runs(t) for t in whole]
        found = model.predict(sets) if model else [(UNKNOWN, 0.0)] * len(sets)
        for key, is_out, (name, score) in zip(keys, out, found):
            yield key, is_out, name, score

    asked = docs.select(doc_id, F.coalesce(held_out(doc_id), F.lit(False)).alias("_out"), text)
    return arrow_rows(asked, rows, schema)
