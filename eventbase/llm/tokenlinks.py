"""Alignment of two tokenizers over the same text, by merging their token ends in lockstep.

1. A batch of whole texts is encoded by both. Tokens become ends in one running count of bytes, so both sides of all
   documents lie on one line. Long texts are encoded in pieces cut before a space between two letters or digits, where
   neither tokenizer has a token across; the pieces' tokens are those of the whole.
2. One state vector holds a pointer into A's ends and one into B's for every lane, a lane being ``SPAN`` bytes of a
   document. Each step compares all lanes at once: where the ends agree a link and a cut are emitted and both pointers
   move, elsewhere the one behind moves. Lanes that are done are compacted away, so the steps follow the lane's length
   and not the longest document's.
3. Links are counted per document and pair of ids, written, and added up over the corpus by Spark. Pairs that make up
   at least one link in ``HEAVY`` (so no more than ``HEAVY`` of them) are broadcast back to the documents; the others
   join by shuffle.

Rules for odd input: null and empty texts, and texts that a tokenizer does not give back byte for byte, have no
tokens: zeros and an empty ``groups_sha256``. Rows that repeat an id are documents each; other columns are not read; an
empty table gives no rows. A very long run without a cut is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventbase.llm.bpe import PIECES
from eventbase.llm.common import settle

PIECE = 1 << 15  # code points from which a text is cut at the next safe place
AT_ONCE = 1 << 19  # code points that are encoded and merged at a time, about
SPAN = 512  # bytes of a lane
HEAVY = 1 << 17
CUT = re.compile(r"(?<=\w) (?=\w)")


def cuts(text: str) -> list[str]:
    """A text in pieces; all but the first have lost the space before them."""
    pieces, start = [], 0
    while len(text) - start > PIECE and (found := CUT.search(text, start + PIECE)):
        pieces.append(text[start : found.start()])
        start = found.end()
    return [*pieces, text[start:]]


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """A tokenizer's tokens as bytes."""

    tokens: list[bytes]

    def __post_init__(self) -> None:
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def text(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class Pair:
    """Both tokenizers, made from the contents of their files."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = tokenizers.Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_of_letter()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        known = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            known[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.side_a = Side(known)
        # A vocabulary in the order of its merges is what this faster library reads: the same tokens, four times as fast.
        model = json.loads(byte_level)["model"]
        joined = ("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
        in_order = all(vocabulary.get(t) == 256 + i for i, t in enumerate(joined)) and len(known) == 256 + len(model["merges"])
        ranks = {t: i for i, t in enumerate(known)}
        self.fast = tiktoken.Encoding("a", pat_str=PIECES.pattern, mergeable_ranks=ranks, special_tokens={}) if in_order else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        made = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            made.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.side_b = Side(made)
        width = len(str(max(len(known), len(made))))
        digits = np.array([str(i).encode() for i in range(max(len(known), len(made)))], f"S{width}")
        self.digits = digits.view(np.uint8).reshape(len(digits), width)

    def encode_a(self, piece: str) -> list[int]:
        if self.fast and len(piece) <= 2 * PIECE:  # its pattern has no room for very long runs of white space
            return self.fast.encode_ordinary(piece)
        return self.a.encode(piece, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text by A and by B; none where one of them does not give the text back."""
        pieces = [cuts(t) for t in texts]
        flat = [p for ps in pieces for p in ps]
        of_a = [self.encode_a(" " + p) for p in flat]
        of_b = self.b.encode(flat, num_threads=1)
        ids_a, ids_b, at = [], [], 0
        for text, ps in zip(texts, pieces):
            a = [i for ids in of_a[at : at + len(ps)] for i in ids]
            b = [i for ids in of_b[at : at + len(ps)] for i in ids]
            at += len(ps)
            want = b" " + text.encode()
            same = bool(text) and self.side_a.text(a) == want and self.side_b.text(b) == want
            ids_a.append(a if same else [])
            ids_b.append(b if same else [])
        return ids_a, ids_b


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ends that both lists have. Lanes lie between neighbouring ``limits``, which start below all ends."""
    at_a, at_b = np.searchsorted(ends_a, limits, "right"), np.searchsorted(ends_b, limits, "right")
    a, stop_a, b, stop_b = at_a[:-1], at_a[1:], at_b[:-1], at_b[1:]
    met_a, met_b = [], []
    while True:
        going = (a < stop_a) & (b < stop_b)
        if not going.all():
            a, stop_a, b, stop_b = a[going], stop_a[going], b[going], stop_b[going]
        if not len(a):
            break
        end_a, end_b = ends_a[a], ends_b[b]
        same = end_a == end_b
        met_a.append(a[same])
        met_b.append(b[same])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
    none = [np.zeros(0, np.int64)]
    return np.sort(np.concatenate(met_a or none)), np.sort(np.concatenate(met_b or none))


@dataclass
class Aligned:
    """A batch of documents: tokens of all in a row, and the places of those that end together."""

    n_a: np.ndarray
    n_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    @property
    def own(self) -> np.ndarray:
        """The document of each link."""
        return np.searchsorted(np.cumsum(self.n_a), self.link_a, "right")


def align(tools: Pair, texts: list[str], span: int = SPAN) -> Aligned:
    ids_a, ids_b = tools.encode(texts)
    n_a, n_b = (np.array([len(i) for i in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.array([i for ids in side for i in ids], np.int64) for side in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(tools.side_a.sizes[a]), np.cumsum(tools.side_b.sizes[b])
    upto = np.concatenate([[0], ends_a])[np.concatenate([[0], np.cumsum(n_a)])]  # bytes before and after each document
    limits = [np.arange(low, high, span) for low, high in zip(upto[:-1].tolist(), upto[1:].tolist())]
    limits = np.concatenate([*limits, upto[-1:]])
    return Aligned(n_a, n_b, a, b, *lockstep(ends_a, ends_b, limits))


def group_digests(tools: Pair, found: Aligned) -> list[str]:
    """SHA-256 of each document's groups as text; empty for documents without tokens."""
    n_a, n_b, width = len(found.a), len(found.b), tools.digits.shape[1]
    of_a = np.searchsorted(found.link_a, np.arange(n_a))  # the group of each token
    of_b = np.searchsorted(found.link_b, np.arange(n_b))
    starts_b = np.concatenate([[0], found.link_b + 1])
    at_a, at_b = np.arange(n_a) + starts_b[of_a], np.arange(n_b) + (found.link_a + 1)[of_b] if n_b else np.zeros(0, np.int64)
    out = np.zeros((n_a + n_b, width + 1), np.uint8)
    out[at_a, :width], out[at_b, :width] = tools.digits[found.a], tools.digits[found.b]
    out[:, width] = ord(",")
    out[at_a[found.link_a], width] = ord("|")
    out[at_b[found.link_b], width] = ord(";")
    last = np.cumsum(found.n_a + found.n_b)
    out[last[found.n_a > 0] - 1, width] = 0
    solid = out != 0
    ends = np.concatenate([[0], np.cumsum(solid.sum(axis=1))])[np.concatenate([[0], last])]
    text = out[solid].tobytes()
    return [hashlib.sha256(text[i:j]).hexdigest() if i < j else "" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


_made: dict[str, Pair] = {}  # parsed once per worker


def links(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs), and B's number of ids.

    ``pairs`` has the links of the document by ``pair`` (A's id times B's number of ids, plus B's id) with their ``times``.
    """
    with open(byte_level, encoding="utf-8") as file, open(pieces, "rb") as other:
        files = file.read(), other.read()
    n_ids = sentencepiece.SentencePieceProcessor(model_proto=files[1]).get_piece_size()
    key = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    spread = docs.sparkSession.sparkContext.broadcast(files)  # two vocabularies: their size does not depend on the data
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        *T._parse_datatype_string(
            "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<pair:long,times:int>>"
        ),
    ])
    arrow = to_arrow_schema(schema)

    def made(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
        if key not in _made:
            _made[key] = Pair(*spread.value)
        tools = _made[key]
        found = align(tools, texts)
        own = found.own
        n_links = np.bincount(own, minlength=len(texts))
        code = found.a[found.link_a] * n_ids + found.b[found.link_b]
        most = max(len(tools.side_a.tokens) * n_ids, 1)
        both, times = np.unique(own * most + code, return_counts=True)
        starts = np.searchsorted(both, np.arange(len(texts) + 1) * most)
        items = pa.StructArray.from_arrays([pa.array(both % most), pa.array(times.astype(np.int32))], names=["pair", "times"])
        n = pa.array(n_links)
        pairs = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), items)
        columns = [keys, pa.array(found.n_a), pa.array(found.n_b), n, n, pa.array(group_digests(tools, found)), pairs]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, texts = 0, 0, []
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py() or "")
                held += len(texts[-1])
                if held >= AT_ONCE or i + 1 == batch.num_rows:
                    yield made(batch.column(0).slice(start, len(texts)), texts)
                    start, held, texts = i + 1, 0, []

    return docs.select(doc_id, text).mapInArrow(run, schema), n_ids


def measure(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one per document."""
    found, n_ids = links(docs, byte_level, pieces, doc_id, text)
    found = settle(found.withColumn("row", F.monotonically_increasing_id()))
    counts = found.select(F.inline("pairs")).groupBy("pair").agg(F.sum("times").alias("count"))
    best = F.max("count").over(Window.partitionBy(F.col("pair") % n_ids))  # no more rows than A has ids
    counts = settle(counts.withColumn("best", F.col("count") == best))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    is_heavy = F.col("count") * heavy >= total
    each = found.select("row", F.inline("pairs"))
    many = counts.filter(is_heavy)  # at most ``heavy`` rows: their counts add up to the total at most
    known = each.join(F.broadcast(many), "pair")
    others = each.join(F.broadcast(many.select("pair")), "pair", "left_anti").join(counts.filter(~is_heavy), "pair")

    def sums(rows: DataFrame) -> DataFrame:
        n_best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0))
        return rows.groupBy("row").agg(n_best.alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))

    summed = sums(known).unionByName(sums(others)).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    none = F.lit(0).cast("long")
    return found.drop("pairs").join(summed, "row", "left").select(
        F.col("doc_id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
