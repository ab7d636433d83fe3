"""Passages that repeat across documents, exactly or nearly, by chaining shared seeds.

1. Seeds: of every six neighbouring five-word shingles the one with the smallest hash (a minimiser). Documents that share
   ten words in a row share a seed.
2. The first document with a seed (smallest id, then position) is its holder. Every other occurrence is matched
   with the holder's alone, so the matches grow with the text, not with the square of a seed's frequency. What a text
   says again and again is matched n-th time with n-th time, and a passage it holds twice also with the first time.
3. Per pair of documents, matches on one diagonal that touch are joined into fragments, and fragments that
   come in the same order in both are chained: the best chain to each fragment is looked up in a Fenwick tree of
   prefix maxima, with a cost per word of gap on either side.
4. Chains are aligned word by word: fragments as they are, the gaps between them and the text beyond their ends by
   edit distance. A passage is a maximal run of the alignment in which four of five words agree, of at least 50 words.
5. What is left: two shared seeds in a row of which no passage so far covers either have a holder of their own, the first
   document with both, and are matched, chained and aligned in the same way. So where the parts of a passage have different
   holders, the documents that share the whole are compared by the seeds on either side of the joins.

Words are runs without ASCII white space, lower-cased A-Z, compared by a 64-bit hash. Of a repeated passage the
smallest document keeps its own; the others are said to repeat it. Repetition within one document is not looked for.

Rules for odd input: null and short texts have no seeds; a null id is not matched; rows that repeat an id are taken as one
document that holds the texts of all (matches between them are none; of a seed that several of them have, one place counts); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventbase.llm.common import arrow_rows, discard, free_name, settle

SHINGLE = 5  # words
WINDOW = 6  # shingles of which one is a seed
LEAST_WORDS = 50  # of a passage
SIMILARITY = 0.8
GAP_COST = 0.2  # per word of a gap on either side, against 1 per word matched
LONGEST_GAP = 64  # words between fragments of one chain
LEAST_SCORE = 6.0  # of a chain: more than one seed alone
NEXT_SEED = 18  # words to the next seed at most, for two in a row
MARGIN = 64  # words beside a chain that are looked at; windows start and end at multiples of it

SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
STEP = 0x9E3779B97F4A7C15  # odd: the hash of a word is a polynomial in it, modulo 2**64
PIECE = 1 << 16  # bytes hashed at once


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, lower-cased A-Z, from sums over many words at once."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    found, began, goes_on = [np.zeros(0, np.uint64)], 0, False
    for at in range(0, len(data), PIECE):
        codes = CODES[data[at : at + PIECE]]
        solid = codes != 0
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        begins = np.flatnonzero(first)
        if len(begins):
            sums = np.add.reduceat(codes * POWERS[: len(codes)], begins) * INVERSES[begins]
            if goes_on and solid[0]:  # the rest of a word of the piece before
                found[-1][-1:] += sums[:1] * np.uint64(pow(STEP, at - began, 1 << 64))
                begins, sums = begins[1:], sums[1:]
            if len(begins):
                began = at + int(begins[-1])
                found.append(sums)
        goes_on = bool(solid[-1])
    return _stirred(np.concatenate(found))


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the minimisers, and whether a row is a second one of its place.

    The second and later occurrences of a seed in the text are seeds of their own, told apart by their number. Where
    at least ``LEAST_WORDS`` lie between an occurrence and the one before it, it is also given as if it were the first.
    """
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    mixed = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        mixed = _mixed(mixed, words[i : i + n])
    mixed = _stirred(mixed)
    width = min(WINDOW, n)
    least, of = mixed[: n - width + 1], np.zeros(n - width + 1, np.int8)
    for i in range(1, width):  # the first minimum of each window
        less = mixed[i : i + len(of)] < least
        least, of[less] = np.minimum(least, mixed[i : i + len(of)]), i
    at = of + np.arange(len(of))
    at = at[np.append(True, at[1:] != at[:-1])]  # the first minimum never moves back
    found = mixed[at]
    order = np.argsort(found, kind="stable")
    places = np.arange(len(at))
    new = np.append(True, found[order][1:] != found[order][:-1])
    nth = np.empty(len(at), np.uint64)
    nth[order] = places - np.maximum.accumulate(np.where(new, places, 0))
    far = np.zeros(len(at), bool)
    far[order[1:]] = ~new[1:] & (np.diff(at[order]) >= LEAST_WORDS)
    own = np.where(nth > 0, _stirred(_mixed(found, nth)), found)
    at, own, again = np.append(at, at[far]), np.append(own, found[far]), np.append(np.zeros(len(at), bool), far[far])
    return at, own.view(np.int64), again


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * np.uint64(0x9E3779B97F4A7C15) + b


def _stirred(a: np.ndarray) -> np.ndarray:
    a = (a ^ a >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return a ^ a >> np.uint64(32)


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.append(np.uint64(1), np.full(PIECE - 1, base, np.uint64)))


POWERS, INVERSES = _powers(STEP), _powers(pow(STEP, -1, 1 << 64))
# A number for every byte, none for white space, one for both cases of A-Z.
CODES = np.where(SPACE, np.uint64(0), _stirred(_mixed(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64), np.uint64(STEP))))


def seed_rows(docs: DataFrame) -> DataFrame:
    """Rows (seed, doc, pos, again) of a table (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("seed", T.LongType()), T.StructField("doc", kind), *T._parse_datatype_string("pos int, again boolean")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = [seeds(word_hashes(t)) for t in part.column(1).to_pylist()]
                own = np.repeat(np.arange(len(found)), [len(at) for at, *_ in found])
                if len(own):
                    pos, seed, again = (np.concatenate(c) for c in zip(*found))
                    made = [pa.array(seed), part.column(0).take(pa.array(own)), pa.array(pos.astype(np.int32)), pa.array(again)]
                    yield pa.RecordBatch.from_arrays(made, names=["seed", "doc", "pos", "again"])

    return docs.select("doc_id", "text").filter("doc_id is not null").mapInArrow(run, schema)


def shared_seeds(docs: DataFrame) -> DataFrame:
    """Rows (seed, doc, pos, again, first, first_pos): every occurrence of a seed that occurs twice or more, and its holder's."""
    found = settle(seed_rows(docs))
    # A holder holds a seed once: what a text repeats as if it were the first has an occurrence before it. Numbers, not
    # structs, are aggregated, so that rows are hashed and not sorted.
    held = found.filter("not again").groupBy("seed").agg(F.min("doc").alias("first"), F.min_by("pos", "doc").alias("first_pos"), F.count("*").alias("n"))
    # Written by itself: few seeds are shared, and the shuffles of all seeds for this and for the join never lie on disk together.
    held = settle(held.filter("n > 1").drop("n"))
    # "merge" here and below: the same plan at every size, also where one side happens to be small.
    shared = settle(found.join(held.hint("merge"), "seed").select("seed", "doc", "pos", "again", "first", "first_pos"))
    discard(found, held)
    return shared


def matches(shared: DataFrame) -> DataFrame:
    """Rows (doc, pos, first, first_pos): an occurrence of a seed and its holder's."""
    return shared.filter(F.col("doc") != F.col("first")).select("doc", "pos", "first", "first_pos")


def pair_matches(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Rows like those of ``matches``, by two shared seeds in a row that the passages ``found`` leave uncovered."""
    spans = found.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(F.struct("start_word", "n_words")).alias("spans"))

    def covers(s: Column) -> Column:
        return (s["start_word"] <= F.col("pos")) & (F.col("pos") + SHINGLE <= s["start_word"] + s["n_words"])

    left = shared.filter("not again").join(spans, "doc", "left").filter(~F.coalesce(F.exists("spans", covers), F.lit(False))).drop("spans")
    row = F.struct("seed", "pos", "first", "first_pos")
    rows = left.withColumn("next", F.lead(row).over(Window.partitionBy("doc").orderBy("pos")))
    rows = settle(rows.filter(F.col("next.pos") - F.col("pos") <= NEXT_SEED).withColumn("next_seed", F.col("next.seed")))
    by = F.min(F.struct(F.col("doc"), F.col("pos"), F.col("next.pos").alias("next_pos")))
    both = rows.groupBy("seed", "next_seed").agg(by.alias("by"), F.count("*").alias("n")).filter("n > 1").drop("n")
    same = (F.col("first") == F.col("by.doc")) & (F.col("first_pos") == F.col("by.pos"))
    same &= (F.col("next.first") == F.col("by.doc")) & (F.col("next.first_pos") == F.col("by.next_pos"))
    met = rows.join(both, ["seed", "next_seed"]).filter((F.col("doc") != F.col("by.doc")) & ~same)
    pairs = F.inline(F.array(
        F.struct(F.col("pos"), F.col("by.doc").alias("first"), F.col("by.pos").alias("first_pos")),
        F.struct(F.col("next.pos").alias("pos"), F.col("by.doc").alias("first"), F.col("by.next_pos").alias("first_pos")),
    ))
    return met.select("doc", pairs).distinct()


class PrefixMax:
    """A Fenwick tree: put values at places, ask for the greatest at or before one."""

    def __init__(self, size: int) -> None:
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if self.best[place] < value:
                self.best[place] = value
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        found, place = (float("-inf"), -1), place + 1
        while place > 0:
            found = max(found, self.best[place])
            place -= place & -place
        return found


def fragments(pos: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int]]:
    """Matches that touch on one diagonal, joined: (position, other's position, words)."""
    order = np.lexsort((pos, pos - other))
    pos, other = pos[order], other[order]
    new = np.ones(len(pos), bool)
    new[1:] = (np.diff(pos - other) != 0) | (np.diff(pos) > SHINGLE)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(pos)) - 1
    found = zip(pos[starts].tolist(), other[starts].tolist(), (pos[ends] - pos[starts] + SHINGLE).tolist())
    return sorted(found)


def chains(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Fragments in chains, best first, each fragment in one at most.

    A chain whose words all lie in fragments of better chains is left out: they are aligned already.
    """
    ends = sorted({o + n for _, o, n in parts})
    place = {e: i for i, e in enumerate(ends)}
    starts_at = np.searchsorted(ends, [o for _, o, _ in parts], side="right") - 1
    events = sorted([(p, 1, i) for i, (p, _, _) in enumerate(parts)] + [(p + n, 0, i) for i, (p, _, n) in enumerate(parts)])
    tree = PrefixMax(len(ends))
    score, before = [0.0] * len(parts), [-1] * len(parts)
    for _, opens, i in events:
        p, o, n = parts[i]
        if opens:
            best, j = tree.upto(int(starts_at[i]))
            best -= GAP_COST * (p + o)
            score[i] = n + max(0.0, best)
            near = j >= 0 and max(p - parts[j][0] - parts[j][2], o - parts[j][1] - parts[j][2]) <= LONGEST_GAP
            if best > 0 and near:
                before[i] = j
            else:
                score[i] = float(n)
        else:
            tree.put(place[o + n], (score[i] + GAP_COST * (p + o + 2 * n), i))
    used = [False] * len(parts)
    low = parts[0][0] if parts else 0
    covered = np.zeros(max((p + n for p, _, n in parts), default=0) - low, bool)
    out = []
    for i in sorted(range(len(parts)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(parts[i])
            i = before[i]
        if sum(n for *_, n in chain) >= LEAST_SCORE and not all(covered[p - low : p - low + n].all() for p, _, n in chain):
            out.append(chain[::-1])
            for p, _, n in chain:
                covered[p - low : p - low + n] = True
    return out


def chain_rows(found: DataFrame) -> DataFrame:
    """Chains of all pairs of documents, from ``matches``: one row per chain, with its fragments."""
    kind = found.schema["doc"].dataType
    schema = T.StructType(
        [T.StructField("doc", kind), T.StructField("first", kind), T.StructField("parts", T.ArrayType(T.ArrayType(T.IntegerType())))]
    )
    ordered = found.repartition("doc").sortWithinPartitions("doc", "first", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            doc, first = (held.column(c).to_numpy() for c in ("doc", "first"))
            cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (first[1:] != first[:-1])) + 1
            if len(cuts):
                yield from made(held.slice(0, int(cuts[-1])), np.append(0, cuts))
                held = held.slice(int(cuts[-1]))
        if held is not None and held.num_rows:
            yield from made(held, np.array([0, held.num_rows]))

    def made(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc, first, pos, other = (table.column(c).to_numpy() for c in ("doc", "first", "pos", "first_pos"))
        docs, firsts, parts = [], [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            for chain in chains(fragments(pos[a:b].astype(np.int64), other[a:b].astype(np.int64))):
                docs.append(doc[a])
                firsts.append(first[a])
                parts.append(chain)
        if docs:
            types = [table.schema.field("doc").type, table.schema.field("first").type, pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((docs, firsts, parts), types)], names=["doc", "first", "parts"]
            )

    return ordered.mapInArrow(run, schema)


def _blocks(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Runs (i, j, n) in which two short word lists agree, in order."""
    if len(a) == len(b):
        same = [x == y for x, y in zip(a, b)]
        if sum(same) >= SIMILARITY * len(a):
            starts = [i for i, s in enumerate(same) if s and (not i or not same[i - 1])]
            ends = [i + 1 for i, s in enumerate(same) if s and (i + 1 == len(same) or not same[i + 1])]
            return [(i, i, j - i) for i, j in zip(starts, ends)]
    return [(i, j, n) for i, j, n in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if n]


def may_agree(words: np.ndarray, others: np.ndarray) -> bool:
    """Whether two windows have as many words in common as the shortest passage needs."""
    (a, times_a), (b, times_b) = np.unique(words, return_counts=True), np.unique(others, return_counts=True)
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    return int(np.minimum(times_a[at], times_b[to]).sum()) >= SIMILARITY * LEAST_WORDS


def align(words: np.ndarray, start: int, others: np.ndarray, other_start: int, parts: list[list[int]]) -> list[tuple[int, int, int, int, float]]:
    """Passages (position, words, other's position, other's words, similarity) along a chain.

    ``words`` are those of the document from ``start`` on, ``others`` those of the holder.
    """
    agree: list[tuple[int, int, int]] = []  # runs of words that agree
    at, to = max(start, parts[0][0] - MARGIN), max(other_start, parts[0][1] - MARGIN)
    before = min(parts[0][0] - at, parts[0][1] - to)
    at, to = parts[0][0] - before, parts[0][1] - before
    for p, o, n in [*parts, [parts[-1][0] + parts[-1][2] + MARGIN, parts[-1][1] + parts[-1][2] + MARGIN, 0]]:
        gap = words[at - start : p - start].tolist(), others[to - other_start : o - other_start].tolist()
        if not n:
            gap = tuple(g[: min(map(len, gap))] for g in gap)
        agree += [(at + i, to + j, k) for i, j, k in _blocks(*gap)]
        if n:
            agree.append((p, o, n))
        at, to = p + n, o + n
    # +1 for a word that agrees, -4 for one that does not: positive runs have more than four of five
    cost = SIMILARITY / (1 - SIMILARITY)
    runs: list[list[float]] = []  # score before, score after, first and last run of words: Ruzzo and Tompa's maximal runs
    total, upto = 0.0, [0]
    for k, (p, o, n) in enumerate(agree):
        if k:
            q, s, m = agree[k - 1]
            total -= cost * max(p - q - m, o - s - m)
        run = [total, total + n, k, k]
        total += n
        upto.append(upto[-1] + n)
        while True:
            j = next((j for j in range(len(runs) - 1, -1, -1) if runs[j][0] < run[0]), None)
            if j is None or runs[j][1] >= run[1]:
                runs.append(run)
                break
            run = [runs[j][0], run[1], runs[j][2], run[3]]
            del runs[j:]
    out = []
    for _, _, i, j in runs:
        (p1, o1, _), (p2, o2, last) = agree[int(i)], agree[int(j)]
        n, m = p2 + last - p1, o2 + last - o1
        if n >= LEAST_WORDS:
            out.append((p1, n, o1, m, (upto[int(j) + 1] - upto[int(i)]) / max(n, m)))
    return [x for x in out if x[4] >= SIMILARITY]


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, first_doc_id, start_word, n_words, first_start_word, first_n_words, similarity), each a passage.

    ``doc_id`` repeats what ``first_doc_id``, which is smaller, has. Word positions count from 0.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = shared_seeds(docs)
    found = aligned_chains(docs, chain_rows(matches(shared)))
    more = aligned_chains(docs, chain_rows(pair_matches(shared, found)))
    discard(shared)
    return found.unionByName(more).distinct()


def aligned_chains(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The passages along the chains of ``chain_rows``, settled."""
    last = F.element_at("parts", -1)

    def low(i: int) -> Column:
        return F.greatest(F.lit(0), F.floor((F.col("parts")[0][i] - MARGIN) / MARGIN) * MARGIN).cast("int")

    def high(i: int) -> Column:
        return (F.ceil((last[i] + last[2] + MARGIN) / MARGIN) * MARGIN).cast("int")

    chained = settle(
        found.select("*", low(0).alias("lo"), high(0).alias("hi"), low(1).alias("first_lo"), high(1).alias("first_hi"))
    )
    asked = chained.select(F.col("doc").alias("doc_id"), "lo", "hi").unionByName(
        chained.select(F.col("first").alias("doc_id"), F.col("first_lo").alias("lo"), F.col("first_hi").alias("hi"))
    )
    # Windows start and end at multiples of MARGIN, so that chains over the same words ask for the same window.
    asked = asked.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("windows"))
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("of", kind), *T._parse_datatype_string("from int, upto int, words array<long>")])

    def cut(columns: list[list]) -> Iterator[tuple]:
        for key, whole, windows in zip(*columns):
            words = word_hashes(whole).view(np.int64)
            for w in windows:
                yield key, w["lo"], w["hi"], words[w["lo"] : w["hi"]]

    texts = settle(arrow_rows(docs.join(asked.hint("merge"), "doc_id"), cut, schema))
    own = texts.select(F.col("of").alias("doc"), F.col("from").alias("lo"), F.col("upto").alias("hi"), "words")
    other = texts.select(
        F.col("of").alias("first"), F.col("from").alias("first_lo"), F.col("upto").alias("first_hi"), F.col("words").alias("others")
    )
    both = chained.join(other, ["first", "first_lo", "first_hi"]).join(own, ["doc", "lo", "hi"])
    both = both.select("doc", "first", "parts", "lo", "first_lo", "words", "others")
    schema = T.StructType(
        [
            T.StructField("doc_id", kind), T.StructField("first_doc_id", kind),
            *T._parse_datatype_string("start_word int, n_words int, first_start_word int, first_n_words int, similarity double"),
        ]
    )

    arrow = to_arrow_schema(schema)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            doc, first, parts, lo, first_lo = (batch.column(i).to_pylist() for i in range(5))
            for i in range(batch.num_rows):
                words, others = (batch.column(c)[i].values.to_numpy() for c in (5, 6))
                if sum(n for *_, n in parts[i]) >= SIMILARITY * LEAST_WORDS or may_agree(words, others):
                    for p, n, o, m, like in align(words, lo[i], others, first_lo[i], parts[i]):
                        made.append((doc[i], first[i], p, n, o, m, like))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)

    passed = settle(both.mapInArrow(aligned, schema).distinct())
    discard(chained, texts)
    return passed


def cut_out(text: str | None, spans: list[tuple[int, int]]) -> str:
    """A text without the given words (start, count) and the white space after them."""
    data = (text or "").encode()
    solid = ~SPACE[np.frombuffer(data, np.uint8)]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = np.append(np.flatnonzero(first), len(data))
    gone = np.zeros(len(data) + 1, np.int64)
    for start, n in spans:
        end = min(start + n, len(begins) - 1)
        if start < end:
            gone[begins[start]] += 1
            gone[begins[end]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return np.frombuffer(data, np.uint8)[keep].tobytes().decode()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents without the passages that a document with a smaller id has. Columns stay; ``n_chars`` follows the text.

    Documents of which no word is left go; those that had none to begin with stay.
    """
    found = settle(passages(docs, doc_id, text))
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "n_words")).alias("_spans"))
    spans = settle(spans.withColumnRenamed("doc_id", "_doc"))
    joined = docs.join(spans.hint("merge"), docs[doc_id] == spans["_doc"], "left")
    joined = joined.select(*(docs[c] for c in docs.columns), spans["_spans"].alias(free_name(docs, "spans")))
    at, schema = docs.columns.index(text), docs.schema
    counted = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def rows(columns: list[list]) -> Iterator[tuple]:
        for *row, spans in zip(*columns):
            if spans:
                row[at] = cut_out(row[at], [(s["start_word"], s["n_words"]) for s in spans])
                if counted is not None:
                    row[counted] = len(row[at])
                if not row[at].strip(" \t\n\r\x0b\x0c"):
                    continue
            yield tuple(row)

    return arrow_rows(joined, rows, schema)
