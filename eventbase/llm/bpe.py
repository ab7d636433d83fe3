"""Byte-level BPE as a streaming transducer, and its decoder.

The encoder reads text piece by piece and keeps a bounded amount of it, whatever the length of a
text or of a single run of letters. For a run longer than a window it relies on the *sufficient
lookahead* of the merge list: with that many bytes after it, no later byte can change a token, so
the token is given out and forgotten.

The lookahead: compare the merging of ``w`` with that of ``wx``, rule by rule in order of rank. Both
agree left of some point, at first the end of ``w``. A rule ``(u, v)`` moves the point only if the
last token they agree on is ``u`` and merges in one of them alone; the point then moves left by
``len(u)``, and what stands right of it now starts with ``u``. So the next rule ``(u2, v2)`` that
moves it has a higher rank and a ``v2`` that starts with ``u``. The longest total over such chains
bounds how far a change reaches. A token sequence cut at a token's end merges the same way on its own,
so what follows can be treated as a new text.

Rules for odd input: a null text is an empty one and has no tokens; added tokens of the vocabulary are
found in the text first, as the library does; other columns of the input are kept by ``encode`` and ``decode``,
except those named like the columns they add.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventbase.llm.common import arrow_rows

# Fixed: how the public vocabulary splits text before merging.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]
SPACE_AFTER_SPACE = regex.compile(r"\s ")
UNSURE = 3  # a piece is certain when this many characters follow it
LONG_PIECE = 2048  # characters; longer pieces are streamed
CHUNK = 1 << 16  # characters taken from a text at a time
SHORT = 64  # bytes up to which a list of ranks is faster than a heap
NEVER = 1 << 60  # the rank of a pair without a merge
REMEMBERED = 64  # characters; longer pieces are not kept
BITS = 20  # of an id
MASK = (1 << BITS) - 1
KEPT_PIECES = 150_000  # pieces in use whose tokens a worker remembers; forgetting costs time only


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeList:
    """The vocabulary: ids of byte strings, ranked merges, added tokens, and the sufficient lookahead."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        letter = byte_letters()

        def in_bytes(token: str) -> bytes:
            return bytes(letter[c] for c in token)

        self.ids = {in_bytes(t): i for t, i in spec["model"]["vocab"].items() if all(c in letter for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.merged: dict[int, int] = {}  # pair of ids -> rank and id of the merged token
        known = {bytes([b]) for b in range(256)}
        reach: dict[bytes, int] = {}
        self.lookahead = 0
        for n, rule in enumerate(spec["model"]["merges"]):
            u, v = map(in_bytes, rule.split(" ") if isinstance(rule, str) else rule)
            if u not in known or v not in known or u + v in known:
                raise ValueError(f"merge {n} does not follow from earlier ones: the lookahead would not hold")
            known.add(u + v)
            self.merged[self.ids[u] << BITS | self.ids[v]] = n << BITS | self.ids[u + v]
            chain = len(u) + max(reach.get(v[:i], 0) for i in range(1, len(v) + 1))
            reach[u] = max(reach.get(u, 0), chain)
            self.lookahead = max(self.lookahead, chain)
        self.of_byte = [self.ids[bytes([b])] for b in range(256)]

    def merge(self, data: bytes) -> list[int]:
        """Ids of a byte string: the pair of lowest rank first, the leftmost of equals."""
        return self._merge_short(data) if len(data) <= SHORT else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        get, of_byte = self.merged.get, self.of_byte
        part = [of_byte[b] for b in data]
        ranks = [get(a << BITS | b, NEVER) for a, b in zip(part, part[1:])]
        while ranks and (lowest := min(ranks)) < NEVER:
            i = ranks.index(lowest)
            part[i] = new = lowest & MASK
            del part[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(part[i - 1] << BITS | new, NEVER)
            if i < len(ranks):
                ranks[i] = get(new << BITS | part[i + 1], NEVER)
        return part

    def _merge_long(self, data: bytes) -> list[int]:
        merged, of_byte, end = self.merged, self.of_byte, len(data)
        part: list[int] = [of_byte[b] for b in data]  # -1 where the token to the left took it
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i) for i in range(end - 1) if (r := merged.get(part[i] << BITS | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= end or merged.get(part[i] << BITS | part[j]) != r:
                continue
            part[i], part[j] = r & MASK, -1
            after[i] = j = after[j]
            if j < end:
                before[j] = i
                if (r := merged.get(part[i] << BITS | part[j])) is not None:
                    heapq.heappush(heap, (r, i))
            if (j := before[i]) >= 0 and (r := merged.get(part[j] << BITS | part[i])) is not None:
                heapq.heappush(heap, (r, j))
        return [p for p in part if p >= 0]


class Known(dict):
    """The ids of pieces met before, as text: "12,7". Two generations: what is in use stays when the rest goes."""

    def __init__(self, merges: MergeList) -> None:
        self.merges, self.old = merges, {}

    def __missing__(self, piece: str) -> str:
        if len(piece) > REMEMBERED:
            return self.made(piece)
        if len(self) >= KEPT_PIECES:
            self.old = dict(self)
            self.clear()
        made = self.old.get(piece)
        self[piece] = made = made or self.made(piece)
        return made

    def made(self, piece: str) -> str:
        return ",".join(map(str, self.merges.merge(piece.encode())))


class KnownWords(Known):
    """The same for a space and what follows up to the next: it starts and ends where pieces do."""

    def __init__(self, merges: MergeList) -> None:
        super().__init__(merges)
        self.pieces = Known(merges)

    def made(self, piece: str) -> str:
        return ",".join(map(self.pieces.__getitem__, PIECES.findall(" " + piece)))


class Encoder:
    """Feed text, take ids as soon as they are settled. Ids come as text, joined by commas."""

    def __init__(self, merges: MergeList, words: KnownWords | None = None) -> None:
        self.merges, self.words = merges, words if words is not None else KnownWords(merges)
        self.known = self.words.pieces
        self.window = 4 * merges.lookahead + 256
        self.text = ""  # not yet searched for added tokens
        self.tail = ""  # plain text whose pieces are not certain
        self.run: regex.Pattern | None = None  # inside a long piece: what goes on with it
        self.pending = b""  # bytes of the long piece without tokens yet

    def feed(self, chunk: str) -> list[str]:
        return self._split(chunk, False)

    def finish(self) -> list[str]:
        return self._split("", True)

    def _split(self, chunk: str, last: bool) -> list[str]:
        text, out = self.text + chunk, []
        while hits := [(i, -len(t), t) for t in self.merges.added if (i := text.find(t)) >= 0]:
            at, _, token = min(hits)
            out += self._plain(text[:at], True)
            out.append(str(self.merges.added[token]))
            text = text[at + len(token) :]
        held = 0
        if not last:
            longest = max(map(len, self.merges.added), default=1) - 1
            held = max((n for t in self.merges.added for n in range(1, min(longest, len(text)) + 1)
                        if n < len(t) and text.endswith(t[:n])), default=0)
        self.text = text[len(text) - held :]
        return out + self._plain(text[: len(text) - held], last)

    def _plain(self, text: str, last: bool) -> list[str]:
        text, out = self.tail + text, []
        if self.run is None and (words := text.split(" ")) and self._simple(text, words):
            # every space but the last one's starts a piece
            self.tail = "" if last or len(words) == 1 else " " + words.pop()
            if len(words) == 1 and not last:
                self.tail = words.pop() + self.tail
            out += map(self.known.__getitem__, PIECES.findall(words[0])) if words else []
            out += map(self.words.__getitem__, words[1:])
            return out
        if self.run is not None:
            text = self._go_on(text, last, out)
        found = PIECES.findall(text) if self.run is None else []
        self.tail = text
        if self.run is None:
            unsure = 0
            while found and unsure < UNSURE and not last:
                unsure += len(found.pop())
            out += map(self.known.__getitem__, found) if all(len(p) <= LONG_PIECE for p in found) else self._whole(found)
            self.tail = text[len(text) - unsure :]
            if unsure > LONG_PIECE and (first := PIECES.match(self.tail)[0]) and len(first) > LONG_PIECE:
                self.run = next(p for p in RUNS if p.match(first[-1]))
                self.pending = first[:-1].encode()
                self.tail = self._go_on(self.tail[len(first) - 1 :], last, out)
        return out

    @staticmethod
    def _simple(text: str, words: list[str]) -> bool:
        return max(map(len, words)) <= LONG_PIECE and not SPACE_AFTER_SPACE.search(text)

    def _whole(self, found: list[str]) -> Iterator[str]:
        for piece in found:
            if len(piece) <= LONG_PIECE:
                yield self.known[piece]
            else:
                self.pending = piece.encode()
                yield from self._settled(True)

    def _go_on(self, text: str, last: bool, out: list[str]) -> str:
        """More of a long piece. Its last character stays back until the next is seen: white space may belong to the next piece."""
        more = self.run.match(text)[0] if text else ""
        ended = last or len(more) < len(text)
        if not ended or (len(more) < len(text) and self.run is RUNS[2]):
            more = more[:-1]
        self.pending += more.encode()
        if ended:
            self.run = None
        out += self._settled(ended)
        return text[len(more) :]

    def _settled(self, ended: bool) -> list[str]:
        out, at = [], 0
        while ended and at < len(self.pending) or len(self.pending) - at > self.window:
            part = self.pending[at : at + self.window]
            sure = len(part) if at + len(part) == len(self.pending) and ended else len(part) - self.merges.lookahead
            done = 0
            for i in self.merges.merge(part):
                size = len(self.merges.bytes_of[i])
                if done + size > sure:
                    break
                done += size
                out.append(str(i))
            at += done
        self.pending = self.pending[at:]
        return out


class Decoder:
    """Feed ids, take text. Bytes of a character that is not complete wait for the next ids."""

    def __init__(self, merges: MergeList) -> None:
        known = [merges.bytes_of.get(i, b"") for i in range(max(merges.bytes_of) + 1)]
        self.all = np.frombuffer(b"".join(known), np.uint8)
        self.size = np.fromiter(map(len, known), np.int64, len(known))
        self.start = np.cumsum(self.size) - self.size
        self.reset()

    def reset(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + size, size)
        return self.state.decode(self.all[at].tobytes(), last)


NONE = np.empty(0, np.int64)


def numbers(ids: str) -> np.ndarray:
    return np.fromstring(ids, np.int64, sep=",")


def chunks(text: str) -> Iterator[str]:
    for start in range(0, len(text), CHUNK):
        yield text[start : start + CHUNK]


def encoded(text: str, merges: MergeList, words: KnownWords) -> Iterator[str]:
    """Ids of a text in parts, as text."""
    encoder = Encoder(merges, words)
    for chunk in chunks(text):
        if made := encoder.feed(chunk):
            yield ",".join(made)
    if made := encoder.finish():
        yield ",".join(made)


_loaded: dict[str, tuple[MergeList, KnownWords, Decoder]] = {}


def tools(shared: tuple[str, Broadcast[str]]) -> tuple[MergeList, KnownWords, Decoder]:
    """Parsed once per worker."""
    key, spec = shared
    if key not in _loaded:
        merges = MergeList(spec.value)
        _loaded[key] = merges, KnownWords(merges), Decoder(merges)
    return _loaded[key]


def _shared_spec(df: DataFrame, tokenizer_path: str) -> tuple[str, Broadcast[str]]:
    """The vocabulary file, read by the driver and sent to the workers, and its digest. Its size does not depend on the data."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    return hashlib.sha256(spec.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(spec)


def _adding(df: DataFrame, field: T.StructField) -> tuple[DataFrame, T.StructType]:
    kept = [f for f in df.schema if f.name != field.name]
    return df, T.StructType([*kept, field])


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of a text column as array<int>."""
    spec, (df, schema) = _shared_spec(df, tokenizer_path), _adding(df, T.StructField(ids, T.ArrayType(T.IntegerType())))
    at, kept = df.columns.index(text), [i for i, c in enumerate(df.columns) if c != ids]

    def rows(columns: list[list]) -> Iterator[tuple]:
        merges, words, _ = tools(spec)
        for row in zip(*columns):
            made = [i for part in encoded(row[at] or "", merges, words) for i in numbers(part).tolist()]
            yield (*(row[k] for k in kept), made)

    return arrow_rows(df, rows, schema)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of a column of token ids; null ids give an empty text."""
    spec, (df, schema) = _shared_spec(df, tokenizer_path), _adding(df, T.StructField(text, T.StringType()))
    at, kept = df.columns.index(ids), [i for i, c in enumerate(df.columns) if c != text]

    def rows(columns: list[list]) -> Iterator[tuple]:
        _, _, decoder = tools(spec)
        for row in zip(*columns):
            decoder.reset()
            yield (*(row[k] for k in kept), decoder.feed(np.array(row[at] or [], np.int64), True))

    return arrow_rows(df, rows, schema)


def round_trip(df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one stream: counts and digests of ids and text, nothing else is kept."""
    spec = _shared_spec(df, tokenizer_path)
    schema = T.StructType([df.schema[doc_id], *T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string")])

    def rows(columns: list[list]) -> Iterator[tuple]:
        merges, words, decoder = tools(spec)
        for key, whole in zip(*columns):
            n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            decoder.reset()
            for part in encoded(whole or "", merges, words):
                of_ids.update(f"{',' if n else ''}{part}".encode())
                ids = numbers(part)
                n += len(ids)
                of_text.update(decoder.feed(ids).encode())
            of_text.update(decoder.feed(NONE, True).encode())
            yield key, n, of_ids.hexdigest(), of_text.hexdigest()

    return arrow_rows(df.select(doc_id, text), rows, schema)
