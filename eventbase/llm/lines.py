"""Quality rules: base counts of a text, and a linear-chain conditional random field over its lines.

Each line with a word is marked content or boilerplate by Viterbi decoding; a text whose content lines
hold at least half of its words is kept. The field has one weight per line feature, one per pair of
neighbouring marks and one per first mark, and is fitted by its exact likelihood (forward-backward).

Only documents are labelled, their lines are not. So marks are found in turns with the weights: at first every line of the sample
carries its document's quality; then lines are marked by Viterbi under the weights found, with a leaning towards their document's
quality that most of its lines must follow, and the weights are fitted to these marks. Good documents so come to hold boilerplate lines and the reverse. Of the
transitions seen, a small part is spread evenly over all pairs of marks, so that change is never ruled out.

The sample is bounded by a number of labelled documents and by a number of lines: documents are taken in the order of a hash, whatever
their length, up to the one that reaches it. Long ones are fitted in pieces.

Rules for odd input: a null text has no words and fails the base rules, as does any with fewer than ten
words; lines without a word are neither marked nor counted; without labelled lines of both kinds there is
no field, which is warned of, and every line is content. Rows that repeat an id are judged each on its own.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.llm.common import arrow_filter, arrow_rows, discard, settle

LEAST_WORDS = 10
WINDOW = 5  # words
MOST_REPEATED = 20  # per cent of words
CONTENT_SHARE = 0.5
SAMPLE_DOCUMENTS = 2000  # labelled documents the field is fitted on, those with the smallest hashes of their ids
SAMPLE_LINES = 1 << 15  # of these; the document that reaches it is the last
PIECE = 64  # lines of a sequence that is fitted
TURNS = 1  # times the lines of the sample are marked anew
LEANINGS = (1.0, 2.0, 4.0, 8.0)  # towards the document's quality, per line
SWITCH = 2.0  # what a change of mark costs while the sample is marked
SPREAD = 0.03  # of the transitions seen

SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
UPPER = np.isin(np.arange(256), list(range(65, 91)))
DIGIT = np.isin(np.arange(256), list(range(48, 58)))
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
LATER_BYTE = np.isin(np.arange(256), list(range(0x80, 0xC0)))  # of a code point
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def n_repeat_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur twice or more."""
    if len(words) < WINDOW + 1:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - WINDOW + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    _, which, times = np.unique(mixed, return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(times[which] > 1)  # equal windows have equal codes; the words decide
    counts: dict[tuple, int] = {}
    for i in maybe.tolist():
        window = tuple(words[i : i + WINDOW])
        counts[window] = counts.get(window, 0) + 1
    inside = np.zeros(len(words) + 1, np.int64)
    for i in maybe.tolist():
        if counts[tuple(words[i : i + WINDOW])] > 1:
            inside[i] += 1
            inside[i + WINDOW] -= 1
    return int((np.cumsum(inside) > 0).sum())


@dataclass
class Lines:
    """What the rules see of a text: its counts, and of each line with a word the number of words and the features."""

    base: tuple[int, int, int, int, int] = (0, 0, 0, 0, 0)
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    features: np.ndarray = field(default_factory=lambda: np.zeros((0, N_FEATURES)))


N_FEATURES = 10


def look(text: str | None) -> Lines:
    data = (text or "").encode()
    words = data.split()
    if not words:
        return Lines((0, 0, int(SYMBOL[np.frombuffer(data, np.uint8)].sum()), 0, 0))
    octets = np.frombuffer(data, np.uint8)
    solid = ~SPACE[octets]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.concatenate([[0], np.flatnonzero(octets == 10) + 1])
    starts = starts[starts < len(octets)]

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64)

    # words with a symbol in them, counted at the place where they begin
    begins = np.flatnonzero(first)
    marked = np.zeros(len(octets), bool)
    marked[begins] = np.add.reduceat(SYMBOL[octets], begins, dtype=np.int64) > 0
    n_marked = per_line(marked)
    n_words, n_solid, n_letters = per_line(first), per_line(solid), per_line(LETTER[octets])
    n_symbols, n_upper, n_digits = per_line(SYMBOL[octets]), per_line(UPPER[octets]), per_line(DIGIT[octets])
    has = n_words > 0
    seen: set[bytes] = set()
    lines = data.split(b"\n")
    repeated = np.zeros(len(starts))
    ends = np.zeros(len(starts))
    for i in np.flatnonzero(has).tolist():
        line = lines[i]
        if line in seen:
            repeated[i] = 1
        seen.add(line)
        ends[i] = line.rstrip()[-1:] in (b".", b"?", b"!")
    base = (
        len(words), int((solid & ~LATER_BYTE[octets]).sum()), int(n_symbols.sum()), int(repeated.sum()), n_repeat_words(words),
    )
    n_words, n_solid = n_words[has], n_solid[has]
    others = n_solid - n_letters[has] - n_digits[has] - n_symbols[has]
    features = np.stack(
        [
            np.ones(len(n_words)),
            np.minimum(4 * n_symbols[has] / n_solid, 1.5),
            n_marked[has] / n_words,
            n_upper[has] / np.maximum(1, n_letters[has]),
            n_digits[has] / n_solid,
            np.minimum(4 * others / n_solid, 1.5),
            np.minimum(n_solid / n_words / 10, 2),
            np.log1p(n_words) / 5,
            repeated[has],
            ends[has],
        ],
        axis=1,
    )
    # the evidence of a line grows with its length
    return Lines(base, n_words, features * np.clip((n_words / 8) ** 0.25, 0.7, 2)[:, None])


def base_failed(base: tuple[int, ...]) -> bool:
    return base[0] < LEAST_WORDS or 100 * base[4] > MOST_REPEATED * base[0]


@dataclass
class Field:
    """Scores of a linear-chain field over two marks: 0 boilerplate, 1 content."""

    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray

    def marks(self, features: np.ndarray, leaning: float = 0.0) -> np.ndarray:
        """The best sequence of marks, by Viterbi; ``leaning`` is added to the score of content for each line."""
        gain = (features @ self.weights + leaning).tolist()
        if not gain:
            return np.zeros(0, bool)
        (p00, p01), (p10, p11) = self.pairs.tolist()
        boiler, content = float(self.start[0]), float(self.start[1]) + gain[0]
        came: list[tuple[bool, bool]] = []  # whether the best way to each mark comes from content
        for g in gain[1:]:
            a, b, c, d = boiler + p00, content + p10, boiler + p01, content + p11
            came.append((b > a, d > c))
            boiler, content = max(a, b), max(c, d) + g
        out = [content >= boiler]
        for from_content in reversed(came):
            out.append(from_content[out[-1]])
        return np.array(out[::-1], bool)

    def content_share(self, lines: Lines) -> float:
        total = int(lines.words.sum())
        return float(lines.words[self.marks(lines.features)].sum() / total) if total else 0.0


def fit_field(
    sequences: list[np.ndarray], marks: list[np.ndarray] | list[int], rounds: int = 150, penalty: float = 1.0, spread: float = 0.0
) -> Field | None:
    """Maximise the likelihood of the marks, which are one per line, or one for all lines of a sequence.

    ``spread`` is the part of the transitions that counts evenly for all pairs. None if there is one kind of mark alone.
    """
    known = [(s, m) for s, m in zip(sequences, marks) if len(s)]
    if len({bool(x) for _, m in known for x in np.atleast_1d(m)}) < 2:
        return None
    sequences, marks = [s for s, _ in known], [m for _, m in known]
    longest = max(len(s) for s in sequences)
    x = np.zeros((len(sequences), longest, sequences[0].shape[1]))
    real = np.zeros((len(sequences), longest), bool)
    y = np.zeros((len(sequences), longest), bool)
    for i, (s, m) in enumerate(zip(sequences, marks)):
        x[i, : len(s)], real[i, : len(s)], y[i, : len(s)] = s, True, m
    n_features = x.shape[2]
    seen_w = (x * (real & y)[:, :, None]).sum((0, 1))
    steps = real[:, 1:].sum()
    seen_pairs = np.array([[(real[:, 1:] & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    seen_pairs = (1 - spread) * seen_pairs + spread * steps / 4
    seen_start = np.array([(y[:, 0] == m).sum() for m in (0, 1)], float)
    theta = np.zeros(n_features + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for round_ in range(1, rounds + 1):
        w, pairs, start = theta[:n_features], theta[n_features : n_features + 4].reshape(2, 2), theta[n_features + 4 :]
        score = np.stack([np.zeros(real.shape), x @ w], axis=2)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(forward[:, t - 1, :1] + pairs[0], forward[:, t - 1, 1:] + pairs[1]) + score[:, t]
            forward[:, t] = np.where(real[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            to = score[:, t + 1] + backward[:, t + 1]
            new = np.logaddexp(to[:, :1] + pairs[:, 0], to[:, 1:] + pairs[:, 1])
            backward[:, t] = np.where(real[:, t + 1, None], new, 0)
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])[:, None]
        content = np.where(real, np.exp(forward[:, :, 1] + backward[:, :, 1] - total), 0)
        expected = np.zeros((2, 2))
        if steps:
            for a in (0, 1):
                for b in (0, 1):
                    both = forward[:, :-1, a] + pairs[a, b] + score[:, 1:, b] + backward[:, 1:, b] - total
                    expected[a, b] = np.exp(np.where(real[:, 1:], both, -np.inf)).sum()
        slope = np.concatenate(
            [
                seen_w - (x * content[:, :, None]).sum((0, 1)),
                (seen_pairs - expected).ravel(),
                seen_start - np.array([(1 - content[:, 0]).sum(), content[:, 0].sum()]),
            ]
        )
        slope = (slope - penalty * theta) / len(sequences)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**round_)) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-8)
    return Field(theta[:n_features], theta[n_features : n_features + 4].reshape(2, 2), theta[n_features + 4 :])


def fit_lines(sequences: list[np.ndarray], qualities: list[int]) -> Field | None:
    """Find marks of the lines and weights in turns, from documents that have one quality each."""
    known = [(s[i : i + PIECE], q) for s, q in zip(sequences, qualities) for i in range(0, len(s), PIECE)]
    pieces = [s for s, _ in known]
    field_ = fit_field(pieces, [q for _, q in known], spread=SPREAD)
    for _ in range(TURNS if field_ else 0):
        field_ = fit_field(pieces, [marks_towards(field_, s, bool(q)) for s, q in known], spread=SPREAD)
    return field_


def marks_towards(field_: Field, features: np.ndarray, good: bool) -> np.ndarray:
    """Marks of a labelled document's lines, of which most are as the document is: it leans more until they are."""
    change = Field(field_.weights, np.array([[0.0, -SWITCH], [-SWITCH, 0.0]]), np.zeros(2))
    for leaning in LEANINGS:
        marks = change.marks(features, leaning if good else -leaning)
        if 2 * (marks == good).sum() > len(marks):
            return marks
    return np.full(len(features), good)


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """Fit the field on a bounded sample of the documents that have a quality label.

    Rows with crc32(doc_id as text) mod 4 = 2 are held out. Only line features of the sample come to the driver.
    """
    usable = labels.filter("quality in (0, 1) and crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id", "quality")
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE_DOCUMENTS)
    drawn = drawn.withColumn("nth", F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "quality")))  # of the sample
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # bounded by SAMPLE_DOCUMENTS

    def rows(columns: list[list]) -> Iterator[tuple]:
        for _, text, quality, nth in zip(*columns):
            features = look(text).features
            if len(features):
                yield nth, len(features), quality, features.ravel().tolist()

    found = settle(arrow_rows(sample, rows, "nth int, n int, quality int, features array<double>"))
    upto, last = 0, 0
    for r in found.groupBy("nth").agg(F.sum("n").alias("n")).orderBy("nth").collect():
        if upto < SAMPLE_LINES:
            upto, last = upto + r.n, r.nth
    known = sorted((r.nth, r.quality, r.features) for r in found.filter(F.col("nth") <= last).collect())
    discard(found)
    fitted = fit_lines([np.array(f).reshape(-1, N_FEATURES) for *_, f in known], [q for _, q, _ in known])
    if fitted is None:
        warnings.warn("no labelled lines of both kinds: every line counts as content", stacklevel=2)
    return fitted


def verdict(field_: Field | None, lines: Lines) -> tuple[bool, bool, float]:
    """base_failed, kept, content share."""
    failed = base_failed(lines.base)
    share = field_.content_share(lines) if field_ else float(lines.base[0] > 0)
    return failed, not failed and share >= CONTENT_SHARE, share


def judge(docs: DataFrame, field_: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, counts, base_failed, kept, content_share), one per document."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            *T._parse_datatype_string(f"{BASE}, base_failed boolean, kept boolean, content_share double"),
        ]
    )

    def rows(columns: list[list]) -> Iterator[tuple]:
        for key, whole in zip(*columns):
            lines = look(whole)
            yield (key, *lines.base, *verdict(field_, lines))

    return arrow_rows(docs.select(doc_id, text), rows, schema)


def keep_good(docs: DataFrame, field_: Field | None, text: str = "text") -> DataFrame:
    """The documents that pass, with all of their columns."""
    return arrow_filter(docs, [text], lambda columns: [verdict(field_, look(t))[1] for t in columns[0]])
