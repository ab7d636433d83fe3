"""The transducer and the decoder against the public library, in chunks of every size."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventbase.llm import bpe
from eventbase.llm.queries import op10_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "1", "23", "!", "--", "é", "ß", "a b", " c", "漢", "😀", "<|endoftext|>", "<|endof", "|>", " ", "\x85", "\x1c", "x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    with open(PATH, encoding="utf-8") as file:
        return bpe.MergeList(file.read())


def ids_of(text, merges, words):
    return [int(i) for part in bpe.encoded(text, merges, words) for i in part.split(",")]


def random_text(r):
    return "".join(r.choice(PARTS) * r.choice([1, 1, 1, 2, 60 if r.random() < 0.1 else 3]) for _ in range(r.randrange(60)))


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 100, 70000])
@pytest.mark.parametrize("long_piece", [8, 40, 2048])
def test_random_texts(monkeypatch, library, merges, chunk, long_piece):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "LONG_PIECE", long_piece)
    r, words = random.Random(chunk * long_piece), bpe.KnownWords(merges)
    for _ in range(60):
        text = random_text(r)
        assert ids_of(text, merges, words) == library.encode(text, add_special_tokens=False).ids, text


def test_every_code_point_of_the_first_planes_splits_alike(library, merges):
    words = bpe.KnownWords(merges)
    for cp in [*range(0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x20000, 41)]:
        text = f"a{chr(cp)}b 1{chr(cp)}{chr(cp)} x"
        assert ids_of(text, merges, words) == library.encode(text, add_special_tokens=False).ids, hex(cp)


def test_long_runs_in_constant_memory(library, merges):
    r = random.Random(3)
    for text in ["a" * 100000, " " * 20000 + "x", "".join(r.choice("abcdefghij") for _ in range(90000)), "thing" * 9000 + " 1" + "2" * 9000 + "\n" * 9000 + "z", "=-" * 9000]:
        encoder, got, most = bpe.Encoder(merges), [], 0
        for at in range(0, len(text), 500):
            got += encoder.feed(text[at : at + 500])
            most = max(most, len(encoder.pending) + len(encoder.tail) + len(encoder.text))
        got += encoder.finish()
        assert [int(i) for part in got for i in part.split(",")] == library.encode(text, add_special_tokens=False).ids
        assert most <= bpe.LONG_PIECE + 2 * encoder.window


def test_the_lookahead_is_sufficient(merges):
    """A token with that many bytes after it stays, whatever follows."""
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(["a", "e", "t", "th", "er", "in", "ing", "ation", "s"]) for _ in range(r.randrange(150, 300))).encode()
        cut = r.randrange(merges.lookahead, len(text) + 1) if len(text) > merges.lookahead else len(text)
        part, done, whole = merges.merge(text[:cut]), 0, merges.merge(text)
        for i, token in enumerate(part):
            done += len(merges.bytes_of[token])
            if done <= cut - merges.lookahead:
                assert whole[i] == token


def test_decoding_any_ids(library, merges):
    r, decoder = random.Random(1), bpe.Decoder(merges)
    for _ in range(500):
        ids = [r.randrange(50257) for _ in range(r.randrange(40))]
        decoder.reset()
        text = "".join(decoder.feed(bpe.np.array([i])) for i in ids) + decoder.feed(bpe.NONE, True)
        assert text == library.decode(ids, skip_special_tokens=False)


def test_tables(spark, library):
    texts = [None, "", "One two\n\n three", "x<|endoftext|>y", "é" * 5000, "One two\n\n three"]
    df = spark.createDataFrame([(i // 2, t, "extra", 7) for i, t in enumerate(texts)], SCHEMA)
    rows = sorted(map(tuple, bpe.round_trip(df, PATH).collect()), key=str)
    want = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i // 2, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows == sorted(want, key=str)
    coded = bpe.encode(df, PATH)
    assert sorted(coded.columns) == ["doc_id", "ids", "n_tokens", "text"]
    back = bpe.decode(coded, PATH).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for t in texts) and {r.n_tokens for r in back} == {7}
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


def test_query(spark, library):
    at = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op10_bpe(spark, at).collect()}
    for r in spark.read.parquet(f"{at}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
