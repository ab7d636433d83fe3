"""One query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventbase.llm import bpe, embeddings, html, languages, lines, mixing, passages, quality, sharding, simhash, tokenlinks, toolcalls, trie
from eventbase.llm.common import load, n_words
from eventbase.llm.sql import SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(load(spark, sf_dir, "pages"))


TOOLS = {
    "search": {
        "type": "object", "required": ["query"], "additionalProperties": False,
        "properties": {
            "query": {"type": "string", "minLength": 8}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}, "after": {"type": "array"},
        },
    },
    "count": {
        "type": "object", "required": ["query", "limit"],
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "maximum": 30}, "after": {"type": "array"}},
    },
}


def _calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every assistant turn as a call, every other turn as the result of the turn before it.

    Name and limit follow the number of words; every second call (by a hash) needs the one two turns earlier.
    """
    turns = conversations.withColumn("call_id", F.substring(F.md5(F.concat_ws(":", "conv_id", "turn", "text")), 1, 12))
    said = turns.filter("role = 'assistant'")
    earlier = said.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("call_id").alias("before"))
    n = n_words(F.col("text"))
    query = F.col("text").alias("query")
    after = F.when(F.substring(F.md5("text"), 1, 1) < "8", F.array_compact(F.array("before"))).alias("after")
    calls = said.join(earlier, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "call_id", F.element_at(F.array(*map(F.lit, ("search", "count", "lookup"))), (n % 3 + 1).cast("int")).alias("name"),
        F.to_json(F.struct(query, n.alias("limit"), after)).alias("arguments"),
    )
    asked = said.select("conv_id", (F.col("turn") + 1).alias("turn"), "call_id")
    heard = turns.filter("role <> 'assistant'").select("conv_id", "turn", F.col("text").alias("content"), F.col("call_id").alias("own"))
    results = heard.join(asked, ["conv_id", "turn"], "left")
    return calls, results.select("conv_id", "turn", F.coalesce("call_id", "own").alias("call_id"), "content")


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results made from all conversations, linked, ordered, validated and written as canonical JSON."""
    return toolcalls.link(*_calls_and_results(load(spark, sf_dir, "conversations")), TOOLS)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their groups of near-duplicates."""
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of one and a half times the corpus takes of each document."""
    return mixing.taken(mixing.mix(load(spark, sf_dir, "documents")))


def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards of near-equal bytes."""
    found = sharding.shards(load(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of fifty words or more that a document shares with one of a smaller id."""
    return passages.passages(load(spark, sf_dir, "documents"))


def op7_quantised_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate vectors."""
    return embeddings.near_duplicates(load(spark, sf_dir, "embeddings"))


def op8_fourier_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score for every document."""
    measured = quality.measure(load(spark, sf_dir, "documents"))
    return quality.score(measured, quality.train(measured, load(spark, sf_dir, "labels")))


def op9_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line labelling's verdict for every document."""
    docs = load(spark, sf_dir, "documents")
    return lines.judge(docs, lines.train(docs, load(spark, sf_dir, "labels")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text, for every document."""
    return bpe.round_trip(load(spark, sf_dir, "documents"), TOKENIZER)


def op11_euler_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, with what its subtree holds and saves."""
    return trie.measure(load(spark, sf_dir, "conversations"))


def op12_lockstep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ends that two tokenizers share, for every document."""
    return tokenlinks.measure(load(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op13_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = load(spark, sf_dir, "documents")
    return languages.predict(docs, languages.train(docs))


QUERIES = [op1_site_style_tree, op2_tool_calls, op3_simhash, op4_mixing, op5_sampled_splitters, op6_passages, op7_quantised_codes, op8_fourier_ridge, op9_line_labels, op10_bpe, op11_euler_tour, op12_lockstep, op13_string_kernel]
__all__ = ["QUERIES", "SQL"]
