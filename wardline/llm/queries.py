"""One registered query for each operator, with its production parameters and whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import exact_search, language, lexical_search, line_dedup, mixing, near_duplicates, near_search, quality, scoring, sentencepiece_codec, sharding, token_alignment, warc
from wardline.session import scratch_path
from wardline.sources.tables import read_parquet

TOKENIZER = os.environ.get("WARDLINE_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")
BYTE_TOKENIZER = os.environ.get("WARDLINE_BYTE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_scoring(spark, folder):
    return scoring.score_corpus(read_parquet(spark, folder, "documents"))


@query
def op2_line_dedup(spark, folder):
    """Every document with the lines that are left of it, and how many went."""
    docs = read_parquet(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs)


@query
def op3_sentencepiece(spark, folder):
    """The ids of every text, and whether they decode to it again."""
    docs = read_parquet(spark, folder, "documents").select("doc_id", "text")
    pieces = sentencepiece_codec.load_pieces(TOKENIZER)
    codec = sentencepiece_codec.build(docs, pieces)
    coded = sentencepiece_codec.encode(docs, codec, restored="restored")
    return coded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids",
                        "restored")


@query
def op5_sharding(spark, folder):
    """Where each document goes: its slot and its shard."""
    docs = read_parquet(spark, folder, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS)


@query
def op6_mixing(spark, folder):
    return mixing.mix(read_parquet(spark, folder, "documents"))


@query
def op7_near_search(spark, folder):
    return near_search.near_top_k(read_parquet(spark, folder, "embeddings"))


@query
def op8_warc(spark, folder):
    """Writes all pages as archives and reads the archives back."""
    archives = scratch_path(spark, "warc")
    warc.write_archives(read_parquet(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives)


@query
def op9_exact_search(spark, folder):
    return exact_search.exact_top_k(read_parquet(spark, folder, "embeddings"))


@query
def op10_language(spark, folder):
    return language.identify(read_parquet(spark, folder, "documents"))


@query
def op4_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(read_parquet(spark, folder, "documents"))


@query
def op13_quality(spark, folder):
    return quality.score_corpus(read_parquet(spark, folder, "documents"), read_parquet(spark, folder, "labels"))


@query
def op11_token_alignment(spark, folder):
    return token_alignment.alignments(read_parquet(spark, folder, "documents"), BYTE_TOKENIZER, TOKENIZER)


@query
def op12_lexical_search(spark, folder):
    return lexical_search.search(read_parquet(spark, folder, "documents"), read_parquet(spark, folder, "benchmark"))
