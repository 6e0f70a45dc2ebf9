"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import bpe_round_trip
from .chat_format import chat_digests, format_conversations
from .chunk_dedup import remove_repeats
from .divergence import source_divergence
from .jaccard_join import jaccard_join
from .line_quality import quality_rules
from .nearest import nearest_neighbours
from .packing import pack_documents
from .periodic_runs import periodic_runs, run_digests, with_planted_runs
from .shared import shared_path, table
from .substring_dedup import remove_substrings
from .token_files import token_digests, write_tokens
from .toxicity import toxicity
from .url_filter import Rule, canonical, filter_urls, host_and_path

RULES = [Rule.of("allow", "org/"), Rule.of("block", "example.org/es/"), Rule.of("block", "example.org/en/1"), Rule.of("allow", "com/fr/"), Rule.of("block", "com/de/")]
#: Hosts whose pages make the list of the URL filter.
LISTED_HOSTS = r"(^|\.)(adult-x|casino-win|spam-farm)\."


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_digests(spark, path)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_substrings(table(spark, sf_dir, "documents")).drop("spans")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("group_key", "text_hash")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("text_hash", "host")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = host_and_path(F.col("url"))
    listed = pages.filter(host.rlike(LISTED_HOSTS)).select(canonical(host, path).alias("canonical"))
    return filter_urls(pages, listed, RULES)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id bigint, turn bigint, role string, text string")
    return chat_digests(format_conversations(rows.unionByName(own)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_substring_dedup, op3_packing, op4_jaccard_join, op5_toxicity, op6_chunk_dedup, op7_byte_bpe, op8_line_quality,
        op9_url_filter, op10_nearest, op11_source_divergence, op12_periodic_runs, op13_chat_format,
    )
}
