"""The ``opN_`` queries: each operator over its whole table, with production
parameters, returning the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from linfold.llm import bpe_rounds, oracle
from linfold.llm.byte_bpe import round_trip
from linfold.llm.collocations import collocations
from linfold.llm.common import documents
from linfold.llm.exact_dedup import exact_dedup
from linfold.llm.jaccard_join import jaccard_components
from linfold.llm.line_dedup import dedup_lines
from linfold.llm.packing import pack
from linfold.llm.quality_mcd import quality_rules
from linfold.llm.substring_dedup import dedup_substrings
from linfold.llm.suffix_array import dedup_bytes
from linfold.llm.token_counts import fresh_cache, token_counts
from linfold.llm.url_filter import judge_urls
from linfold.llm.whitening import whiten

#: The contract's rules: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), links=False).select("doc_id", "n_shingles", "component_id")


def op2_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the join's columns, which its SQL fixes, and the number of all links
    return jaccard_components(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own, so that every run encodes what its documents hold
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), fresh_cache(spark))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("select * from values " + ", ".join(map(str, URL_RULES)) + " as r(host, path, verdict)")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("d2")


def op11_bpe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_rounds.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_exact_dedup": (op1_exact_dedup, oracle.EXACT_DEDUP),
    "op2_jaccard_join": (op2_jaccard_join, oracle.JACCARD_JOIN),
    "op2_jaccard_links": (op2_jaccard_links, oracle.JACCARD_LINKS),
    "op3_token_counts": (op3_token_counts, None),
    "op4_url_filter": (op4_url_filter, oracle.url_filter(URL_RULES)),
    "op5_suffix_array_dedup": (op5_suffix_array_dedup, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_line_dedup": (op7_line_dedup, oracle.LINE_DEDUP),
    "op8_substring_dedup": (op8_substring_dedup, oracle.SUBSTRING_DEDUP),
    "op9_packing": (op9_packing, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_bpe_rounds": (op11_bpe_rounds, None),
    "op12_collocations": (op12_collocations, oracle.COLLOCATIONS),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}
