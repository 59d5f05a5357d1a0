"""The corpus pipeline: quality rules, line dedup, near duplicates, substring
dedup, packing. Each stage works on all that the one before kept; its result is
written as Parquet and read again as the next one's documents.

Defined results. Null and empty texts have no words and so fail the quality
rules; an empty table goes through all stages and gives no pieces. A null doc_id
comes after all others where the smallest one stays. Rows that repeat a doc_id are
judged by their own text in the first two stages, stay together in the third if
one of them does, and lose passages each by its text. Columns that ``documents``
has besides its own are carried along, whatever their names, up to packing, which
returns its own columns. Texts of any length are read in whole."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linfold.llm.common import documents, finished, unstage
from linfold.llm.jaccard_join import one_per_component
from linfold.llm.line_dedup import without_repeated_lines
from linfold.llm.packing import pack
from linfold.llm.quality_mcd import quality_filter
from linfold.llm.substring_dedup import without_repeated_substrings


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document has go; every document stays."""
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return one_per_component(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words that a smaller document has go; every document stays."""
    return without_repeated_substrings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and sequences: what a training reads."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("jaccard_join", near_duplicates),
          ("substring_dedup", substrings), ("packing", packing)]

#: SQL expresses neither the covariance estimates nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; the last one's rows. A stage's result
    is deleted when the next one's is written, and so is all it stored on the way."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        after = finished(lambda: stage(spark, docs, sf_dir), name)  # noqa: B023
        if before is not None:
            unstage(before)
        docs = before = after
    return docs
