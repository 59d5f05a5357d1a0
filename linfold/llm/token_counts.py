"""Token counts with a digest cache.

The cache is a parquet table (digest, version, n_tokens): SHA-256 of a text,
SHA-256 of the tokenizer's file, count. A run digests its texts, joins the
distinct digests to the stored counts of its tokenizer version (a partition of
the cache), encodes one text for each digest that has none, appends these counts,
and joins counts back to the documents. A group of copies is encoded once,
however large: copies are found by partial aggregates over digests, and one row
of each group that misses goes to the encoder.

Documents are digested once into slim rows. Where no digest misses, no text is
read again. Where at most one document in ``SHARE`` misses, and ``FEW`` in all,
the misses are broadcast, so that only their texts are shuffled; else they meet
the texts in a shuffle, repeated rows combined first. Both give the same counts.
``compact`` rewrites a cache that many runs have appended to.

Defined results: a null text is the empty text with 0 tokens. Rows that repeat a
doc_id, null doc_ids, doc_ids of any type and empty tables are handled like any
others; there is one row out per row in.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm.bytescan import segments
from linfold.llm.common import documents_of, scratch, staged, unstage
from linfold.llm.tokens import file_bytes, worker_encoder

FEW = 200_000  # missing digests that are broadcast, 40 bytes each
SHARE = 10
CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def _count(batches, kind, content):
    chunks = worker_encoder(kind, content)
    for batch in batches:
        counts = []
        for _, _, data, offsets in segments(batch):
            counts.append(chunks.ids(data, offsets)[1])
        n = [int(x) for c in counts for x in c[1:] - c[:-1]]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row. ``tokenizer_path``
    is a .json (tokenizers) or .model (sentencepiece) file, ``cache_path`` a
    folder that all executors see; it is made if absent and appended to."""
    spark = docs.sparkSession
    content = file_bytes(tokenizer_path)
    version, kind = hashlib.sha256(content).hexdigest(), tokenizer_path.rpartition(".")[2]
    # a row's place among copies: documents, of whatever type their ids are, by digest
    rows = documents_of(docs).select("doc_id", F.xxhash64("doc_id").alias("owner"), F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    slim = staged(rows.select("doc_id", "owner", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").partitionBy("version").parquet(cache_path)
    misses = staged(slim.groupBy("digest").agg(F.min("owner").alias("owner"))
                    .join(_stored(spark, cache_path, version), "digest", "left_anti"), "misses")
    n = misses.count()
    if n:
        on, keyed = ["digest", "owner"], rows.select("digest", "owner", "text")
        if n <= FEW and n * SHARE <= slim.count():
            chosen = keyed.join(F.broadcast(misses), on, "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
        else:
            # rows that repeat a document are combined inside the tasks
            once = keyed.groupBy(*on).agg(F.first("text").alias("text"))
            chosen = once.join(misses.hint("shuffle_hash"), on, "left_semi").select("digest", "text")
        made = chosen.mapInArrow(lambda it: _count(it, kind, content), "digest binary, n_tokens long")
        made.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").partitionBy("version").parquet(cache_path)
    unstage(misses)
    return (slim.join(_stored(spark, cache_path, version), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def _stored(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; digests that two runs appended count once."""
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("version") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def compact(spark: SparkSession, cache_path: str) -> str:
    """A new cache folder with each digest of ``cache_path`` once, in files of a
    few digest ranges; the old one is left for runs that still read it."""
    path = scratch(spark, "token-cache")
    (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).groupBy("version", "digest").agg(F.max("n_tokens").alias("n_tokens"))
     .repartitionByRange("version", "digest").write.partitionBy("version").parquet(path))
    return path


def fresh_cache(spark) -> str:
    """A new cache folder under the session's shared folder."""
    return scratch(spark, "token-cache")
