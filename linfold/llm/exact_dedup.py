"""Exact dedup by deterministic block naming.

Every normalised text is cut into blocks of fixed size. Equal blocks get equal
integer names and different blocks different ones; then adjacent pairs of names
are named the same way, round by round, until each document has one name. Two
documents are equal exactly when their final names (and block counts) are.

A name is the pair (digest, ordinal): blocks are dealt out by a 64-bit digest,
and distinct blocks that share a digest are sorted and numbered, so names are
free of collisions and depend on nothing but the blocks themselves: not on
partitions, row order or doc_ids. Naming needs no way back to the rows: a
block's digest is at hand wherever the block is, and the ordinal is 0 but for
the blocks in the table of shared digests (about n*n/2**65 of n blocks), which
is joined only when it has rows. Whole block contents are shuffled once, after
the copies inside each task were combined, so a group that holds a third of
all rows arrives as one row per task.

Only DataFrame functions. Defined results: a null text is the empty text, one
empty block. Rows that repeat a doc_id are one document if their texts are
equal; with different texts they are judged separately. A null doc_id comes
after all others. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.llm.common import documents_of, staged, unstage

BLOCK_BYTES = 4096
#: Runs of white space that are not already one space: most runs need no replacing.
NOT_ONE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def _digest(bits: int, *cols: Column) -> Column:
    h = F.xxhash64(*cols)
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def _shared(keys: DataFrame, cols: list[str]) -> DataFrame:
    """Of ``keys`` (digest ``h`` and the columns ``cols`` it was made of) those
    whose digest several distinct ones share, sorted and numbered."""
    distinct = keys.groupBy("h", *cols).agg(F.lit(1).alias("one"))
    # partial counts first, so that only digests and counts are shuffled here
    clash = distinct.groupBy("h").count().where("count > 1").select("h")
    clash = staged(clash, "clash")
    if clash.isEmpty():
        unstage(clash)
        return None
    numbered = distinct.join(clash, "h").select(
        "h", *cols, F.expr(f"cast(row_number() over (partition by h order by {', '.join(cols)}) as int) - 1").alias("ord"))
    return staged(numbered, "shared")


def _renumber(rows: DataFrame, shared: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` (key, i, h, cols) to (key, names) with the shared ordinals."""
    on = (F.col("r.h") == F.col("s.h"))
    for c in cols:
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    joined = rows.alias("r").join(shared.alias("s"), on, "left").select(
        "r.key", "r.i", F.struct(F.col("r.h").alias("h"), F.coalesce("s.ord", F.lit(0)).alias("ord")).alias("name"))
    # equal rows share their key: they are counted and come back as often
    return (joined.groupBy("key", "i").agg(F.first("name").alias("name"), F.count(F.lit(1)).alias("copies"))
            .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("x"), F.min("copies").alias("copies"))
            .select("key", F.transform("x", lambda v: v["name"]).alias("names"), "copies")
            .select("key", F.explode(F.expr("array_repeat(names, cast(copies as int))")).alias("names")))


def document_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, n_blocks, name): ``name`` with ``n_blocks``
    identifies the normalised text. ``bits`` shortens the digests (tests use it
    to make blocks share them)."""
    norm = (documents_of(docs).select("doc_id", F.regexp_replace("text", NOT_ONE_SPACE, " ").alias("norm"))
            .select(F.struct("doc_id", F.sha2("norm", 256).alias("sha")).alias("key"),
                    F.col("norm").cast("binary").alias("bytes")))
    cut = F.expr("transform(sequence(0, greatest(octet_length(bytes) - 1, 0) div {0}), "
                 "b -> substring(bytes, cast(b * {0} + 1 as int), {0}))".format(int(block_bytes)))
    blocks = norm.select("key", cut.alias("blocks"))
    named = F.transform("blocks", lambda b: F.struct(_digest(bits, b).alias("h"), F.lit(0).alias("ord")))
    # the outer form: the other gets a filter that would normalise a text again for each of its blocks
    spread = blocks.select("key", F.posexplode_outer("blocks").alias("i", "block")).withColumn("h", _digest(bits, F.col("block")))
    shared = _shared(spread.select("h", "block"), ["block"])
    names = blocks.select("key", named.alias("names")) if shared is None else _renumber(spread, shared, ["block"])
    names = staged(names.withColumn("n_blocks", F.size("names")), "names")
    most = names.agg(F.max("n_blocks")).first()[0] or 1
    while most > 1:
        pairs = F.expr("transform(sequence(0, (size(names) - 1) div 2), j -> "
                       "struct(names[2 * j] as l, try_element_at(names, cast(2 * j + 2 as int)) as r))")
        paired = names.select("key", "n_blocks", "names", F.when(F.size("names") > 1, pairs).alias("pairs"))
        spread = (paired.select("key", F.posexplode_outer("pairs").alias("i", "p")).where("i is not null").select("key", "i", "p.l", "p.r")
                  .withColumn("h", _digest(bits, F.col("l"), F.col("r"))))
        shared = _shared(spread.select("h", "l", "r"), ["l", "r"])
        if shared is None:  # each row goes on by itself, one name as it is
            name = F.transform("pairs", lambda p: F.struct(_digest(bits, p["l"], p["r"]).alias("h"), F.lit(0).alias("ord")))
            names = paired.select("key", F.coalesce(name, "names").alias("names"), "n_blocks")
        else:
            higher = (_renumber(spread, shared, ["l", "r"])
                      .join(names.select("key", "n_blocks").distinct(), "key").select("key", "names", "n_blocks"))
            names = staged(names.where(F.size("names") == 1).unionByName(higher), "names")
        most = (most + 1) // 2
    return names.select("key.doc_id", F.col("key.sha").alias("text_sha256"), "n_blocks", F.col("names")[0].alias("name"))


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_blocks) of every row:
    of equal normalised texts the row with the smallest doc_id stays."""
    # the names are a few bytes per document: staged once, read by the grouping and by the way back
    names = staged(document_names(docs, block_bytes, bits), "identity")
    groups = names.groupBy("n_blocks", "name").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return names.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "n_blocks")
