"""Incremental, reversible line dedup.

A line's key is the line without white space at both ends, A-Z lower-cased.
Keys of at least ``MIN_CHARS`` code points that several documents hold lose
their lines everywhere but in the smallest doc_id that holds them.

``LineIndex`` keeps in a folder, and opens again from there:

- ``lines``: the exact reference counts, one row per key digest and document
  that holds it, so that a deletion finds the next smallest holder. A change
  appends a segment of rows with +1 or -1; ``compact`` joins the segments;
- ``filters``: a cuckoo filter per shard of the digests, of the keys that two or
  more documents hold. 16-bit fingerprints, buckets of four, two buckets per
  key; a key that finds no room goes to the shard's exact overflow list;
- ``manifest``: a row per version, which names the segments and the filters. It
  is written last, so a change that breaks off leaves the version before.

``insert`` and ``delete`` count the references of the digests that they touch,
before and after, and add or remove just the keys whose count crossed two.
Shards double in number as the digests do, and a crowded filter grows; only then
are filters made anew from the exact counts. ``clean`` looks the distinct digests of
its documents up in the filters, shard by shard; only those that a filter may
hold meet the exact table, which confirms them. Deleting a document therefore
brings its lines back where they were dropped because of it.

Digests are dealt out by shard only after partial aggregates reduced them to
one row per digest, so a line that a third of all documents hold costs no more
than others; shards are sized by the number of digests, and asked in pieces where
a table has more digests than the index. Lines meet the
confirmed digests in a join whose skewed partitions Spark splits.

Defined results: a null or empty text is one empty line. Rows that repeat a
doc_id count as one document; a null doc_id counts as one document after all
others. Texts of repeated rows are cleaned each. Empty tables give no rows.
doc_ids may be of any type that has an order, the same in every change.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm.common import lower_ascii, path_exists, scratch, staged, unstage
from linfold.session import remove_path

MIN_CHARS = 10
SHARD_KEYS = 50_000  # digests per shard, about
KICKS = 200
DIGEST = 16  # bytes


# -- the filter of one shard -------------------------------------------------

class Cuckoo:
    """Cuckoo filter over 16-byte digests, with an exact overflow list."""

    def __init__(self, buckets: int, table: bytes | None = None, rest: bytes = b""):
        self.buckets = buckets
        self.table = np.zeros((buckets, 4), np.uint16) if table is None else np.frombuffer(table, np.uint16).reshape(-1, 4).copy()
        self.rest = {rest[i:i + DIGEST] for i in range(0, len(rest), DIGEST)}

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        """Room for ``keys`` at four fifths load; a power of two of buckets."""
        return cls(1 << max(4, int(keys / 3.2).bit_length()))

    def places(self, digests: np.ndarray):
        """(fingerprints, first and second buckets) of an (n, 2) uint64 array."""
        mark = (digests[:, 0] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (digests[:, 1] & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, one, self._other(one, mark)

    def _other(self, bucket, mark):
        return bucket ^ (mark.astype(np.int64) * 0x5BD1E995 & (self.buckets - 1))

    def holds(self, digests: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(digests)
        found = ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)
        if self.rest:
            found |= np.fromiter((d.tobytes() in self.rest for d in digests), bool, len(digests))
        return found

    def add(self, digests: np.ndarray) -> None:
        mark, one, two = self.places(digests)
        state = np.random.Generator(np.random.PCG64(1))
        for k in range(len(digests)):
            m, b = mark[k], int(one[k])
            undo = []
            for bucket in (int(one[k]), int(two[k])):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = m
                    break
            else:
                for _ in range(KICKS):
                    slot = int(state.integers(4))
                    undo.append((b, slot))
                    m, self.table[b, slot] = self.table[b, slot], m
                    b = int(self._other(np.int64(b), np.uint16(m)))
                    free = np.flatnonzero(self.table[b] == 0)
                    if len(free):
                        self.table[b, free[0]] = m
                        break
                else:  # no room: put everything back, remember the key itself
                    for b, slot in reversed(undo):
                        m, self.table[b, slot] = self.table[b, slot], m
                    self.rest.add(digests[k].tobytes())

    def remove(self, digests: np.ndarray) -> None:
        """Of keys that were added."""
        mark, one, two = self.places(digests)
        for k in range(len(digests)):
            if (d := digests[k].tobytes()) in self.rest:
                self.rest.remove(d)
                continue
            for bucket in (int(one[k]), int(two[k])):
                slot = np.flatnonzero(self.table[bucket] == mark[k])
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break

    def load(self) -> float:
        return float((self.table != 0).mean())


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


FILTER_SCHEMA = "shard int, buckets long, filter binary, overflow binary, crowded boolean"
MANIFEST = ("version long, segments array<string>, signed boolean, filters string, shards int, digests long, min_chars int")


def _filter_row(shard: int, f: Cuckoo) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "buckets": pa.array([f.buckets], pa.int64()),
                     "filter": pa.array([f.table.tobytes()], pa.binary()),
                     "overflow": pa.array([b"".join(sorted(f.rest))], pa.binary()),
                     "crowded": pa.array([f.load() > 0.9 or len(f.rest) > 0.02 * f.buckets], pa.bool_())})


def _shard_filter(old: pa.Table) -> Cuckoo | None:
    if old.num_rows == 0:
        return None
    row = old.slice(0, 1).to_pylist()[0]
    return Cuckoo(row["buckets"], row["filter"], row["overflow"])


def _changed(key, keys: pa.Table, old: pa.Table) -> pa.Table:
    """The shard's filter after its keys' counts changed (digest, before, after);
    a new one has room for twice its keys."""
    f = _shard_filter(old)
    digests = _digests(keys.column("digest").combine_chunks() if keys.num_rows else pa.array([], pa.binary()))
    before, after = (keys.column(c).to_numpy() > 1 for c in ("before", "after"))
    if f is None:
        f = Cuckoo.sized(2 * int(after.sum()))
    f.remove(digests[before & ~after])
    f.add(digests[after & ~before])
    return _filter_row(key[0].as_py(), f)


def _maybe(key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    f = _shard_filter(filters)
    if f is None or keys.num_rows == 0:
        return keys.slice(0, 0).select(["digest"])
    digest = keys.column("digest").combine_chunks()
    return pa.table({"digest": digest}).filter(pa.array(f.holds(_digests(digest))))


# -- lines --------------------------------------------------------------------

def _lowered(line: Column) -> Column:
    """A-Z lower-cased: by the fast function where all characters are ASCII."""
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(lower_ascii(line))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, i, digest) of every line whose key is long enough; ``th``
    tells apart texts of rows that repeat a doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", F.xxhash64(text).alias("th"), F.posexplode_outer(F.split(text, "\n", -1)).alias("i", "line"))
            .select("doc_id", "th", "i", F.trim("line", F.lit(" \t\n\v\f\r")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("doc_id", "th", "i", F.substring(F.unhex(F.sha2(_lowered(F.col("key")), 256)), 1, DIGEST).alias("digest")))


class LineIndex:
    """The reference counts and filters of a set of documents, in the folder
    ``path``; what an earlier index stored there is opened."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_chars: int = MIN_CHARS):
        self.spark, self.path, self.min_chars = spark, path or scratch(spark, "lines"), min_chars
        self.state = {"version": 0, "segments": [], "signed": False, "filters": None, "shards": 1, "digests": 0, "min_chars": min_chars}
        if path and path_exists(spark, f"{path}/manifest"):
            self.state = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.desc("version")).first().asDict()
            if self.state["min_chars"] != min_chars:
                raise ValueError(f"the index in {path} has keys of at least {self.state['min_chars']} characters")

    def _store(self, df: DataFrame, name: str) -> str:
        name = f"{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return name

    def _table(self, *names: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{name}" for name in names])

    def _filters(self) -> DataFrame:
        return self.spark.read.schema(FILTER_SCHEMA).parquet(f"{self.path}/{self.state['filters']}")

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.state["shards"])).cast("int").alias("shard")

    def pairs(self) -> DataFrame:
        """(digest, doc_id): which documents hold which lines. Once documents
        were inserted."""
        rows = self._table(*self.state["segments"])
        if self.state["signed"]:  # a pair may have gone, and come again
            rows = rows.groupBy("digest", "doc_id").agg(F.sum("change").alias("n")).where("n > 0")
        return rows.select("digest", "doc_id")

    def counts(self, pairs: DataFrame | None = None) -> DataFrame:
        """(digest, n_docs, first_doc): the exact reference counts."""
        return (self.pairs() if pairs is None else pairs).groupBy("digest").agg(
            F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))

    def _apply(self, pairs: DataFrame, change: int) -> LineIndex:
        """Append ``pairs`` as a segment, and bring the filters up to it."""
        segment = self._store(pairs.withColumn("change", F.lit(change).cast("byte")), "lines")
        touched = self._table(segment).groupBy("digest").agg(F.sum("change").alias("by"))
        changed, new = None, dict(self.state)
        if self.state["segments"]:
            before = self.counts(self.pairs().join(touched, "digest", "left_semi")).select("digest", F.col("n_docs").alias("n"))
            n = F.coalesce("n", F.lit(0))
            changed = staged(touched.join(before, "digest", "left").select("digest", n.alias("before"), (n + F.col("by")).alias("after")), "changed")
            sums = changed.agg(F.count_if(F.expr("before = 0 and after > 0")), F.count_if(F.expr("before > 0 and after = 0"))).first()
            new["digests"] += sums[0] - sums[1]
        else:
            new["digests"] = touched.count()
        while new["digests"] > new["shards"] * SHARD_KEYS:
            new["shards"] *= 2
        new["segments"], new["signed"] = [*self.state["segments"], segment], self.state["signed"] or change < 0
        old, self.state = self.state, new
        kept = None
        if changed is not None and old["filters"] and old["shards"] == new["shards"]:
            # a key that neither had nor has two holders is not the filters' business
            kept = self._store(self._filled(changed.where("before > 1 or after > 1"), self._filters()), "filters")
            if self._table(kept).where("crowded").limit(1).count():
                kept = None
        new["filters"] = kept or self._store(self._fresh(), "filters")
        if changed is not None:
            unstage(changed)
        return self._commit()

    def _fresh(self) -> DataFrame:
        """All filters, from the exact counts."""
        keys = self.counts().where("n_docs > 1").select("digest", F.lit(0).cast("long").alias("before"), F.col("n_docs").alias("after"))
        return self._filled(keys, self.spark.createDataFrame([], FILTER_SCHEMA))

    def _filled(self, keys: DataFrame, filters: DataFrame) -> DataFrame:
        return (keys.select(self._shard(), "digest", "before", "after").groupBy("shard")
                .cogroup(filters.groupBy("shard")).applyInArrow(_changed, FILTER_SCHEMA))

    def _commit(self) -> LineIndex:
        self.state["version"] += 1
        row = tuple(self.state[c.split()[0]] for c in MANIFEST.split(", "))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return self

    def insert(self, docs: DataFrame, rows: DataFrame | None = None) -> LineIndex:
        """Count the lines of documents; a doc_id already in the index gains the
        new lines. ``rows``: their ``line_rows``, if these are stored already."""
        new = (line_rows(docs, self.min_chars) if rows is None else rows).select("digest", "doc_id").distinct()
        if self.state["segments"]:
            on = (F.col("n.digest") == F.col("h.digest")) & F.col("n.doc_id").eqNullSafe(F.col("h.doc_id"))
            new = new.alias("n").join(self.pairs().alias("h"), on, "left_anti")
        return self._apply(new, 1)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take the documents of ``doc_ids`` (doc_id) out again."""
        if not self.state["segments"]:
            return self
        gone = doc_ids.select("doc_id").distinct().alias("g")
        return self._apply(self.pairs().alias("l").join(gone, F.col("l.doc_id").eqNullSafe(F.col("g.doc_id")), "left_semi"), -1)

    def compact(self) -> LineIndex:
        """Join the segments into one; the old ones stay for who reads them
        still, until ``remove``."""
        if self.state["segments"]:
            one = self._store(self.pairs().withColumn("change", F.lit(1).cast("byte")), "lines")
            self.state = self.state | {"segments": [one], "signed": False}
            self._commit()
        return self

    def duplicates(self, rows: DataFrame, asks: int | None = None) -> DataFrame:
        """(digest, first_doc) of those digests in ``rows`` that several
        documents of the index hold: filters first, exact counts for the rest.
        ``asks``: how many digests ``rows`` has at most, if that is known."""
        if not self.state["filters"]:
            return rows.where(F.lit(False)).select("digest", F.col("doc_id").alias("first_doc"))
        asked = rows.groupBy("digest").agg(F.lit(1).alias("one"))
        pieces = 1 + (asked.count() if asks is None else asks) // (self.state["shards"] * SHARD_KEYS)
        piece = F.pmod(F.xxhash64("digest", F.lit("piece")), F.lit(pieces)).cast("int").alias("piece")
        filters = self._filters().withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
        maybe = (asked.select(self._shard(), piece, "digest").groupBy("shard", "piece")
                 .cogroup(filters.groupBy("shard", "piece")).applyInArrow(_maybe, "digest binary"))
        return self.counts().where("n_docs > 1").join(maybe, "digest", "left_semi").select("digest", "first_doc")

    def clean(self, docs: DataFrame, rows: DataFrame | None = None, asks: int | None = None) -> DataFrame:
        """(row, lines, dropped): each row of ``docs`` as a struct, its text's
        lines, and the places of those that the index drops."""
        rows = line_rows(docs, self.min_chars) if rows is None else rows
        dropped = (rows.join(self.duplicates(rows, asks), "digest")
                   .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
                   .groupBy("doc_id", "th").agg(F.collect_set("i").alias("dropped")))
        text = F.coalesce(F.col("text"), F.lit(""))
        whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("d"), F.xxhash64(text).alias("t"))
        joined = whole.join(dropped.hint("shuffle_hash"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th")), "left")
        return joined.select("row", F.split(F.coalesce("row.text", F.lit("")), "\n", -1).alias("lines"),
                             F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))

    def remove(self) -> None:
        """Delete what the index stored, all versions."""
        if not path_exists(self.spark, f"{self.path}/manifest"):
            return
        versions = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").collect()  # a row per change
        for name in {x for v in versions for x in [*v["segments"], v["filters"]] if x} | {"manifest"}:
            remove_path(self.spark, f"{self.path}/{name}")


def _cleaned(docs: DataFrame, min_chars: int) -> DataFrame:
    """``docs`` judged against itself; its lines are digested once."""
    rows = staged(line_rows(docs, min_chars), "lines")
    index = LineIndex(docs.sparkSession, min_chars=min_chars).insert(docs, rows)
    return index.clean(docs, rows, asks=index.state["digests"])


KEPT_TEXT = ("array_join(transform(array_except(sequence(0, size(lines) - 1), dropped), i -> lines[i]), '\n')")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row, its lines judged
    against all of ``docs``."""
    return _cleaned(docs.select("doc_id", "text"), min_chars).select(
        F.col("row.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"), F.sha2(F.expr(KEPT_TEXT), 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with all its columns, ``text`` (and ``n_chars``) without the dropped lines."""
    cleaned = _cleaned(docs, min_chars).select("row", F.expr(KEPT_TEXT).alias("kept"))
    return cleaned.select(*[
        F.col("kept").alias(c) if c == "text" else F.length("kept").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col("row").getField(c).alias(c) for c in docs.columns])
