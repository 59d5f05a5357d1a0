"""Substring dedup over words: prefix-partitioned suffix trees.

A suffix is a word position; only its first ``window`` words matter, so each
subtree is cut at that depth, and its nodes there with leaves from several
documents are the repeats. Words that a repeat covers go from every document
but the one with the smallest doc_id.

1. Each window of words is represented by the least digest of its ``gram``-word
   stretches, which equal windows share and neighbouring windows mostly share:
   about two per eleven words. Stretches that only one text has leave
   all their windows out; this drops the bulk of a corpus at a fraction of its
   suffixes. Nothing that repeats is lost, as equal windows have equal stretches.
2. The suffixes left are dealt out by a variable-length prefix: the words up to
   the end of the window's stretch, or, where more than ``GROUP`` texts share
   the stretch, the whole window. So groups fit into memory. Within a group,
   suffixes sorted by their digest at full depth form the subtree's deep nodes;
   each node's smallest document keeps its words.
3. The removed starts come back per document, as a list no longer than it.

Before each shuffle a task settles what its own rows settle: of a stretch or
node that several of its texts hold, one row goes on as a witness, the others
are answered on the spot. A passage that a third of all documents hold thus
arrives as one row per task. Whole copies are found first by digests of their
words; they hold no suffix of their own and are removed as a whole.

Digests have 64 bits, over words and then over stretches; texts are told apart
by SHA-256.

Defined results: a null text has no words. Texts with fewer words than a window
stay. A null doc_id comes after all others. Rows that repeat a doc_id are one
document with one text, or several texts neither of which precedes the other.
Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.bytescan import Digests, mix, ragged, runs, segments, sliding_min, whole_groups, words
from linfold.llm.common import SPACE, staged, unstage

WINDOW, GRAM = 13, 4
GROUP = 10_000  # texts that may share a stretch before its suffixes are dealt out by whole windows
HELD = 2_000_000  # rows that a task settles at a time
LAST = (1 << 63) - 1
TH_BITS = 12
TH = (1 << TH_BITS) - 1
ASK, WITNESS, KNOWN = 0, 1, 2
_EMPTY = hashlib.sha256(b"").hexdigest()


def _windows(data, offsets, window, gram):
    """(row, start, word digests, digests of stretches, least stretch) of every window."""
    starts, ends, first = words(data, offsets)
    values = Digests(data).of(starts, ends)
    by_word = Digests(values)
    grams = by_word.sliding(gram)
    least = sliding_min(grams, window - gram + 1)
    n = np.maximum(np.diff(first) - window + 1, 0)
    p = ragged(first[:-1], n)
    row = np.repeat(np.arange(len(n)), n)
    return row, p, first, by_word, grams, least[p] if len(p) else least[:0]


def _flush_stretches(held):
    a, th = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((th, a))
    a, th = a[order], th[order]
    keep = runs(a, th)
    a, th = a[keep], th[keep]
    new = runs(a)
    many = np.diff(np.append(np.flatnonzero(new), len(a)))
    several = np.repeat(many > 1, many)
    # a row carries its stretch as its route, or, if settled, beside a route that spreads it
    a = np.where(a <= KNOWN, a + np.uint64(KNOWN + 1), a)
    b = np.where(several, a, np.uint64(ASK))
    route = np.where(several, mix((a ^ th.view(np.uint64)) + np.uint64(1)), a)
    w = several & new  # one more row of each settled stretch, for the other tasks
    cols = [np.concatenate([route, a[w]]).view(np.int64), np.concatenate([th, th[w]]),
            np.concatenate([b, np.full(int(w.sum()), WITNESS, np.uint64)]).view(np.int64)]
    for x in range(0, len(cols[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[x:x + 100_000]) for c in cols], ["route", "th", "b"])


def _stretches(batches, window, gram):
    held, n = [], 0
    for batch in batches:
        th = batch.column("th").to_numpy()
        for a, _, data, offsets in segments(batch):
            row, _, _, _, _, least = _windows(data, offsets, window, gram)
            new = runs(least, row)
            held.append((least[new], th[a + row[new]]))
            n += len(held[-1][0])
            if n > HELD:
                yield from _flush_stretches(held)
                held, n = [], 0
    if held:
        yield from _flush_stretches(held)


def _shared_stretches(batches):
    """Sorted by route: the texts of stretches that several texts have."""
    for g in whole_groups(batches, ["route", "th", "b"], "route"):
        known = (g["b"] != ASK) & (g["b"] != WITNESS)
        out = [(g["th"][known], g["b"][known])]
        a, th, state = g["route"][~known], g["th"][~known], g["b"][~known]
        if len(a):
            order = np.lexsort((th, a))
            a, th, state = a[order], th[order], state[order]
            first = np.flatnonzero(runs(a))
            size = np.diff(np.append(first, len(a)))
            several = np.repeat(th[first] != th[first + size - 1], size)
            pick = several & (state == ASK)
            out.append((th[pick], a[pick]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["th", "a"])


def _flush_suffixes(held):
    route, h, owner, p = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((owner, h))
    route, h, owner, p = route[order], h[order], owner[order], p[order]
    first = np.flatnonzero(runs(h))
    size = np.diff(np.append(first, len(h)))
    known = owner > np.repeat(owner[first], size) if len(h) else np.zeros(0, bool)
    route = np.where(known, mix(h ^ (owner.view(np.uint64) * np.uint64(31) + p.view(np.uint64))), route)
    # a settled start is a negative one; 32 bits deal groups out, the whole digest tells them apart
    cols = [(route >> np.uint64(32)).astype(np.uint32).view(np.int32), h.view(np.int64), owner, np.where(known, ~p, p)]
    for x in range(0, len(h), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[x:x + 100_000]) for c in cols], ["route", "h", "owner", "p"])


def _suffixes(batches, window, gram):
    """The suffixes whose stretch is listed for their text."""
    held, n = [], 0
    for batch in batches:
        owner, th = batch.column("owner").to_numpy(), batch.column("th").to_numpy() & TH
        lists = {c: (batch.column(c).combine_chunks() if hasattr(batch.column(c), "combine_chunks") else batch.column(c)) for c in ("shared", "large")}
        for a, b, data, offsets in segments(batch):
            row, p, first, by_word, grams, least = _windows(data, offsets, window, gram)

            def pairs(name):
                part = lists[name].slice(a, b - a)
                at = np.asarray(part.offsets.to_numpy())
                values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                return np.sort(mix(values + np.repeat(np.arange(b - a), np.diff(at)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

            own = mix(least + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            listed = np.isin(own, pairs("shared"))
            row, p, least, own = row[listed], p[listed], least[listed], own[listed]
            if not len(p):
                continue
            upto = np.zeros(len(p), np.int64)  # place of the stretch in its window
            for k in range(window - gram, -1, -1):
                upto[grams[p + k] == least] = k
            large = np.isin(own, pairs("large"))
            end = np.where(large, p + window, p + upto + gram)
            held.append((by_word.of(p, end), by_word.of(p, p + window), owner[a + row], ((p - first[row]) << TH_BITS) | th[a + row]))
            n += len(p)
            if n > HELD:
                yield from _flush_suffixes(held)
                held, n = [], 0
    if held:
        yield from _flush_suffixes(held)


def _removed(batches):
    """Sorted by route: the starts that a smaller document has too."""
    for g in whole_groups(batches, ["route", "h", "owner", "p"], "route"):
        known = g["p"] < 0
        out = [(g["owner"][known], ~g["p"][known])]
        h, owner, p = g["h"][~known], g["owner"][~known], g["p"][~known]
        if len(h):
            order = np.lexsort((owner, h))
            h, owner, p = h[order], owner[order], p[order]
            first = np.flatnonzero(runs(h))
            least = np.repeat(owner[first], np.diff(np.append(first, len(h))))
            out.append((owner[owner > least], p[owner > least]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["owner", "p"])


def _rewritten(batches, window):
    for batch in batches:
        removed, digests, texts = [], [], []
        starts = batch.column("starts")
        for a, b, data, offsets in segments(batch):
            ws, we, first = words(data, offsets)
            whole = data.tobytes()
            for k in range(a, b):
                lo, hi = first[k - a], first[k - a + 1]
                gone = np.zeros(hi - lo + 1, np.int64)
                at = np.unique(np.asarray(starts[k].values))
                at = at[at + window <= hi - lo]
                np.add.at(gone, at, 1)
                np.add.at(gone, np.minimum(at + window, hi - lo), -1)
                kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + lo
                text = b" ".join([whole[x:y] for x, y in zip(ws[kept].tolist(), we[kept].tolist(), strict=True)])
                removed.append(int(hi - lo - len(kept)))
                digests.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode())
        cols = {"owner": batch.column("owner"), "th": batch.column("th"), "removed": pa.array(removed, pa.int64()),
                "kept_sha": pa.array(digests, pa.string()), "kept": pa.array(texts, pa.string())}
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _prepared(docs: DataFrame) -> DataFrame:
    """(owner, th, text): ``th`` digests the words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = F.trim(F.regexp_replace(text, SPACE, " "))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"),
                       F.xxhash64(norm).alias("th"), text.alias("text"), norm.alias("norm"))


def word_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP,
                 *, stage: bool = True) -> tuple[DataFrame, DataFrame]:
    """(``base``, ``found``): ``base`` (owner, th, n_words, sha, copy) has a row
    per row of ``docs``, ``copy`` if a smaller document has the same words;
    ``found`` (owner, th, starts) the window starts to remove of other texts.
    With ``stage`` it is stored and the stretches are freed; without, a plan that
    joins it with the texts by (owner, th) shuffles them once for both joins."""
    prepared = _prepared(docs)
    n = F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    base = staged(prepared.select("owner", "th", n.cast("long").alias("n_words"), F.sha2("norm", 256).alias("sha")), "words")
    first = base.groupBy("th", "sha").agg(F.min("owner").alias("owner"))
    texts = prepared.select("owner", "th", "text")
    rows = texts.select("th", "text").mapInArrow(lambda it: _stretches(it, window, gram), "route long, th long, b long")
    shared = staged(rows.repartition("route").sortWithinPartitions("route").mapInArrow(_shared_stretches, "th long, a long"), "stretches")
    large = shared.groupBy("a").count().where(F.col("count") > group).select("a", F.lit(True).alias("large"))
    lists = (shared.join(large, "a", "left").groupBy("th")
             .agg(F.collect_list("a").alias("shared"), F.collect_list(F.when(F.col("large"), F.col("a"))).alias("large"))
             .join(first.select("th", "owner"), "th"))
    # one text per group of copies goes on, spread by document
    suffixes = (texts.join(lists.hint("shuffle_hash"), ["owner", "th"])
                .select("owner", "th", "text", "shared", "large")
                .mapInArrow(lambda it: _suffixes(it, window, gram), "route int, h long, owner long, p long"))
    # a start carries a few bits of its text's digest, for rows that repeat a doc_id
    starts = (suffixes.repartition("route").sortWithinPartitions("route").mapInArrow(_removed, "owner long, p long")
              .groupBy("owner", F.col("p").bitwiseAND(TH).alias("bits"))
              .agg(F.collect_list(F.shiftright("p", TH_BITS).cast("int")).alias("starts")))
    found = (starts.join(first.select("owner", "th", F.col("th").bitwiseAND(TH).alias("bits")), ["owner", "bits"])
             .select("owner", "th", "starts"))
    if stage:
        found = staged(found, "starts")
        unstage(shared)
    copies = base.alias("b").join(first.alias("f"), ["th", "sha"]).select(
        "b.owner", "th", "n_words", "sha", (F.col("b.owner") > F.col("f.owner")).alias("copy"))
    return copies, found


def _kept(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    base, found = word_repeats(docs, window, stage=False)
    texts = _prepared(docs).select("owner", "th", "text").join(found.hint("shuffle_hash"), ["owner", "th"])
    kept = texts.mapInArrow(lambda it: _rewritten(it, window), "owner long, th long, removed long, kept_sha string, kept string")
    return base, kept


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    base, kept = _kept(docs, window)
    kept = kept.select("owner", "th", "removed", "kept_sha").groupBy("owner", "th").agg(
        F.first("removed").alias("removed"), F.first("kept_sha").alias("kept_sha"))
    gone = F.col("copy") & (F.col("n_words") >= window)
    return base.join(kept, ["owner", "th"], "left").select(
        F.when(F.col("owner") != LAST, F.col("owner")).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_words",
        F.when(gone, F.col("n_words")).when(F.col("copy"), 0).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(_EMPTY)).when(F.col("copy"), F.col("sha")).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))


def without_repeated_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns; a text that loses words becomes its other
    words joined by one space (and ``n_chars`` their length)."""
    base, found = word_repeats(docs, window)
    gone = base.where(F.col("copy")).select("owner", "th", (F.col("n_words") >= window).alias("gone")).distinct()
    marks = found.join(gone, ["owner", "th"], "full").select("owner", "th", "starts", "gone")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"),
                        F.xxhash64(F.trim(F.regexp_replace(text, SPACE, " "))).alias("th"))
    joined = keyed.join(marks.hint("shuffle_hash"), ["owner", "th"], "left")
    split = F.filter(F.split(F.regexp_replace(F.coalesce("row.text", F.lit("")), SPACE, " "), " "), lambda w: w != "")
    # the words no removed window covers
    covered = F.flatten(F.transform(F.array_distinct("starts"), lambda s: F.sequence(s, s + (window - 1))))
    joined = joined.withColumn("w", F.when(F.size("starts") > 0, split)).withColumn("cover", F.when(F.size("starts") > 0, covered))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(w) - 1), cover), i -> w[i]), ' ')")
    kept = F.when(F.col("gone"), F.lit("")).when(F.col("w").isNotNull(), kept).otherwise(F.col("row.text"))
    joined = joined.select("row", kept.alias("kept"))
    return joined.select(*[
        F.col("kept").alias(c) if c == "text" else F.length("kept").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col("row").getField(c).alias(c) for c in docs.columns])
