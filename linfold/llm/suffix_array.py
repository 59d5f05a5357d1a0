"""Suffix-array dedup over bytes: prefix doubling on the positions that matter.

A position's rank at depth ``d`` stands for the ``d`` bytes that start there.
Doubling makes ranks at a greater depth from pairs of ranks a growing offset
apart, sorts the pairs, and drops the positions whose pair is unique; at the
threshold, those left start a string that also starts elsewhere. Ranks here are
64-bit digests of the strings, which sort into the same classes on every
executor without a table of names.

1. Up to ``depth`` the pairs are joined inside each text. Of every run of
   neighbouring windows that share the place of their least rank at this depth,
   one row is sorted by Spark (two in about a hundred positions). A run whose
   least rank is unique is unique at the threshold too, and drops out: nearly
   all do. Equal windows share their least rank and its place in them, so
   nothing that repeats is lost.
2. Runs whose whole bytes have another occurrence are past the threshold with
   all their positions. What is left are runs at the edges of repeats, and one
   witness of each whole run beside them: their positions are ranked at the
   threshold by the pairs (rank at p, rank at p + threshold - depth), sorted by
   Spark again.

Each task first settles what its own rows settle and sends one row per class
as a witness, so that a string that a third of all documents hold arrives as
one row per task. Spans come back per document, as a list no longer than it.

Defined results: a null text has no bytes. Copies of a text, rows that repeat a
doc_id included, are other places for each other. A null doc_id is a document
like any other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.bytescan import Digests, mix, ragged, runs, segments, sliding_min, whole_groups
from linfold.llm.common import staged

THRESHOLD, DEPTH = 400, 300
HELD = 2_000_000  # rows that a task settles at a time
LONGEST = 511  # positions that a packed run holds
TH_BITS, LEN_BITS = 24, 9
NULL = -(1 << 63)
ASK, WITNESS, KNOWN = 0, 1, 2  # state; the kind of a span is added times 4
PAST, RANK = 1, 2  # kinds: all positions repeat; positions are to be ranked singly


def _ranks(data, offsets, threshold, depth):
    """(row, start, place of the least rank at ``depth``, the first of equals)
    of every window, the ranks, and the digests."""
    digests = Digests(data)
    ranks = digests.sliding(depth)
    # ranks that agree in their upper bits go by place: equal windows still agree
    low = np.uint64((1 << max(22, len(data).bit_length())) - 1)
    at = sliding_min((ranks & ~low) | np.arange(len(ranks), dtype=np.uint64), threshold - depth + 1) & low
    n = np.maximum(np.diff(offsets) - threshold + 1, 0)
    p = ragged(offsets[:-1], n)
    return np.repeat(np.arange(len(n)), n), p, at[p].astype(np.int64) if len(p) else p, ranks, digests


def _batches(cols, names):
    for x in range(0, len(cols[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[x:x + 100_000]) for c in cols], names)


def _spread(*cols):
    out = np.full(len(cols[0]), 17, np.uint64)
    for c in cols:
        out = mix(out * np.uint64(31) + c.view(np.uint64))
    return out


RUN = ["route", "c", "owner", "span", "state"]


def _flush_runs(held):
    a, c, owner, span = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((c, a))
    a, c, owner, span = a[order], c[order], owner[order], span[order]
    group, klass = runs(a), runs(a, c)
    first, kfirst = np.flatnonzero(group), np.flatnonzero(klass)
    size = np.diff(np.append(first, len(a)))
    many = np.repeat(np.add.reduceat(klass.astype(np.int64), first) > 1, size)  # classes in the group
    ksize = np.repeat(np.diff(np.append(kfirst, len(a))), np.diff(np.append(kfirst, len(a))))
    past = np.where(ksize > 1, PAST, 0)
    # rows beside their class's first are past the threshold; the firsts of a group of many classes are ranked singly
    state = np.where(~klass, KNOWN + 4 * PAST, np.where(many, KNOWN + 4 * (RANK + past), ASK + 4 * past))
    route = np.where(state % 4 == KNOWN, _spread(owner, span), a)
    w = many & group
    cols = [np.concatenate([route, a[w]]).view(np.int64), np.concatenate([c, c[w]]).view(np.int64), np.concatenate([owner, owner[w]]),
            np.concatenate([span, span[w]]), np.concatenate([state, np.full(int(w.sum()), WITNESS)]).astype(np.int32)]
    yield from _batches(cols, RUN)


def _runs(batches, threshold, depth):
    held, n = [], 0
    for batch in batches:
        owner, th = batch.column("owner").to_numpy(), batch.column("th").to_numpy()
        for a, _, data, offsets in segments(batch):
            row, p, place, ranks, digests = _ranks(data, offsets, threshold, depth)
            if not len(p):
                continue
            at = np.flatnonzero(runs(place, row))
            size = np.diff(np.append(at, len(p)))
            lo, row, place = p[at], row[at], place[at]
            span = ((lo - offsets[row]) << (TH_BITS + LEN_BITS)) | (size << TH_BITS) | th[a + row]
            held.append((ranks[place], digests.of(lo, lo + size - 1 + threshold), owner[a + row], span))
            n += len(at)
            if n > HELD:
                yield from _flush_runs(held)
                held, n = [], 0
    if held:
        yield from _flush_runs(held)


def _settled_runs(batches):
    """Sorted by route: the spans of runs that are not unique, and their kind."""
    for g in whole_groups(batches, RUN, "route"):
        known = g["state"] % 4 == KNOWN
        out = [(g["owner"][known], g["span"][known], (g["state"][known] // 4).astype(np.int32))]
        a, c, owner, span, state = (g[x][~known] for x in RUN)
        if len(a):
            order = np.lexsort((state % 4, c, a))
            a, c, owner, span, state = a[order], c[order], owner[order], span[order], state[order]
            first, klass = np.flatnonzero(runs(a)), runs(a, c)
            size = np.diff(np.append(first, len(a)))
            # a witness stands for several classes, its own too: their rows of that task are ranked singly
            many = np.repeat((np.add.reduceat(klass.astype(np.int64), first) > 1) | np.logical_or.reduceat(state == WITNESS, first), size)
            kfirst = np.flatnonzero(klass)
            ksize = np.diff(np.append(kfirst, len(a)))
            past = np.repeat((ksize > 1) | (np.maximum.reduceat(state // 4, kfirst) > 0), ksize)
            kind = np.where(past, PAST, 0) + np.where(many & klass, RANK, 0)
            pick = (state % 4 == ASK) & (kind > 0)
            out.append((owner[pick], span[pick], kind[pick].astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["owner", "span", "kind"])


POSITION = ["route", "owner", "span", "state"]


def _flush_positions(held):
    h, owner, span = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(h, kind="stable")
    h, owner, span = h[order], owner[order], span[order]
    first = np.flatnonzero(runs(h))
    size = np.diff(np.append(first, len(h)))
    several = np.repeat(size > 1, size)
    w = first[size > 1]
    route = np.where(several, _spread(owner, span), h)
    cols = [np.concatenate([route, h[w]]).view(np.int64), np.concatenate([owner, owner[w]]), np.concatenate([span, span[w]]),
            np.concatenate([np.where(several, KNOWN, ASK), np.full(len(w), WITNESS)]).astype(np.int32)]
    yield from _batches(cols, POSITION)


def _positions(batches, threshold, depth):
    """The positions of listed runs, with their rank at the threshold."""
    held, n = [], 0
    for batch in batches:
        owner, th = batch.column("owner").to_numpy(), batch.column("th").to_numpy()
        spans = batch.column("spans")
        for a, b, data, offsets in segments(batch):
            digests = Digests(data)
            part = spans.slice(a, b - a)
            flat = part.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            size = (flat >> TH_BITS) & LONGEST
            p = ragged(offsets[row] + (flat >> (TH_BITS + LEN_BITS)), size)
            row = np.repeat(row, size)
            # the pair of ranks at p and an offset on makes the rank at the threshold
            pair = _spread(digests.of(p, p + depth), digests.of(p + (threshold - depth), p + threshold))
            held.append((pair, owner[a + row], ((p - offsets[row]) << (TH_BITS + LEN_BITS)) | (1 << TH_BITS) | th[a + row]))
            n += len(p)
            if n > HELD:
                yield from _flush_positions(held)
                held, n = [], 0
    if held:
        yield from _flush_positions(held)


def _settled_positions(batches):
    for g in whole_groups(batches, POSITION, "route"):
        known = g["state"] == KNOWN
        out = [(g["owner"][known], g["span"][known])]
        h, owner, span, state = (g[x][~known] for x in POSITION)
        if len(h):
            size = np.diff(np.append(np.flatnonzero(runs(h)), len(h)))
            pick = np.repeat(size > 1, size) & (state == ASK)
            out.append((owner[pick], span[pick]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["owner", "span"])


def _rewritten(batches, threshold, with_bytes):
    for batch in batches:
        rows = {"removed": [], "spans": [], "digest": [], "bytes": []}
        spans = batch.column("spans")
        for a, b, data, offsets in segments(batch):
            for k in range(b - a):
                text = data[offsets[k]:offsets[k + 1]]
                found = spans[a + k].values
                found = np.zeros(0, np.int64) if found is None else np.asarray(found)
                if not len(found):
                    n, many, kept = 0, 0, text
                else:
                    start = found >> (TH_BITS + LEN_BITS)
                    gone = np.zeros(len(text) + 1, np.int64)
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + ((found >> TH_BITS) & LONGEST) - 1 + threshold, -1)
                    out = np.cumsum(gone[:-1]) > 0
                    n, many, kept = int(out.sum()), int(out[0]) + int((out[1:] & ~out[:-1]).sum()), text[~out]
                rows["removed"].append(n)
                rows["spans"].append(many)
                rows["digest"].append(hashlib.sha256(kept).hexdigest())
                rows["bytes"].append(kept.tobytes() if with_bytes else None)
        size = pc.binary_length(batch.column("text").cast(pa.large_binary())).cast(pa.int64())
        cols = {"doc_id": batch.column("doc_id"), "n_bytes": size, "n_removed": pa.array(rows["removed"], pa.int64()),
                "n_spans": pa.array(rows["spans"], pa.int64()), "kept_sha256": pa.array(rows["digest"], pa.string())}
        if with_bytes:
            cols["kept"] = pa.array(rows["bytes"], pa.binary())
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def dedup_bytes(docs: DataFrame, threshold: int = THRESHOLD, depth: int | None = None, with_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), with ``with_bytes``
    also the ``kept`` bytes, of every row: without the bytes that a string of
    ``threshold`` bytes covers which starts anywhere else too."""
    depth = depth or max(1, min(threshold, threshold * DEPTH // THRESHOLD))
    if not threshold <= 2 * depth <= 2 * threshold or threshold - depth >= LONGEST:
        raise ValueError("depth must be at least half the threshold, and within 510 of it")
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL)).alias("owner"),
                        F.xxhash64(text).bitwiseAND((1 << TH_BITS) - 1).alias("th"), text.alias("text"))
    rows = texts.select("owner", "th", "text").mapInArrow(
        lambda it: _runs(it, threshold, depth), "route long, c long, owner long, span long, state int")
    found = staged(rows.repartition("route").sortWithinPartitions("route").mapInArrow(_settled_runs, "owner long, span long, kind int"), "runs")
    th = F.col("span").bitwiseAND((1 << TH_BITS) - 1).alias("th")
    lists = (found.where(F.col("kind") >= RANK).groupBy("owner", th).agg(F.collect_set("span").alias("spans")))
    positions = (texts.select("owner", "th", "text").join(lists.hint("shuffle_hash"), ["owner", "th"])
                 .mapInArrow(lambda it: _positions(it, threshold, depth), "route long, owner long, span long, state int"))
    single = positions.repartition("route").sortWithinPartitions("route").mapInArrow(_settled_positions, "owner long, span long")
    spans = (found.where(F.col("kind").bitwiseAND(PAST) > 0).select("owner", "span").union(single)
             .groupBy("owner", th).agg(F.collect_set("span").alias("spans")))
    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return (texts.join(spans.hint("shuffle_hash"), ["owner", "th"], "left").select("doc_id", "text", "spans")
            .mapInArrow(lambda it: _rewritten(it, threshold, with_bytes), out + ", kept binary" * with_bytes))
