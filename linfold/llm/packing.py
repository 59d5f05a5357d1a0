"""Best-fit packing by large-item matching.

Texts become token pieces of at most the capacity. Pieces of equal length are
interchangeable, so what is packed is the histogram of lengths: at most as many
counts as the capacity, whatever the number of documents. Lengths above a third
of the capacity go at most two to a sequence: the longest is matched with the
longest that still fits, until none is left. Shorter lengths, longest first, go
to the sequence with the smallest gap that holds them; a new one opens when no
gap does. Sequences that look alike are placed as one run, so the plan has some
thousand runs (length, first rank, count, first sequence, offset).

A piece's place in the plan is its rank among the pieces of its length. Each
task numbers its own pieces per length while it makes them; per task and length
the counts before it are summed by a window over these counts alone. So there
is no global sort, no task that sees all pieces, and only the histogram (one
row per length) reaches the driver. Pieces are staged once, with their numbers.

Defined results: a null text is the empty text; each document ends with the end
id, so none is empty. Only documents over the capacity are cut; their first
piece is the shorter one. Repeated rows are packed each. An empty table gives
no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linfold.llm.bytescan import ragged, segments
from linfold.llm.common import documents_of, staged
from linfold.llm.tokens import file_bytes, worker_encoder

CAPACITY, END_ID = 1024, 2


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, pieces per sequence, first sequence,
    offset) that pack ``counts[length]`` pieces of each length. Piece ``r`` of a
    run is in sequence ``first + r // per``, at ``offset + r % per * length``."""
    left = {n: c for n, c in counts.items() if c}
    rank: dict[int, int] = defaultdict(int)
    runs, gaps, opened = [], defaultdict(list), 0  # gaps: size -> [(first sequence, how many)]

    def put(n, pieces, per, first, at):
        runs.append((n, rank[n], pieces, per, first, at))
        rank[n] += pieces
        left[n] -= pieces

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect.bisect_right(large, capacity - a) - 1
        if k < 0:
            pairs, b = 0, 0
        else:
            b = large[k]
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
        if pairs:
            if a == b:
                put(a, 2 * pairs, 2, opened, 0)
            else:
                put(a, pairs, 1, opened, 0)
                put(b, pairs, 1, opened, a)
            gaps[capacity - a - b].append((opened, pairs))
            opened += pairs
        # a length that pairs with itself and is odd, or fits no other, stands alone
        elif k > 0 and a == b:
            b = large[k - 1]
            put(a, 1, 1, opened, 0)
            put(b, 1, 1, opened, a)
            gaps[capacity - a - b].append((opened, 1))
            opened += 1
        else:
            n = left[a]
            put(a, n, 1, opened, 0)
            gaps[capacity - a].append((opened, n))
            opened += n
        large = [n for n in large if left[n]]
    sizes = sorted(gaps)
    for n in sorted((n for n in left if 0 < 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect.bisect_left(sizes, n)
            if at == len(sizes):
                gap, first, many = capacity, opened, -(-left[n] // (capacity // n))
                opened += many
            else:
                gap = sizes[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(at)
            per = gap // n
            full = min(many, left[n] // per)
            rest = left[n] - full * per if full < many else 0
            used = [(first, full, per)] * (full > 0) + [(first + full, 1, rest)] * (rest > 0)
            for start, bins, each in used:
                put(n, bins * each, each, start, capacity - gap)
            done = full + (rest > 0)
            for start, bins, size in [(s, b, gap - e * n) for s, b, e in used] + [(first + done, many - done, gap)] * (many > done):
                if size:
                    if not gaps[size]:
                        bisect.insort(sizes, size)
                    gaps[size].append((start, bins))
    return runs


def _cut(batches, kind, content, capacity, end_id, with_ids):
    """Pieces of every text, numbered per length within the task."""
    chunks, part, seen = worker_encoder(kind, content), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    for batch in batches:
        for a, b, data, offsets in segments(batch):
            ids, upto = chunks.ids(data, offsets)
            total = np.diff(upto) + 1
            # each text's ids, then the end id
            out = np.empty(int(total.sum()), "<u4")
            ends = np.cumsum(total)
            mask = np.ones(len(out), bool)
            mask[ends - 1] = False
            out[mask], out[ends - 1] = ids, end_id
            n = -(-total // capacity)
            doc = np.repeat(np.arange(b - a), n)
            piece = ragged(np.zeros(len(n), np.int64), n)
            first = (total - (n - 1) * capacity)[doc]
            start = np.where(piece > 0, first + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first)
            begin = (ends - total)[doc] + start
            raw = memoryview(out.view(np.uint8))
            crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            # rank within this task: by length, in order of appearance
            order = np.argsort(length, kind="stable")
            lengths, at, many = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(at, many) + np.repeat(seen[lengths], many)
            seen[lengths] += many
            cols = {"doc_id": batch.column("doc_id").slice(a, b - a).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array(np.full(len(doc), part), pa.int32()), "nth": pa.array(nth, pa.int64())}
            if with_ids:
                edges = np.append(begin, len(out))
                cols["ids"] = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(out.astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _placed(batches, runs, extra):
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    span = np.int64(1) << np.int64(48)  # ranks within a length stay below
    keys = table[:, 0] * span + table[:, 1]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        run = table[np.searchsorted(keys, length * span + rank, side="right") - 1] if len(length) else table[:0]
        r = rank - run[:, 1]
        per = np.maximum(run[:, 3], 1)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        cols = [batch.column(c) for c in names] + [pa.array(run[:, 4] + r // per), pa.array(run[:, 5] + r % per * length)]
        yield pa.RecordBatch.from_arrays(cols + [batch.column(c) for c in extra], [*names, "sequence_id", "offset", *extra])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), and the
    ``ids`` themselves with ``with_ids``, of every piece."""
    content, kind = file_bytes(tokenizer_path), tokenizer_path.rpartition(".")[2]
    base = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    ids = ", ids array<int>" * with_ids
    pieces = staged(documents_of(docs).mapInArrow(
        lambda it: _cut(it, kind, content, capacity, end_id, with_ids), f"{base}, part int, nth long{ids}"), "pieces")
    per_part = staged(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one per length
    runs = plan_packing(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(ranks, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    extra = ["ids"] * with_ids
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank", *extra).mapInArrow(
        lambda it: _placed(it, runs, extra), f"{base}, sequence_id long, offset long{ids}")
