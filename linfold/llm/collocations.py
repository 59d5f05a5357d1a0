"""Phrase collocation mining over count streams in prefix and suffix order.

A phrase is a run of up to ``longest`` words of one piece; everything is counted
per language.

1. Pairs. A first scan counts pairs of words by digest. Pairs that reach
   ``least`` set a bit in a table of fixed size, which is broadcast.
2. Phrases. A phrase that occurs often enough holds only pairs that do, so the
   second scan sends all words and the phrases all of whose pairs have their
   bit. They are summed as text: the words give each language's total, and
   phrases of more words with ``least`` occurrences are the candidates. The bit
   table only spares rows: a shared bit or digest never changes a count.
3. Streams. The candidates are range-partitioned and sorted twice: by their
   words (prefix order) and by their words from the last to the first (suffix
   order). In prefix order a phrase comes after its own beginnings and before
   its extensions, so one forward scan reads off the counts of all its first
   parts and the largest count of a phrase with one more word behind; suffix
   order gives the last parts and the words before. Phrases that share their
   first two words (last two) are never parted; the count of the single first
   (last) word comes with the pair, from a merge join with the words.
4. Merging. Both streams, sorted by phrase, are merge-joined in lockstep: each cut
   has its left count from the one and its right count from the other. No hash
   table of counts is held anywhere.

A phrase is dropped when a longer candidate around it has ``cover`` percent of
its occurrences. A longer candidate of several more words implies one of one
more word, at least as frequent, so the extensions by one word decide.

Scores are floor(``SCALE`` * a / (l + r)) in decimals, exact for counts up to
10^20.

Defined results: a null text is empty, a null language is ``und``; repeated rows
and doc_ids count as often as they occur; a language without candidates has no
row; equal scores and counts go by the phrase's UTF-8 bytes. Texts of any length
are read in whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfold.llm.bytescan import Digests, lower, mix, ragged, segments
from linfold.llm.common import staged, unstage

LEAST, LONGEST, COVER, TOP = 30, 4, 80, 2000
SCALE = 2_000_000
BITS = 27  # the table of frequent pairs has 2**BITS bits: 16 MB
PAIR = np.uint64((1 << 32) - 1)  # the part of a pair's digest that is counted: shorter rows, a shared one spares none
PAIRS = 4_000_000  # pairs that a task holds before it sends them, in
PAIR_PARTS = 16  # parts
HELD = 2_000_000  # phrases, or
HELD_BYTES = 64 << 20  # bytes of them, that a task holds before it sends them
SENT = 100_000  # rows of a batch that it sends
TEXT = 512 << 10  # bytes of text whose words are found at a time: their numbers take some 60 times that

_PARTS = np.zeros(256, bool)  # characters that end a piece
_PARTS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_APART = _PARTS.copy()  # and those that end a word
_APART[[32, 9]] = True


def _language(name: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(name.encode(), digest_size=8).digest(), np.uint64)[0]


class _Words:
    """The words of a segment: text with one space between them, places in it,
    the piece and language of each, and digests per language."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, salt: np.ndarray):
        data = lower(data)
        solid = ~_APART[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(offsets, start, side="right") - 1
        # a piece ends at one of its characters and with its row
        self.piece = np.cumsum(_PARTS[data])[start] + row if len(start) else start
        self.lang = lang[row]
        size = end - start
        spaced = np.append(data, np.uint8(32))[ragged(start, size + 1)]
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        spaced[self.end] = 32
        self.text = spaced
        self.digests = Digests(mix(Digests(data).of(start, end) ^ salt[row]))

    def phrases(self, n: int) -> np.ndarray:
        """The first words of all phrases of ``n`` words."""
        return np.flatnonzero(self.piece[:max(0, len(self.piece) - n + 1)] == self.piece[n - 1:])

    def cut(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases of ``n`` words at ``at`` as strings."""
        size = self.end[at + n - 1] - self.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        text = self.text[ragged(self.start[at], size)]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(text))


def _segments(batches):
    for batch in batches:
        names = batch.column("lang").to_pylist()
        of = {x: k for k, x in enumerate(dict.fromkeys(names))}
        known = np.array([_language(x) for x in of], np.uint64)
        code = np.array([of[x] for x in names], np.int64)
        langs = list(of)
        for a, b, data, offsets in segments(batch, limit=TEXT):
            yield langs, _Words(data, offsets, code[a:b], known[code[a:b]])


def _merged(digest: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct digest is, in ascending order, its total)."""
    order = np.argsort(digest, kind="stable")
    first = np.flatnonzero(np.append(True, digest[order][1:] != digest[order][:-1]))
    return order[first], np.add.reduceat(many[order], first)


class _Held:
    """Distinct phrases of a task with their counts, by number of words."""

    def __init__(self):
        self.languages: dict[str, int] = {}
        self._clear()

    def _clear(self):
        self.rows, self.n, self.bytes = {}, 0, 0

    def add(self, words: _Words, langs: list[str], at: np.ndarray, n: int):
        if not len(at):
            return
        code = np.array([self.languages.setdefault(x, len(self.languages)) for x in langs], np.int32)
        digest, once, many = np.unique(words.digests.sliding(n)[at], return_index=True, return_counts=True)
        text = words.cut(at[once], n)
        self.rows.setdefault(n, []).append((digest, many, code[words.lang[at[once]]], text))
        self.n += len(once)
        self.bytes += text.nbytes

    def _settle(self):
        """What is held, each phrase once."""
        rows, (self.rows, self.n, self.bytes) = self.rows, ({}, 0, 0)
        for n in sorted(rows):
            digest, many, code = (np.concatenate([r[k] for r in rows[n]]) for k in range(3))
            pick, many = _merged(digest, many)
            text = pa.chunked_array([r[3] for r in rows.pop(n)]).take(pa.array(pick)).combine_chunks()
            self.rows[n] = [(digest[pick], many, code[pick], text)]
            self.n += len(pick)
            self.bytes += text.nbytes

    def full(self) -> bool:
        if self.n < HELD and self.bytes < HELD_BYTES:
            return False
        self._settle()
        return 2 * self.n >= HELD or 2 * self.bytes >= HELD_BYTES

    def send(self):
        self._settle()
        names = pa.array(list(self.languages), pa.string())
        for n, [(_, many, code, text)] in self.rows.items():
            order = pc.sort_indices(text)  # neighbours alike: the shuffle's compression halves them
            text, order = text.take(order), order.to_numpy()
            many, code = many[order], code[order]
            for k in range(0, len(many), SENT):
                part = text.slice(k, SENT)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(code[k:k + SENT])), part.cast(pa.string()), pa.array(np.full(len(part), n, np.int32)), pa.array(many[k:k + SENT], pa.int64())],
                    ["lang", "phrase", "n", "f"])
        self._clear()


def _counted_pairs(batches):
    """Rows (digest of two words, how often a task has them)."""
    held, n = [], 0

    def sent():  # in ascending parts, so that little beside what is held is taken
        edges = np.arange(1, PAIR_PARTS, dtype=np.uint64) * ((PAIR + np.uint64(1)) // np.uint64(PAIR_PARTS))
        cuts = [np.concatenate([[0], np.searchsorted(d, edges), [len(d)]]) for d, _ in held]
        for k in range(PAIR_PARTS):
            digest, many = (np.concatenate([r[x][c[k]:c[k + 1]] for r, c in zip(held, cuts, strict=True)]) for x in (0, 1))
            if len(digest):
                pick, many = _merged(digest, many)
                yield pa.RecordBatch.from_arrays([pa.array(digest[pick].view(np.int64)), pa.array(many, pa.int64())], ["pair", "f"])
    for _, words in _segments(batches):
        at = words.phrases(2)
        if len(at):
            held.append(np.unique(words.digests.sliding(2)[at] & PAIR, return_counts=True))
            n += len(held[-1][0])
        if n >= PAIRS:
            yield from sent()
            held, n = [], 0
    if n:
        yield from sent()


def _counted_phrases(batches, table, longest):
    """Rows of all words, and of the phrases of two to ``longest`` words whose
    pairs are all in the table."""
    bits, held = np.frombuffer(table.value, np.uint64), _Held()
    place = np.uint64(len(bits) * 64 - 1)
    for langs, words in _segments(batches):
        at = words.phrases(2)
        slot = words.digests.sliding(2)[at] & place
        often = np.zeros(len(words.piece) + longest, bool)
        often[at] = (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        for n in range(1, longest + 1):
            at = words.phrases(n)
            for k in range(n - 1):
                at = at[often[at + k]]
            held.add(words, langs, at, n)
        if held.full():
            yield from held.send()
    yield from held.send()


def _bit_table(pairs: DataFrame, least: int, bits: int) -> bytes:
    """The table of the pairs that reach ``least``: 2**bits bits, whatever the input."""
    slot = F.col("pair").bitwiseAND((1 << bits) - 1)
    # a task's pairs are summed already: dealt out as they are, without a second table of them in the JVM
    words = (pairs.repartition("pair").groupBy("pair").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
             .select(F.shiftrightunsigned(slot, 6).alias("at"), F.expr("shiftleft(1L, cast(pair & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow())
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words["at"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return table.tobytes()


def _scanned(frames, longest: int, parts: str):
    """A stream of phrases, each after its own beginnings (in the stream's
    direction), with the counts of all these and the largest of an extension.
    The last phrase of each size is carried on until its extensions are over."""
    names, carried = [f"{parts}{k}" for k in range(1, longest)], None
    columns = ["lang", "phrase", "n", "a", *names, "ext"]
    for frame in frames:
        frame["ext"] = 0
        if carried is not None:
            frame = pd.concat([carried.drop(columns=names), frame], ignore_index=True)
        n, a, ext = (frame[c].to_numpy(np.int64, copy=True) for c in ("n", "a", "ext"))
        known, here = frame["edge"].fillna(0).to_numpy(np.int64), np.arange(len(frame))
        for k, name in enumerate(names, 1):
            # the last phrase of k words before a longer one is its beginning; that of one word came with the pair
            above = np.maximum.accumulate(np.where(n == max(k, 2), here, 0))
            frame[name] = np.where(n > k, (known if k == 1 else a)[above], 0)
            if k > 1:
                longer = n == k + 1
                np.maximum.at(ext, above[longer], a[longer])
        frame["ext"] = ext
        open_rows, size = [], longest  # from the end: what a phrase still to come may extend
        for i in range(len(n) - 1, -1, -1):
            if n[i] < size:
                open_rows.append(i)
                size = n[i]
            if size == 2:
                break
        carried = frame.loc[open_rows[::-1]]
        yield frame.drop(index=open_rows)[columns]
    if carried is not None:
        yield carried[columns]


def _stream(phrases: DataFrame, words: DataFrame, longest: int, prefix: bool) -> DataFrame:
    """(lang, phrase, n, a, counts of the parts, ext) in prefix or suffix order."""
    order = F.split("phrase", " ") if prefix else F.reverse(F.split("phrase", " "))
    rows = phrases.withColumn("order", order)
    single = words.select(F.col("lang").alias("w_lang"), F.col("phrase").alias("w"), F.col("f").alias("edge"))
    first = F.col("order")[0]
    # the single word's count comes with the pairs only, so a word joins as often as it has frequent neighbours
    pairs = rows.where("n = 2").join(single.hint("merge"), (F.col("lang") == F.col("w_lang")) & (first == F.col("w")), "left").drop("w_lang", "w")
    rows = pairs.unionByName(rows.where("n > 2").withColumn("edge", F.lit(None).cast("long")))
    rows = (rows.select("lang", F.col("order")[0].alias("w1"), F.col("order")[1].alias("w2"), "order", "phrase", "n", "a", "edge")
            .repartitionByRange("lang", "w1", "w2").sortWithinPartitions("lang", "order").select("lang", "phrase", "n", "a", "edge"))
    parts = "p" if prefix else "s"
    counts = ", ".join(f"{parts}{k} long" for k in range(1, longest))
    return rows.mapInPandas(lambda it: _scanned(it, longest, parts), f"lang string, phrase string, n int, a long, {counts}, ext long")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates (lang, phrase, n words, a), frequent words (lang, phrase, f),
    languages (lang, words counted)), all stored."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = texts.mapInArrow(_counted_pairs, "pair long, f long")
    table = docs.sparkSession.sparkContext.broadcast(_bit_table(pairs, least, bits))
    counts = staged(texts.mapInArrow(lambda b: _counted_phrases(b, table, longest), "lang string, phrase string, n int, f long")
                    .groupBy("lang", "phrase", "n").agg(F.sum("f").alias("a")).where((F.col("n") == 1) | (F.col("a") >= least)), "counts")
    languages = staged(counts.where("n = 1").groupBy("lang").agg(F.sum("a").alias("total")), "languages")
    often = staged(counts.where(F.col("a") >= least), "often")
    unstage(counts)
    return often.where("n > 1"), often.where("n = 1").select("lang", "phrase", F.col("a").alias("f")), languages


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: int = COVER, top: int = TOP, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases of 2 to ``longest`` words by the score of their lowest cut."""
    phrases, words, languages = phrase_counts(docs, least, longest, bits)
    left = staged(_stream(phrases, words, longest, True), "prefix")
    right = staged(_stream(phrases, words, longest, False), "suffix")
    right = right.select(F.col("lang").alias("s_lang"), F.col("phrase").alias("s_phrase"), *[f"s{k}" for k in range(1, longest)], F.col("ext").alias("s_ext"))
    rows = left.join(right.hint("merge"), (F.col("lang") == F.col("s_lang")) & (F.col("phrase") == F.col("s_phrase")))

    def cut(k, size):
        l, r = F.col(f"p{k}"), F.col(f"s{size - k}")  # noqa: E741
        score = F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(p{k} as decimal(20,0)) + cast(s{size - k} as decimal(20,0)))")
        return F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
    least_cut = F.coalesce(*[F.when(F.col("n") == size, F.array_min(F.array(*[cut(k, size) for k in range(1, size)]))) for size in range(2, longest + 1)])
    whole = _exact(F.greatest("ext", "s_ext")) * 100 < _exact(F.col("a")) * cover
    rows = rows.where(whole).select("lang", "phrase", "a", least_cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # a language's first ones are among the first of each of its parts, so no task gets them all
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*by))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    return (rows.join(languages, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
