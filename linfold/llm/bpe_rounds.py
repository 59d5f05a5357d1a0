"""BPE encoding and decoding by batched numpy merge rounds.

A word's bytes become symbols; the symbols of many words lie in one flat array.
In each round every word finds its adjacent pair of the lowest merge rank and
merges all places that hold it, from left to right. Ranks come from a binary
search over the sorted keys (left id, right id) of all merges, and only pairs
next to a merged symbol are searched again. Words without a pair that merges
leave the array. Merging all places at once equals one merge at a time because
no merge uses a symbol before the merge that makes it; a file in which one does
is merged one place a round.

Words are found as the file says: its added tokens first, then the byte-level
split pattern. Characters that Unicode 3.2 does not have may be classed
differently by different Unicode versions, so chunks that hold one are split
by the tokenizers library, whose results are to be met; it encodes nothing.
Distinct chunks of a segment are encoded once (see ``tokens.Chunks``; the
pattern never continues from a solid character into a space or newline, so the
cuts are safe for it).

Files: byte-level BPE as .json without normalizer, prefix space, dropout,
prefix or suffix marks, and with every byte in the vocabulary; others are
refused. Truncation and padding of the file are not used.

Defined results: a null text is the empty text with no ids. One row out per row
in, whatever repeats, doc_ids of any type; an empty table gives no rows. Unknown
ids decode to nothing, bytes that are no UTF-8 to U+FFFD; null ids are none.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from linfold.llm.bytescan import ragged, segments
from linfold.llm.common import documents_of
from linfold.llm.tokens import Chunks, byte_characters, file_bytes

#: Fixed value: the split pattern that byte-level files of this kind stand for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max  # the rank of a pair that no merge has


def _refuse(spec: dict) -> None:
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if model.get("type", "BPE") != "BPE" or not plain or spec.get("normalizer"):
        raise ValueError("only plain BPE models without a normalizer are encoded in rounds")
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("only the byte-level split without a prefix space is known")
    for t in spec.get("added_tokens", []):
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["content"].isascii() or not t["content"].isprintable() or " " in t["content"]:
            raise ValueError(f"added token {t['content']!r}: only plain ones are known")


class Rounds(Chunks):
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        _refuse(spec)
        sign, vocab = byte_characters(), spec["model"]["vocab"]
        table = {c: b for b, c in sign.items()}
        missing = [c for c in table if c not in vocab]
        if missing:
            raise ValueError(f"{len(missing)} bytes are not in the vocabulary")
        self.of_byte = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        pairs = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pairs[vocab[a], vocab[b]] = (r, vocab[a + b])
        self.width = 1 + max(vocab.values())
        left, right = np.array(list(pairs), np.int64).reshape(-1, 2).T
        rank, made = np.array(list(pairs.values()), np.int64).reshape(-1, 2).T
        order = np.argsort(left * self.width + right)
        self.pair, self.rank = (left * self.width + right)[order], rank[order].astype(np.int32)
        self.made = np.zeros(1 + max(rank, default=0), np.int64)
        self.made[rank] = made
        # no merge uses a symbol before one that makes it
        last_made, first_used = np.full(self.width, -1), np.full(self.width, NONE)
        np.maximum.at(last_made, made, rank)
        for side in (left, right):
            np.minimum.at(first_used, side, rank)
        self.at_once = bool((last_made < first_used).all())

        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        name = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        back = [b"" if (t := name.get(i)) is None else bytes(map(table.__getitem__, t)) if all(c in table for c in t) else t.encode()
                for i in range(1 + max(name))]
        self.bytes_count = np.array(list(map(len, back)), np.int64)
        self.bytes_start = np.cumsum(self.bytes_count) - self.bytes_count
        self.bytes_pool = np.frombuffer(b"".join(back), np.uint8)
        text = [b"%d," % i for i in range(len(back))]
        self.text_count = np.array(list(map(len, text)), np.int64)
        self.text_start = np.cumsum(self.text_count) - self.text_count
        self.text_pool = np.frombuffer(b"".join(text), np.uint8)

        self.words = regex.compile(SPLIT).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._library = None
        super().__init__(None)

    def _split(self, text: str) -> list[str]:
        if text.isascii() or all(unicodedata.ucd_3_2_0.category(c) != "Cn" for c in text):
            return self.words(text)
        if self._library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self._library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _made(self, data, begin, end):
        """(ids of all these chunks, how many of each)."""
        words, n_words, fixed = [], np.zeros(len(begin), np.int64), {}
        for k, (x, y) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
            chunk, before = data[x:y].tobytes().decode(), len(words)
            if self.specials is not None and self.specials.search(chunk):
                for part in self.specials.split(chunk):
                    if part in self.added:
                        fixed[len(words)] = self.added[part]
                        words.append(b"\0")
                    elif part:
                        words.extend(w.encode() for w in self._split(part))
            else:
                words.extend(w.encode() for w in self._split(chunk))
            n_words[k] = len(words) - before
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids, counts = self.merge_rounds(self.of_byte[np.frombuffer(b"".join(words), np.uint8)], sizes)
        starts = np.cumsum(counts) - counts
        for word, i in fixed.items():  # an added token took one place
            ids[starts[word]] = i
        upto = np.concatenate([[0], np.cumsum(counts)])
        last = np.cumsum(n_words)
        return ids.astype(np.uint32), upto[last] - upto[last - n_words]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair, key), max(0, len(self.pair) - 1))
        if not len(self.pair):
            return np.full(len(key), NONE, np.int32)
        return np.where(self.pair[at] == key, self.rank[at], NONE)

    def merge_rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words given one after the other as
        symbols, ``sizes`` of each; every word has at least one."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), NONE, np.int32)  # of the pair that starts here
        same = np.flatnonzero(word[:-1] == word[1:])
        rank[same] = self._ranks(symbols[same], symbols[same + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(first, append=len(symbols))
            if (best == NONE).any():  # words that are whole leave
                of = np.repeat(best != NONE, length)
                done.append((word[~of], symbols[~of]))
                symbols, word, rank = symbols[of], word[of], rank[of]
                best, length = best[best != NONE], length[best != NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, length))
            new = np.ones(len(at), bool)
            if self.at_once:  # of places that overlap every other one, from the left
                new[1:] = at[1:] != at[:-1] + 1
                if not new.all():
                    here = np.arange(len(at))
                    at = at[(here - np.maximum.accumulate(np.where(new, here, 0))) % 2 == 0]
            else:
                new[1:] = word[at[1:]] != word[at[:-1]]
                at = at[new]
            symbols[at] = self.made[rank[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            place = at - np.arange(len(at))  # each merge before took one symbol away
            symbols, word, rank = symbols[stays], word[stays], rank[stays]
            touched = np.concatenate([place, place[place > 0] - 1])
            follows = np.minimum(touched + 1, len(symbols) - 1)
            inside = (word[touched] == word[follows]) & (follows > touched)
            rank[touched] = np.where(inside, self._ranks(symbols[touched], symbols[follows]), NONE)
        word = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(sizes))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        ids = ids[(ids >= 0) & (ids < len(self.bytes_count))]
        return self.bytes_pool[ragged(self.bytes_start[ids], self.bytes_count[ids])]


_ready: dict[str, Rounds] = {}


def worker_rounds(content: bytes) -> Rounds:
    """The worker's encoder of a file's content, made once."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _ready:
        _ready[key] = Rounds(content)
    return _ready[key]


def _encoded(batches, content, digests):
    rounds = worker_rounds(content.value)
    for batch in batches:
        for a, b, data, offsets in segments(batch):
            ids, upto = rounds.ids(data, offsets)
            cols = {"doc_id": batch.column("doc_id").slice(a, b - a)}
            if digests:
                spans = lambda ends: zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                cols["n_tokens"] = pa.array(np.diff(upto), pa.int64())
                text = memoryview(rounds.text_pool[ragged(rounds.text_start[ids], rounds.text_count[ids])])
                to = np.concatenate([[0], np.cumsum(rounds.text_count[ids])])[upto]
                cols["ids_sha256"] = pa.array([hashlib.sha256(text[x:max(x, y - 1)]).hexdigest() for x, y in spans(to)], pa.string())
                raw = memoryview(rounds.bytes_of(ids))
                to = np.concatenate([[0], np.cumsum(rounds.bytes_count[ids])])[upto]
                cols["decoded_sha256"] = pa.array([hashlib.sha256(str(raw[x:y], "utf-8", "replace").encode()).hexdigest() for x, y in spans(to)], pa.string())
            else:
                cols["ids"] = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _decoded(batches, content):
    rounds = worker_rounds(content.value)
    for batch in batches:
        texts = [rounds.bytes_of(np.array([i for i in x or [] if i is not None], np.int64)).tobytes().decode(errors="replace")
                 for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _mapped(df: DataFrame, path: str, worker, columns: str) -> DataFrame:
    content = df.sparkSession.sparkContext.broadcast(file_bytes(path))  # one vocabulary file
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(lambda batches: worker(batches, content), f"doc_id {kind}, {columns}")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text."""
    return _mapped(documents_of(docs), path, lambda b, c: _encoded(b, c, False), "ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    return _mapped(encoded.select("doc_id", "ids"), path, _decoded, "text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its ids
    decoded, both digested in the same task, so that ids are not shuffled."""
    return _mapped(documents_of(docs), path, lambda b, c: _encoded(b, c, True), "n_tokens long, ids_sha256 string, decoded_sha256 string")
