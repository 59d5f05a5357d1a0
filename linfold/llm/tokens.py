"""Token ids of whole texts, each distinct chunk encoded once.

Texts are cut where no token can cross: before a space (for the byte-level
vocabularies also before a newline) that follows a character which is surely
not white space. The libraries split there themselves: the split pattern never
continues from other characters into white space, and no piece of the
sentencepiece model has its space sign after another character (checked when
the model is loaded). That holds for the split patterns named here and for
nothing else: with any other pattern, normaliser or kind of added token a text
is one chunk. So the ids of a text are those of its chunks in a row,
and each distinct chunk of a segment is encoded by the library once. Frequent
chunks stay in a cache of bounded size in the Python worker.
"""

from __future__ import annotations

import base64
import hashlib
import json
from itertools import chain

import numpy as np

from linfold.llm.bytescan import Digests, ragged

CACHED = 1_000_000  # chunks that a worker's cache holds at most, about 50 bytes each
JOINED = 100  # chunks that one call's string holds
LONGEST = 64  # bytes of a chunk that is cached
# Fixed value: the split of the byte-level vocabularies, whose matches never continue into white space
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Chunks:
    """Encodes texts by chunks. ``encode`` gives lists of ids for strings.
    ``strip``: chunks inside a text are encoded without their leading space
    (the library puts its own before). ``sizes``: bytes of each id, if ids keep
    all bytes; then distinct chunks are joined, about a hundred to a string,
    which the library handles faster, and their ids told apart by bytes.
    ``cut``: whether texts may be cut; if not, each is encoded whole."""

    def __init__(self, encode, newline: bool = True, strip: bool = False, sizes: np.ndarray | None = None, cut: bool = True):
        self.encode, self.newline, self.strip, self.cut = encode, newline, strip, cut
        self.sizes = sizes if cut else None
        self._reset()

    def _reset(self):
        self.keys, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = offsets[:-1][offsets[:-1] < offsets[1:]]
        if not self.cut:
            return row, np.zeros(len(row), bool)
        at = data == 32
        if self.newline:
            at |= data == 10
        at = np.flatnonzero(at)
        b1, b2, b3 = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
        # white space beyond ASCII starts with the bytes C2 or E1 to E3
        solid = ((b1 > 32) & (b1 < 127)) | ((b1 >= 128) & (b2 != 0xC2) & ((b3 < 0xE1) | (b3 > 0xE3)))
        mark = np.zeros(len(data), bool)
        mark[at[solid]] = True
        mark[row] = True
        starts = np.flatnonzero(mark)
        inside = np.ones(len(starts), bool)
        inside[np.searchsorted(starts, row)] = False
        return starts, inside

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of each row's first id)."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, inside = self._cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        begin = starts + inside if self.strip else starts
        keys, first, of = np.unique(Digests(data).of(begin, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        old, new = np.flatnonzero(known), np.flatnonzero(~known)
        made, sizes = self._made(data, begin[first[new]], ends[first[new]])
        pool = np.concatenate([self.pool, made])
        start, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        start[old], count[old] = self.start[place[old]], self.count[place[old]]
        start[new], count[new] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        out = pool[ragged(start[of], count[of])]
        upto = np.concatenate([[0], np.cumsum(count[of])])
        self.used[place[old]] += 1
        short = (ends - begin)[first[new]] <= LONGEST
        self._keep(place[new][short], keys[new][short], start[new][short], sizes[short], pool)
        return out, upto[np.searchsorted(starts, offsets)]

    def _made(self, data, begin, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all these chunks, how many of each)."""
        size = end - begin
        joined = np.zeros(len(begin), bool)
        if self.sizes is not None and len(begin):
            full = np.flatnonzero(size > 1)
            a, z = data[begin[full]], data[end[full] - 1]
            joined[full] = ((a == 32) | (a == 10)) & (z > 32) & (z < 127)
        ids, counts = [], np.zeros(len(begin), np.int64)
        to = np.flatnonzero(joined)
        if len(to):
            text = data[ragged(begin[to], size[to])].tobytes()
            ends = np.cumsum(size[to])
            cut = [0, *ends[JOINED - 1::JOINED].tolist()]
            cut += [len(text)] * (cut[-1] < len(text))
            made = self._flat(self.encode([text[x:y].decode() for x, y in zip(cut[:-1], cut[1:], strict=True)]))
            upto = np.cumsum(self.sizes[made])
            last = np.searchsorted(upto, ends)
            if len(upto) and last[-1] < len(upto) and (upto[last] == ends).all():
                counts[to] = np.diff(last, prepend=-1)
                ids.append((to, made))
            else:
                joined[:] = False
        to = np.flatnonzero(~joined)
        if len(to):
            lists = self.encode([data[x:y].tobytes().decode() for x, y in zip(begin[to].tolist(), end[to].tolist(), strict=True)])
            counts[to] = np.fromiter(map(len, lists), np.int64, len(lists))
            ids.append((to, self._flat(lists)))
        out, start = np.empty(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        for to, made in ids:
            out[ragged(start[to], counts[to])] = made
        return out, counts

    @staticmethod
    def _flat(lists) -> np.ndarray:
        return np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))

    def _keep(self, place, keys, start, count, pool):
        """Put new chunks, sorted by key, into the cache."""
        if len(self.keys) + len(keys) > CACHED:  # only what several segments used stays, if that is enough
            keep = self.used > 1
            if keep.sum() + len(keys) > CACHED:
                keep[:] = False
                keys, start, count = keys[:CACHED], start[:CACHED], count[:CACHED]
            moved = self.start[keep], self.count[keep]
            both = np.concatenate([moved[0], start]), np.concatenate([moved[1], count])
            pool = pool[ragged(*both)]
            upto = np.cumsum(both[1]) - both[1]
            self.keys, self.used = self.keys[keep], np.ones(int(keep.sum()), np.int64)
            self.start, self.count, start = upto[:len(self.keys)], moved[1], upto[len(self.keys):]
            place = np.searchsorted(self.keys, keys)
        self.pool = pool
        self.keys, self.start = np.insert(self.keys, place, keys), np.insert(self.start, place, start)
        self.count, self.used = np.insert(self.count, place, count), np.insert(self.used, place, 1)


_ready: dict[tuple[str, str], object] = {}


def worker_encoder(kind: str, content: bytes, pattern: str | None = None):
    """The worker's encoder for a vocabulary file's content, made once.

    ``json``: tokenizers, its special strings read as the library does by
    default; ``model``: sentencepiece; ``tiktoken``: ranks, run by tokenizers."""
    key = (kind, hashlib.sha256(content + (pattern or "").encode()).hexdigest())
    if key not in _ready:
        _ready[key] = {"json": _from_json, "model": _from_model, "tiktoken": _from_ranks}[kind](content, pattern)
    return _ready[key]


def _quiet():
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task; Spark has the cores
    os.environ["RAYON_NUM_THREADS"] = "1"


def _splits_at_spaces(file: dict) -> bool:
    """Whether a .json file's texts may be cut before white space: split by
    ``SPLIT`` alone, and no added token that holds or takes in white space."""
    split = file.get("pre_tokenizer") or {}
    return (file.get("normalizer") is None and file["model"].get("type") == "BPE" and not file["model"].get("dropout")
            and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
                        for t in file.get("added_tokens") or []))


def _from_json(content: bytes, _):
    _quiet()
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(content.decode())
    t.no_truncation()
    t.no_padding()
    special = {i: len(x.content.encode()) for i, x in t.get_added_tokens_decoder().items()}
    known = {i: len(x) for x, i in t.get_vocab(with_added_tokens=False).items()} | special
    sizes = np.array([known.get(i, 0) for i in range(max(known) + 1)], np.int64)
    return Chunks(lambda texts: [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)], sizes=sizes,
                  cut=_splits_at_spaces(json.loads(content)))


def _from_model(content: bytes, _):
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_proto=content)
    sign = "▁"
    pieces = [s.id_to_piece(i) for i in range(s.get_piece_size())]
    # chunks are independent if no piece crosses into a space, spaces are kept as they are, and one is put before
    apart = all(sign not in p.lstrip(sign) for p in pieces) and s.encode("a  b ", out_type=str) == [
        sign + "a", sign, sign + "b", sign] and s.encode("  ﬁ", out_type=str)[-1] == "ﬁ"
    lone = [s.piece_to_id(sign)]
    return Chunks(lambda texts: [x if t else lone for t, x in zip(texts, s.encode(texts, num_threads=1), strict=True)],
                  newline=False, strip=True, cut=apart)


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones for themselves, the others counted up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


def _from_ranks(content: bytes, pattern: str):
    _quiet()
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, sign = read_ranks(content), byte_characters()
    name = lambda t: "".join(map(sign.__getitem__, t))
    # every way to put a token together, by the token's rank: the lowest joint rank is merged first
    merges = [(name(t[:i]), name(t[i:])) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t))
              if t[:i] in ranks and t[i:] in ranks]
    t = Tokenizer(models.BPE({name(x): r for x, r in ranks.items()}, merges, ignore_merges=True))
    t.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    # decoding: the reversed byte table, as one pool of bytes with each id's place in it
    table = {c: b for b, c in sign.items()}
    known = t.get_vocab()
    back = {r: bytes(map(table.__getitem__, x)) for x, r in known.items()}
    sizes = np.array([len(back.get(i, b"")) for i in range(max(back) + 1)], np.int64)
    chunks = Chunks(lambda texts: [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)], sizes=sizes, cut=pattern == SPLIT)
    chunks.bytes_pool = np.frombuffer(b"".join(back.get(i, b"") for i in range(max(back) + 1)), np.uint8)
    chunks.bytes_count, chunks.bytes_start = sizes, np.cumsum(sizes) - sizes
    return chunks


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
