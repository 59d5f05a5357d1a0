"""Byte-level BPE encoding and decoding over Arrow batches.

The merges are run by the tokenizers library: a rank file becomes a BPE model
over characters that stand for bytes, split first by the given pattern. Each
distinct chunk of a segment is encoded once (see ``tokens``). Offsets map each
token to characters through the byte table: a token that starts inside a
character counts from that character. Decoding reverses the byte table, joins
the bytes, and reads them as UTF-8; a character split between tokens comes back
whole, one that the ids cut off becomes U+FFFD.

Defined results: a null text is the empty text with no ids. One row out per row
in, whatever repeats; an empty table gives no rows. Unknown ids decode to no
bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linfold.llm.bytescan import ragged, segments
from linfold.llm.common import documents_of
from linfold.llm.tokens import file_bytes, worker_encoder


def _bytes_of(chunks, ids: np.ndarray) -> np.ndarray:
    ids = ids[ids < len(chunks.bytes_count)]
    return chunks.bytes_pool[ragged(chunks.bytes_start[ids], chunks.bytes_count[ids])]


def _spans(chunks, data, offsets, ids, upto):
    """Of each token the first character it has a byte of, and the end of the last; within its row."""
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = np.cumsum(chunks.bytes_count[ids])
    starts = ends - chunks.bytes_count[ids]
    before = np.repeat(lead[offsets[:-1]], np.diff(upto))
    return lead[np.minimum(starts + 1, len(data))] - 1 - before, lead[ends] - before


def _encoded(batches, content, pattern, with_ids):
    chunks = worker_encoder("tiktoken", content, pattern)
    for batch in batches:
        for a, b, data, offsets in segments(batch):
            ids, upto = chunks.ids(data, offsets)
            cols = {"doc_id": batch.column("doc_id").slice(a, b - a)}
            if with_ids:
                first, last = _spans(chunks, data, offsets, ids, upto)
                for name, x in (("ids", ids), ("char_start", first), ("char_end", last)):
                    cols[name] = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(x.astype(np.int32), pa.int32()))
            else:
                back = _bytes_of(chunks, ids)
                to = np.concatenate([[0], np.cumsum(chunks.bytes_count[ids])])[upto]
                raw, ids = memoryview(back), memoryview(ids.astype("<u4").view(np.uint8))
                cols["n_tokens"] = pa.array(np.diff(upto), pa.int64())
                cols["ids_sha256"] = pa.array([hashlib.sha256(ids[4 * x:4 * y]).hexdigest() for x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)], pa.string())
                cols["decoded_sha256"] = pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _decoded(batches, content, pattern):
    chunks = worker_encoder("tiktoken", content, pattern)
    for batch in batches:
        texts = [_bytes_of(chunks, np.asarray(x or [], np.int64)).tobytes().decode(errors="replace") for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _typed(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, char_start, char_end): token ids of every text, with each
    token's place in characters."""
    content = file_bytes(ranks_path)
    return documents_of(docs).mapInArrow(lambda it: _encoded(it, content, pattern, True),
                                         _typed(docs) + ", ids array<int>, char_start array<int>, char_end array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    content = file_bytes(ranks_path)
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decoded(it, content, pattern), _typed(encoded) + ", text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its
    ids decoded, both digested in the same task, so that ids are not shuffled."""
    content = file_bytes(ranks_path)
    return documents_of(docs).mapInArrow(lambda it: _encoded(it, content, pattern, False),
                                         _typed(docs) + ", n_tokens long, ids_sha256 string, decoded_sha256 string")
