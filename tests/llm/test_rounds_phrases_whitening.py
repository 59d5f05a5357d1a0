"""BPE rounds against the library, collocations and whitening against plain
versions."""

import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import CLASH, lower, sha, strings, table

from linfold.llm import bpe_rounds, collocations as phrases, whitening
from linfold.llm.queries import REGISTRY

SF001 = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- BPE rounds
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    t.no_truncation()
    t.no_padding()
    return t


def fuzzed(n=400, seed=5):
    rnd = random.Random(seed)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "日本", "1", "12", "!", "<|endoftext|>", "<|endo", " ", "　", "\x85",
            "\U0001F600", "\U0003d000", "\x00", "the", "ing", " the", "\x1c", "aaaaaaa", "\r\n", "՘", "x" * 50, "�"]
    rows = [(k, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 50)))) for k in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, "a" * 3000), (n + 3, "日本語の文章" * 4000), (None, "null id"), rows[3], rows[3]]


def digests(rows):
    t, out = library(), []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    return strings(out)


def test_rounds_equal_the_library(spark):
    rows = fuzzed()
    docs = table(spark, rows)
    assert strings(bpe_rounds.round_trip(docs, JSON).collect()) == digests(rows)
    enc = bpe_rounds.encode(docs, JSON)
    back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in bpe_rounds.decode(enc, JSON).collect())
    assert back == sorted((i is None, i or 0, t or "") for i, t in rows)
    assert bpe_rounds.round_trip(docs.limit(0), JSON).count() == 0


def test_string_ids_and_odd_ids_decode(spark):
    docs = spark.createDataFrame([("x", "some words")], "doc_id string, text string")
    assert bpe_rounds.encode(docs, JSON).collect()[0]["doc_id"] == "x"
    odd = spark.createDataFrame([("y", [10 ** 6, None, -4, 64]), ("z", None)], "doc_id string, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe_rounds.decode(odd, JSON).collect()}
    assert got == {"y": library().decode([64]), "z": ""}


def test_query_equals_the_library(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert strings(REGISTRY["op11_bpe_rounds"][0](spark, SF001).collect()) == digests(rows)


def small_file(merges, tokens=()):
    from linfold.llm.tokens import byte_characters
    vocab = {c: k for k, c in enumerate(byte_characters().values())}
    for m in merges:
        vocab.setdefault("".join(m), len(vocab))
    return {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
            "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}, "post_processor": None,
            "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                      "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": vocab, "merges": [list(m) for m in merges]}}


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_merges(seed):
    """Also files in which a merge uses a symbol that a later merge makes."""
    from tokenizers import Tokenizer
    rnd = random.Random(seed)
    made, merges = list("abc"), []
    for _ in range(14):
        a, b = rnd.choice(made), rnd.choice(made)
        if (a, b) not in merges:
            merges.append((a, b))
            made.append(a + b)
    if seed % 2:
        rnd.shuffle(merges)
    spec = json.dumps(small_file(merges))
    mine, lib = bpe_rounds.Rounds(spec.encode()), Tokenizer.from_str(spec)
    assert mine.at_once or seed % 2
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids, upto = mine.ids(np.frombuffer(data, np.uint8), offsets)
    assert [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:])] == [lib.encode(t).ids for t in texts]


def test_files_it_does_not_know_are_refused():
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError):
            bpe_rounds.Rounds(json.dumps({**small_file([]), **change}).encode())


# ---------------------------------------------------------------- collocations
def plain_phrases(rows, least, longest, cover, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, longest + 1):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in cands.items():
            score, k = min((phrases.SCALE * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            inside = any(100 * b >= cover * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in cands.items() if len(h) > len(g))
            if not inside:
                kept.append((-score, -a, " ".join(g).encode(), " ".join(g), f[g[:k]], f[g[k:]]))
        for rank, (s, a, _, g, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, g, -a, left, right, total[lang], -s))
    return strings(out)


def phrase_rows(seed, n=120):
    rnd = random.Random(seed)
    vocab = ["New", "york", "city", "of", "the", "a\x01", "a", "é", "日本", "x-y", "3"]
    fixed = ["new york city hall", "of the", "a\x01 a b", "the the the the the"]
    text = lambda: "".join((rnd.choice(fixed) if rnd.random() < .3 else rnd.choice(vocab)) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "!x"])
                           for _ in range(rnd.randint(0, 40)))
    rows = [(rnd.choice(["en", "en", "de", None, "und"]), text()) for _ in range(n)]
    return [*rows, ("en", None), ("fr", ""), ("fr", " ., "), ("en", "long " * 5000), *rows[:3], ("en", "hot pair " * 3000)]


@pytest.mark.parametrize("seed,least,longest", [(1, 3, 4), (2, 2, 3), (3, 5, 5), (4, 4, 2)])
def test_collocations_equal_plain(spark, monkeypatch, seed, least, longest):
    rows = phrase_rows(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for c in CLASH:
        docs = docs.selectExpr("*", f"'clash' AS `{c}`")
    got = phrases.collocations(docs, least=least, longest=longest, top=25, bits=8 + seed)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert strings(got.collect()) == plain_phrases(rows, least, longest, phrases.COVER, 25)


def test_collocations_with_small_limits(spark):
    """Phrases sent often, streams cut into many batches."""
    rows = phrase_rows(9)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = strings(phrases.collocations(docs, least=2, top=40).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_phrases(rows, 2, 4, phrases.COVER, 40)


def test_task_holds_few_phrases(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace
    monkeypatch.setattr(phrases, "HELD", 5)
    monkeypatch.setattr(phrases, "SENT", 2)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 20, "text": ["a b c a b, d", "a b c"] * 20})
    got = Counter()
    full = SimpleNamespace(value=np.full(4, ~np.uint64(0)).tobytes())
    for b in phrases._counted_phrases([batch] * 3, full, 3):
        for r in b.to_pylist():
            got[r["lang"], r["phrase"], r["n"]] += r["f"]
    assert got["en", "a", 1] == 120 and got["de", "c", 1] == 60 and got["en", "d", 1] == 60 and got["en", "c a b", 3] == 60 and got["de", "a b c", 3] == 60
    assert sum(r["f"] for b in phrases._counted_pairs([batch] * 3) for r in b.to_pylist()) == 60 * 6


def test_pairs_leave_a_task_in_ascending_parts():
    """The merge of all pairs at once took several times what a task holds."""
    import pyarrow as pa
    text = " ".join(f"w{k * k % 7919}" for k in range(20_000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en", None], "text": [text, "a b"]})
    parts = list(phrases._counted_pairs([batch.set_column(0, "lang", batch["lang"].fill_null("und"))] * 2))
    digest = np.concatenate([b["pair"].to_numpy() for b in parts])
    assert max(b.num_rows for b in parts) < len(digest) / 4 and (digest[1:] > digest[:-1]).all()
    assert sum(b["f"].to_numpy().sum() for b in parts) == 2 * (19_999 + 1)


def test_no_phrases(spark):
    docs = spark.createDataFrame([("en", "a b")], "lang string, text string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_collocation_query_equals_plain(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert strings(REGISTRY["op12_collocations"][0](spark, SF001).collect()) == plain_phrases(rows, 30, 4, 80, 2000)


# ---------------------------------------------------------------- whitening
@pytest.mark.parametrize("kind", ["full", "few", "copies", "constant", "scales"])
def test_spectrum_updates(kind):
    rng = np.random.default_rng(len(kind))
    x = rng.normal(size=(60, 12)) + 5
    if kind == "few":
        x = x[:5]
    if kind == "copies":
        x = np.repeat(x[:4], 15, 0)
    if kind == "constant":
        x[:, 3], x[:, 7] = 2, x[:, 1]
    if kind == "scales":
        x *= 10.0 ** np.arange(-6, 6)
    one, a, b = whitening.Spectrum(12), whitening.Spectrum(12), whitening.Spectrum(12)
    for k, v in enumerate(x):
        one.add(v)
        (a if k % 3 else b).add(v)
    a.combine(b)
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    for s in (one, a):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(0))
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - want).max() < 1e-12 * np.abs(want).max()
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-12


def test_secular_roots():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 30):
        d, z = np.sort(rng.normal(size=n)) * 10.0 ** rng.integers(-8, 8), rng.normal(size=n)
        origin, offset = whitening.secular_roots(d, z * z, 2.5)
        want = np.linalg.eigvalsh(np.diag(d) + 2.5 * np.outer(z, z))
        assert np.abs(d[origin] + offset - want).max() <= 1e-13 * np.abs(want).max()


def check_whitening(got, rows, width, tol=1e-8):
    """``rows``: (id, vector or None) as they were given."""
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and len(v) == width]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fine])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s // n - (s % n) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, int((values > 1e-12 * values[0]).sum())) if values[0] > 0 else 0
    assert len(got) == k * len(fine)
    if not k:
        return
    white = (x - s // n - (s % n) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    want = defaultdict(list)
    for (i, _), d, w in zip(fine, dev, white):
        want[i].append((d, w))
    by = defaultdict(dict)
    for r in got:
        by[r["vec_id"], r["deviation"]].setdefault(r["component"], []).append(r["whitened"])
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / np.trace(v)) - 1) < 1e-9 and r["identity_error"] < 1e-8
    sign = None
    for i, places in want.items():
        for d, w in places:
            assert sorted(by[i, d]) == list(range(1, k + 1))
            mine = np.array([by[i, d][c][0] for c in range(1, k + 1)])
            sign = np.sign(mine * w) if sign is None else sign
            assert np.abs(mine * sign - w).max() < tol


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(c) for c in rng.normal(size=6) * np.arange(1, 7)]) for k in range(200)]
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] + [0.0] * 5), (304, [float("-inf")] + [0.0] * 5),
             (305, [1.0, 2.0]), rows[7], rows[7], (306, rows[7][1]), (None, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for c in ("x", "c", "n", "part", "k", "component"):
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    check_whitening(whitening.whiten(df).collect(), rows, 6)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [5.0, 7.0])], [(1, None)]])
def test_whitening_of_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    if rows and rows[0][1]:
        check_whitening(got, rows, 2)
    else:
        assert got == []


def test_whitening_levels(spark, monkeypatch):
    """Spectra combined two at a time, over several levels."""
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in rng.normal(size=4)]) for k in range(90)]
    called = []
    monkeypatch.setattr(whitening, "staged", lambda df, tag, f=whitening.staged: called.append(tag) or f(df, tag))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert called.count("spectra") > 2
    check_whitening(got, rows, 4)


def test_deviation_beyond_64_bits(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.5])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    dev = {i: sum((3 * a - b) ** 2 for a, b in zip(r, s)) for (i, _), r in zip(rows, x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 1 << 63 else None for i, d in dev.items()}


def test_whitening_query(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    check_whitening(REGISTRY["op13_embedding_whitening"][0](spark, SF001).collect(), rows, 64)
