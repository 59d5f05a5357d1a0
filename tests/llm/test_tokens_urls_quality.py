"""Tokens, packing, urls, quality rules and the pipeline."""

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from helpers import awkward, stats, strings, table, tuples
from linfold.llm import byte_bpe
from linfold.llm.packing import pack, plan_packing
from linfold.llm.quality_mcd import quality_filter, quality_rules
from linfold.llm.token_counts import fresh_cache, token_counts
from linfold.llm.url_filter import judge_urls

ODD = ["<|endoftext|> a<|endoftext|>b", "a  b\n\n c\u00a0d\u3000 e", "\u2581x y \u2581", "日本語 テキスト 😀😀 é\u0301", "</s><s> \x00 \x1c \x85 x", " lead", "trail ", "'s 'll don't 123abc"]
ROWS = awkward(30, 4) + [(3000 + k, t) for k, t in enumerate(ODD)]
RANKS, JSON, MODEL = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).cache()


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_token_counts_and_cache(spark, docs, path):
    if path == MODEL:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    cache = fresh_cache(spark)
    want = strings((i, len((t or "").encode()), count(t or ""), count(t or "") > 50) for i, t in ROWS)
    got = token_counts(docs, path, cache, limit=50)
    assert tuples(got.collect(), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t in ROWS})  # each distinct text once
    again = token_counts(docs, path, cache, limit=50)  # all hits: nothing is encoded or appended
    assert tuples(again.collect(), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert spark.read.parquet(cache).count() == stored


def test_cache_grows_by_few_or_many_misses(spark, docs, monkeypatch):
    import linfold.llm.token_counts as T
    cache, half = fresh_cache(spark), docs.where("doc_id % 2 = 0 or doc_id is null")
    seen = {t or "" for i, t in ROWS if i is None or i % 2 == 0}
    for few, part, texts in ((10**6, half, seen), (0, docs, {t or "" for _, t in ROWS})):
        monkeypatch.setattr(T, "FEW", few)
        monkeypatch.setattr(T, "SHARE", 0)
        assert token_counts(part, MODEL, cache).count() == part.count()
        assert spark.read.parquet(cache).count() == len(texts)
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(cache)
    fewer = T.compact(spark, cache)
    assert spark.read.parquet(fewer).count() == len(texts)
    monkeypatch.setattr(T, "_count", None)  # nothing is encoded again
    want = strings((r.doc_id, r.n_tokens) for r in token_counts(docs, MODEL, cache).collect())
    named = docs.selectExpr("cast(doc_id as string) as doc_id", "text")  # ids of another type
    assert strings((r.doc_id, r.n_tokens) for r in token_counts(named, MODEL, fewer).collect()) == want


def test_patterns_whose_matches_run_into_white_space(spark, tmp_path):
    """Other patterns and other .json files are not cut before newlines and spaces."""
    import tiktoken
    from tokenizers import AddedToken, Regex, Tokenizer, models, pre_tokenizers

    from linfold.llm.tokens import SPLIT, byte_characters
    assert SPLIT == P.PATTERN
    pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+(?!\S)|\s+"
    ranks = {bytes([b]): b for b in range(256)} | {b".\n": 256, b" a": 257}
    path = str(tmp_path / "own.tiktoken")
    with open(path, "wb") as f:
        f.writelines(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items())
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["x.\ny a", "a.\n\n a a", "", ". a\n.", "<s>\n <s>  a.\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in byte_bpe.encode(df, path, pattern).collect()}
    assert [got[k] for k in range(len(texts))] == [enc.encode_ordinary(t) for t in texts]
    assert got[0] == [120, 256, 121, 257]

    sign = byte_characters()
    name = lambda t: "".join(sign[b] for b in t)
    for regex, added in ((pattern, []), (None, [AddedToken("<s>", rstrip=True)]), (None, [AddedToken("a.\n")])):
        t = Tokenizer(models.BPE({name(x): r for x, r in ranks.items()}, [(name(x[:1]), name(x[1:])) for x in (b".\n", b" a")]))
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=regex is None)
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(regex), "isolated"), level]) if regex else level
        t.add_tokens(added)
        file = str(tmp_path / "own.json")
        t.save(file)
        counts = {r.doc_id: r.n_tokens for r in token_counts(df, file, fresh_cache(spark)).collect()}
        assert [counts[k] for k in range(len(texts))] == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_bpe_equals_tiktoken_and_comes_back(docs):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in ROWS:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()
    assert tuples(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == strings(want)
    encoded = byte_bpe.encode(docs, RANKS, P.PATTERN)
    rows = {r.doc_id: r for r in encoded.collect() if r.doc_id and r.doc_id >= 3000}
    for k, t in enumerate(ODD):
        r = rows[3000 + k]
        assert r.ids == enc.encode_ordinary(t)
        _, starts = enc.decode_with_offsets(r.ids)
        assert r.char_start == starts and r.char_end[-1] == len(t)
    back = byte_bpe.decode(encoded, RANKS, P.PATTERN).collect()
    assert strings((r.doc_id, r.text) for r in back) == strings((i, t or "") for i, t in ROWS)


def test_decoding_a_cut_character(spark):
    df = spark.createDataFrame([(1, [172, 253, 999_999]), (2, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in byte_bpe.decode(df, RANKS, P.PATTERN).collect()}
    assert got[2] == "" and "�" in got[1]


def _packed(rows, sizes, capacity):
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs), pieces


def test_packing(docs):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(JSON)
    ids = {}
    for i, t in ROWS:
        ids.setdefault(i, []).append(model.encode(t or "", add_special_tokens=False).ids + [2])
    rows = pack(docs, JSON, capacity=64, with_ids=True).collect()
    n, pieces = _packed(rows, ids, 64)
    assert set(pieces) == set(ids)
    for i, texts in ids.items():
        if len(texts) == 1:
            got = sorted(pieces[i], key=lambda r: r.piece)
            assert [r.piece for r in got] == list(range(len(got))) and sum((r.ids for r in got), []) == texts[0]
            assert all(r.length == 64 for r in got[1:]) and (len(got) == 1) == (len(texts[0]) <= 64)
            assert all(r.start == sum(x.length for x in got[:r.piece]) for r in got)
            assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    total = sum(len(x) for texts in ids.values() for x in texts)
    assert -(-total // 64) <= n <= 1.1 * total / 64 + 2


def test_plan_is_as_good_as_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(200):
        capacity = int(rng.choice([5, 12, 40, 100]))
        items = rng.integers(1, capacity + 1, rng.integers(0, 80)).tolist()
        bins, ranks = defaultdict(list), Counter()
        for n, rank, many, per, first, at in plan_packing(Counter(items), capacity):
            assert rank == ranks[n]
            ranks[n] += many
            for k in range(many):
                bins[first + k // per].append((at + k % per * n, n))
        assert ranks == Counter(items)
        for b in bins.values():
            at = 0
            for offset, n in sorted(b):
                assert offset == at
                at += n
            assert at <= capacity
        gaps = []
        for x in sorted(items, reverse=True):
            fit = [k for k, g in enumerate(gaps) if g >= x]
            if fit:
                gaps[min(fit, key=gaps.__getitem__)] -= x
            else:
                gaps.append(capacity - x)
        assert len(bins) <= len(gaps) + 1


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("example.com", "/de/", "allow"),
         ("org", "/fr/", "allow"), ("a.b", "", "block"), (None, "/", "block")]
URLS = ["http://x.example.net/en/1?a=/fr/", "https://example.net", "https://EXAMPLE.net/", "http://example.com/de/x#y", "notexample.com/de/",
        "http://notexample.com/de/", "ftp://q.org/fr/", "http://org/fr/é", "http://a.b", "http://z.a.b?x", "://", "http:///en/", None, "", "x",
        "http://net#/", "a://b://c.net/", "http://example.net/en/"]


def _judge(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = max(((len(h) + len(p), len(h), v == "block", h.lower() + p, v) for h, p, v in RULES
                if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)), default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls(spark):
    urls = [(k, u) for k, u in enumerate(URLS)] + [(None, URLS[0]), (3, URLS[3])]
    pages = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "'clash' AS host", "'clash' AS digest", "'clash' AS r_host")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = judge_urls(pages, rules).collect()
    assert tuples(got, "page_id", "host", "path", "rule", "verdict") == strings((k, *_judge(u)) for k, u in urls)
    assert judge_urls(pages.limit(0), rules).collect() == []
    none = judge_urls(pages, rules.limit(0), default="block").collect()
    assert len(none) == len(urls) and all(r.verdict == "block" and r.rule is None for r in none)


def test_statistics(docs):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = quality_rules(docs).collect()
    assert tuples(got, *cols) == strings((i, *stats(t)) for i, t in ROWS)
    assert all(not (r.kept and r.base_failed) for r in got)


def plain_distances(rows):
    """The squared distance of each of (lang, source, vector), by numpy."""
    from linfold.llm.quality_mcd import ASSUMED, BORROWED, CHI2_MEDIAN, RIDGE, SETTLED, STEPS, SUBSET
    quantile = lambda v, q: np.sort(v, axis=0)[max(int(np.ceil(q * len(v))), 1) - 1]
    groups = defaultdict(list)
    for lang, source, x in rows:
        for key in {(lang, source), (lang, "*"), ("*", "*")}:
            groups[key].append(x)
    groups = {k: np.array(x) for k, x in groups.items()}
    ridge = RIDGE * np.eye(5)

    def distance(x, m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    fits = {}
    for k, x in groups.items():
        mid = quantile(x, .5)
        fits[k, 0] = mid, np.diag((1.4826 * quantile(np.abs(x - mid), .5)) ** 2) + ridge
        fits[k, 1] = x.mean(axis=0), np.cov(x.T, bias=True).reshape(5, 5) + ridge
    logdet = lambda f: {k: np.linalg.slogdet(c)[1] for k, (_, c) in f.items()}
    for _ in range(STEPS):
        after = {}
        for (k, start), (m, c) in fits.items():
            d2 = distance(groups[k], m, c)
            near = groups[k][d2 <= quantile(d2, SUBSET) * (1 + 1e-12)]
            after[k, start] = near.mean(axis=0), np.cov(near.T, bias=True).reshape(5, 5) + ridge
        fell = max(abs(a - b) for a, b in zip(logdet(fits).values(), logdet(after).values(), strict=True))
        fits = after
        if fell <= SETTLED:
            break
    best = {}
    for k, x in groups.items():
        m, c = min((fits[k, 0], fits[k, 1]), key=lambda f: round(np.linalg.slogdet(f[1])[1], 9))
        half = quantile(distance(x, m, c), .5)
        best[k] = m, c * (half / CHI2_MEDIAN if half > 0 else 1), len(x)

    def borrowed(k, parent):
        m, c, n = best[k]
        return tuple((n * a + BORROWED * b) / (n + BORROWED) for a, b in zip((m, c), parent, strict=True))
    m, c, n = best["*", "*"]
    every = m, (n * c + ASSUMED * np.eye(5)) / (n + ASSUMED)
    return [float(distance(x[None], *borrowed((lang, source), borrowed((lang, "*"), every)))[0])
            for lang, source, x in ((a, b, np.array(v)) for a, b, v in rows)]


def vector(t):
    n, chars, symbols, dup, rep, _ = stats(t)
    return [np.log1p(n), np.log(max(chars, 1) / n) * 4, np.sqrt(symbols / n) * 4, np.sqrt(dup / n) * 2, np.sqrt(rep / n)]


@pytest.mark.parametrize("groups", [10**6, 0])
def test_outliers_by_plain_covariance_determinant(spark, monkeypatch, groups):
    """The estimates and distances equal a numpy version's, in large groups and in
    groups of one; planted junk goes, clean documents stay."""
    import random

    import linfold.llm.quality_mcd as Q
    monkeypatch.setattr(Q, "GROUPS", groups)  # parameters broadcast, or joined by salt
    rnd = random.Random(3)
    rows = []
    for i in range(500):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 3) + str(rnd.randint(0, 10_000)) for _ in range(rnd.randint(60, 400))]
        lang, source = ("en", "a") if i < 390 else ("de", None) if i < 460 else (None, f"s{i % 9}") if i < 499 else ("fr", "*")
        rows.append((i, " ".join(w + "%%#" if i % 20 == 0 else w for w in words), lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    want = plain_distances([(f"={a}" if a else "", f"={b}" if b else "", vector(t)) for _, t, a, b in rows])
    assert np.allclose(want, [got[i].d2 for i in range(500)], rtol=1e-6)
    assert all(got[i].kept == (i % 20 != 0) for i in got)


def test_few_documents_have_no_outliers(spark):
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (60, 20_000, 55)] + ["% & " * 300, None]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert [r.kept for r in quality_rules(df).orderBy("doc_id").collect()] == [True, True, True, False, False]


def test_quality_query_equals_plain(spark):
    """Over the whole table, whose groups are all small."""
    from linfold.llm.quality_mcd import CUTOFF
    from linfold.llm.queries import op10_quality_rules
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    tag = lambda x: "" if x is None else f"={x}"
    good = [r for r in rows if not stats(r.text)[-1]]
    d2 = dict(zip((r.doc_id for r in good), plain_distances([(tag(r.lang), tag(r.source), vector(r.text)) for r in good]), strict=True))
    got = op10_quality_rules(spark, sf).collect()
    assert strings((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == strings(
        (r.doc_id, *stats(r.text)) for r in rows)
    assert {r.doc_id for r in got if r.kept} == {i for i, d in d2.items() if d <= CUTOFF}


def test_quality_filter_keeps_rows_whole(docs):
    kept = quality_filter(docs)
    verdict = Counter(str(r.doc_id) for r in quality_rules(docs).collect() if r.kept)
    assert kept.columns == docs.columns and Counter(str(r.doc_id) for r in kept.collect()) == verdict


def test_empty_tables(spark, docs):
    nothing = docs.limit(0)
    assert token_counts(nothing, MODEL, fresh_cache(spark)).collect() == []
    assert byte_bpe.round_trip(nothing, RANKS, P.PATTERN).collect() == []
    assert pack(nothing, JSON).collect() == []
    assert quality_rules(nothing).collect() == [] and quality_filter(nothing).collect() == []


def test_pipeline_equals_plain_stages(spark, tmp_path):
    """Each stage against the plain version on what the stage before kept."""
    import corpus_pipeline
    from helpers import WORD, components, lines, substrings

    rows = [r for r in awkward(80, 9) if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    path = str(tmp_path)
    table(spark, rows, clash=False).write.parquet(f"{path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert {r.doc_id for r in after} <= {i for i, t in before if not stats(t)[5]}
            assert all(dict(before)[r.doc_id] == r.text for r in after)
        if name == "line_dedup":
            assert sorted((str(r.doc_id), hashlib.sha256(r.text.encode()).hexdigest()) for r in after) == sorted((x[0], x[3]) for x in lines(before))
        if name == "jaccard_join":
            assert {str(r.doc_id) for r in after} == {x[0] for x in components(before) if x[0] == x[2]}
        if name == "substring_dedup":
            digest = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
            assert sorted((str(r.doc_id), digest(r.text)) for r in after) == sorted((x[0], x[3]) for x in substrings(before))
        if name == "packing":
            _packed(after, None, 1024)
            assert {r.doc_id for r in after} == {i for i, _ in before}
            # the ids are those of the kept texts
            from tokenizers import Tokenizer
            library, ids = Tokenizer.from_file(JSON), {}
            for r in sorted(after, key=lambda r: (r.doc_id, r.piece)):
                assert len(r.ids) == r.length
                ids.setdefault(r.doc_id, []).extend(r.ids)
            assert {i: library.decode(x[:-1], skip_special_tokens=False) for i, x in ids.items()} == {i: t or "" for i, t in before}
            assert all(x[-1] == 2 for x in ids.values())
        seen[name] = len(after)
    from linfold.session import shared_dir
    folder = shared_dir(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, path)
    assert out.count() == seen["packing"]
    # of all that was stored only the result is left
    assert {x for x in set(os.listdir(folder)) - there} == {os.path.basename(out._staged_path)}


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    table(spark, awkward(80, 9)).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
