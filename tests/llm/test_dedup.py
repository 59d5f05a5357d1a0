"""Exact, near, line, substring and byte dedup against plain versions."""

import random

import numpy as np
import pytest

from helpers import awkward, byte_spans, components, exact, lines, links, sha, strings, substrings, table, tuples
from linfold.llm.bytescan import Digests
from linfold.llm.exact_dedup import exact_dedup
from linfold.llm.jaccard_join import divide_skip, jaccard_components, one_per_component
from linfold.llm.line_dedup import Cuckoo, LineIndex, dedup_lines, line_rows, without_repeated_lines
from linfold.llm.substring_dedup import dedup_substrings, without_repeated_substrings
from linfold.llm.suffix_array import dedup_bytes

ROWS = awkward()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, ROWS).limit(0)


@pytest.mark.parametrize("block, bits", [(4096, 64), (16, 64), (16, 5)])
def test_exact(docs, block, bits):
    """Also with digests of five bits, which most blocks share."""
    got = exact_dedup(docs, block, bits).collect()
    assert tuples(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact(ROWS)


def test_components(docs):
    assert tuples(jaccard_components(docs).collect(), "doc_id", "n_shingles", "component_id") == components(ROWS)


def test_components_with_long_lists_and_small_blocks(docs, monkeypatch):
    import linfold.llm.jaccard_join as J
    monkeypatch.setattr(J, "LONG", 2)
    monkeypatch.setattr(J, "BLOCK", 100)
    monkeypatch.setattr(J, "HOT", 0)
    assert tuples(jaccard_components(docs).collect(), "doc_id", "n_shingles", "component_id") == components(ROWS)


@pytest.mark.parametrize("block", [4_000_000, 100])
def test_links_are_all_counted(spark, docs, block, monkeypatch):
    """Also where the linked texts fill many pieces."""
    import linfold.llm.jaccard_join as J
    monkeypatch.setattr(J, "BLOCK", block)
    got = jaccard_components(docs).collect()
    assert tuples(got, "doc_id", "n_shingles", "n_links") == links(ROWS)
    w = [f"w{k}" for k in range(80)]
    three = [(k, " ".join([*w[:40], *w[41:], *[f"end{k}"] * (k > 0)])) for k in range(3)]
    assert [r.n_links for r in jaccard_components(table(spark, three)).collect()] == [2, 2, 2]


def test_one_per_component_keeps_columns(docs):
    kept = one_per_component(docs)
    stay = {a for a, _, c in components(ROWS) if a == c}
    assert kept.columns == docs.columns and {str(r.doc_id) for r in kept.collect()} == stay


def test_divide_skip_equals_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 300, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) < .9], rng.integers(0, 300, 6)])).astype(np.uint64) for _ in range(400)]
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(400), sizes)
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    for q in range(0, 400, 20):
        got = divide_skip(sets[q], (flat[start], start, np.append(start[1:], len(flat))), owner, sizes, 75)
        overlap = np.array([len(np.intersect1d(sets[q], s)) for s in sets])
        assert got.tolist() == np.flatnonzero(100 * overlap >= 75 * (sizes[q] + sizes - overlap)).tolist()


def test_lines(docs):
    assert tuples(dedup_lines(docs).collect(), "doc_id", "n_lines", "n_dropped", "kept_sha256") == lines(ROWS)


def test_lines_come_back_when_documents_go(spark, docs):
    """Inserting in two parts equals inserting at once; deleting undoes it."""
    rows = [r for r in ROWS if r[0] is not None]
    half = table(spark, rows[::2], clash=False), table(spark, rows[1::2], clash=False)
    index = LineIndex(spark).insert(half[0]).insert(half[1])
    both = table(spark, rows, clash=False)

    def cleaned(frame):
        return strings((r.row.doc_id, len(r.lines), len(r.dropped), sha("\n".join(x for k, x in enumerate(r.lines) if k not in r.dropped)))
                       for r in index.clean(frame).collect())
    assert cleaned(both) == lines(rows)
    gone = {r[0] for r in rows[1::2]}
    index.delete(half[1].select("doc_id"))
    left = [r for r in rows if r[0] not in gone]
    assert cleaned(table(spark, left, clash=False)) == lines(left)
    index.remove()


def test_lines_with_one_key_per_shard(docs, monkeypatch):
    import linfold.llm.line_dedup as L
    monkeypatch.setattr(L, "SHARD_KEYS", 4)
    assert tuples(dedup_lines(docs).collect(), "doc_id", "n_lines", "n_dropped", "kept_sha256") == lines(ROWS)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_line_index_grows_and_opens_again(spark, tmp_path, monkeypatch, kind):
    """Opened again, grown tenfold, documents deleted and inserted again, segments joined: always as brute force."""
    import random

    import linfold.llm.line_dedup as L
    monkeypatch.setattr(L, "SHARD_KEYS", 60)
    rnd = random.Random(5)
    rows = [(1000 + i, "\n".join(f"line number {rnd.randrange(20 * (i // 30 + 1) ** 2)} of text" for _ in range(rnd.randrange(12)))) for i in range(300)]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    path = str(tmp_path / "index")

    def agrees(part):
        index = LineIndex(spark, path)
        got = strings((r.row.doc_id, len(r.lines), len(r.dropped), sha("\n".join(x for k, x in enumerate(r.lines) if k not in r.dropped)))
                      for r in index.clean(frame(part)).collect())
        assert got == lines(part)
        digests = line_rows(frame(part)).select("digest").distinct()
        assert index.state["digests"] == digests.count()
        assert max(r["count"] for r in digests.groupBy(index._shard()).count().collect()) <= 2 * L.SHARD_KEYS
        return index
    assert [r.dropped for r in LineIndex(spark, path).delete(frame(rows[:3])).clean(frame(rows[:3])).collect()] == [[]] * 3
    LineIndex(spark, path).insert(frame(rows[:30]))
    small = agrees(rows[:30]).state["shards"]
    index = agrees(rows[:30]).insert(frame(rows[20:60]))  # some are known already
    agrees(rows[:60])
    index.insert(frame(rows[60:]))
    assert agrees(rows).state["shards"] > small
    index.delete(frame(rows[:200:2]))
    agrees(rows[1:200:2] + rows[200:])
    index.insert(frame(rows[:100:2]))
    left = rows[:100] + rows[101:200:2] + rows[200:]
    agrees(left)
    index.compact()
    assert len(agrees(left).state["segments"]) == 1
    with pytest.raises(ValueError):
        LineIndex(spark, path, min_chars=5)
    index.remove()
    assert list((tmp_path / "index").iterdir()) == []


def test_crowded_filters_grow(spark, monkeypatch):
    index = LineIndex(spark)
    frame = lambda n: spark.range(2 * n).selectExpr("id as doc_id", f"concat('a line of number ', id % {n}) as text")
    index.insert(frame(10))
    room = index._filters().first().buckets
    index.insert(frame(400))
    assert index._filters().where("crowded").count() == 0 and index._filters().first().buckets > room
    assert index.duplicates(line_rows(frame(400))).count() == 400
    index.remove()


def test_cuckoo_holds_all_and_forgets():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (3000, 2)).astype(np.uint64)
    for buckets in (1024, 256):  # enough room; far too little, so that the overflow list works
        f = Cuckoo(buckets)
        f.add(keys)
        assert f.holds(keys).all() and (f.rest != set()) == (buckets == 256)
        f = Cuckoo(buckets, f.table.tobytes(), b"".join(f.rest))
        f.remove(keys[:2000])
        assert f.holds(keys[2000:]).all()
        assert f.holds(keys[:2000]).mean() < .05


def test_line_texts_keep_columns(docs):
    got = without_repeated_lines(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(sha(r.text or "") for r in rows) == sorted(x[3] for x in lines(ROWS))
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("group", [10_000, 1])
def test_substrings(docs, group, monkeypatch):
    """Also where every stretch counts as too large for a group."""
    import linfold.llm.substring_dedup as S
    monkeypatch.setattr(S.word_repeats, "__defaults__", (S.WINDOW, S.GRAM, group))
    assert tuples(dedup_substrings(docs).collect(), "doc_id", "n_words", "n_removed", "kept_sha256") == substrings(ROWS)


def test_substrings_shuffle_texts_once(spark, docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/docs")
    out = dedup_substrings(spark.read.parquet(f"{tmp_path}/docs"))
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_substring_texts_keep_columns(docs):
    got = without_repeated_substrings(docs)
    assert got.columns == docs.columns
    assert sorted(sha(" ".join((r.text or "").split())) for r in got.collect()) == sorted(
        sha(" ".join(x.split())) for x in _kept_texts())


def _kept_texts():
    from helpers import LAST, WORD, order
    first, out = {}, []
    for i, t in ROWS:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            first[g] = min(first.get(g, LAST), order(i))
    for i, t in ROWS:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < order(i):
                gone.update(range(k, k + 13))
        out.append(" ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("threshold", [40, 13])
def test_bytes(docs, threshold):
    got = dedup_bytes(docs, threshold).collect()
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_spans(ROWS, threshold)


def test_bytes_at_half_depth(docs):
    got = dedup_bytes(docs, 40, depth=20, with_bytes=True).collect()
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_spans(ROWS, 40)
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in got)


def test_bytes_at_the_contract_threshold(spark):
    """400 bytes repeat or they stay: shared passages just below and at it, one of
    59 words in 394 bytes, two-byte letters, periodic texts."""
    rnd = random.Random(7)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    words = " ".join("abcdefg"[:5 + (k % 10 < 7)] for k in range(59))[:394]
    assert len(words.split()) == 59
    passages = [words, noise(399), noise(400), noise(401), "ñ" * 100 + noise(200), noise(900)]
    rows = []
    for k, x in enumerate(passages):  # closed by different bytes
        rows += [(2 * k, noise(30) + "A" + x + "B" + noise(50)), (2 * k + 1, noise(70) + "C" + x + "D")]
    rows += [(20, "xyz" * 200), (21, "E" + "xyz" * 133 + "F"), (22, noise(400)), (23, "pq" * 200), (24, "pq" * 200 + "p"), (25, None)]
    got = dedup_bytes(table(spark, rows)).collect()
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_spans(rows, 400)
    removed = {r.doc_id: r.n_removed for r in got}
    assert [removed[2 * k] for k in range(6)] == [removed[2 * k + 1] for k in range(6)] == [0, 0, 400, 401, 400, 900]


@pytest.mark.parametrize("less", [True, False])
def test_bytes_of_a_class_that_another_task_holds_alone(spark, less):
    """One task holds a text and a variant of it, another one the text alone,
    with the text's digest below and above the variant's."""
    rows = []
    for k in range(6):
        x = sha(f"text {k}")[:40]
        digest = lambda t: Digests(np.frombuffer(t.encode(), np.uint8)).of(np.array([0]), np.array([40]))[0]
        y = next(x[:-1] + c for c in map(chr, range(33, 127)) if (digest(x) < digest(x[:-1] + c)) == less)
        rows.append([(k, x), (10 + k, y), (20 + k, x)])
    parts = [[r for three in rows for r in three[:2]], [three[2] for three in rows]]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(parts, 2).flatMap(list), "doc_id long, text string")
    assert docs.rdd.getNumPartitions() == 2
    got = dedup_bytes(docs, 40).collect()
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_spans(parts[0] + parts[1], 40)


@pytest.mark.parametrize("run", [exact_dedup, jaccard_components, one_per_component, dedup_lines, without_repeated_lines,
                                 dedup_substrings, without_repeated_substrings, dedup_bytes])
def test_empty_table(nothing, run):
    assert run(nothing).collect() == []


def hot_rows(seed):
    """Passages alone, cut short, with changed words and with tails of many
    lengths: texts of equal and of similar hot shingles, linked and not."""
    rnd = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(40)] for k in range(3)]
    rows = []
    for i in range(110):
        w = list(rnd.choice(passages))
        if rnd.random() < .4:
            w = w[rnd.randint(0, 3):len(w) - rnd.randint(0, 6)]
        for _ in range(rnd.choice([0, 0, 0, 1, 2])):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 4)}"
        w += [f"t{i if rnd.random() < .8 else rnd.randint(0, 3)}n{k}" for k in range(rnd.choice([0, 2, 5, 6, 8, 9, 11, 13, 30]))]
        if rnd.random() < .1:
            w += rnd.choice(passages)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,long,wide,block,small", [(1, 64, 512, 4_000_000, 1_000_000), (3, 2, 6, 4_000_000, 0), (4, 3, 5, 300, 1_000_000)])
def test_hot_and_wide_lists(spark, monkeypatch, seed, long, wide, block, small):
    """Also where too many classes are searched to broadcast their ids."""
    from linfold.llm import jaccard_join
    for name, value in (("LONG", long), ("WIDE", wide), ("BLOCK", block), ("SMALL", small)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = hot_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert strings(jaccard_join.jaccard_components(docs, links=False).collect()) == components(rows)
    got = jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "n_links")
    assert strings(got.collect()) == links(rows)
