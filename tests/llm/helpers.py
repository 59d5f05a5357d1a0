"""Small tables with every awkward case, and plain versions of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def awkward(n=60, seed=1):
    """(doc_id, text): nulls, empty and long texts, copies, near copies, shared
    passages and lines, repeated rows, a repeated doc_id with another text."""
    rnd = random.Random(seed)
    vocab = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta,", "the", "of", "and", "日本", "#x", "12"]
    words = lambda k: [rnd.choice(vocab) + (str(rnd.randint(0, 40)) if rnd.random() < .6 else "") for _ in range(k)]
    passage, line = " ".join(words(30)), "A very common LINE here"
    rows = []
    for i in range(n):
        w = words(rnd.choice([0, 1, 3, 20, 60, 90]))
        if rnd.random() < .3:
            w[len(w) // 2:len(w) // 2] = [passage]
        sep = lambda: rnd.choice([" ", " ", " ", "\n", "  ", "\t"])
        text = "".join(x + sep() for x in w)
        if rnd.random() < .4:
            text += "\n " + line + "\t\n" + line.lower() + "\nshort"
        rows.append((i * 3, text))
    for k in range(12):  # near copies of one text, and exact ones
        w = words(80) if k == 0 else w
        v = list(w)
        if k % 3:
            v[rnd.randrange(80)] = f"new{k}"
        rows.append((1000 - k, " ".join(v)))
    rows += [(2001, None), (2002, ""), (2003, " \n\t "), (2004, "word " * 3000), (2005, "x" * 5000), (None, "a null id " * 20),
             (None, None), rows[3], rows[3], (rows[5][0], "another text under a known id"), (2006, rows[4][1])]
    rnd.shuffle(rows)
    return rows


CLASH = ("row", "owner", "th", "a", "x", "n", "key", "names", "uid", "digest", "label", "part", "fit", "d2", "starts", "kept", "lines", "base_failed")


def table(spark, rows, clash=True):
    """The rows as ``documents`` with other columns of clashing names."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'en', null) AS lang", "'src' AS source",
                       "cast(length(text) as bigint) AS n_chars")
    for c in CLASH if clash else ():
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    return df


def tuples(rows, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


def strings(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def order(doc_id):
    return LAST if doc_id is None else doc_id


def unorder(x):
    return None if x == LAST else x


def exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(order(i))
    return strings((i, unorder(min(groups[t])), len(groups[t]), order(i) == min(groups[t]), sha(t)) for (i, _), t in zip(rows, norm))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def components(rows, shingle=5, percent=75):
    sets = []
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = defaultdict(lambda: LAST + 1)
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least[root(k)], order(i))
    return strings((i, len(sets[k]), unorder(least[root(k)]) if sets[k] else i) for k, (i, _) in enumerate(rows))


def links(rows, shingle=5, percent=75):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    linked = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    return strings((i, len(sets[k]), sum(1 for j, s in enumerate(sets) if j != k and linked(sets[k], s))) for k, (i, _) in enumerate(rows))


def line_key(x):
    return lower(x.strip(" \t\n\v\f\r"))


def lines(rows, documents=None):
    first = defaultdict(set)
    for i, t in documents or rows:
        for x in (t or "").split("\n"):
            first[line_key(x)].add(order(i))
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(line_key(x)) < 10 or len(first[line_key(x)]) < 2 or order(i) == min(first[line_key(x)])]
        out.append((i, len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept))))
    return strings(out)


def substrings(rows, window=13):
    first, out = {}, []
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, LAST), order(i))
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return strings(out)


def byte_spans(rows, threshold):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[p:p + threshold] for p in range(len(b) - threshold + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - threshold + 1):
            if count[b[p:p + threshold]] > 1:
                gone[p:p + threshold] = [True] * threshold
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, sha(kept)))
    return strings(out)


def stats(t):
    w = WORD.findall(t or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    seen = set()
    for k, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            seen.update((k, k + 1, k + 2))
    ls = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), len(seen),
            len(w) < 50 or 100 * len(seen) > 50 * len(w))
