"""N-gram Jaccard self-join by T-occurrence search, and its components.

A document's set holds the digests of its distinct word shingles; documents
with equal sets are one class. Two classes link when 100 * intersection is at
least ``percent`` * union. What is asked for is each document's component, and
the number of its links.

1. Inverted lists. In one order of all shingles, sets that link share one of
   the first ``n - ceil(t * n) + 1`` of each: only these are put into lists.
   Shingles that many documents of a task hold (``HOT`` at most, a fixed
   bound) come last in that order, so that common passages are in few lists;
   any order gives the same links. A list that only one class is in is dropped
   when it is sorted, which leaves about a fifth; each task sends one row of
   the lists it settled itself.
2. T-occurrence on the lists: with ``c`` lists in common, the overlap is at most
   ``c`` plus what either set has behind its prefix, so a pair is a candidate
   only from ``c`` lists on. In lists of up to ``LONG`` classes the pairs are
   counted, a shared long list being assumed wherever both have one more. Long
   lists are not paired with themselves: each of their classes meets one class,
   the least of lists it is in, linked classes merge, and then only classes of different
   components that meet in long lists are counted. So the copies of one page,
   however many, cost a row each, and no link between components is lost. In
   lists of over ``WIDE`` classes these are not paired either: such a list is a
   block of step 3 by itself, and its classes outside its largest component the
   queries.
   Hot lists, those of the shingles that come last, hold one class only of all
   that have the same hot shingles: the one with the fewest rare ones. Whatever
   shares no rare shingle with a class of its list has only hot ones in common
   with it, so with h hot ones shared by all of a group, a class of it links the
   group's first if h >= t (h + both's rare ones), which takes no search. Those
   that don't may still link the first of another group, but only of one with
   fewer rare ones than their own first has; these pairs are candidates. A passage
   in many unlike documents is thus one class in its lists.
3. Search. Candidates are verified in blocks: the classes whose queries share
   their least neighbour, cut into pieces by the size of their sets, and with
   each piece the classes to query it with. A block holds inverted lists of whole sets. DivideSkip answers each
   query: the longest lists (fewer than the required overlap) are put aside,
   the short ones merged, and the classes with enough hits looked up in the
   long ones by binary search.
4. Components by least labels and pointer jumps over the links.
5. Links. Steps 2 and 3 stop at the links that connect; what they leave out
lies inside the components. To count all links, each component is cut into
pieces of about ``BLOCK`` shingles, every two pieces (and each with itself)
make a block, and DivideSkip answers every class of the one in the other. A
block sums the sizes of the linked classes, so it sends a row per class and no
pairs. A set goes into as many blocks as its component has pieces.

Defined results: a null or blank text has no shingles, links with nothing and
is its own component; fewer words than a shingle are one shingle. Rows that
repeat a doc_id are judged each by their text. A null doc_id comes after all
others. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.bytescan import Digests, lower, ragged, runs, segments, words
from linfold.llm.common import staged, unstage
from linfold.llm.substring_dedup import HELD, LAST, _flush_stretches, _shared_stretches

SHINGLE, PERCENT = 5, 75
HOT = 65_536  # shingles that may come last in the order
LOCAL = 3  # documents of a task that make a shingle a candidate for that
LONG = 64  # classes in a long list
WIDE = 512  # classes in one whose classes are not paired any more
BLOCK = 4_000_000  # shingles in a block, about
SMALL = 1_000_000  # rows of up to five numbers (64 MB) that texts and sets may be joined with by broadcast


def shingle_sets(data, offsets, shingle):
    """(sorted distinct digests, 64-bit id) of each row's set."""
    starts, ends, first = words(data, offsets)
    by_word = Digests(Digests(lower(data)).of(starts, ends))
    grams = by_word.sliding(shingle)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= shingle:
            s = np.unique(grams[lo:hi - shingle + 1])
        else:
            s = by_word.of(np.array([lo]), np.array([hi])) if hi > lo else grams[:0]
        yield s, _id(s)


def _id(digests: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(digests.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sizes(batches, shingle, hot):
    """Of each row the size and id of its set, how many of it are rare (not
    ``hot``) and the id of those that are hot."""
    for batch in batches:
        n, x, rare, hx = [], [], [], []
        for _, _, data, offsets in segments(batch):
            sets = list(shingle_sets(data, offsets, shingle))
            sizes = np.array([len(s) for s, _ in sets], np.int64)
            flat = np.concatenate([s for s, _ in sets])
            late = np.zeros(len(flat), bool)
            if len(hot):
                late = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
            ends = np.cumsum(sizes)
            n += sizes.tolist()
            x += [key for _, key in sets]
            for s, a, z in zip((s for s, _ in sets), (ends - sizes).tolist(), ends.tolist(), strict=True):
                common = s[late[a:z]]
                rare.append(len(s) - len(common))
                hx.append(_id(common))
        yield pa.RecordBatch.from_arrays([batch.column("owner"), *[pa.array(c, pa.int64()) for c in (n, x, rare, hx)]], ["owner", "n", "x", "rare", "hx"])


def _distinct_sets(batches, shingle, portion):
    """The sets of a task, those of copies once, in portions of so many shingles."""
    held, n, seen = [], 0, set()
    for batch in batches:
        for _, _, data, offsets in segments(batch):
            for s, key in shingle_sets(data, offsets, shingle):
                if len(s) and key not in seen:
                    seen.add(key)
                    held.append((s, key))
                    n += len(s)
            if n > portion:
                yield held
                held, n, seen = [], 0, set()
    if held:
        yield held


def _common(batches, shingle):
    for held in _distinct_sets(batches, shingle, 2 * HELD):
        a, many = np.unique(np.concatenate([s for s, _ in held]), return_counts=True)
        a, many = a[many >= LOCAL], many[many >= LOCAL]
        if len(a) > HOT:
            top = np.argpartition(many, len(a) - HOT)[len(a) - HOT:]
            a, many = a[top], many[top]
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(many, pa.int64())], ["a", "many"])


def _prefixes(batches, shingle, percent, hot):
    for held in _distinct_sets(batches, shingle, HELD // 2):
        sizes = np.array([len(s) for s, _ in held])
        flat, row = np.concatenate([s for s, _ in held]), np.repeat(np.arange(len(held)), sizes)
        late = np.isin(flat, hot)
        order = np.lexsort((late, row))  # stable: by digest within
        first = np.cumsum(sizes) - sizes
        pick = order[ragged(first, sizes - -(-percent * sizes // 100) + 1)]
        x = np.array([key for _, key in held], np.int64)
        yield from _flush_stretches([(flat[pick], x[row[pick]])])


def divide_skip(query: np.ndarray, lists, owners, sizes, percent: int) -> np.ndarray:
    """The ordinals of the sets that link with ``query``. ``lists``: (values,
    starts, ends) of inverted lists into ``owners``, each in ascending order."""
    values, start, end = lists
    at = np.searchsorted(values, query)
    at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == query)]
    length = end[at] - start[at]
    required = -(-percent * len(query) // 100)  # of any set that links
    at = at[np.argsort(-length, kind="stable")]
    length = end[at] - start[at]
    # long lists: those that cost more to merge than to probe, fewer than required
    n_long = min(required - 1, int((length > 16 * (1 + np.log2(1 + length))).sum()))
    short = at[n_long:]
    merged = owners[ragged(start[short], end[short] - start[short])]
    if len(merged) > len(sizes):  # a count per set costs less than sorting the hits
        hits = np.bincount(merged, minlength=len(sizes))
        found = np.flatnonzero(hits)
        hits = hits[found]
    else:
        found, hits = np.unique(merged, return_counts=True)
    keep = hits >= required - n_long
    found, hits = found[keep], hits[keep]
    for k, i in enumerate(at[:n_long].tolist()):
        keep = hits >= required - (n_long - k)
        found, hits = found[keep], hits[keep]
        one = owners[start[i]:end[i]]
        if 8 * len(found) > len(one):  # a mark per set costs less than the searches
            holds = np.zeros(len(sizes), bool)
            holds[one] = True
            hits = hits + holds[found]
        else:
            place = np.minimum(np.searchsorted(one, found), len(one) - 1)
            hits = hits + (one[place] == found)
    return found[100 * hits >= percent * (len(query) + sizes[found] - hits)]


def _inverted(sets):
    """The inverted lists of ``sets``, their owners, and the sizes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(runs(flat))
    return (flat[start], start, np.append(start[1:], len(flat))), owner, sizes


def _links(key, table: pa.Table, percent: int) -> pa.Table:
    """Links between a block's queries and its sets: of those found the ones
    that join two groups, so a block yields fewer links than it has sets. Sets
    that come with the same ``kin`` are of one group from the start."""
    once = np.unique(table.column("x").to_numpy(), return_index=True)[1]  # rows that repeat a document come alike
    table = table.take(pa.array(once))
    x, ask = table.column("x").to_numpy(), table.column("ask").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
    up, u, v = list(range(len(sets))), [], []
    if "kin" in table.column_names:
        first: dict[int, int] = {}
        up = [first.setdefault(kin, k) for k, kin in enumerate(table.column("kin").to_pylist())]
    groups = len(set(up))
    lists, owner, sizes = _inverted(sets)

    def root(k):
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k
    for q in np.flatnonzero(ask).tolist():
        if groups == 1:
            break
        for y in divide_skip(sets[q], lists, owner, sizes, percent).tolist():
            if (a := root(q)) != (b := root(y)):
                up[b] = a
                groups -= 1
                u.append(x[q])
                v.append(x[y])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _degrees(key, table: pa.Table, percent: int) -> pa.Table:
    """Of each class of two pieces, the documents that it links with in the other
    one; if they are the same piece, in it, copies of its own text left out."""
    once = np.unique(table.column("x").to_numpy(), return_index=True)[1]  # rows that repeat a document come alike
    table = table.take(pa.array(once))
    piece, many = table.column("piece").to_numpy(), table.column("many").to_numpy()
    lo, hi = key[1].as_py(), key[2].as_py()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
    n, left, right = np.zeros(len(sets), np.int64), np.flatnonzero(piece == lo), np.flatnonzero(piece == hi)
    if len(left) and len(right):
        lists, owner, sizes = _inverted([sets[k] for k in right.tolist()])
        for q in left.tolist():
            y = right[divide_skip(sets[q], lists, owner, sizes, percent)]
            if lo == hi:
                n[q] = many[y].sum() - many[q]  # a set links with itself
            else:
                n[q] = many[y].sum()
                n[y] += many[q]
    return pa.table({"x": table.column("x"), "n_links": pa.array(n, pa.int64())})


def _sets_of(batches, shingle):
    for batch in batches:
        x, rows, sets = batch.column("x").to_numpy(), [], []
        for a, _, data, offsets in segments(batch):
            for k, (s, key) in enumerate(shingle_sets(data, offsets, shingle)):
                if key == x[a + k]:  # a repeated doc_id may have another text
                    rows.append(a + k)
                    sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(x[rows], pa.int64()), pa.array(sets, pa.binary())], ["x", "set"])


def components(edges: DataFrame) -> DataFrame:
    """(x, label) of every vertex of ``edges`` (u, v): the least vertex reachable."""
    both = staged(edges.union(edges.select("v", "u")).distinct().toDF("u", "v"), "edges")
    label = staged(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("x"), F.least("u", "v").alias("label")), "label")
    while True:
        near = (both.join(label, both.v == label.x).groupBy("u").agg(F.min("label").alias("near")))
        new = label.join(near, label.x == near.u).select("x", F.least("label", "near").alias("label"))
        jump = new.select(F.col("x").alias("j"), F.col("label").alias("far"))
        new = staged(new.join(jump, new.label == jump.j).select("x", F.least("label", "far").alias("label")), "label")
        changed = not new.join(label, ["x", "label"], "left_anti").isEmpty()
        unstage(label)
        label = new
        if not changed:
            return label


def _narrow(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` of a few numbers, broadcast to the texts or sets that they
    meet if they are ``SMALL`` at most; beyond that both sides are shuffled."""
    return F.broadcast(rows) if rows.count() <= SMALL else rows


def _sets(wanted: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(x, set) of the classes in ``wanted`` (x), from one text of each."""
    ids = staged(wanted.join(classes.select("x", "owner"), "x"), "wanted")
    return staged(texts.join(_narrow(ids), "owner").select("x", "text")
                  .mapInArrow(lambda it: _sets_of(it, shingle), "x long, set binary"), "members")


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among candidate ``pairs`` (u, v), u the query."""
    # a pair's block goes by the least neighbour of its query, which those of one group mostly share
    label = (pairs.union(pairs.select("v", "u")).toDF("x", "y").groupBy("x").agg(F.min("y").alias("least"))
             .select("x", F.least("x", "least").alias("label")))
    located = pairs.join(label, pairs.u == label.x).select("u", "v", "label")
    load = (located.select("label", F.col("v").alias("x")).distinct().join(classes, "x")
            .groupBy("label").agg(F.ceil(F.sum("n") / BLOCK).alias("pieces")))
    block = F.struct(F.col("label"), F.pmod(F.xxhash64("v"), F.col("pieces")).alias("piece"))
    located = staged(located.join(load, "label").select("u", "v", block.alias("block")), "blocks")
    members = (located.select(F.col("v").alias("x"), "block", F.lit(False).alias("ask"))
               .union(located.select("u", "block", F.lit(True)))
               .groupBy("x", "block").agg(F.max("ask").alias("ask")))
    rows = sets.join(_narrow(staged(members, "asked")), "x").select("x", "block.*", "ask", "set")
    return rows.groupBy("label", "piece").applyInArrow(lambda key, t: _links(key, t, percent), "u long, v long")


def _wide_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join labels within each list of ``rows`` (a, x, n, label): the
    list's classes are one block, or every two pieces of them, and those outside
    the list's most frequent label are its queries. No pairs are formed. Lists
    that classes connect are one list together where that is less work."""
    least = rows.groupBy("x").agg(F.min("a").alias("v"))
    lists = components(rows.join(least, "x").select(F.col("a").alias("u"), "v").distinct()).select(F.col("x").alias("a"), F.col("label").alias("cluster"))
    rows = staged(rows.join(lists, "a"), "wide")
    apart = rows.groupBy("cluster", "a").agg(F.count(F.lit(1)).alias("m")).groupBy("cluster").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    whole = rows.select("cluster", "x").distinct().groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    rows = (rows.join(apart, "cluster").join(whole, "cluster")
            .select(F.when(F.col("m") * F.col("m") <= F.col("apart"), F.col("cluster")).otherwise(F.col("a")).alias("a"), "x", "n", "label").distinct())
    rows = staged(rows, "wide")
    labels = rows.groupBy("a", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    lists = (labels.groupBy("a").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("m", "label")).alias("most"), F.ceil(F.sum("n") / BLOCK).alias("pieces"))
             .where("labels > 1").select(F.col("a").alias("list"), F.col("most.label").alias("most"), "pieces"))
    piece = F.pmod(F.xxhash64("x"), F.col("pieces"))
    blocks = (rows.join(lists, F.col("a") == F.col("list")).select("list", "x", "label", (F.col("label") != F.col("most")).alias("ask"), piece.alias("piece"),
                                                               F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other"))
              .select("list", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "x", F.col("label").alias("kin"), "ask"))
    return (sets.join(blocks, "x").select("list", "lo", "hi", "x", "kin", "ask", "set").groupBy("list", "lo", "hi")
            .applyInArrow(lambda key, t: _links(key, t, percent), "u long, v long"))


def _all_degrees(label: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, n_links): of each class in ``label`` (x, label) the documents of other
    classes that it links with. Links lie within components, so all are found."""
    members = classes.select("x", "n", "many").join(label, "x")
    load = members.groupBy("label").agg(F.ceil(F.sum("n") / BLOCK).alias("pieces"))
    piece = F.pmod(F.xxhash64("x"), F.col("pieces"))
    blocks = (members.join(load, "label").select("x", "many", "label", piece.alias("piece"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other"))
              .select("x", "many", "label", "piece", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi")))
    return (sets.join(blocks, "x").select("label", "lo", "hi", "x", "many", "piece", "set").groupBy("label", "lo", "hi")
            .applyInArrow(lambda key, t: _degrees(key, t, percent), "x long, n_links long")
            .groupBy("x").agg(F.sum("n_links").alias("n_links")))


def _candidates(shared: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the counted pairs (u, nu, v, nv, c) that can reach the overlap."""
    behind = lambda n: F.ceil(F.col(n) * percent / 100) - 1
    need = F.ceil(percent * (F.col("nu") + F.col("nv")) / (100 + percent))
    return shared.where(F.col("c") + F.greatest(behind("nu"), behind("nv")) >= need).select("u", "v", "c")


def one_per_component(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns as they came, whose doc_id names their
    component: the smallest of each. Rows that share a doc_id stay if one does.
    The doc_ids that go, far fewer than those that stay, are stored first, so
    that Spark knows their size and moves the texts only if it must."""
    gone = staged(jaccard_components(docs.select("doc_id", "text"), shingle, percent, links=False)
                  .groupBy(F.col("doc_id").alias("gone_id"))
                  .agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays"))
                  .where("not stays").select("gone_id"), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("gone_id")), "left_anti").select("row.*")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row. ``component_id``
    is the smallest doc_id reachable by links; ``n_links``, left out without
    ``links``, counts all other rows that the row links with."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("owner"), F.coalesce("text", F.lit("")).alias("text"))
    top = texts.select("text").mapInArrow(lambda it: _common(it, shingle), "a long, many long")
    top = staged(top.groupBy("a").agg(F.sum("many").alias("many")).orderBy(F.desc("many"), "a").limit(HOT).select("a"), "hot")
    hot = np.sort(np.array([r["a"] for r in top.collect()], np.int64).view(np.uint64))  # at most HOT numbers
    base = staged(texts.mapInArrow(lambda it: _sizes(it, shingle, hot), "owner long, n long, x long, rare long, hx long"), "sets")
    classes = staged(base.where("n > 0").groupBy("x", "n", "rare", "hx").agg(F.min("owner").alias("owner"), F.count(F.lit(1)).alias("many")), "classes")
    rows = texts.select("text").mapInArrow(lambda it: _prefixes(it, shingle, percent, hot), "route long, th long, b long")
    lists = (rows.repartition("route").sortWithinPartitions("route").mapInArrow(_shared_stretches, "th long, a long")
             .select("a", F.col("th").alias("x")).distinct().join(classes.select("x", "n", "rare", "hx"), "x"))
    lists = staged(lists.join(F.broadcast(top.withColumn("hot", F.lit(True))), "a", "left").withColumn("hot", F.coalesce("hot", F.lit(False))), "lists")
    fits = lambda a, b: (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))
    one = lambda rows, side, *columns: rows.select("a", *[F.col(c).alias(f"{c}{side}") for c in columns])

    # hot lists keep one class of each set of hot shingles, that with the fewest rare ones
    group = lists.where("hot").groupBy("hx").agg(F.min(F.struct("rare", "x")).alias("first"))
    group = group.select("hx", F.col("first.rare").alias("least_rare"), F.col("first.x").alias("first"))
    inside = staged(lists.where("hot").join(group, "hx"), "hot-lists")
    firsts, others = inside.where("x = first"), inside.where("x <> first")
    common = F.col("n") - F.col("rare")
    near_first = 100 * common >= percent * (F.col("n") + F.col("least_rare"))
    own = others.where(near_first).select(F.col("first").alias("u"), F.col("x").alias("v")).distinct()
    left, right = one(others.where(~near_first), "u", "x", "n", "rare", "least_rare"), one(firsts, "v", "x", "n", "rare")
    hu, hv = F.col("nu") - F.col("rareu"), F.col("nv") - F.col("rarev")
    reach = 100 * F.least(hu, hv) >= percent * (F.greatest(hu, hv) + F.col("rareu") + F.col("rarev"))
    far = (left.join(right, (left.a == right.a) & (F.col("rarev") < F.col("least_rareu")) & reach)
           .select(F.col("xv").alias("u"), F.col("xu").alias("v")).distinct())
    # what a class has in hot lists is hidden from pairs that are not both first ones
    hidden = inside.groupBy("x").agg(F.count(F.lit(1)).alias("in_hot"), F.max(F.expr("x = first")).alias("is_first"))
    seen = lists.where("not hot").select("a", "x", "n").union(firsts.select("a", "x", "n"))
    seen = (seen.join(hidden, "x", "left").select("a", "x", "n", F.coalesce("in_hot", F.lit(0)).alias("in_hot"), F.coalesce("is_first", F.lit(False)).alias("is_first")))
    seen = staged(seen, "seen")
    spare = F.when(F.col("is_firstu") & F.col("is_firstv"), 0).otherwise(F.least("in_hotu", "in_hotv"))

    def counted(rows):
        """Candidates among the classes of a list that have different labels."""
        cols = ("x", "n", "label", "in_hot", "is_first")
        left, right = one(rows, "u", *cols), one(rows, "v", *cols)
        shared = (left.join(right, (left.a == right.a) & (F.col("xu") < F.col("xv")) & (F.col("labelu") != F.col("labelv")) & fits("nu", "nv"))
                  .groupBy(F.col("xu").alias("u"), "nu", F.col("xv").alias("v"), "nv").agg((F.count(F.lit(1)) + F.max(spare)).alias("c")))
        return staged(_candidates(shared, percent).select("u", "v"), "pairs")

    # each class of a long list with the least of a list: of several the one it shares most lists with
    long = staged(seen.groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("x", "n")).alias("least")).where(F.col("m") > LONG), "long")
    star = (seen.join(long, "a").select(F.col("least.x").alias("u"), F.col("least.n").alias("nu"), F.col("x").alias("v"), F.col("n").alias("nv"))
            .where((F.col("u") != F.col("v")) & fits("nu", "nv")).groupBy("u", "nu", "v", "nv").agg(F.count(F.lit(1)).alias("c")))
    # and all pairs of short ones, which long lists add at most their number to
    few = seen.join(long.select("a"), "a", "left_anti")
    more = seen.join(long.select("a"), "a", "left_semi").groupBy("x").agg(F.count(F.lit(1)).alias("more"))
    few = few.join(more, "x", "left").withColumn("more", F.coalesce("more", F.lit(0)))
    cols = ("x", "n", "more", "in_hot", "is_first")
    left, right = one(few, "u", *cols), one(few, "v", *cols)
    near = (left.join(right, (left.a == right.a) & (F.col("xu") < F.col("xv")) & fits("nu", "nv"))
            .groupBy(F.col("xu").alias("u"), "nu", F.col("xv").alias("v"), "nv")
            .agg((F.count(F.lit(1)) + F.least(F.max("moreu"), F.max("morev")) + F.max(spare)).alias("c")))
    star = _candidates(star, percent).groupBy("v").agg(F.max(F.struct("c", "u")).alias("best")).select("best.u", "v")
    first = staged(star.union(_candidates(near, percent).select("u", "v")).union(far).distinct(), "pairs")
    ids = lambda pairs: pairs.select(F.col("u").alias("x")).union(pairs.select("v")).distinct()
    wanted = ids(first.union(own)) if links else ids(first)
    sets = _sets(wanted, classes, texts, shingle)
    joining = staged(_verified(first, classes, sets, percent).union(own), "links")
    # what may still link different components meets in a long list
    merged = seen.withColumn("label", F.col("x"))
    if not joining.isEmpty():
        merged = seen.join(components(joining), "x", "left").withColumn("label", F.coalesce("label", "x"))
    wide = long.where(F.col("m") > WIDE).select("a")
    pairs = counted(merged.join(long.where(F.col("m") <= WIDE).select("a"), "a", "left_semi"))
    wide_rows = staged(merged.join(wide, "a", "left_semi").select("a", "x", "n", "label"), "wide")
    missing = ids(pairs).union(wide_rows.select("x")).distinct().join(sets.select("x"), "x", "left_anti")
    some_pairs, some_wide = not pairs.isEmpty(), not wide_rows.isEmpty()
    if some_pairs or some_wide:
        sets = sets.union(_sets(missing, classes, texts, shingle))
        joining = joining.union(_verified(pairs, classes, sets, percent)) if some_pairs else joining
        joining = joining.union(_wide_links(wide_rows, sets, percent)) if some_wide else joining
        joining = staged(joining.distinct(), "links")
    label = classes.select("x", F.col("x").alias("label")).limit(0) if joining.isEmpty() else components(joining)
    named = classes.select("x", "owner", "many").join(label, "x", "left").withColumn("label", F.coalesce("label", "x"))
    least = named.groupBy("label").agg(F.min("owner").alias("least"))
    named = named.join(least, "label").select("x", "least", "many")
    if links:
        # copies of a text link with each other, and a class's links are those of each of its rows
        named = (named.join(_all_degrees(label, classes, sets, percent), "x", "left")
                 .withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("many") - 1))
    kind = docs.schema["doc_id"].dataType
    ident = lambda c: F.when(c != LAST, c).cast(kind)
    return base.join(named, "x", "left").select(
        ident(F.col("owner")).alias("doc_id"), F.col("n").alias("n_shingles"),
        ident(F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("owner"))).alias("component_id"),
        *[F.coalesce("n_links", F.lit(0)).alias("n_links")] * links)
