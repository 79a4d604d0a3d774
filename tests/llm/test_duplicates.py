"""Operators 4, 7 and 9: embeddings, n-gram join, lines."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from cases import Groups, awkward, empty, low_words, prose, shingles
from conftest import SMALL
from shoplens.llm import line_dedup, rp_forest, trie_join


def brute_links(points, ids, threshold=0.9):
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    groups = Groups()
    for i, j in zip(*np.nonzero(near)):
        groups.join(ids[i], ids[j])
    return near.sum(1), [groups.find(i) for i in ids], near


def test_forest_against_brute_force(spark):
    """Clusters, one of them a third of all rows, and a crowd of single vectors."""
    rng = np.random.default_rng(2)
    parts = [rng.standard_normal((1500, 24))]
    for size in (900, 60, 7, 2):
        parts.append(rng.standard_normal(24) + 0.1 * rng.standard_normal((size, 24)))
    points = np.vstack(parts).astype(np.float32)
    order = rng.permutation(len(points))
    rows = [(int(i), points[i].tolist(), 0) for i in order] + [(9000 + i, points[-1].tolist(), 1) for i in range(50)]
    ids = [r[0] for r in rows]
    n, root, _ = brute_links(np.array([r[1] for r in rows]), ids)
    got = {r.vec_id: r for r in rp_forest.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    found = np.array([got[i].n_links for i in ids])
    assert (found <= n).all() and found.sum() >= 0.9 * n.sum()
    assert np.mean([got[i].component_id == r for i, r in zip(ids, root)]) >= 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)


def test_links_of_crowds_are_complete(spark, monkeypatch):
    """Two crowds whose members are about as far apart as the threshold, next to
    each other and to single vectors, with copies, in several blocks."""
    monkeypatch.setattr(rp_forest, "BLOCK", 700)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    other = centre + 0.6 * rng.standard_normal(64)
    points = np.vstack([rng.standard_normal((2500, 64)), centre + 0.33 * rng.standard_normal((2500, 64)),
                        other + 0.3 * rng.standard_normal((800, 64)), centre + 0.5 * rng.standard_normal((300, 64))])
    points = np.vstack([points, points[2500:2540], points[5790:5810]]).astype(np.float32)
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    n, root, _ = brute_links(points.astype(float), list(range(len(points))))
    got = {r.vec_id: r for r in rp_forest.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    found = np.array([got[i].n_links for i in range(len(points))])
    assert (found == n).mean() >= 0.99 and (found[2500:5000] == n[2500:5000]).all()
    assert [got[i].component_id for i in range(len(points))] == root


def test_all_links_within_a_leaf_are_found(spark, monkeypatch):
    """One leaf of 2,500 and one of 4,500 vectors about as far apart as the threshold, as one block and as several."""
    rng = np.random.default_rng(8)
    for n, block in ((2500, 4096), (4500, 1000)):
        monkeypatch.setattr(rp_forest, "BLOCK", block)
        points = (rng.standard_normal(64) + 0.33 * rng.standard_normal((n, 64))).astype(np.float32)
        unit = rp_forest.unit(points)
        a, b = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
        classes = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "cid long, embedding array<float>")
        got = rp_forest.forest_links(classes, {}, 0.9).toArrow()   # no tree: one leaf
        found = set(zip(got.column("a").to_pylist(), got.column("b").to_pylist()))
        assert len(a) > n and found == set(zip(a.tolist(), b.tolist()))


def test_forest_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [1e300, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS cid", "'x' AS weight", "1 AS label")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in rp_forest.near_duplicates(df).collect()), key=str)
    want = [(1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
            (7, 0, 7, True), (8, 0, 8, True), (9, 4, 1, False), (10, 0, 10, True), (11, 4, 1, False), (11, 4, 1, False),
            (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert rp_forest.near_duplicates(df.limit(0)).count() == 0


def test_trie_links_are_exact():
    rng = np.random.default_rng(4)
    order = trie_join.Order(rng.integers(1, 400, 30).astype(np.uint64))
    for _ in range(60):
        base = rng.choice(400, rng.integers(1, 200), replace=False)
        sets = []
        for _ in range(12):
            keep = base[rng.random(len(base)) < rng.choice([0.3, 0.85, 0.97, 1.0])]
            more = rng.choice(400, rng.integers(0, 1 + len(base) // 6), replace=False)
            s = np.unique(np.concatenate([keep, more, base[:1]])).astype(np.uint64)
            sets.append(order(s))
        probe, rest = sets[0], sets[1:]
        want = [i for i, s in enumerate(rest)
                if 100 * len(set(probe) & set(s)) >= 75 * len(set(probe) | set(s))]
        assert sorted(trie_join.trie_links(probe, rest)) == want


def test_no_link_needs_fewer_shared_shingles(spark):
    """Sets at the threshold, with all that is not shared first in the order, share as
    many prefix shingles as ``least_shared`` says, or more."""
    got = {r.n: r.least for r in spark.range(1, 400).select(
        F.col("id").alias("n"), trie_join.least_shared(F.col("id")).alias("least")).collect()}
    for n in got:
        for m in range(-(-3 * n // 4), 4 * n // 3 + 1):
            both = next(k for k in range(min(n, m) + 1) if 100 * k >= 75 * (n + m - k))
            # own shingles first, then the common ones, which stand in the same order in both
            shared = min(trie_join.prefix_length(n) - (n - both), trie_join.prefix_length(m) - (m - both))
            assert max(got[n], got.get(m, 0)) <= shared, (n, m)


def test_least_between_holds_for_every_partner(spark):
    spans = [(n, low, high) for n in range(1, 130) for low in range(-(-3 * n // 4), 4 * n // 3 + 1)
             for high in range(low, 4 * n // 3 + 1, 1 + n // 12)]
    sizes = [(n, m) for n in range(1, 130) for m in range(-(-3 * n // 4), 4 * n // 3 + 1)]
    shared = {(r.n, r.m): r.s for r in spark.createDataFrame(sizes, "n long, m long").select(
        "n", "m", trie_join.shared_with(F.col("n"), F.col("m")).alias("s")).collect()}
    for (n, m), s in shared.items():
        both = next(k for k in range(min(n, m) + 1) if 100 * k >= 75 * (n + m - k))
        assert s <= min(trie_join.prefix_length(n) - (n - both), trie_join.prefix_length(m) - (m - both)), (n, m)
    for r in spark.createDataFrame(spans, "n long, low long, high long").withColumn(
            "least", trie_join.least_between(F.col("n"), F.col("low"), F.col("high"))).collect():
        assert r.least <= max(1, min(shared[r.n, m] for m in range(r.low, r.high + 1))), r


def placed_postings(spark, texts):
    """Prefix postings of the texts, each class a component of its own, and the shingles by class."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = trie_join.class_table(docs, trie_join.Order(trie_join.frequent_shingles(docs))).cache()
    sets = {r.cid: shingles(texts[r.doc_id]) for r in classes.select("doc_id", "cid").collect()}
    return trie_join.postings(classes).withColumn("component", F.col("cid")), sets


def test_open_pairs_hold_every_link(spark):
    """Groups of copies about the threshold, cut and lengthened, so that sizes differ; some rows twice."""
    texts = []
    for k, length in enumerate((12, 40, 90, 200)):
        base = prose(70 + k, length)
        copies = [t for edits in (1, length // 50, length // 30 + 1) for t in variations(edits, base, 12, edits)]
        texts += copies + [" ".join(t.split()[:-length // 7]) for t in copies[:9]] \
            + [t + " " + prose(400 + i, length // 6) for i, t in enumerate(copies[:9])]
    placed, sets = placed_postings(spark, texts + texts[:5])
    found = {(r.a, r.b) for r in trie_join.open_pairs(placed).collect()}
    links = {(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(links) > 100 and links <= found


def test_unlinked_copies_of_one_text_do_not_pair(spark):
    """Copies that differ from a common text by too much to link with it or one another share
    most of its shingles; none of these may bring all of them together."""
    placed, sets = placed_postings(spark, variations(7, prose(75, 150), 200, 6))
    pairs = "sum(n * (n - 1) / 2)"
    count = lambda rows: rows.groupBy("token").agg(F.count("*").alias("n")).selectExpr(pairs).first()[0]
    assert count(placed) > 200 * 199     # more than one shingle for each pair
    assert count(trie_join.key_postings(placed)) < 5 * len(sets)


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    by, groups, seen = defaultdict(list), Groups(), set()
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for held in by.values():
        for k, a in enumerate(held):
            for b in held[:k]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    groups.join(a, b)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def variations(seed, base, n, edits):
    r, out = random.Random(seed), []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_join_against_brute_force(spark):
    """Given documents, a large group of near copies at the edge of the threshold,
    a passage that many documents share, and chains of copies of copies."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    texts = variations(1, prose(50, 120), 60, 3) + [prose(51, 60) + " " + prose(200 + i, 70) for i in range(60)]
    chain = prose(52, 200)
    for k in range(20):
        chain = variations(900 + k, chain, 1, 3)[0]
        texts.append(chain)
    texts += ["same words here again now"] * 30 + ["Short one", "short ONE", "short two", "a b c d e", "a b c d e f"]
    rows += [(100_000 + i, t) for i, t in enumerate(texts)]
    random.Random(3).shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in trie_join.join_documents(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute_groups(rows)


def test_frequent_list_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(trie_join, "FREQUENT", 40)
    monkeypatch.setattr(trie_join, "FREQUENT_MIN", 2)
    rows = list(enumerate(variations(5, prose(60, 90), 25, 4) + [prose(61, 40) + " " + prose(300 + i, 30) for i in range(25)]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in trie_join.join_documents(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


def test_join_of_awkward_rows(spark):
    docs = awkward(spark)
    got = trie_join.join_documents(docs).collect()
    named = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    want = brute_groups(named)
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert trie_join.join_documents(empty(spark)).count() == 0


def one_apart(a, b):
    """Are two word sequences at most one edit apart? Of equal length they differ at one
    place; else the longer one without some word is the shorter one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    cut = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) == 1 and a[cut:] == b[cut + 1:]


def brute_lines(rows):
    """(doc_id, line) of every line that goes: lines of three words and more that are equal
    to an earlier one, of five words and more also those one word edit from it."""
    lines = [((i, k), tuple(low_words(x))) for i, t in rows if i is not None for k, x in enumerate((t or "").split("\n"))]
    first = {}
    for place, w in sorted(lines):
        if len(w) >= 3:
            first.setdefault(w, place)
    near, by = set(), defaultdict(list)
    for w, p in first.items():
        if len(w) >= 5:
            by[len(w)].append((p, w))
    for w, p in first.items():
        for n in (len(w) - 1, len(w), len(w) + 1) if len(w) >= 5 else ():
            # one edit leaves at least one of the first and last two words alone
            if any(q < p and (v[:2] == w[:2] or v[-2:] == w[-2:]) and one_apart(w, v) for q, v in by[n]):
                near.add(w)
    return {p for p, w in lines if w in near or w in first and first[w] != p}


def check_lines(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    gone = brute_lines(rows)
    want = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if (i, k) not in gone]
        want[i, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)] += 1
    got = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in line_dedup.dedup_report(docs).collect())
    assert got == want
    return gone


def test_lines_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert check_lines(spark, docs)


def test_line_edits(spark):
    a = prose(70, 14).split()
    swap, drop, add, two = list(a), a[:5] + a[6:], a[:9] + ["more"] + a[9:], list(a)
    swap[3] = "other"
    two[2], two[11] = "x", "y"
    texts = [" ".join(a).upper(), " ".join(swap), " ".join(drop), " ".join(add), " ".join(two), "a b", "a b", "a b c", "A b  c"]
    rows = [(10 - i, t + "\nown " + str(i)) for i, t in enumerate(texts)]
    gone = check_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert (10, 0) in gone and (3, 0) in gone and (6, 0) not in gone and (5, 0) not in gone and (4, 0) not in gone


def test_short_line_edits(spark):
    lines = ["one two three four five", "one two three four six", "one two three four", "a b c d", "a b c e",
             "two three four five", "zero one two three four five", "one x three four y"]
    gone = check_lines(spark, spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert gone == {(1, 0), (6, 0)}


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert (13, 0) in check_lines(spark, docs)
    out, lines, removed = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns + [lines, removed] and out.count() == len(rows)
    assert line_dedup.dedup_report(empty(spark)).count() == 0
