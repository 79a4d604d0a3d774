"""Operators 11 to 13: vector codes, neighbour search, fill-in-the-middle."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import LONG, awkward, empty
from shoplens.llm import cover_lloyd, fill_middle, forest_search

VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    """Rows with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for name in ("cid", "leaf", "cell", "size", "block", "turn", "query", "rank", "score", "k1", "ids", "code", "error", "_label",
                 "query_id", "least", "place", "found", "skip"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def odd_vectors(dim=8, n=700, seed=3):
    """Clusters, copies, ties, unusable vectors, other lengths, shared and null ids."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] * rng.uniform(0.2, 2) + 0.3 * rng.standard_normal(dim)
        rows.append((i, v.astype(np.float32).tolist(), None if i % 5 == 0 else i % 5))
    rows += [(n + i, rows[40][1], 1) for i in range(60)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [None] * dim, 1), (2003, [NAN] + [0.0] * (dim - 1), 1),
             (2004, [INF] + [0.0] * (dim - 1), 2), (2005, [0.0] * dim, 2), (2006, [1.0] * 3, 2), (2020, [1.0] * (dim - 4), 2),
             (2007, [1.0] * (dim - 4), None), (20, rows[20][1], 3), (20, rows[21][1], 3), (None, rows[40][1], 3), (None, rows[7][1], None)]
    return rows


# -- op11 ---------------------------------------------------------------------

def lloyd(rows, parts, entries, rounds):
    """Plain Python rounds over all entries."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v], lab) for i, v, lab in rows
            if v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [x / 1024 for x in r[1]]))
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    w = length // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for r in kept:
                groups.setdefault(near(cut(r[1], p), books[p])[1], []).append(cut(r[1], p))
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    out, by_label = [], {}
    for i, v, lab in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, lab))
    text = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=str)


@pytest.mark.parametrize("entries", [3, 16])
def test_codes_equal_plain_lloyd(spark, entries):
    rows = odd_vectors(n=240)
    got = cover_lloyd.compress(vectors(spark, rows), entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == lloyd(rows, 4, entries, 4)


def test_codes_of_few_and_no_rows(spark):
    rows = odd_vectors(n=240)[:5]
    assert sorted(map(tuple, cover_lloyd.compress(vectors(spark, rows)).collect()), key=str) == lloyd(rows, 4, 256, 4)
    assert cover_lloyd.compress(vectors(spark, rows).limit(0)).count() == 0


def test_huge_components_are_bounded(spark):
    most = cover_lloyd.bound(4)
    got = cover_lloyd.compress(vectors(spark, [(1, [3e38, -3e38, 1.0, -1.0], 1), (2, [3e38, 3e38, 1.0, 0.0], 1)]), entries=1, rounds=0)
    assert {r.vec_id: r.error for r in got.collect()} == {1: 0, 2: (2 * most) ** 2 + 1024 ** 2}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80), st.integers(1, 5), st.integers(1, 12), st.sampled_from([3, 60, 5000, 1 << 26]), st.integers(0, 999))
def test_tree_assigns_exactly(n, width, entries, spread, seed):
    rng = np.random.default_rng(seed)
    points, weight = np.unique(rng.integers(-spread, spread, (n, width)), axis=0, return_counts=True)
    book = rng.integers(-spread, spread, (entries, width))
    tree = cover_lloyd.CoverTree.build(points, weight)
    tree = cover_lloyd.CoverTree.unpack(tree.pack(tree.at))[0]
    entry, sums, counts = tree.assign(book)
    want = ((tree.points[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
    assert entry.tolist() == want.tolist()
    for k in range(entries):
        assert counts[k] == tree.weight[want == k].sum()
        assert (sums[k] == (tree.points * tree.weight[:, None])[want == k].sum(0)).all()


def test_tree_covers_and_separates():
    points = np.unique(np.random.default_rng(1).integers(-500, 500, (400, 6)), axis=0)
    tree = cover_lloyd.CoverTree.build(points, np.ones(len(points), np.int64))
    whole = 0
    for v in range(len(tree.pivot)):
        inside = tree.points[tree.low[v]:tree.high[v]]
        gap = np.sqrt(((inside - tree.points[tree.pivot[v]]) ** 2).sum(1))
        assert gap.max() == pytest.approx(tree.radius[v])
        assert tree.count[v] == len(inside) and (tree.total[v] == inside.sum(0)).all()
        kids = [tree.points[tree.pivot[c]] if c >= 0 else tree.points[-1 - c] for c in tree.children[tree.first[v]:tree.last[v]]]
        apart = [np.linalg.norm(a - b) for i, a in enumerate(kids) for b in kids[:i]]
        assert min(apart) > tree.radius[v] / 2
        whole += 1
    # subtrees are taken as a whole where entries lie far apart
    far = np.array([[0] * 6, [100_000] * 6])
    assert (tree.assign(far)[0] == 0).all() and whole > 10


# -- op12 ---------------------------------------------------------------------

def brute_nearest(rows, count, every):
    fine = [(i, np.array(v, np.float64)) for i, v, _ in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(fine):
        if i is None or i % every:
            continue
        scores = []
        for b, (j, v) in enumerate(fine):
            if a != b and len(q) == len(v):
                total = 0.0
                for x, y in zip(q.tolist(), v.tolist()):
                    total += x * y
                scores.append((-total, j is None, j or 0))
        out += [(i, k + 1, None if none else j, -s) for k, (s, none, j) in enumerate(sorted(scores)[:count])]
    return sorted(out, key=str)


def test_search_of_one_leaf_is_exact(spark):
    rows = odd_vectors(n=300)
    got = forest_search.nearest(vectors(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "double"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_nearest(rows, 20, 20)
    assert forest_search.nearest(vectors(spark, rows).limit(0)).count() == 0


def test_all_leaves_and_blocks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(forest_search, "LEAF", 40)
    monkeypatch.setattr(forest_search, "CELL_BYTES", 30 * 8 * 8)  # several cells a tree, several blocks and turns a cell
    rows = odd_vectors(n=500)
    got = forest_search.nearest(vectors(spark, rows), every=2, recall=1.0, trees=2)
    want = brute_nearest(rows, 20, 2)
    found = {(r[0], r[2]) for r in want} & {(r.query_id, r.vec_id) for r in got.collect()}
    assert len(found) > 0.97 * len({(r[0], r[2]) for r in want})


def test_recall_of_a_forest(spark, monkeypatch):
    monkeypatch.setattr(forest_search, "LEAF", 32)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    rows = [(i, (centres[i % 40] + 0.5 * rng.standard_normal(16)).astype(np.float32).tolist(), 0) for i in range(4000)]
    used = []
    monkeypatch.setattr(forest_search, "leaves_needed", lambda *a, f=forest_search.leaves_needed: used.append((f(*a), a[0])) or used[-1][0])
    got = forest_search.nearest(vectors(spark, rows)).collect()
    assert used[0][0] < used[0][1].trees * used[0][1].leaves / 2  # a search, not a scan
    want = {(r[0], r[2]) for r in brute_nearest(rows, 20, 20)}
    assert len(want & {(r.query_id, r.vec_id) for r in got}) > 0.92 * len(want)
    byrank = {}
    for r in got:
        byrank.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    for seen in byrank.values():
        seen.sort()
        assert [k for k, _, _ in seen] == list(range(1, 21)) and [x[1:] for x in seen] == sorted(x[1:] for x in seen)


def test_queue_takes_the_nearest_split_first():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((600, 5))
    forest = forest_search.Forest(points, 600 * 64, trees=3)
    everything = forest.trees * forest.leaves
    for q, seen in zip(points[:20], forest.search(points[:20], everything)):
        assert sorted(seen) == list(range(everything))
        scaled = q * forest.length / np.linalg.norm(q)

        def beyond(leaf):
            t, v, far = leaf // forest.leaves, leaf % forest.leaves + forest.inner, 0.0
            while v:
                up = (v - 1) // 2
                m = np.float32(scaled) @ forest.direction[t, up] - forest.threshold[t, up]
                if (m > 0) != (v == 2 * up + 2):
                    far = max(far, abs(m))
                v = up
            return far
        way = [beyond(x) for x in seen]
        assert all(a <= b + 1e-5 for a, b in zip(way, way[1:]))


# -- op13 ---------------------------------------------------------------------

def plain_transform(doc_id, text, rate=90):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def fuzz(n=300):
    r = random.Random(8)
    odd = ["a", "Bc", " ", "\n", "é", "漢", "😀", "́", "<", ">", "P", "S>", "<M", "1", "_", "", "\x00", "@", "[", "`", "{"]
    return ["".join(r.choice(odd) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["<P>", "a<S>b", "<M>", "<<P", LONG]


def test_transform_equals_plain_and_restores(spark):
    texts = fuzz()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for rate in (90, 100):
        out = fill_middle.transform(docs, rate=rate, restored=True).collect()
        for r in out:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_transform(r.doc_id, texts[r.doc_id], rate)
            assert r.restored == texts[r.doc_id]
        assert {r.form for r in out} == {"plain", "psm", "spm"}
    back = fill_middle.restore(fill_middle.transform(docs)).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(texts))


def test_transform_of_awkward_rows(spark):
    docs = awkward(spark)
    got = fill_middle.transform_digest(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, form, head, body, out = plain_transform(r.doc_id, r.text)
        want.append((r.doc_id, n, form, head, body, hashlib.sha256(out.encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert fill_middle.transform_digest(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.integers(0, 40), st.integers(0, 40))
def test_exchange_swaps_neighbours(data, a, b):
    lo, mid = sorted((min(a, len(data)), min(b, len(data))))
    buf = bytearray(data)
    fill_middle.exchange(buf, lo, mid, len(buf))
    assert bytes(buf) == data[:lo] + data[mid:] + data[lo:mid]
