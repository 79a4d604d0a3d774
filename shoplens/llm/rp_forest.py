"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Equal vectors fall together into one class. A bounded sample of classes
(``SAMPLE``, those of the lowest hash) fits the trees: a node splits at the
median of its points' projections on a random direction, and points within
``SPILL`` of the median, by rank, go to both sides, so a tree's leaves overlap
and follow the density. Trees are added until the linked pairs of the sample
share a leaf as often as ``RECALL`` asks for. Every class is then sent to its
leaves of every tree, all classes of a leaf are compared in double precision (a
leaf of more than ``BLOCK`` classes in salted blocks, each with each), and the
verified pairs of all trees are united.

Crowds, places where the sample tells of ``CROWD`` classes or more within the
threshold of one vector, do not go through the forest. A crowd owns the classes
within ``REACH`` angles of the threshold of its centre (the nearest centre's,
if there are several) and is compared, exactly, with itself and with all
classes that can lie within the threshold of an owned one, in salted blocks:
links are counted per class and block, and a block emits only a spanning
forest of its links. Pairs without an owned class are left to the forest.

Afterwards ``PROBES`` classes, half of them linked ones, are compared with the
whole table. While the forest has fewer than ``RECALL`` of their links, trees
are added, up to the most; a share that is still short is warned of.

Links are exact (no pair below the threshold); links of crowds are complete,
others are found with high probability. Copies are never expanded: a class
counts its size in n_links.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are kept; vectors of different length are
never compared; rows that share a vec_id are separate nodes that carry the
same id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import components, materialise

THRESHOLD = 0.9
SAMPLE = 16_384
CHECKED = 4_096   # sample vectors whose pairs measure the forest
LEAF = 512
LEAST = 8         # sample points of the smallest node
SPILL = 0.06
RECALL = 0.98
TREES = (6, 24)   # at least, at most
CROWD = 256       # classes within the threshold of one that make a crowd
SEEN = 16         # sample points that a crowd shows at least
REACH = 1.5       # radius of a crowd, in angles of the threshold
BLOCK = 4096      # classes of a block of a crowd or leaf
FOREST_BYTES = 1 << 26  # of the directions of all trees; wide vectors get fewer, larger leaves
PROBES = 256      # classes whose links are counted over the whole table


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the scale by the largest component keeps squares finite."""
    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Tree:
    """A spill tree: directions and the two thresholds of each inner node."""

    def __init__(self, points: np.ndarray, depth: int, rng: np.random.Generator):
        dim = points.shape[1]
        self.depth = depth
        inner = (1 << depth) - 1
        self.direction = np.zeros((inner, dim), np.float32)
        self.low, self.high = np.full(inner, np.inf), np.full(inner, np.inf)
        # a node with too few points is not split: all go left
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if node >= inner or len(at) < 2 * LEAST:
                continue
            way = rng.standard_normal(dim)
            p = points[at] @ way
            lo, hi = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
            self.direction[node], self.low[node], self.high[node] = way, lo, hi
            p = points[at] @ self.direction[node].astype(np.float64)
            stack += [(2 * node + 1, at[p <= hi]), (2 * node + 2, at[p >= lo])]

    def leaves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of every leaf that each point belongs to."""
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            p = np.einsum("ij,ij->i", points[at], self.direction[node].astype(np.float64))
            left, right = p <= self.high[node], p >= self.low[node]
            at, node = np.concatenate([at[left], at[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        return at, node


def linked(points: np.ndarray, threshold: float, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of unit rows whose cosine reaches the threshold."""
    a, b = [], []
    for lo in range(0, len(points), block):
        i, j = np.nonzero(points[lo:lo + block] @ points[lo:].T >= threshold)
        keep = i < j
        a.append(i[keep] + lo)
        b.append(j[keep] + lo)
    return np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])


def crowd_centres(sample: np.ndarray, total: int, threshold: float) -> np.ndarray:
    """Centres of the crowds that a sample of ``total`` points shows, densest first."""
    rest = sample.astype(np.float32)
    least = max(SEEN, CROWD * len(sample) / max(1, total))
    near = lambda points, others: sum(((points @ others[lo:lo + 1024].T) >= threshold).sum(1)
                                      for lo in range(0, len(others), 1024))
    count = np.concatenate([near(rest[lo:lo + 1024], rest) for lo in range(0, len(rest), 1024)])
    centres = []
    while len(rest) and count.max() >= least:
        centre = rest[count.argmax()]
        centres.append(centre.astype(np.float64))
        own = rest @ centre >= cosine(REACH, threshold) - 1e-6
        gone, rest, count = rest[own], rest[~own], count[~own]
        if len(rest):
            count = count - np.concatenate([near(rest[lo:lo + 1024], gone) for lo in range(0, len(rest), 1024)])
    return unit(np.array(centres)) if centres else np.zeros((0, sample.shape[1]))


def cosine(angles: float, threshold: float) -> float:
    """Cosine of so many angles of the threshold."""
    return math.cos(min(math.pi, angles * math.acos(max(-1.0, min(1.0, threshold)))))


def spanning(met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of a spanning forest of the bipartite graph ``met``."""
    a, b = [], []
    rows, columns = met.any(1), np.ones(met.shape[1], bool)  # not yet reached
    for first in np.flatnonzero(rows):
        if not rows[first]:
            continue
        rows[first] = False
        front = np.array([first])
        while len(front):
            new = np.flatnonzero(met[front].any(0) & columns)
            columns[new] = False
            a.append(front[met[np.ix_(front, new)].argmax(0)] if len(new) else new)
            b.append(new)
            back = np.flatnonzero(met[:, new].any(1) & rows)
            rows[back] = False
            a.append(back)
            b.append(new[met[np.ix_(back, new)].argmax(1)] if len(back) else back)
            front = back
    return np.concatenate(a or [np.zeros(0, int)]), np.concatenate(b or [np.zeros(0, int)])


def grow(sample: np.ndarray, total: int, threshold: float, seed: int = 7, least: int = TREES[0]) -> list[Tree]:
    """Trees whose leaves hold about LEAF of ``total`` points, until the sample's links are met."""
    rng = np.random.default_rng(seed)
    shrink = math.log(1 / (0.5 + SPILL))
    depth = max(0, min(math.ceil(math.log(max(1, total / LEAF)) / shrink),
                       int(math.log(max(1, len(sample) / LEAST)) / shrink),
                int(math.log2(max(1, FOREST_BYTES // (4 * TREES[1] * sample.shape[1]))))))
    checked = sample[:CHECKED]
    a, b = linked(checked, threshold)
    if len(a) > 200_000:
        pick = rng.choice(len(a), 200_000, replace=False)
        a, b = a[pick], b[pick]
    met, trees = np.zeros(len(a), bool), []
    while len(trees) < least or (len(trees) < TREES[1] and len(a) and met.mean() < RECALL):
        tree = Tree(sample, depth, rng)
        trees.append(tree)
        at, node = tree.leaves(checked)
        member = np.zeros((len(checked), (1 << depth)), bool)
        member[at, node - ((1 << depth) - 1)] = True
        bits = np.packbits(member, axis=1)
        for lo in range(0, len(a), 20_000):
            met[lo:lo + 20_000] |= (bits[a[lo:lo + 20_000]] & bits[b[lo:lo + 20_000]]).any(1)
    return trees


def valid(vector: str = "embedding"):
    """Is the vector usable?"""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def by_length(batch, at: int) -> Iterator:
    """(length, rows, unit vectors) of the vectors in column ``at`` of an Arrow batch."""
    size = batch.column(at).value_lengths().to_numpy()
    flat = batch.column(at).flatten().to_numpy()
    end = np.cumsum(size)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, unit(flat[(end[rows] - d)[:, None] + np.arange(d)[None, :]])


def packed(points: np.ndarray) -> np.ndarray:
    return np.array([p.tobytes() for p in points.astype("<f8")], object)


def sampled(classes: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(cids, unit vectors) of the n classes of the lowest hash, by length."""
    table = classes.orderBy(F.xxhash64("cid"), "cid").limit(n).select("cid", "embedding").toArrow().combine_chunks()
    out = {}
    for batch in table.to_batches():  # one, or none of an empty table
        for d, rows, points in by_length(batch, 1):
            out[d] = batch.column(0).to_numpy()[rows], points
    return out


def place(classes: DataFrame, centres: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """cid, size, home, crowd, point and weight: one row for each crowd that a class takes part in.

    ``home`` is the crowd that owns the class, or null. A class is a guest of
    the crowds after which its own one comes, so that each pair with an owned
    class meets in one crowd, the first of its two homes.
    """
    own, guest = cosine(REACH, threshold), cosine(REACH + 1, threshold)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cid, weight = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for d, rows, points in by_length(batch, 1):
                c = centres.get(d)
                if c is None or not len(c):
                    continue
                for lo in range(0, len(rows), 1000):
                    near = points[lo:lo + 1000] @ c.T
                    best = near.argmax(1)
                    home = np.where(near[np.arange(len(near)), best] >= own, best, len(c))
                    i, k = np.nonzero((near >= guest - 1e-9) & (np.arange(len(c)) <= home[:, None]))
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cid[rows[lo + i]]), pa.array(np.full(len(i), d, np.int32)),
                             pa.array(home[i].astype(np.int32), mask=home[i] == len(c)), pa.array(k.astype(np.int32)),
                             pa.array(packed(points[lo + i]), pa.binary()), pa.array(weight[rows[lo + i]])],
                            names=["cid", "size", "home", "crowd", "point", "weight"])

    return classes.select("cid", "embedding", "weight").mapInArrow(
        run, "cid long, size int, home int, crowd int, point binary, weight long")


def crowd_links(placed: DataFrame, threshold: float) -> DataFrame:
    """a, b and n from the blocks of all crowds: class a has n links (rows) in a
    block (b null), or a link of the block's spanning forest joins a and b (n null)."""
    sizes = placed.groupBy("size", "crowd").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    salted = placed.join(F.broadcast(sizes), ["size", "crowd"]).withColumn(
        "own", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("blocks")).cast("int"))
    dealt = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "size", "crowd", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "cid", F.col("home").eqNullSafe(F.col("crowd")).alias("member"), "point", "weight")

    def compare(table):
        import pyarrow as pa

        cid, weight = table.column("cid").to_numpy(), table.column("weight").to_numpy()
        points = np.frombuffer(b"".join(table.column("point").to_pylist()), "<f8").reshape(len(cid), -1)
        member, own = table.column("member").to_numpy(), table.column("own").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        count, a, b = np.zeros(len(cid), np.int64), [], []
        # each pair with a member once: members of one side with all of the other, and its members with the guests of the first
        for x, y in ((left[member[left]], right), (left[~member[left]], right[member[right]])):
            if low == high and len(x) and not member[x[0]]:
                continue  # the members have met these guests
            for i in range(0, len(x), 1024):
                for j in range(0, len(y), 1024):
                    xs, ys = x[i:i + 1024], y[j:j + 1024]
                    met = points[xs] @ points[ys].T >= threshold
                    met &= xs[:, None] != ys[None, :]
                    count[xs] += met @ weight[ys]
                    once = met if low != high else met & ~member[ys][None, :]
                    count[ys] += weight[xs] @ once
                    r, c = spanning(met)
                    a.append(cid[xs[r]])
                    b.append(cid[ys[c]])
        a, b = np.concatenate(a or [cid[:0]]), np.concatenate(b or [cid[:0]])
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        some = np.flatnonzero(count)
        none = np.zeros(len(pairs) + len(some), bool)
        none[len(pairs):] = True
        return pa.table({"a": pa.array(np.concatenate([pairs[:, 0], cid[some]]), pa.int64()),
                         "b": pa.array(np.concatenate([pairs[:, 1], cid[some]]), pa.int64(), mask=none),
                         "n": pa.array(np.concatenate([pairs[:, 0], count[some]]), pa.int64(), mask=~none)})

    return dealt.groupBy("size", "crowd", "low", "high").applyInArrow(compare, "a long, b long, n long")


def routed(classes: DataFrame, forests: dict[int, list[Tree]], crowded: dict | None) -> DataFrame:
    """Leaf counts (size, tree, leaf, n), or (if ``crowded`` names the blocks of large
    leaves) the classes of each leaf, dealt to the pairs of its blocks."""
    schema = "size int, tree int, leaf long, n long" if crowded is None else \
        "size int, tree int, leaf long, low int, high int, own int, cid long, point binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for d, rows, points in by_length(batch, 1):
                raw, cid = packed(points) if crowded is not None else None, batch.column(0).to_numpy()[rows]
                # a length that the sample does not hold has one leaf
                for t, tree in enumerate(forests.get(d, [None])):
                    at, node = tree.leaves(points) if tree else (np.arange(len(rows)), np.zeros(len(rows), np.int64))
                    if crowded is None:
                        leaf, n = np.unique(node, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(leaf), d, np.int32)), pa.array(np.full(len(leaf), t, np.int32)),
                             pa.array(leaf), pa.array(n)], names=["size", "tree", "leaf", "n"])
                        continue
                    blocks = np.ones(len(node), np.int64)
                    for leaf, b in crowded.get((d, t), {}).items():
                        blocks[node == leaf] = b
                    own = (cid[at] * 0x9E3779B1 >> 16) % blocks
                    # block b meets each block of its leaf, itself included
                    copy = np.repeat(np.arange(len(at)), blocks)
                    other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    for lo in range(0, len(copy), 5000):
                        i, o = copy[lo:lo + 5000], other[lo:lo + 5000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(i), d, np.int32)), pa.array(np.full(len(i), t, np.int32)), pa.array(node[i]),
                             pa.array(np.minimum(own[i], o).astype(np.int32)), pa.array(np.maximum(own[i], o).astype(np.int32)),
                             pa.array(own[i].astype(np.int32)), pa.array(cid[at[i]]), pa.array(raw[at[i]], pa.binary())],
                            names=["size", "tree", "leaf", "low", "high", "own", "cid", "point"])

    return classes.select("cid", "embedding").mapInArrow(run, schema)


def forest_links(classes: DataFrame, forests: dict[int, list[Tree]], threshold: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of linked classes that share a leaf; all of them."""
    crowded: dict[tuple[int, int], dict[int, int]] = {}
    # at most a row for each leaf of the forest
    for r in routed(classes, forests, None).groupBy("size", "tree", "leaf").agg(F.sum("n").alias("n")) \
            .where(F.col("n") > BLOCK).collect():
        crowded.setdefault((r["size"], r["tree"]), {})[r["leaf"]] = -(-r["n"] // BLOCK)

    def compare(table):
        import pyarrow as pa

        cid = table.column("cid").to_numpy()
        points = np.frombuffer(b"".join(table.column("point").to_pylist()), "<f8").reshape(len(cid), -1)
        own, low, high = table.column("own").to_numpy(), table.column("low")[0].as_py(), table.column("high")[0].as_py()
        if low == high:
            i, j = linked(points, threshold)
        else:
            left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
            met = [np.nonzero(points[left[lo:lo + 1024]] @ points[right].T >= threshold) for lo in range(0, len(left), 1024)]
            i = np.concatenate([left[:0], *[left[lo + x] for lo, (x, _) in zip(range(0, len(left), 1024), met)]])
            j = np.concatenate([right[:0], *[right[y] for _, y in met]])
        return pa.table({"a": pa.array(np.minimum(cid[i], cid[j]), pa.int64()),
                         "b": pa.array(np.maximum(cid[i], cid[j]), pa.int64())})

    return routed(classes, forests, crowded).groupBy("size", "tree", "leaf", "low", "high") \
        .applyInArrow(compare, "a long, b long").distinct()


def probe_links(classes: DataFrame, probes: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of linked classes of which one is a probe."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for d, rows, points in by_length(batch, 1):
                if d not in probes:
                    continue
                cid, (ids, those) = batch.column(0).to_numpy()[rows], probes[d]
                i, j = np.nonzero(points @ those.T >= threshold)
                a, b = cid[i], ids[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[a != b]), pa.array(np.maximum(a, b)[a != b])],
                                                 names=["a", "b"])

    return classes.select("cid", "embedding").mapInArrow(run, "a long, b long").distinct()


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b), a < b, of linked classes without crowds, found by the forest; ``classes`` has cid and embedding."""
    total = classes.count()
    sample = sampled(classes, SAMPLE)
    seen = sum(len(ids) for ids, _ in sample.values())
    share = {d: total * len(ids) // max(1, seen) for d, (ids, _) in sample.items()}
    forests = {d: grow(points, share[d], threshold) for d, (_, points) in sample.items()}
    pairs = materialise(forest_links(classes, forests, threshold), "forest-links")
    # half of the probes are linked classes: few others have links to lose
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    probes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for part in (sampled(classes, PROBES // 2), sampled(classes.join(ends, "cid", "left_semi"), PROBES // 2)):
        for d, (ids, points) in part.items():
            ids, points = (np.concatenate([x, y]) for x, y in zip(probes[d], (ids, points))) if d in probes else (ids, points)
            ids, first = np.unique(ids, return_index=True)
            probes[d] = ids, points[first]
    true = materialise(probe_links(classes, probes, threshold), "forest-probes")
    n, used = true.count(), max(map(len, forests.values()), default=0)
    while n:
        recall = true.join(pairs, ["a", "b"], "left_semi").count() / n
        if recall >= RECALL:
            break
        if used >= TREES[1]:
            warnings.warn(f"the forest found {recall:.3f} of the {n} links of its probes", stacklevel=2)
            break
        more = min(TREES[0], TREES[1] - used)
        forests = {d: grow(points, share[d], threshold, 7 + used, more)[:more] for d, (_, points) in sample.items()}
        pairs = materialise(pairs.union(forest_links(classes, forests, threshold)).distinct(), "forest-links")
        used += more
    return pairs


def crowds(classes: DataFrame, threshold: float) -> dict[int, np.ndarray]:
    """Centres of the crowds of each vector length."""
    total, sample = classes.count(), sampled(classes, SAMPLE)
    seen = sum(len(ids) for ids, _ in sample.values())
    return {d: crowd_centres(points, total * len(ids) // seen, threshold) for d, (ids, points) in sample.items()}


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = materialise(vectors.select("vec_id", F.when(valid(), F.xxhash64("embedding")).alias("cid"),
                                      F.when(valid(), F.col("embedding")).alias("embedding")), "forest-rows")
    usable = rows.where("cid is not null")
    classes = materialise(usable.groupBy("cid").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"),
                                                    F.first("embedding").alias("embedding")), "forest-classes")
    centres = crowds(classes, threshold)
    placed = materialise(place(classes, centres, threshold), "forest-crowds")
    counted = materialise(crowd_links(placed, threshold), "forest-counted")
    owned = placed.where("home is not null").select("cid").distinct()
    pairs = links(materialise(classes.join(owned, "cid", "left_anti"), "forest-rest"), threshold)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(classes.select(F.col("cid").alias("b"), "weight"), "b").select("a", F.col("weight").alias("n")) \
        .unionByName(counted.where("b is null").select("a", "n")).groupBy(F.col("a").alias("cid")) \
        .agg(F.sum("n").alias("others"))
    pairs = pairs.unionByName(counted.where("b is not null").select("a", "b"))
    root = components(pairs, "forest-cc").withColumnRenamed("id", "cid")
    placed = materialise(classes.select("cid", "weight", "least").join(degree, "cid", "left").join(root, "cid", "left").select(
        "cid", "least", F.coalesce("component", "cid").alias("root"),
        (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "forest-placed")
    least = materialise(placed.groupBy("root").agg(F.min("least").alias("component_id")), "forest-least")
    classed = materialise(placed.join(least, "root").select("cid", "n_links", "component_id"), "forest-classed")
    return rows.select("vec_id", "cid").join(classed, "cid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
