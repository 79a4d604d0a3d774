"""Vector codes by Lloyd rounds over partition-local cover trees.

Components become integers and a vector is cut into equal parts. Each run of
``RUN`` rows builds one cover tree for each part, over its distinct points: a
node's children are centres more than half its scale apart that cover all its
points, and it keeps radius, count and component sums of its whole subtree. A
round takes the codebook down the trees: a node whose pivot is nearer to one
entry than to any other by more than twice the radius gives its sums to that
entry as a whole (triangle inequality); other nodes hand the entries that are
still open to their children, and single points compare them exactly, in
integers. Trees are built once, written to the shared folder and read in each
round; a round sends one row of sums per entry and task, and the codebooks
(``ENTRIES`` entries a part) are all the driver holds.

Results do not depend on the trees: assignments and sums are exact.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped, and so are vectors whose length is no positive multiple of
``PARTS`` or differs from that of the smallest vec_id's usable one. Integers
beyond the largest power of two b for which length * (2b)^2 stays under 2^62
are set to that bound, so that errors fit a long; label_error is null where a
long cannot hold it. Fewer rows than ``ENTRIES`` give a smaller codebook. Rows
that share a vec_id are coded separately, in the order of their vectors as
starting entries; a null vec_id sorts last. An empty table gives no rows;
columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import materialise, small_side

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
RUN = 2048        # rows that share their trees
EXACT = 1 << 53   # integers below this are exact as doubles


def bound(length: int) -> int:
    """Largest power of two b with length * (2b)^2 < 2^62."""
    b = 1
    while length * (4 * b) ** 2 < 1 << 62:
        b *= 2
    return b


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of rows of finite components."""
    most = bound(vectors.shape[1])
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -most, most).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two integer arrays."""
    most = 2 * max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if a.shape[1] * most * most < EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


class CoverTree:
    """A cover tree in flat arrays.

    ``points`` stand in the order of the leaves, so a node's subtree is
    ``points[low:high]``. ``children[first[v]:last[v]]`` are node numbers, or
    ``-1 - k`` for the single point k.
    """

    FIELDS = ("points", "weight", "pivot", "radius", "low", "high", "first", "last", "children", "total", "count")

    @classmethod
    def build(cls, points: np.ndarray, weight: np.ndarray) -> "CoverTree":
        gap = np.sqrt(squared(points, points).astype(np.float64))
        order: list[int] = []
        pivot, radius, low, high, child = [], [], [], [], []

        def open_node(centre: int, members: np.ndarray) -> int:
            pivot.append(centre)
            radius.append(float(gap[centre, members].max()))
            low.append(len(order))
            high.append(0)
            child.append([])
            return len(pivot) - 1

        root = open_node(0, np.arange(len(points)))
        # (node, its groups still to place); a node is closed after its last group
        stack = [(root, iter(cls._split(gap, 0, np.arange(len(points)), radius[root])))]
        while stack:
            node, groups = stack[-1]
            group = next(groups, None)
            if group is None:
                high[node] = len(order)
                stack.pop()
                continue
            centre, members = group
            if len(members) == 1:
                child[node].append(-1 - len(order))
                order.append(centre)
                continue
            v = open_node(centre, members)
            child[node].append(v)
            stack.append((v, iter(cls._split(gap, centre, members, radius[v]))))
        at = np.empty(len(points), np.int64)
        at[order] = np.arange(len(points))
        self = cls()
        self.at = at
        self.points, self.weight = points[order], weight[order].astype(np.int64)
        self.pivot, self.radius = at[pivot], np.array(radius)
        self.low, self.high = np.array(low), np.array(high)
        size = np.array([len(c) for c in child])
        self.last = np.cumsum(size)
        self.first = self.last - size
        self.children = np.concatenate([np.array(c, np.int64) for c in child])
        sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64),
                               np.cumsum(self.points * self.weight[:, None], 0)])
        counts = np.concatenate([[0], np.cumsum(self.weight)])
        self.total = sums[self.high] - sums[self.low]
        self.count = counts[self.high] - counts[self.low]
        return self

    @staticmethod
    def _split(gap: np.ndarray, centre: int, members: np.ndarray, radius: float) -> list:
        """(centre, members) of the children: the centre itself first, then points not yet covered at half the radius."""
        scale = radius / 2
        centres, open_ = [centre], gap[centre, members] > scale
        while open_.any():
            c = int(members[open_.argmax()])
            centres.append(c)
            open_ &= gap[c, members] > scale
        nearest = gap[np.ix_(members, centres)].argmin(1)
        order = np.argsort(nearest, kind="stable")
        ends = np.cumsum(np.bincount(nearest, minlength=len(centres)))
        return [(c, members[order[e - k:e]]) for c, e, k in zip(centres, ends, np.diff(ends, prepend=0))]

    def pack(self, place: np.ndarray) -> bytes:
        """The tree and, per row, the position of its point."""
        out = io.BytesIO()
        small = np.int32 if np.abs(self.points).max(initial=0) < 1 << 31 else np.int64
        np.savez(out, place=place.astype(np.int32), **{
            f: getattr(self, f).astype(small) if f == "points" else getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, raw: bytes) -> tuple["CoverTree", np.ndarray]:
        got, self = np.load(io.BytesIO(raw), allow_pickle=False), cls()
        for f in cls.FIELDS:
            setattr(self, f, got[f])
        self.points = self.points.astype(np.int64)
        return self, got["place"]

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each point, component sums and counts of the entries); ties go to the lower entry."""
        entry = np.zeros(len(self.points), np.int64)
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        node, open_ = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
        while len(node):
            far = np.sqrt(squared(self.points[self.pivot[node]], book).astype(np.float64))
            far[~open_] = np.inf
            # a little more than the bound: rounding may only leave entries open
            open_ &= far <= (far.min(1) + 2 * self.radius[node])[:, None] * (1 + 1e-9) + 1e-6
            whole = open_.sum(1) == 1
            taken = open_[whole].argmax(1)
            np.add.at(sums, taken, self.total[node[whole]])
            np.add.at(counts, taken, self.count[node[whole]])
            for v, e in zip(node[whole], taken):
                entry[self.low[v]:self.high[v]] = e
            node, open_ = node[~whole], open_[~whole]
            size = self.last[node] - self.first[node]
            up = np.repeat(np.arange(len(node)), size)
            at = np.arange(len(up)) - np.repeat(np.cumsum(size) - size, size) + self.first[node][up]
            below = self.children[at]
            single = below < 0
            for lo in range(0, int(single.sum()), 1024):
                k, mask = -1 - below[single][lo:lo + 1024], open_[up[single][lo:lo + 1024]]
                exact = squared(self.points[k], book)
                exact[~mask] = np.iinfo(np.int64).max if exact.dtype == np.int64 else np.inf
                best = exact.argmin(1)
                entry[k] = best
                np.add.at(sums, best, self.points[k] * self.weight[k][:, None])
                np.add.at(counts, best, self.weight[k])
            node, open_ = below[~single], open_[up[~single]]
        return entry, sums, counts


def plant(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """One row for each run: its vec_ids, labels and a packed tree per part."""
    width = length // parts
    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["vec_id"].dataType)),
                           T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
                           T.StructField("trees", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, len(batch), RUN):
                part = batch.slice(lo, RUN)
                vectors = integers(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), length))
                trees = []
                for p in range(parts):
                    points, place, weight = np.unique(vectors[:, p * width:(p + 1) * width], axis=0,
                                                      return_inverse=True, return_counts=True)
                    tree = CoverTree.build(points, weight)
                    trees.append(tree.pack(tree.at[place.ravel()]))
                ends = pa.array([0, len(part)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part.column(0)), pa.ListArray.from_arrays(ends, part.column(1)),
                     pa.array([trees], pa.list_(pa.binary()))], names=schema.names)

    return rows.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def sums_of(trees: DataFrame, books: list[np.ndarray]) -> list:
    """(part, entry, n, s0, ...) of one round, at most ENTRIES rows a part."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in batch.column(0):
                for p, raw in enumerate(row):
                    _, s, n = CoverTree.unpack(raw.as_py())[0].assign(books[p])
                    sums[p] += s
                    counts[p] += n
        for p, (s, n) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]),
                 *[pa.array(np.ascontiguousarray(s[used, i])) for i in range(width)]], names=["part", "entry", "n", *names])

    part = trees.select("trees").mapInArrow(run, "part int, entry int, n long, " + ", ".join(f"{x} long" for x in names))
    return part.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names]).collect()


def code(trees: DataFrame, books: list[np.ndarray], vec_id: T.StructField, label: T.StructField) -> DataFrame:
    """vec_id, label, code and error of every row."""
    schema = T.StructType([vec_id, label, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(len(batch)):
                error, entries = 0, []
                for p, raw in enumerate(batch.column(2)[i]):
                    tree, place = CoverTree.unpack(raw.as_py())
                    entry = tree.assign(books[p])[0]
                    error = error + ((tree.points - books[p][entry]) ** 2).sum(1)[place]
                    entries.append(entry[place].astype(np.uint8))
                digits = np.stack(entries, 1).tobytes().hex()
                wide = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values,
                     pa.array([digits[k:k + wide] for k in range(0, len(digits), wide)]), pa.array(error, pa.int64())],
                    names=schema.names)

    return trees.mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row."""
    if entries > 256:
        raise ValueError("an entry is written as two hex digits")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.coalesce(fine & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0), F.lit(False))) \
        .select("vec_id", "label", "embedding")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).select(F.size("embedding")).first()
    length = first[0] if first else parts
    rows = rows.where(F.size("embedding") == length)
    start = [r["embedding"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries)
             .select("embedding").collect()]
    width = length // parts
    start = integers(np.array(start, np.float64).reshape(len(start), length))
    books = [start[:, p * width:(p + 1) * width] for p in range(parts)]
    trees = materialise(plant(rows, length, parts), "cover-trees")
    for _ in range(rounds if len(start) else 0):
        books = [b.copy() for b in books]
        for r in sums_of(trees, books):
            books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    coded = materialise(code(trees, books, rows.schema["vec_id"], rows.schema["label"]), "cover-codes")
    by_label = small_side(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), F.lit(2))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
