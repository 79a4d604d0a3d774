"""Nearest neighbours by largest inner product, from a forest of random-projection trees.

A bounded sample (``SAMPLE`` vectors, those of the lowest hash) fits the trees:
a node splits at the median of its points' projections on a random direction.
Every vector is indexed, in one leaf of each tree. A query walks all trees
through one shared priority queue: it descends to a leaf on its own side of
each split, queues the other sides by how far they lie beyond the splits, and
takes the nearest one next, whatever its tree, until it has seen its number of
leaves. The members of its leaves are then ranked exactly.

How many leaves a query sees is measured, not guessed: ``PROBES`` queries (of
the lowest hash) are compared with the whole table, and the number is the least
one with which the queue meets ``RECALL`` of their true neighbours; if nothing
less does, all leaves, which is exact. So are tables of one leaf, and vectors
of a length that has no probe.

On Spark: equal vectors fall into one class that keeps its smallest ids, as
many as a result can need, so copies cannot crowd a leaf. Leaves of a tree that
follow one another form a cell of about ``CELL_BYTES``; members and queries of
a cell meet in one group, and a cell with more members or queries is salted into
blocks. A group sends the best of each query only.

The score is the sum of the products in order of the components, in double
precision; it does not depend on how the work is dealt.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length never meet; rows that
share a vec_id are separate, a query leaves out its own row alone, and equal
queries each get their rows; a null vec_id is no query and comes last among
ties; products beyond the range of doubles are infinite; an empty table gives
no rows; columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import materialise

NEAREST = 20
EVERY = 20             # queries are the rows whose vec_id is divisible by this
SAMPLE = 65_536
LEAF = 512             # vectors of a leaf, while the sample lasts
LEAST = 8              # sample vectors of a leaf
TREES = 8
FOREST_BYTES = 1 << 25  # size of all directions at most
PROBES = 96
RECALL = 0.95
CELL_BYTES = 1 << 23   # vectors of a group, as doubles


def usable(vector: str = "embedding"):
    v = F.col(vector)
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def vectors_of(column) -> Iterator:
    """(length, rows, vectors as doubles) of an Arrow list column, by length."""
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    end = np.cumsum(size)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, flat[(end[rows] - d)[:, None] + np.arange(d)[None, :]].astype(np.float64)


class Forest:
    """Directions and thresholds of all trees; node v of a tree has the children 2v + 1 and 2v + 2."""

    def __init__(self, sample: np.ndarray, total: int, trees: int = TREES, seed: int = 11):
        dim = sample.shape[1]
        room = FOREST_BYTES // (trees * dim * 4) + 1
        self.depth = max(0, min(math.ceil(math.log2(max(1, total / LEAF))),
                                int(math.log2(max(1, len(sample) / LEAST))), int(math.log2(room))))
        self.trees, self.inner, self.leaves = trees, (1 << self.depth) - 1, 1 << self.depth
        # queries are scaled to a long vector's length: the inner product ranks alike, the margins do not
        norm = np.linalg.norm(sample, axis=1)
        self.length = float(np.quantile(norm, 0.9)) if len(norm) else 1.0
        self.direction = np.zeros((trees, self.inner, dim), np.float32)
        self.threshold = np.zeros((trees, self.inner), np.float64)
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            stack = [(0, np.arange(len(sample)))]
            while stack:
                v, at = stack.pop()
                if v >= self.inner:
                    continue
                way = rng.standard_normal(dim).astype(np.float32)
                p = sample[at] @ way
                self.direction[t, v] = way
                self.threshold[t, v] = np.median(p) if len(at) else 0.0
                right = p > self.threshold[t, v]
                stack += [(2 * v + 1, at[~right]), (2 * v + 2, at[right])]

    def place(self, points: np.ndarray) -> np.ndarray:
        """Leaf of every point in each tree, (points, trees)."""
        node = np.zeros((len(points), self.trees), np.int64)
        for _ in range(self.depth):
            for t in range(self.trees):
                v = node[:, t]
                p = np.einsum("ij,ij->i", points, self.direction[t, v].astype(np.float64))
                node[:, t] = 2 * v + 1 + (p > self.threshold[t, v])
        return node - self.inner

    def search(self, points: np.ndarray, most: int) -> Iterator[list[int]]:
        """For each query the first ``most`` leaves (tree * leaves + leaf) that the shared queue gives, in order."""
        inner, leaves = self.inner, self.leaves
        scaled = points * (self.length / np.linalg.norm(points, axis=1))[:, None]
        ways, limits = self.direction.reshape(-1, points.shape[1]).T, self.threshold.reshape(-1)
        step = max(1, (1 << 21) // max(1, len(limits)))
        for lo in range(0, len(points), step):
            margins = scaled[lo:lo + step].astype(np.float32) @ ways - limits
            for row in margins.tolist():
                heap = [(0.0, t, 0) for t in range(self.trees)]
                seen: list[int] = []
                while heap and len(seen) < most:
                    far, t, v = heappop(heap)
                    at = t * inner
                    while v < inner:
                        m = row[at + v]
                        own, other = (2 * v + 2, 2 * v + 1) if m > 0 else (2 * v + 1, 2 * v + 2)
                        heappush(heap, (max(far, abs(m)), t, other))
                        v = own
                    seen.append(t * leaves + v - inner)
                yield seen


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in order of the components."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out = out + a[:, i] * b[:, i]
    return out


def best(queries: np.ndarray, members: np.ndarray, least: np.ndarray, count: int, allowed=None) -> Iterator:
    """(query row, member rows, scores) with the ``count`` best members, ties by ``least``; chunks of queries."""
    reach = np.linalg.norm(members, axis=1).max(initial=0)
    for lo in range(0, len(queries), 128):
        q = queries[lo:lo + 128]
        rough = q @ members.T
        if allowed is not None:
            rough[~allowed(lo, lo + len(q))] = -np.inf
        if rough.shape[1] > count:
            limit = np.partition(rough, rough.shape[1] - count, axis=1)[:, -count]
        else:
            limit = np.full(len(q), -np.inf)
        # all that may be among the best: the product below rounds otherwise than this one
        slack = 1e-12 * q.shape[1] * np.linalg.norm(q, axis=1) * reach
        i, j = np.nonzero((rough >= (limit - slack)[:, None]) & (rough > -np.inf))
        score = product(q[i], members[j])
        order = np.lexsort((least[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < count
        yield lo + i[keep], j[keep], score[keep]


def ids_last(values) -> np.ndarray:
    """Ids for sorting, null last."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.fill_null(values.cast(pa.int64()), np.iinfo(np.int64).max).to_numpy()


def classes_of(vectors: DataFrame, nearest: int, every: int) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors (cid, embedding, ids, least) and queries (query_id, cid)."""
    keys = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    rows = vectors.where(usable()).select("vec_id", "embedding", *keys)
    first = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last())
    kept = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= nearest + 1)
    classes = kept.groupBy("embedding").agg(
        F.first("k1").alias("k1"), F.first("k2").alias("k2"),
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "vec_id"))), lambda r: r["vec_id"]).alias("ids"))
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("cid"), "*",
                                         F.element_at("ids", 1).alias("least")), "search-classes")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "k1", "k2")
    queries = asked.join(classes.select("cid", "k1", "k2"), ["k1", "k2"]).select("query_id", "cid")
    return classes.drop("k1", "k2"), materialise(queries, "search-queries")


def sampled(classes: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(cids, vectors) of the n classes of the lowest hash, by length."""
    import pyarrow as pa

    table = classes.orderBy(F.xxhash64("cid"), "cid").limit(n).select("cid", "embedding").toArrow().combine_chunks()
    if not len(table):
        return {}
    column = table.column("embedding")
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    cid = table.column("cid").to_numpy()
    return {d: (cid[rows], points) for d, rows, points in vectors_of(column)}


def true_neighbours(classes: DataFrame, probes: dict, count: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length (probe's number, neighbour's vector) of the probes' best classes of the whole table."""
    schema = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("probe", T.IntegerType()),
                           T.StructField("least", T.LongType()), T.StructField("score", T.DoubleType()),
                           classes.schema["embedding"]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            least = ids_last(batch.column(0))
            for d, rows, points in vectors_of(batch.column(1)):
                if d in probes:
                    for i, j, score in best(probes[d][1], points, least[rows], count):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                             pa.array(least[rows[j]]), pa.array(score), batch.column(1).take(pa.array(rows[j]))],
                            names=schema.names)

    order = Window.partitionBy("d", "probe").orderBy(F.desc("score"), "least")
    rows = classes.select("least", "embedding").mapInArrow(run, schema) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).collect()
    return {d: (np.array([r["probe"] for r in rows if r["d"] == d]),
                np.array([r["embedding"] for r in rows if r["d"] == d], np.float64)) for d in {r["d"] for r in rows}}


def leaves_needed(forest: Forest, probes: np.ndarray, probe: np.ndarray, points: np.ndarray, recall: float) -> int:
    """Least number of leaves with which the queue meets that share of the probes' neighbours."""
    home = forest.place(points) + np.arange(forest.trees) * forest.leaves
    turn = np.empty(forest.trees * forest.leaves, np.int64)
    met = []
    for q, seen in enumerate(forest.search(probes, forest.trees * forest.leaves)):
        turn[seen] = np.arange(1, len(seen) + 1)
        met.append(turn[home[probe == q]].min(1))
    met = np.sort(np.concatenate(met))
    return int(met[max(0, math.ceil(recall * len(met)) - 1)])


def routed(classes: DataFrame, forests: dict[int, Forest], counts_only: bool, cells: dict | None = None,
           blocks: dict | None = None) -> DataFrame:
    """Leaf counts (size, leaf, n), or the members of each cell's blocks."""
    embedding = classes.schema["embedding"]
    schema = "size int, leaf int, n long" if counts_only else T.StructType(
        [T.StructField(n, t) for n, t in (("size", T.IntegerType()), ("cell", T.IntegerType()), ("block", T.IntegerType()),
                                          ("leaf", T.IntegerType()), ("cid", T.LongType()), ("least", T.LongType()))]
        + [embedding])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cid, least = batch.column(0).to_numpy(), ids_last(batch.column(1))
            for d, rows, points in vectors_of(batch.column(2)):
                forest = forests.get(d)
                home = forest.place(points) + np.arange(forest.trees) * forest.leaves if forest \
                    else np.zeros((len(rows), 1), np.int64)
                if counts_only:
                    leaf, n = np.unique(home, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), d, np.int32)),
                                                      pa.array(leaf.astype(np.int32)), pa.array(n)], names=["size", "leaf", "n"])
                    continue
                for t in range(home.shape[1]):
                    cell = cells[d][home[:, t]]
                    # a hash of the id deals members to the cell's blocks
                    block = (cid[rows] * 0x9E3779B1 >> 16) % blocks[d][cell]
                    for lo in range(0, len(rows), 2000):
                        s = slice(lo, lo + 2000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows[s]), d, np.int32)), pa.array(cell[s].astype(np.int32)),
                             pa.array(block[s].astype(np.int32)), pa.array(home[s, t].astype(np.int32)),
                             pa.array(cid[rows[s]]), pa.array(least[rows[s]]), batch.column(2).take(pa.array(rows[s]))],
                            names=schema.names)

    return classes.select("cid", "least", "embedding").mapInArrow(run, schema)


def asked(queries: DataFrame, forests: dict[int, Forest], budget: dict[int, int], cells: dict) -> DataFrame:
    """One row for each query class and cell, with the leaves it sees there."""
    schema = T.StructType([T.StructField("size", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                           T.StructField("query", T.LongType()), T.StructField("leaves", T.ArrayType(T.IntegerType())),
                           queries.schema["embedding"]])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cid = batch.column(0).to_numpy()
            for d, rows, points in vectors_of(batch.column(1)):
                forest = forests.get(d)
                found = forest.search(points, budget[d]) if forest else iter([[0]] * len(rows))
                for lo in range(0, len(rows), 500):
                    who, cell, leaves = [], [], []
                    for i in range(lo, min(lo + 500, len(rows))):
                        seen = np.sort(np.array(next(found)))
                        own = cells[d][seen]
                        cut = np.flatnonzero(np.diff(own)) + 1
                        for part in np.split(np.arange(len(seen)), cut):
                            who.append(rows[i])
                            cell.append(own[part[0]])
                            leaves.append(seen[part])
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(who), d, np.int32)), pa.array(np.array(cell, np.int32)), pa.array(cid[who]),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(leaves).astype(np.int32))),
                         batch.column(1).take(pa.array(who))], names=schema.names)

    return queries.select("cid", "embedding").mapInArrow(run, schema)


def compare(members: DataFrame, questions: DataFrame, count: int) -> DataFrame:
    """The best members of each query in each block: query, cid, least, score."""
    def run(left, right):
        import pyarrow as pa

        if not len(left) or not len(right):
            return pa.table({"query": pa.array([], pa.int64()), "cid": pa.array([], pa.int64()),
                             "least": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        flat = lambda table: next(vectors_of(pa.concat_arrays(table.column("embedding").chunks)))[2]
        points, asking = flat(left), flat(right)
        cid, least = left.column("cid").to_numpy(), left.column("least").to_numpy()
        query = right.column("query").to_numpy()
        leaf = left.column("leaf").to_numpy()
        known, own = np.unique(leaf, return_inverse=True)
        leaves = pa.concat_arrays(right.column("leaves").chunks)
        ends = np.concatenate([[0], np.cumsum(leaves.value_lengths().to_numpy())])
        wanted = leaves.flatten().to_numpy()
        row = np.repeat(np.arange(len(query)), np.diff(ends))
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        there = known[at] == wanted
        seen = np.zeros((len(query), len(known)), bool)
        seen[row[there], at[there]] = True
        out = list(best(asking, points, least, count, lambda lo, hi: seen[lo:hi][:, own]))
        i, j, score = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query": query[i], "cid": cid[j], "least": least[j], "score": score})

    keys = ["size", "cell", "block", "turn"]
    return members.groupBy(*keys).cogroup(questions.groupBy(*keys)).applyInArrow(
        run, "query long, cid long, least long, score double")


def nearest(vectors: DataFrame, count: int = NEAREST, every: int = EVERY, recall: float = RECALL,
            trees: int = TREES) -> DataFrame:
    """query_id, rank, vec_id and score of the ``count`` nearest rows found for each query."""
    classes, queries = classes_of(vectors, count, every)
    asking = materialise(classes.join(queries.select("cid").distinct(), "cid", "left_semi"), "search-asking")
    total, sample = classes.count(), sampled(classes, SAMPLE)
    seen = sum(len(ids) for ids, _ in sample.values())
    forests = {d: Forest(points, total * len(ids) // seen, trees) for d, (ids, points) in sample.items()}
    forests = {d: f for d, f in forests.items() if f.depth}
    budget = {d: f.trees * f.leaves for d, f in forests.items()}
    probes = sampled(asking, PROBES)
    for d, (probe, points) in true_neighbours(classes, {d: p for d, p in probes.items() if d in forests}, count).items():
        budget[d] = leaves_needed(forests[d], probes[d][1], probe, points, recall)

    # leaves that follow one another form cells; at most one row a leaf comes to the driver
    cells, blocks, width = {}, {}, {}
    counted = routed(classes, forests, True).groupBy("size", "leaf").agg(F.sum("n").alias("n")).collect()
    for d in {r["size"] for r in counted}:
        forest, most = forests.get(d), max(1, CELL_BYTES // (8 * d))
        n = np.zeros(forest.trees * forest.leaves if forest else 1, np.int64)
        for r in counted:
            if r["size"] == d:
                n[r["leaf"]] = r["n"]
        cell, used, at = np.zeros(len(n), np.int64), 0, 0
        for leaf in range(len(n)):
            if leaf and (used + n[leaf] > most or (forest and leaf % forest.leaves == 0)):
                at, used = at + 1, 0
            cell[leaf] = at
            used += n[leaf]
        cells[d], width[d] = cell, most
        blocks[d] = np.maximum(1, -(-np.bincount(cell, n).astype(np.int64) // most))
    questions = materialise(asked(asking, forests, budget, cells), "search-questions")
    members = routed(classes, forests, False, cells, blocks)

    # a cell that many queries see is met by them in turns; both tables have at most a row a leaf
    spark = classes.sparkSession
    turns = {(r["size"], r["cell"]): -(-r["n"] // (4 * width[r["size"]]))
             for r in questions.groupBy("size", "cell").agg(F.count("*").alias("n")).collect()}
    dealt = spark.createDataFrame([(int(d), c, int(blocks[d][c]), int(turns.get((d, c), 0))) for d in cells for c in range(len(blocks[d]))],
                                  "size int, cell int, blocks int, turns int")
    members = members.join(F.broadcast(dealt.select("size", "cell", "turns").where("turns > 0")), ["size", "cell"]) \
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    questions = questions.join(F.broadcast(dealt), ["size", "cell"]) \
        .withColumn("turn", F.pmod(F.xxhash64("query"), F.col("turns")).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "turns")
    found = materialise(compare(members, questions, count + 1), "search-found")

    top = Window.partitionBy("query").orderBy(F.desc("score"), "least", "cid")
    found = found.groupBy("query", "cid").agg(F.first("least").alias("least"), F.first("score").alias("score")) \
        .withColumn("place", F.row_number().over(top)).where(F.col("place") <= count + 1)
    # ids of the best classes; one spare, as the query itself may be among them
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    found = found.join(classes.select("cid", "ids"), "cid") \
        .select("query", "cid", "score", F.explode("ids").alias("vec_id")) \
        .withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= count + 1)
    found = materialise(found.groupBy("query").agg(F.sort_array(F.collect_list(
        F.struct("place", "vec_id", "score", "cid"))).alias("found")), "search-best")
    answered = queries.join(found, F.col("cid") == F.col("query"))
    # the first row with the query's own id and class is its own
    own = F.filter("found", lambda x: x["vec_id"].eqNullSafe(F.col("query_id")) & (x["cid"] == F.col("query")))
    answered = answered.withColumn("skip", F.coalesce(F.get(own, F.lit(0))["place"], F.lit(count + 1)))
    rows = answered.select("query_id", "skip", F.explode(F.filter("found", lambda x: x["place"] != F.col("skip"))).alias("x"))
    return rows.select(
        F.col("query_id").cast("long").alias("query_id"),
        (F.col("x.place") - (F.col("x.place") > F.col("skip")).cast("int")).cast("int").alias("rank"),
        F.col("x.vec_id").cast("long").alias("vec_id"), F.col("x.score").alias("score")).where(F.col("rank") <= count)
