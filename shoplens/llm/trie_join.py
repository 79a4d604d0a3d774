"""Exact n-gram Jaccard join over prefix trees.

A document's set holds 64-bit hashes of its distinct five-word shingles, in
one global order: rare shingles by hash, then the frequent ones by how often
they occur. Of two sets of similarity ``NUM / DEN`` or more, the first three
eighths of both, in that order, have at least an eighth of a set in common
(prefix filter with a long prefix), so

1. equal sets fall together into one class;
2. each class emits its prefix shingles; those that only one class has vanish
   in a streamed pass over the sorted postings;
3. a class with fewer shared prefix shingles than any link needs goes, and so
   do shingles that only one class is left with, in a few rounds; texts that
   meet by chance, in a shingle here and there, are gone before any pair forms;
4. in a few rounds, every class is paired with one hub for each shingle and
   size band (star pairs, as many as postings at most), the pairs are verified
   and joined into components; large groups of near copies are settled here
   without pairing their members, as a rule around the class that shares most.
   After each round, shingles whose classes lie in one component go, and with
   them classes that then share too few for a link to any other component, so
   each round works on what is still open;
5. of the postings that are open in the end, those of a class's rarest shingles
   that no link can do without pair up, by size; a pair survives only if its
   shared prefix shingles plus the remaining lengths can reach the needed
   overlap;
6. surviving pairs are verified like star pairs, and all links together give
   the components.

Verification stores the candidate sets of one probe, in global order, in a
trie (sorted sets with common-prefix lengths), walks it once, shares the
partial overlap of common prefixes, and leaves a branch as soon as the
remaining lengths cannot reach the needed overlap.

Every class pair that meets the threshold ends up in one component; which
shingles count as frequent changes the work, never the result. Class ids are
64-bit digests of sets.

Defined cases: null text and text without a word have the empty set, link with
nothing and are their own component; so do rows without a doc_id, whose
component is null; fewer than five words are one shingle;
rows with the same doc_id are separate nodes that carry the same id; an empty
table gives no rows; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import bounded, components, materialise, small_side, split_words, text_runs

WORDS = 5
NUM, DEN = 3, 4     # similarity of 0.75
LATER = 5, 8        # share of a set after its prefix; less than the similarity
FREQUENT = 65_536   # shingles that the frequent part of the order lists at most
FREQUENT_MIN = 8    # documents that such a shingle occurs in at least
ROUNDS = 3          # of star pairs, each with other hubs, at most
SETTLED = 0.9       # share of the postings left after a round of either kind beyond which no further one is made
BANDS = 4           # bands of sizes from a set's to the least it can link with
PRUNING = 3         # rounds that drop classes with too few shared shingles, at most
MIX = np.uint64(0xBF58476D1CE4E5B9)


def needed(nx, ny):
    """Least overlap of sets of nx and ny shingles at the threshold."""
    return -(-NUM * (nx + ny) // (NUM + DEN))


def rest(n):
    """Shingles of a set of n after its prefix."""
    return max(0, LATER[0] * n // LATER[1] - 1)


def prefix_length(n):
    return n - rest(n)


def least_shared(n: F.Column) -> F.Column:
    """Prefix shingles that a set of n has in common with those of any set it links with.

    The prefix that ends first lies within what the other prefix spans, so the
    two share the needed overlap but for the rest of one of them. That is least
    for the smallest partner (NUM / DEN of n), or, as rounding goes, the largest.
    """
    smallest = F.ceil(F.lit(NUM) * n / DEN) - rest_of(n)
    largest = F.ceil(n * (LATER[1] * NUM - LATER[0] * DEN) / (LATER[1] * NUM)) + 1
    return F.greatest(F.lit(1), F.least(smallest, largest))


def rest_of(n: F.Column) -> F.Column:
    """``rest`` of a column."""
    return F.greatest(F.lit(0), F.floor(F.lit(LATER[0]) * n / LATER[1]) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow string array."""
    import pyarrow.compute as pc
    import xxhash

    bounds, codes, vocabulary = split_words(pc.ascii_lower(texts))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary.to_numpy(zero_copy_only=False)),
                      np.uint64, len(vocabulary))
    h = own[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        rolled = mix(rolled + h[k:len(h) - words + 1 + k] + np.uint64(k + 1)) if len(rolled) else rolled
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            yield np.unique(rolled[a:b - words + 1])
        else:
            whole = np.zeros(1, np.uint64)
            for k in range(a, b):
                whole = mix(whole + h[k:k + 1] + np.uint64(100 * (b - a) + 1))
            yield whole[:int(b > a)]


class Order:
    """The global order: shingles not in ``frequent`` by hash, then those by rank."""

    def __init__(self, frequent: np.ndarray):
        self.rank = np.argsort(frequent, kind="stable")
        self.known = frequent[self.rank]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.known) or not len(shingles):
            return shingles
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        often = self.known[at] == shingles
        late = shingles[often]
        return np.concatenate([shingles[~often], late[np.argsort(self.rank[at[often]])]])


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Frequent shingles, rarest first; a bounded list that only orders sets.

    Each task keeps the shingles it meets most often, ``FREQUENT`` at most.
    """
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for _, texts in text_runs(batch.column(0)):
                k, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(texts)]), return_counts=True)
                keys, counts = _add(keys, counts, k[n > 1], n[n > 1])
                if len(keys) > 4 * FREQUENT:
                    keys, counts = _most(keys, counts, 2 * FREQUENT)
        keys, counts = _most(keys, counts, FREQUENT)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["s", "n"])

    rows = (bounded(docs.select("text")).mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= FREQUENT_MIN).orderBy(F.desc("n"), "s").limit(FREQUENT).toPandas())
    return rows["s"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def _add(keys, counts, more, n):
    both, inv = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return both, np.bincount(inv, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)


def _most(keys, counts, limit):
    if len(keys) <= limit:
        return keys, counts
    at = np.sort(np.argpartition(-counts, limit)[:limit])
    return keys[at], counts[at]


def class_table(docs: DataFrame, order: Order) -> DataFrame:
    """doc_id, n_shingles, class id (null for empty sets) and the prefix in global order."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("cid", T.LongType()), T.StructField("prefix", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                n, cid, prefix = [], [], []
                known = batch.column(0).slice(first, len(texts)).is_valid().to_pylist()
                for s, named in zip(shingle_sets(texts), known):
                    n.append(len(s))
                    if not named:
                        s = s[:0]
                    cid.append(digest(s) if len(s) else None)
                    prefix.append(order(s)[:prefix_length(len(s))].tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(cid, pa.int64()),
                     pa.array(prefix, pa.binary())], names=schema.names)

    return bounded(docs.select("doc_id", "text")).mapInArrow(run, schema)


def digest(s: np.ndarray) -> int:
    both = mix(s + np.uint64(len(s)))
    return int(mix(both.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def postings(classes: DataFrame) -> DataFrame:
    """(token, n, cid) for the prefix shingles of each class."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw = batch.column(2).to_pylist()
            for lo in range(0, len(raw), 1000):
                part = raw[lo:lo + 1000]
                size = np.array([len(x) // 8 for x in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(part), np.int64)),
                     pa.array(np.repeat(batch.column(1).slice(lo, len(part)).to_numpy(), size)),
                     pa.array(np.repeat(batch.column(0).slice(lo, len(part)).to_numpy(), size))],
                    names=["token", "n", "cid"])

    return classes.select("cid", "n_shingles", "prefix").mapInArrow(run, "token long, n long, cid long")


def shared_postings(rows: DataFrame) -> DataFrame:
    """Postings of shingles that two classes or more share. Rows are streamed in
    shingle order, so no group is held."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, held = None, None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(k).to_numpy() for k in range(3)]
            t = columns[0]
            again = np.append([last is not None and t[0] == last], t[1:] == t[:-1])
            more = np.append(t[:-1] == t[1:], False)
            out = [c[again | more] for c in columns]
            if again[0] and held is not None:
                out = [np.append(c, h) for c, h in zip(out, held)]
            held = None if again[-1] else [c[-1] for c in columns]
            last = t[-1]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["token", "n", "cid"])

    return (rows.repartition("token").sortWithinPartitions("token")
            .mapInArrow(run, "token long, n long, cid long"))


def live_postings(shared: DataFrame) -> DataFrame:
    """The shared postings of classes that can have a link at all."""
    for _ in range(PRUNING):
        before = shared.count()
        shared = materialise(shared_postings(linkable(shared).select("token", "n", "cid")), "trie-live")
        if shared.count() > SETTLED * before:
            break
    return shared


def linkable(rows: DataFrame) -> DataFrame:
    """The postings of classes that have as many as any link needs."""
    live = (rows.groupBy("cid", "n").agg(F.count("*").alias("shared"))
            .where(F.col("shared") >= least_shared(F.col("n"))).select("cid"))
    return rows.join(small_side(live, F.lit(1)), "cid")


def open_postings(placed: DataFrame) -> DataFrame:
    """The placed postings that a link between two components can rest on.

    Classes of different components share only shingles that both hold, so a
    shingle whose classes all lie in one component tells nothing more, and a
    class with too few other shingles links with none outside its own.
    """
    mixed = (placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo != hi").select("token"))
    rows = materialise(placed.join(small_side(mixed, F.lit(1)), "token"), "trie-mixed")
    return materialise(linkable(rows), "trie-open")


def star_pairs(placed: DataFrame, seed: int) -> DataFrame:
    """(a, b): each class with the hub of its shingle and size band, or of the band below.

    Sets that can link lie in the same band or in neighbouring ones. The first
    hub is the class that shares most of its set, as a rule the text from which
    the others were made, which links with all that any near copy of it does;
    with a later seed it is the class of the least seeded hash. Either is mostly
    one for all shingles of a group of near copies; pairs within a component are
    left out.
    """
    rows = placed.withColumn("band", size_band(F.col("n"), 1)).withColumn("own", F.lit(0.0))
    if seed == 0:
        most = placed.groupBy("cid").agg((-F.count("*") / F.max("n")).alias("own"))
        rows = rows.drop("own").join(small_side(most, F.lit(1)), "cid")
    hubs = materialise(rows.groupBy("token", "band").agg(F.min(F.struct(
        "own", F.xxhash64(F.col("cid"), F.lit(seed)).alias("h"), F.col("cid").alias("a"), F.col("n").alias("na"),
        F.col("component").alias("ca"))).alias("hub")).select("token", "band", "hub.*").drop("own", "h"), "trie-hubs")
    near = rows.drop("own").withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    pairs = near.join(hubs, ["token", "band"]).where(
        (F.col("component") != F.col("ca")) & (DEN * F.col("n") >= NUM * F.col("na"))
        & (DEN * F.col("na") >= NUM * F.col("n")))
    counted = pairs.groupBy("a", "na", F.col("cid").alias("b"), F.col("n").alias("nb")).agg(
        (2 * F.count("*")).alias("shared"))  # some of a pair's shingles have another hub
    return counted.where(possible()).select("a", "b")


def size_band(n: F.Column, bands: int) -> F.Column:
    """Number of the size band, ``bands`` of them from a set's size to the least it can link with."""
    return F.floor(F.log(n.cast("double")) / math.log(DEN / NUM) * bands).cast("int")


def shared_with(n: F.Column, m: F.Column) -> F.Column:
    """Prefix shingles that linked sets of n and m have in common at least."""
    return F.ceil(F.lit(NUM) * (n + m) / (NUM + DEN)) - F.greatest(rest_of(n), rest_of(m))


def least_between(n: F.Column, low: F.Column, high: F.Column) -> F.Column:
    """The least of ``shared_with`` over partners of ``low`` to ``high`` shingles.

    It rises up to partners of n and falls from there on, but for a step of
    one that rounding makes.
    """
    return F.greatest(F.lit(1), F.least(shared_with(n, low), shared_with(n, high) - (high > n).cast("int")))


def key_postings(placed: DataFrame) -> DataFrame:
    """The placed postings that suffice to meet every class of another component that a class links with.

    Taken for each class and each size band of partners, the rarest open
    shingles first. A link needs ``least`` of the shingles that a class shares
    with classes there, so the first one that two linked classes have in common
    is no later than the last but ``least - 1`` of either; ``left`` counts the
    shingles from each one on. A class that differs from a large group in more
    than a link allows keeps none of the group's shingles, so the group's classes
    do not pair with it or with one another.
    """
    rows = placed.withColumn("band", size_band(F.col("n"), BANDS))
    held = (rows.groupBy("token", F.col("band").alias("partner"))
            .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("lo"),
                 F.max("component").alias("hi"), F.count("*").alias("held"))
            .withColumn("held", F.sum("held").over(Window.partitionBy("token"))))
    met = (rows.join(held, "token")  # about as large as the postings
           .where((F.abs(F.col("band") - F.col("partner")) <= BANDS + 1)
                  & ((F.col("lo") != F.col("component")) | (F.col("hi") != F.col("component"))))
           .withColumn("low", F.greatest("low", F.ceil(F.lit(NUM) * F.col("n") / DEN)))
           .withColumn("high", F.least("high", F.floor(F.lit(DEN) * F.col("n") / NUM)))
           .where("low <= high"))
    each = Window.partitionBy("cid", "partner")
    ranked = (met.withColumn("least", F.min(least_between(F.col("n"), F.col("low"), F.col("high"))).over(each))
              .withColumn("left", F.row_number().over(each.orderBy(F.desc("held"), F.desc("token")))))
    return materialise(ranked.where("left >= least")
                       .select("token", "band", "partner", "n", "left", "cid", "component"), "trie-keys")


def open_pairs(placed: DataFrame) -> DataFrame:
    """(a, b) of different components that can link by the prefix shingles they share, a < b."""
    keys = key_postings(placed)
    x, y = keys.alias("x"), keys.alias("y")
    met = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.partner") == F.col("y.band"))
                  & (F.col("x.band") == F.col("y.partner")) & (F.col("x.cid") < F.col("y.cid"))
                  & (F.col("x.component") != F.col("y.component"))
                  & (DEN * F.col("x.n") >= NUM * F.col("y.n")) & (DEN * F.col("y.n") >= NUM * F.col("x.n"))
                  & (F.least("x.left", "y.left") >= shared_with(F.col("x.n"), F.col("y.n"))))
           .select(F.col("x.cid").alias("a"), F.col("x.n").alias("na"), F.col("y.cid").alias("b"),
                   F.col("y.n").alias("nb")).distinct())
    held = small_side(placed.groupBy("cid").agg(F.collect_list("token").alias("tokens")), F.size("tokens"))
    both = (met.join(held.select(F.col("cid").alias("a"), F.col("tokens").alias("of_a")), "a")
            .join(held.select(F.col("cid").alias("b"), F.col("tokens").alias("of_b")), "b"))
    return (both.withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
            .where(possible()).select("a", "b"))


def possible() -> F.Column:
    """Can a pair (a, na, b, nb) with ``shared`` common prefix shingles reach the threshold?"""
    after = F.greatest(rest_of(F.col("na")), rest_of(F.col("nb")))
    return F.col("shared") + after >= F.ceil(F.lit(NUM) * (F.col("na") + F.col("nb")) / (NUM + DEN))


def trie_links(probe: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Indices of the sets that link with the probe; all are in global order."""
    at = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
    ranked = np.sort(probe)
    found, before, hits = [], np.zeros(0, np.uint64), np.zeros(1, np.int64)
    for i in at:
        s = sets[i]
        n, goal = len(s), needed(len(probe), len(s))
        m = min(len(before), n)
        differ = np.flatnonzero(before[:m] != s[:m])
        depth = min(int(differ[0]) if len(differ) else m, len(hits) - 1)
        # hits[d]: overlap of the first d shingles on the current path of the trie
        hits = hits[:depth + 1]
        total, alive = int(hits[-1]), True
        while depth < n:
            if total + min(n - depth, len(probe) - total) < goal:
                alive = False
                break
            part = s[depth:depth + 64]
            spot = np.minimum(np.searchsorted(ranked, part), len(ranked) - 1)
            hits = np.concatenate([hits, total + np.cumsum(ranked[spot] == part)])
            depth += len(part)
            total = int(hits[-1])
        before = s
        if alive and total >= goal:
            found.append(i)
    return found


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of linked classes; ``sets`` has cid and shingles in global order.

    Both sides read one shuffle of the sets by class (a reused exchange).
    """
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = []
            for probe in np.unique(a):
                at = np.flatnonzero(a == probe)
                own = np.frombuffer(batch.column(2)[int(at[0])].as_py(), np.uint64)
                out += at[trie_links(own, [np.frombuffer(batch.column(3)[int(i)].as_py(), np.uint64)
                                           for i in at])].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a[out]), pa.array(b[out])], names=["a", "b"])

    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")
    return bounded(both).mapInArrow(run, "a long, b long")


def sets_of(docs: DataFrame, members: DataFrame, pairs: DataFrame, order: Order) -> DataFrame:
    """cid and shingles in global order of the classes that occur in ``pairs``."""
    wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    ids = small_side(members.join(wanted, "cid").groupBy("cid").agg(F.min("doc_id").alias("doc_id")), F.lit(2))
    schema = "cid long, shingles binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                ids, out = batch.column(0).slice(first, len(texts)).to_numpy(), []
                for cid, s in zip(ids, shingle_sets(texts)):
                    out.append(order(s).tobytes() if len(s) and digest(s) == cid else None)
                keep = [i for i, x in enumerate(out) if x is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[keep]), pa.array([out[i] for i in keep], pa.binary())],
                    names=["cid", "shingles"])

    # rows that share a doc_id may hold other texts, whose digest differs
    return bounded(docs.select("doc_id", "text").join(ids, "doc_id").select("cid", "text")) \
        .mapInArrow(run, schema).dropDuplicates(["cid"])


def place(rows: DataFrame, settled: DataFrame) -> DataFrame:
    """Adds the component of each row's class, which is its own if it has no link."""
    return rows.join(settled.withColumnRenamed("id", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    order = Order(frequent_shingles(docs))
    table = materialise(class_table(docs, order), "trie-classes")
    members = table.where("cid is not null").select("doc_id", "cid")
    one = small_side(members.groupBy("cid").agg(F.min("doc_id").alias("doc_id")), F.lit(2))
    classes = table.join(one, ["cid", "doc_id"])  # prefixes move only if the classes are many
    shared = live_postings(materialise(shared_postings(postings(classes)), "trie-postings"))

    placed, links, tried, settled = shared.withColumn("component", F.col("cid")), None, None, None
    for seed in range(ROUNDS):
        star = star_pairs(placed, seed)
        if tried is not None:
            star = star.join(tried, ["a", "b"], "left_anti")
        star = materialise(star, "trie-star")
        if star.isEmpty():
            break
        found = materialise(verified(star, sets_of(docs, members, star, order)), "trie-links")
        tried = star if tried is None else tried.unionByName(star)
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            break
        # between rounds, classes linked to one hub count as settled with it
        heads = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
        before, placed = placed.count(), open_postings(place(placed.drop("component"), heads))
        if placed.count() > SETTLED * before:
            break
    if links is not None and not links.isEmpty():
        settled = components(links, "trie-cc")
        placed = open_postings(place(placed.drop("component"), settled))
    pairs = open_pairs(placed)
    if tried is not None:
        tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    pairs = materialise(pairs, "trie-pairs")
    if not pairs.isEmpty():
        more = materialise(verified(pairs, sets_of(docs, members, pairs, order)), "trie-links")
        settled = components(more if links is None else links.unionByName(more), "trie-cc")

    rooted = table.withColumn("component", F.col("cid")) if settled is None else place(table, settled)
    rows = materialise(rooted.select("doc_id", "n_shingles", F.col("component").alias("_root")), "trie-rooted")
    least = materialise(rows.where("_root is not null").groupBy("_root").agg(F.min("doc_id").alias("component_id")),
                        "trie-least")
    return rows.join(least, "_root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
