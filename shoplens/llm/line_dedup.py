"""Line deduplication over a deletion neighbourhood.

Lines are compared as sequences of lower-cased words. A line goes when an
earlier line, of any document, is equal to it, or, for lines of at least
``NEAR_WORDS`` words, lies within one word edit (a word replaced, inserted or
deleted). "Earlier" is by (doc_id, line number); the earliest line stays.
Lines of fewer than ``MIN_WORDS`` words always stay.

Equal lines fall together first. Two lines within one edit agree on their
first or their last half, so only lines that share a half with another one go
on. Those emit all their variants with one word deleted as hashed keys, next
to the line itself; a streamed pass over the sorted keys meets every pair of
lines that one edit joins: equal variants at one place are a replacement, and
a line equal to a variant is an insertion or deletion. No group is held in
memory. Each pair's edit distance is verified on the words, and a class of
equal lines whose earliest occurrence has an earlier neighbour goes whole.

Defined cases (doc_id is an integer): null and empty text stay as they are;
rows without a doc_id have no place, so they stay as they are and no line goes
because of them; rows that share a doc_id are taken as copies of one document,
so that a line number that goes in one goes in all; the white space of kept
lines is kept; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import bounded, byte_runs, fresh, materialise, small_side, split_words, text_runs

MIN_WORDS = 3
NEAR_WORDS = 5
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
TWIST = np.uint64(0xD6E8FEB86659FD93)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Lines:
    """Word hashes of the lines of an Arrow string array, and hashes of their parts."""

    def __init__(self, texts):
        import pyarrow.compute as pc
        import xxhash

        lists = pc.split_pattern(texts, "\n")
        self.text = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
        self.count = np.diff(lists.offsets.to_numpy())
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.number = np.arange(len(self.doc)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.bounds, codes, words = split_words(pc.ascii_lower(self.text))
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_numpy(zero_copy_only=False)),
                          np.uint64, len(words))
        self.words = np.diff(self.bounds)
        self.hash = own[codes] if len(codes) else np.zeros(0, np.uint64)
        self.up, self.down = powers(BASE, len(codes)), powers(INVERSE, len(codes))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hash * self.up[:-1])])

    def part(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a to b, the same wherever they stand."""
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def deleted(self, a: int, b: int) -> np.ndarray:
        """Hashes of the line of words a to b with each word left out in turn."""
        at = np.arange(a, b)
        return ((self.sums[at] - self.sums[a]) + (self.sums[b] - self.sums[at + 1]) * INVERSE) * self.down[a]


def final(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * TWIST
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, line, words, key, and the half keys of long lines, for lines of MIN_WORDS or more."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("line", T.IntegerType()),
                           T.StructField("words", T.IntegerType()), T.StructField("key", T.LongType()),
                           T.StructField("halves", T.ArrayType(T.LongType()))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                x = Lines(texts)
                at = np.flatnonzero(x.words >= MIN_WORDS)
                a, b, n = x.bounds[:-1][at], x.bounds[1:][at], x.words[at]
                key = final(x.part(a, b) + n.astype(np.uint64))
                far = n >= NEAR_WORDS
                halves = half_keys(x, a[far], b[far], n[far])
                offsets = np.concatenate([[0], np.cumsum(4 * far)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + x.doc[at])), pa.array(x.number[at].astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(key),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(halves.reshape(-1)))],
                    names=schema.names)

    return bounded(docs.where("doc_id is not null").select("doc_id", "text")).mapInArrow(run, schema)


def half_keys(x: Lines, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Keys of the halves that one edit may leave as they are.

    Lines of n words, and lines of n + 1 seen as n and one more, agree on the
    first n // 2 words or on the last n - n // 2.
    """
    out = []
    for m in (n, n - 1):
        half = m // 2
        tag = m.astype(np.uint64) * np.uint64(2)
        out += [final(x.part(a, a + half) * TWIST + tag), final(x.part(b - (m - half), b) * TWIST + tag + np.uint64(1))]
    return np.stack(out, 1) if len(a) else np.zeros((0, 4), np.int64)


def sharing(keys: DataFrame) -> DataFrame:
    """cid of each row (key, cid) whose key has two rows or more; streamed."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, held = None, None
        for batch in batches:
            if not len(batch):
                continue
            k, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            again = np.append([last is not None and k[0] == last], k[1:] == k[:-1])
            more = np.append(k[:-1] == k[1:], False)
            out = c[again | more]
            if again[0] and held is not None:
                out = np.append(out, held)
            held = None if again[-1] else c[-1]
            last = k[-1]
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out)], names=["cid"])

    return keys.repartition("key").sortWithinPartitions("key").select("key", "cid").mapInArrow(run, "cid long")


def variants(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted lines (cid, doc_id, line) with their words and deletion keys."""
    schema = T.StructType([T.StructField("cid", T.LongType()), docs.schema["doc_id"],
                           T.StructField("line", T.IntegerType()), T.StructField("text", T.StringType()),
                           T.StructField("whole", T.LongType()), T.StructField("deleted", T.ArrayType(T.LongType()))])
    lists = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("line", "cid")).alias("lines"))  # one text's lines
    rows = docs.select("doc_id", "text").join(small_side(lists, F.size("lines") + 4), "doc_id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first, texts in text_runs(batch.column(1), 2_000_000):
                x = Lines(texts)
                start = np.cumsum(x.count) - x.count
                out = []
                for i in range(len(texts)):
                    for want in batch.column(2)[first + i].as_py():
                        at = int(start[i]) + want["line"]
                        if want["line"] >= x.count[i]:
                            continue  # another row of this doc_id
                        a, b = int(x.bounds[at]), int(x.bounds[at + 1])
                        n = np.uint64(b - a)
                        if b - a < NEAR_WORDS or final(x.part(np.array([a]), np.array([b])) + n)[0] != want["cid"]:
                            continue
                        whole = final(x.part(np.array([a]), np.array([b])) * TWIST + n)[0]
                        gone = final(x.deleted(a, b) * TWIST + n - np.uint64(1))
                        out.append((want["cid"], first + i, want["line"], x.text[at].as_py(), whole, gone))
                if out:
                    cid, doc, line, text, whole, gone = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cid, pa.int64()), batch.column(0).take(pa.array(doc, pa.int64())),
                         pa.array(line, pa.int32()), pa.array(text, pa.string()), pa.array(whole, pa.int64()),
                         pa.array(gone, pa.list_(pa.int64()))], names=schema.names)

    return bounded(rows.select("doc_id", "text", "lines")).mapInArrow(run, schema)


def neighbours(lines: DataFrame) -> DataFrame:
    """(later, earlier) class ids of lines that one word edit joins.

    Keys are streamed in (key, place, position) order: the line that equals a
    variant comes first, then the variants of each place, earliest line first.
    """
    keys = lines.select("cid", F.col("doc_id").cast("long").alias("doc"), "line",
                        F.posexplode(F.concat(F.array("whole"), "deleted")).alias("spot", "key"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, whole, spot, head = None, None, None, None
        for batch in batches:
            key, place, doc, line, cid = (batch.column(k).to_numpy() for k in range(5))
            if not len(key):
                continue
            same = np.append(last is not None and key[0] == last, key[1:] == key[:-1])
            more = np.append(key[:-1] == key[1:], True)  # the next batch may go on
            late, early = [], []
            for i in np.flatnonzero(same | more):
                if not same[i]:
                    whole, spot, head = None, None, None
                own = (doc[i], line[i], cid[i])
                if place[i] == 0:
                    whole = own
                    continue
                if whole is not None and whole[2] != own[2]:
                    late.append(max(whole, own)[2])
                    early.append(min(whole, own)[2])
                if place[i] != spot:
                    spot, head = place[i], own
                elif head[2] != own[2]:
                    late.append(own[2])
                    early.append(head[2])
            last = key[-1]
            if late:
                yield pa.RecordBatch.from_arrays([pa.array(late, pa.int64()), pa.array(early, pa.int64())],
                                                 names=["later", "earlier"])

    return (keys.repartition("key").sortWithinPartitions("key", "spot", "doc", "line", "cid")
            .select("key", "spot", "doc", "line", "cid").mapInArrow(run, "later long, earlier long").distinct())


def one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Is the edit distance of two word sequences at most one?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs whose words are within one edit."""
    left = lines.select(F.col("cid").alias("later"), F.col("text").alias("text_a"))
    right = lines.select(F.col("cid").alias("earlier"), F.col("text").alias("text_b"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            a, b = (pc.ascii_lower(batch.column(k)).to_pylist() for k in (1, 2))
            ok = [one_edit(x.encode().split(), y.encode().split()) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_()))], names=["cid"])

    return pairs.join(left, "later").join(right, "earlier").select("later", "text_a", "text_b") \
        .mapInArrow(run, "cid long").distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id and line of every line that goes."""
    table = materialise(line_table(docs), "line-table")
    first = F.min(F.struct("doc_id", "line")).alias("first")
    classes = materialise(table.groupBy("key").agg(first, F.count("*").alias("n"), F.max("words").alias("words"),
                                                   F.first("halves").alias("halves")), "line-classes")
    far = classes.where(F.col("words") >= NEAR_WORDS)
    close = sharing(far.select(F.col("key").alias("cid"), F.explode("halves").alias("key"))).distinct()
    close = materialise(far.select(F.col("key").alias("cid"), "first.*").join(close, "cid"), "line-close")
    lines = materialise(variants(docs, close).dropDuplicates(["cid"]), "line-variants")
    gone = materialise(verified(neighbours(lines), lines), "line-near").withColumnRenamed("cid", "key")

    hit = materialise(classes.join(gone.withColumn("near", F.lit(True)), "key", "left")
                      .where((F.col("n") > 1) | F.col("near")).select("key", "first", "near"), "line-hit")
    return table.select("doc_id", "line", "key").join(hit, "key") \
        .where(F.col("near") | ~F.struct("doc_id", "line").eqNullSafe(F.col("first"))).select("doc_id", "line")


def strip_lines(docs: DataFrame, gone: DataFrame) -> tuple[DataFrame, str, str]:
    """(rows, lines, removed): all columns of ``docs`` with the lines (doc_id, line)
    of ``gone`` taken out of text, and the names of two more columns that say how
    many lines there were and how many went."""
    out, lines, removed = (fresh(docs, n) for n in ("_gone", "_lines", "_removed"))
    lists = gone.groupBy("doc_id").agg(F.collect_set("line").alias(out))  # one text's lines
    named = docs.join(small_side(lists, F.size(out) + 4), "doc_id", "left").select(*docs.columns, out)
    schema = T.StructType([*docs.schema, T.StructField(lines, T.LongType()), T.StructField(removed, T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in byte_runs(size + 100):
                part = batch.slice(lo, hi - lo)
                texts, all_lines, went = [], [], []
                for text, drop in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                    split = (text or "").split("\n")
                    drop = set(drop or ())
                    kept = [x for i, x in enumerate(split) if i not in drop] if drop else split
                    texts.append("\n".join(kept) if drop else text)
                    all_lines.append(len(split))
                    went.append(len(split) - len(kept))
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(all_lines, pa.int64()), pa.array(went, pa.int64())],
                                                 names=schema.names)

    return bounded(named).mapInArrow(run, schema), lines, removed


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """(rows, lines, removed) as ``strip_lines`` gives them, without the repeated lines."""
    return strip_lines(docs, materialise(repeated_lines(docs), "line-gone"))


def dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that stays, for every row."""
    rows, lines, removed = dedup_lines(docs.select("doc_id", "text"))
    return rows.select("doc_id", F.col(lines).alias("n_lines"), F.col(removed).alias("n_removed"),
                       F.col("text").alias("kept_text"))
