"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import scratch_path

# Bytes of text that one run of a batch may hold; bounds what is alive at once
# whatever the batch size. A longer text makes a run of its own.
SLICE_BYTES = 2_000_000

# Bytes that Spark sends a Python worker at once. Its own bound of 64 MB, or
# 10,000 rows, is held by each task as grown buffers in the JVM, as a message
# and as a batch in the worker.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file on the machine that calls this."""
    import public_tokenizers

    return public_tokenizers.path(name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives the next steps a
    table whose rows and partitions do not change between reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components: (id, component) for every id in an edge.

    ``edges`` has columns a and b. Large-star and small-star rounds, each an
    aggregation and a join on DataFrames written to the shared folder, until
    the edge set no longer changes; every node then points to the smallest id
    of its component. Self-edges and repeated edges are fine.
    """
    def digest(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = materialise(e, f"{name}-edges")
    before = digest(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first, so that both sides of the join are shuffled and a hot node can be split
        low = materialise(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), f"{name}-low")
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialise(large, f"{name}-large")
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("p")).select("p.*")
        e = materialise(small.where("u != v").distinct(), f"{name}-small")
        after = digest(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def small_side(df: DataFrame, weight: Column, limit: int = 4_000_000) -> DataFrame:
    """``df``, written and counted, with a broadcast hint if its weights sum to ``limit`` at most.

    The other side of the join, as a rule whole texts, then need not move;
    beyond the limit Spark shuffles both sides as usual.
    """
    df = materialise(df, "small-side")
    total = df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def byte_runs(sizes, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of items whose ``sizes`` sum to about ``limit``; a larger item is a run of its own.

    After the last one, free memory goes back to the system, so that what an
    idle worker holds does not add up.
    """
    import numpy as np

    end, lo = np.cumsum(sizes), 0
    while lo < len(end):
        before = end[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(end, before + limit, "right")))
        yield lo, hi
        lo = hi
    give_back()


def give_back() -> None:
    """Return free memory of Arrow and of the C library to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bounded(df: DataFrame) -> DataFrame:
    """``df``, which its session sends to Python in batches of ``BATCH_BYTES`` from now on.

    A larger row makes a batch of its own. A bound that the session was given
    stays. The setting counts when the rows are read, so it is not taken back.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH, None) is None:
        conf.set(BATCH, str(BATCH_BYTES))
    return df


def text_runs(column, limit: int = SLICE_BYTES) -> Iterator:
    """(first row, Arrow string array) runs of about ``limit`` bytes; null reads as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    for lo, hi in byte_runs(pc.binary_length(column).to_numpy(zero_copy_only=False), limit):
        yield lo, column.slice(lo, hi - lo)


def split_words(texts):
    """Words ``[^\\x20\\x09-\\x0D]+`` of an Arrow string array.

    Returns (bounds, codes, words): text i has the words
    ``words[codes[bounds[i]:bounds[i + 1]]]``; ``words`` are distinct and none
    is empty.
    """
    import numpy as np
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(texts)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    coded = flat.dictionary_encode()
    codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    blank = pc.index(words, "").as_py()  # next to white space at either end of a text
    if blank >= 0:
        full = codes != blank
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        codes = codes[full]
        codes -= codes > blank
        words = words.filter(pc.not_equal(words, ""))
    return bounds, codes, words


def spread(values, codes, bounds):
    """Concatenated values of coded items.

    ``values`` are little-endian unsigned 32-bit strings, one for each code.
    Returns (ids, bounds of ids) for the items' ``bounds``.
    """
    import numpy as np

    pool = np.frombuffer(b"".join(values), "<u4")
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    first = np.concatenate([[0], np.cumsum(size)])
    each = size[codes]
    end = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(first[codes] - end[:-1], each)
    at += np.arange(len(at))
    return pool[at], end[bounds]


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others take the characters from
    256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each new word once.

    The word-level tokenizer drops white space and never looks across it, so
    the ids of a text are the ids of its white-space-separated words, one
    after the other. A word of printable Latin-1 is lower-cased and cut by the
    tokenizer's own pattern, and the library's model encodes each new piece;
    any other word, and one that may hold a special token, goes through the
    whole library. A piece that is met as a word has the same ids, so both are
    kept in one table, which is bounded: at ``limit`` entries it starts anew.
    """

    def __init__(self, path: str, limit: int = 400_000):
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.limit = limit
        self.known: dict[str, bytes] = {}
        # Latin-1 letters need no normalising but lower case, and all are letters.
        self.plain = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
        self.cut = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall
        self.shown = byte_characters()
        self.raw = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]

    def _piece(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.shown)
        ids = self.raw
        got = self.known[piece] = b"".join([ids[t.id] for t in self.model.tokenize(raw)])
        return got

    def _word(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or self.plain(word)):  # one piece
            piece = word.lower()
            return self.known.get(piece) or self._piece(piece)
        if self.plain(word) and "<|" not in word:
            known = self.known
            return b"".join([known[p] if p in known else self._piece(p) for p in self.cut(word.lower())])
        ids = self.library.encode(word, add_special_tokens=False).ids
        return b"".join([self.raw[i] for i in ids])

    def words(self, words: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word."""
        if len(self.known) > self.limit:
            self.known.clear()
        known, out = self.known, []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._word(w)
            out.append(ids)
        return out

    def encode(self, texts):
        """(ids, bounds) of an Arrow string array: text i has ids[bounds[i]:bounds[i + 1]]."""
        bounds, codes, words = split_words(texts)
        return spread(self.words(words.to_numpy(zero_copy_only=False)), codes, bounds)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, limit: int = 400_000) -> WordEncoder:
    """The encoder of this Python worker, made on first use."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = WordEncoder(path, limit)
        give_back()  # what reading the file took
    return _ENCODERS[path, limit]
