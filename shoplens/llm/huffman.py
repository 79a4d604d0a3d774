"""Token-id files: canonical length-limited Huffman code in independent blocks.

A token file is a folder with three tables:

* ``codebook``: (id, bits), the code length of every id that occurs. Codes are
  canonical, so the lengths are the whole code.
* ``blocks``: one row per run of whole documents of about ``BLOCK_IDS`` ids:
  part, block, start (ids before it in its part), doc_ids, lengths,
  checkpoints (little-endian unsigned 32-bit bit offsets of every
  ``CHECK_IDS``-th id) and payload (codes, most significant bit first). Files
  and rows stand in ascending doc_id order; each block decodes by itself.
* ``parts``: (part, part_start), the ids before each part.

Ids are counted over the whole corpus; only one count for each id of the
vocabulary reaches the driver, which fixes the code lengths by package-merge.

Defined cases: null and empty text give a document of the end id alone; rows
with the same doc_id are separate documents, in the order of their ids; a null
doc_id comes first; a document longer than a block makes a block of its own;
an empty table gives an empty file; input columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import byte_runs, materialise, text_runs, tokenizer_file, word_encoder
from shoplens.session import scratch_path

END_ID = 1
MAX_BITS = 20
BLOCK_IDS = 65_536
CHECK_IDS = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` bits (package-merge).

    ``counts`` are positive; needs at most ``2 ** max_bits`` of them.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need codes of more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        is_leaf.append(at < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code from (ids, bits): encoding and table-driven decoding."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        at = np.lexsort((ids, bits))
        self.ids, self.bits = ids[at].astype(np.int64), bits[at].astype(np.int64)
        self.top = int(self.bits[-1]) if len(bits) else 0
        # in steps of the longest code, canonical codes are running sums
        span = np.int64(1) << (self.top - self.bits)
        self.codes = (np.cumsum(span) - span) >> (self.top - self.bits)
        self.span = span

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1 if len(self.ids) else 0
        codes, bits = np.zeros(size, np.int64), np.zeros(size, np.int64)
        codes[self.ids], bits[self.ids] = self.codes, self.bits
        return codes, bits

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """For each ``top``-bit window: the id it begins with, and its bits."""
        size = 1 << self.top
        sym, bits = np.zeros(size, np.uint32), np.ones(size, np.int64)
        used = int(self.span.sum())
        sym[:used] = np.repeat(self.ids, self.span)
        bits[:used] = np.repeat(self.bits, self.span)
        return sym, bits


def encode_block(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of one block."""
    size = bits[ids]
    end = np.cumsum(size)
    begin = end - size
    word = (codes[ids] << (32 - (begin & 7) - size)).astype(">u4").view(np.uint8).reshape(-1, 4)
    n = (int(end[-1]) + 7) // 8
    out = np.zeros(n + 4)
    for k in range(4):  # codes do not overlap, so their bytes add up
        out += np.bincount((begin >> 3) + k, weights=word[:, k], minlength=n + 4)[:n + 4]
    return out[:n].astype(np.uint8).tobytes(), begin[::CHECK_IDS].astype("<u4").tobytes()


def decode_block(payload: bytes, checkpoints: bytes, n: int, sym: np.ndarray, bits: np.ndarray,
                 top: int) -> np.ndarray:
    """The block's n ids."""
    return decode_blocks([(payload, checkpoints, n)], sym, bits, top)[0]


def decode_blocks(blocks: list[tuple[bytes, bytes, int]], sym: np.ndarray, bits: np.ndarray,
                  top: int) -> list[np.ndarray]:
    """The ids of blocks (payload, checkpoints, n); all checkpoints are followed side by side."""
    raw = np.frombuffer(b"".join([payload + bytes(8) for payload, _, _ in blocks]), np.uint8).astype(np.uint32)
    window = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    marks = [np.frombuffer(m, "<u4").astype(np.int64) for _, m, _ in blocks]
    room = np.array([8 * len(payload) + 64 for payload, _, _ in blocks])
    begin = np.cumsum(room) - room
    held = np.array([len(m) for m in marks])
    at = np.concatenate(marks) + np.repeat(begin, held)
    last = np.repeat(begin + room - 32, held)
    out = np.empty((CHECK_IDS, len(at)), np.uint32)
    drop = np.uint32(32 - top)
    for k in range(min(CHECK_IDS, max(n for _, _, n in blocks))):
        part = (window[at >> 3] << (at & 7).astype(np.uint32)) >> drop
        out[k] = sym[part]
        at = np.minimum(at + bits[part], last)  # the last run of a block may end early
    end = np.cumsum(held)
    return [out[:, e - h:e].T.reshape(-1)[:n] for e, h, (_, _, n) in zip(end, held, blocks)]


def token_table(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID) -> DataFrame:
    """doc_id and ids, as little-endian unsigned 16-bit integers where they fit, else 32."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = word_encoder(tokenizer_file(tokenizer))
        kind = _kind(enc.library.get_vocab_size())
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                ids, bounds = enc.encode(texts)
                ids = ids.astype(kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.array([ids[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:])], pa.binary())],
                    names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _vocabulary(tokenizer: str) -> int:
    return word_encoder(tokenizer_file(tokenizer)).library.get_vocab_size()


def id_counts(tokens: DataFrame, vocabulary: int) -> DataFrame:
    """(id, n) over all documents; every task adds its own counts first."""
    kind = _kind(vocabulary)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind),
                                 minlength=vocabulary)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(total[ids])],
                                         names=["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json",
                 end_id: int = END_ID) -> None:
    """Encode all documents and write the token file at ``path``."""
    spark = docs.sparkSession
    vocabulary = _vocabulary(tokenizer)
    kind = _kind(vocabulary)
    tokens = materialise(token_table(docs, tokenizer, end_id), "huffman-ids")
    found = id_counts(tokens, vocabulary).toPandas().sort_values("id")
    ids = found["id"].to_numpy(np.int64)
    bits = code_lengths(found["n"].to_numpy(np.int64))
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits)], "id int, bits int") \
        .coalesce(1).write.parquet(f"{path}/codebook")

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("checkpoints", T.BinaryType()), T.StructField("payload", T.BinaryType())])

    def blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        codes, size = Code(ids, bits).encoder()
        part, block, start = TaskContext.get().partitionId(), 0, 0
        keys, runs, held = [], [], 0

        def done():
            nonlocal block, start, keys, runs, held
            payload, marks = encode_block(np.concatenate(runs).astype(np.int64), codes, size)
            out = pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "start": start, "n_ids": held, "doc_ids": keys,
                "lengths": [len(r) for r in runs], "checkpoints": marks, "payload": payload}],
                schema=arrow)
            block, start, keys, runs, held = block + 1, start + held, [], [], 0
            return out

        arrow = None
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([
                    ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()),
                    ("n_ids", pa.int64()), ("doc_ids", pa.list_(batch.column(0).type)),
                    ("lengths", pa.list_(pa.int64())), ("checkpoints", pa.binary()),
                    ("payload", pa.binary())])
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                runs.append(np.frombuffer(raw.as_py(), kind))
                held += len(runs[-1])
                if held >= BLOCK_IDS:
                    yield done()
        if keys:
            yield done()

    (tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks"))
    totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each file of blocks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")) \
        .write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit), decoded from a token file."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    ids, bits = book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64)
    table = spark.read.parquet(f"{path}/blocks").join(spark.read.parquet(f"{path}/parts"), "part")
    schema = T.StructType([
        T.StructField("doc_id", table.schema["doc_ids"].dataType.elementType),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType())])

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        code = Code(ids, bits)
        sym, size = code.decoder()
        for batch in batches:
            for lo, hi in byte_runs(4 * batch.column(2).to_numpy(zero_copy_only=False)):
                rows = [[batch.column(k)[i].as_py() for k in range(1, 6)] for i in range(lo, hi)]
                decoded = decode_blocks([(payload, marks, n) for _, n, _, marks, payload in rows], sym, size, code.top)
                for i, (start, _, lengths, _, _), got in zip(range(lo, hi), rows, decoded):
                    end = np.cumsum(lengths)
                    begin = end - lengths
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[i].values, pa.array(start + begin), pa.array(lengths, pa.int64()),
                         pa.array([got[a:b].tobytes() for a, b in zip(begin, end)], pa.binary())],
                        names=schema.names)

    return table.select("doc_ids", (F.col("part_start") + F.col("start")).alias("start"), "n_ids", "lengths",
                        "checkpoints", "payload").mapInArrow(decode, schema)


def round_trip_digest(docs: DataFrame) -> DataFrame:
    """Writes the token file and reads it back: start, n_tokens and checksum per document."""
    path = scratch_path(docs.sparkSession, "token-file")
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
