"""Byte-level byte-pair encoding and decoding with a two-tier lookup.

A text is cut by the public pattern; a pre-token that is in the vocabulary as
a whole is found through a minimal perfect hash (two array reads and one
comparison), any other one is merged from single bytes with a heap over
linked neighbours. Decoding reads each id's bytes from one pool.

Defined cases: null and empty text have no ids and decode to no bytes; texts
are never cut; rows with the same doc_id are encoded separately; an empty
table gives no rows; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import byte_runs, spread, text_runs, tokenizer_file

VOCABULARY = "byte_bpe_50k.tiktoken"
RUN_BYTES = 4_000_000
MATCHES = 1_000_000  # pre-tokens that are looked up at once; a longer text is encoded in parts
KEPT_BYTES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, none empty.

    Keys fall into buckets by one hash; the largest bucket first, each takes
    the first displacement that puts all its keys on free slots. A bucket of
    one key names its slot outright. A string that is no key gets some slot
    too, so the caller compares the key that stands there.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n)
        own = self.hashes(keys)
        if len(np.unique(own)) < n:
            raise ValueError("repeated keys")
        bucket = own % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        slot_of = np.empty(n, np.int64)
        taken = np.zeros(n, bool)
        spare = None
        for b in np.argsort(-np.diff(bounds), kind="stable"):
            at = order[bounds[b]:bounds[b + 1]]
            if not len(at):
                break
            if len(at) == 1:
                if spare is None:
                    spare = iter(np.flatnonzero(~taken))
                slot = int(next(spare))
                self.shift[b], slot_of[at[0]], taken[slot] = -slot - 1, slot, True
                continue
            d = 0
            while True:  # 32 displacements at a time
                tries = self._place(own[at][None, :], np.arange(d, d + 32)[:, None])
                free = ~taken[tries].any(1)
                good = [k for k in np.flatnonzero(free) if len(set(tries[k].tolist())) == len(at)]
                if good:
                    d, slots = d + good[0], tries[good[0]]
                    break
                d += 32
            self.shift[b], slot_of[at], taken[slots] = d, slots, True
        self.key_at = np.empty(n, np.int64)  # slot -> index of its key
        self.key_at[slot_of] = np.arange(n)

    @staticmethod
    def hashes(keys) -> np.ndarray:
        import xxhash

        return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))

    def _place(self, own: np.ndarray, d) -> np.ndarray:
        h = (own ^ (np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(32))) % np.uint64(self.size)).astype(np.int64)

    def slots(self, items) -> np.ndarray:
        """The only slot where each item can stand."""
        own = self.hashes(items)
        d = self.shift[(own % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -d - 1, self._place(own, np.maximum(d, 0)))


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always merge the adjacent pair of lowest rank, leftmost first."""
    n = len(word)
    part = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    find = ranks.get
    heap = [(r, i, 2) for i in range(n - 1) if (r := find(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        own = part[i]
        if own is None:
            continue
        j = after[i]
        # the pair has changed since it was pushed
        if j >= n or len(own) + len(part[j]) != size:
            continue
        part[i] = own = own + part[j]
        part[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := find(own + part[k])) is not None:
                heapq.heappush(heap, (r, i, len(own) + len(part[k])))
        h = before[i]
        if h >= 0 and (r := find(part[h] + own)) is not None:
            heapq.heappush(heap, (r, h, len(part[h]) + len(own)))
    return [ranks[p] for p in part if p is not None]


class ByteEncoder:
    """Both tiers over one vocabulary; what misses gave is kept, bounded by ``limit``
    pre-tokens of at most ``KEPT_BYTES``."""

    def __init__(self, path: str, pattern: str, limit: int = 300_000):
        import regex

        self.ranks = read_ranks(path)
        self.keys = list(self.ranks)
        self.ids = np.fromiter(self.ranks.values(), np.int64, len(self.keys))
        self.hash = PerfectHash(self.keys)
        self.whole = [self.ids[k].astype("<u4").tobytes() for k in self.hash.key_at]
        self.at = [self.keys[k] for k in self.hash.key_at]
        self.cut = regex.compile(pattern)
        self.limit = limit
        self.merged: dict[bytes, bytes] = {}

    def pre_tokens(self, items: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each pre-token."""
        merged, at, whole, out = self.merged, self.at, self.whole, []
        for item, slot in zip(items, self.hash.slots(items).tolist()):
            if at[slot] == item:
                out.append(whole[slot])
                continue
            got = merged.get(item)
            if got is None:
                got = np.array(merge_bytes(item, self.ranks), "<u4").tobytes()
                if len(item) <= KEPT_BYTES:
                    if len(merged) >= self.limit:
                        merged.clear()
                    merged[item] = got
            out.append(got)
        return out

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The text's pre-tokens, in lists of about ``MATCHES``."""
        if len(text) <= MATCHES:
            yield self.cut.findall(text)
            return
        held = []
        for m in self.cut.finditer(text):
            held.append(m.group())
            if len(held) >= MATCHES:
                yield held
                held = []
        yield held

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of an Arrow string array."""
        out, size = [np.zeros(0, "<u4")], np.zeros(len(texts), np.int64)
        items, owners, counts = [], [], []

        def flush() -> None:
            ids, bounds = self._ids(items, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]))
            out.append(ids)
            np.add.at(size, owners, np.diff(bounds))
            for held in (items, owners, counts):
                held.clear()

        for i, t in enumerate(texts):
            for part in self.pieces(t.as_py()):
                items += part
                owners.append(i)
                counts.append(len(part))
                if len(items) >= MATCHES:
                    flush()
        flush()
        return np.concatenate(out), np.concatenate([[0], np.cumsum(size)])

    def _ids(self, items: list[str], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa

        coded = pa.array(items, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        return spread(self.pre_tokens(list(distinct)), coded.indices.to_numpy().astype(np.int64), bounds)


_ENCODERS: dict[str, ByteEncoder] = {}


def byte_encoder(name: str) -> ByteEncoder:
    """The encoder of this Python worker, made on first use."""
    if name not in _ENCODERS:
        import public_tokenizers

        _ENCODERS[name] = ByteEncoder(tokenizer_file(name), public_tokenizers.PATTERN)
    return _ENCODERS[name]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row; with ``decoded``
    also the bytes that these ids decode to."""
    fields = [docs.schema["doc_id"], T.StructField("ids", T.BinaryType())]
    schema = T.StructType(fields + ([T.StructField("bytes", T.BinaryType())] if decoded else []))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = byte_encoder(vocabulary)
        dec = byte_decoder(vocabulary) if decoded else None
        for batch in batches:
            for first, texts in text_runs(batch.column(1), RUN_BYTES):
                ids, bounds = enc.encode(texts)
                raw = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [batch.column(0).slice(first, len(texts)), pa.array(raw, pa.binary())]
                if dec:
                    columns.append(pa.array([dec.decode(np.frombuffer(x, "<u4")) for x in raw], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class ByteDecoder:
    """Bytes of ids from one pool."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        words = [b""] * (max(ranks.values()) + 1)
        for word, i in ranks.items():
            words[i] = word
        self.pool = np.frombuffer(b"".join(words), np.uint8)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self._bytes(ids[lo:lo + MATCHES]) for lo in range(0, len(ids), MATCHES))

    def _bytes(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.repeat(self.first[ids] - (end - size), size)
        at += np.arange(len(at))
        return self.pool[at].tobytes()


_DECODERS: dict[str, ByteDecoder] = {}


def byte_decoder(name: str) -> ByteDecoder:
    """The decoder of this Python worker, made on first use."""
    if name not in _DECODERS:
        _DECODERS[name] = ByteDecoder(tokenizer_file(name))
    return _DECODERS[name]


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and the decoded bytes of every row; null ids decode to no bytes."""
    schema = T.StructType([encoded.schema["doc_id"], encoded.schema["ids"], T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        dec = byte_decoder(vocabulary)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for lo, hi in byte_runs(size, RUN_BYTES):
                part = batch.slice(lo, hi - lo)
                out = [dec.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())],
                                                 names=schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip_digest(docs: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every row."""
    return encode(docs, decoded=True).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
