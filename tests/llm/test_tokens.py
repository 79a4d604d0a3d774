"""Operators 1, 2, 8 and 10: packing, token files, counts, byte-level encoding."""

import hashlib
import heapq
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import awkward, empty
from shoplens.llm import byte_bpe, huffman, packing, token_count
from shoplens.llm.common import WordEncoder, text_runs, tokenizer_file

ODD = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "'re", "'v", "'", "!", "1", "23", "é", "ß", "漢", "😀", "\u0301",
       "<|endoftext|>", "<|startoftext|>", "٣", "Ⅷ", "\x1c", "\x85", "\x0b", "\x00", "İ", "Σ", "the", " and", "'S",
       "''", "ÿ", "×", "÷", "Ö"]


def fuzz(n=400):
    r = random.Random(5)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["a" * 3000, " " * 500]


def test_words_encode_as_the_whole_text():
    enc = WordEncoder(tokenizer_file("word_bpe_49k.json"), limit=50)
    texts = fuzz()
    for first, run in text_runs(pa.array(texts), 300):
        ids, bounds = enc.encode(run)
        for i in range(len(run)):
            want = enc.library.encode(texts[first + i], add_special_tokens=False).ids
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want, texts[first + i]


def test_a_piece_met_as_a_word_is_encoded_once():
    enc = WordEncoder(tokenizer_file("word_bpe_49k.json"))
    model, calls = enc.model, []

    class Counting:
        def tokenize(self, piece):
            calls.append(piece)
            return model.tokenize(piece)
    enc.model = Counting()
    ids, bounds = enc.encode(pa.array(["Hello hello, hello", "HELLO ,"]))
    assert calls == ["hello", ","]
    assert ids.tolist() == enc.library.encode("Hello hello, hello HELLO ,", add_special_tokens=False).ids
    assert bounds.tolist()[1] == len(enc.library.encode("Hello hello, hello", add_special_tokens=False).ids)


def test_blocks_decoded_side_by_side_stay_apart():
    r = np.random.default_rng(2)
    runs = [r.integers(0, 3 ** (i % 5 + 1), n) for i, n in enumerate((1, 255, 256, 257, 70_000, 2, 5_000, 65_536))]
    ids, counts = np.unique(np.concatenate(runs), return_counts=True)
    code = huffman.Code(ids, huffman.code_lengths(counts))
    blocks = [(*huffman.encode_block(run, *code.encoder()), len(run)) for run in runs]
    for got, run in zip(huffman.decode_blocks(blocks, *code.decoder(), code.top), runs):
        assert np.array_equal(got, run)


def best_fit(histogram, size):
    rooms, made = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms.pop(at)
            else:
                room, made = size, made + 1
            if room > length:
                insort(rooms, room - length)
    return made


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_is_best_fit_and_gapless(histogram):
    rows = packing.plan_slots(histogram, 40)
    held, ranks = {}, Counter()
    for length, a, b, sequence, offset in rows:
        assert a == ranks[length]
        ranks[length] = b
        for k in range(b - a):
            held.setdefault(sequence + k, []).append((offset, length))
    assert ranks == Counter(histogram)
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40
    assert len(held) == best_fit(histogram, 40)


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark)
    library = WordEncoder(tokenizer_file("word_bpe_49k.json")).library
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[r.doc_id, k // 2048, k, np.array(ids[k:k + 2048], "<u4").tobytes()] += 1
    got = packing.pack(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in got) == want
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for pieces in held.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) == best_fit(Counter(r.length for r in got), 2048)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(spark.createDataFrame(got)).collect()}
    assert joined == {k: b"".join(x[2] for x in sorted(v)) for k, v in held.items()}
    digest = packing.pack_digest(docs).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in digest) == \
        Counter((d, p, zlib.crc32(raw)) for (d, p, _, raw), n in want.items() for _ in range(n))
    assert packing.pack_digest(empty(spark)).count() == 0


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for n in (2, 3, 10, 700):
        counts = (rng.pareto(1, n) * 10 + 1).astype(int)
        heap, total = [int(c) for c in counts], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        bits = huffman.code_lengths(counts, 40)
        assert (counts * bits).sum() == total and (2.0 ** -bits).sum() == 1
    bits = huffman.code_lengths(np.array([1, 1, 2, 4, 8, 16, 32, 64, 128]), 5)
    assert bits.max() == 5 and (2.0 ** -bits).sum() == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, int), 3)


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(1, 900) * 10 + 1).astype(int)
    code = huffman.Code(np.arange(900) * 3, huffman.code_lengths(counts))
    ids = rng.choice(900, n, p=counts / counts.sum()) * 3
    payload, marks = huffman.encode_block(ids, *code.encoder())
    assert (huffman.decode_block(payload, marks, n, *code.decoder(), code.top) == ids).all()


def test_token_file_of_awkward_rows(spark):
    docs = awkward(spark)
    library = WordEncoder(tokenizer_file("word_bpe_49k.json")).library
    rows = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1])
        rows.append((r.doc_id, ids.astype("<u4").tobytes(), ids.astype("<u2").tobytes()))
    rows.sort(key=lambda x: (x[0] is not None, x[0], x[2]))
    at, want = 0, []
    for key, raw, _ in rows:
        want.append((key, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    got = [tuple(r) for r in huffman.round_trip_digest(docs).collect()]
    assert sorted(got, key=lambda x: x[1]) == want
    assert huffman.round_trip_digest(empty(spark)).count() == 0


def test_counts_match_the_library():
    counter = token_count.TokenCounter(tokenizer_file("byte_bpe_50k.json"))
    counter.pairs.limit = 500  # tables that start anew give the same counts
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = fuzz()
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.run(texts).tolist() == want
    assert [int(counter.run([t])[0]) for t in texts[:50]] == want[:50]


def test_chunk_maps_compose():
    rng = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 1000):
        kinds = rng.integers(0, 8, n).astype(np.int8)
        state, want = token_count.FREE, []
        for k in kinds:
            want.append(bool(token_count.EMIT[state, k]))
            state = token_count.GOTO[state, k]
        assert token_count.starts_of(kinds).tolist() == want


def test_counts_of_awkward_rows(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    docs = awkward(spark)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in token_count.count_tokens(docs).collect()) == want
    assert token_count.count_tokens(empty(spark)).count() == 0


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(3000)]
    h = byte_bpe.PerfectHash(keys)
    slots = h.slots(keys)
    assert sorted(slots.tolist()) == list(range(3000))
    assert [keys[k] for k in h.key_at[slots]] == keys
    assert ((0 <= h.slots([b"other", b""])) & (h.slots([b"other", b""]) < 3000)).all()


def test_byte_pairs_match_tiktoken_and_decode():
    import public_tokenizers
    import tiktoken
    enc = byte_bpe.byte_encoder(byte_bpe.VOCABULARY)
    dec = byte_bpe.ByteDecoder(tokenizer_file(byte_bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})
    texts = fuzz()
    ids, bounds = enc.encode(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        own = ids[bounds[i]:bounds[i + 1]]
        assert own.tolist() == library.encode_ordinary(t), t
        assert dec.decode(own) == t.encode()


def test_long_texts_are_encoded_in_parts(monkeypatch):
    """Parts and a store that starts anew give the ids of the whole."""
    enc = byte_bpe.byte_encoder(byte_bpe.VOCABULARY)
    texts = fuzz() + [" ".join(fuzz())]
    want, bounds = enc.encode(pa.array(texts, pa.large_string()))
    monkeypatch.setattr(byte_bpe, "MATCHES", 7)
    monkeypatch.setattr(enc, "limit", 20)
    enc.merged.clear()
    ids, parts = enc.encode(pa.array(texts, pa.large_string()))
    assert len(enc.merged) <= 20 and (ids == want).all() and (parts == bounds).all()


def test_a_very_long_text_takes_bounded_memory():
    import os
    import subprocess
    import sys
    code = """
import random, resource
import pyarrow as pa
from shoplens.llm import byte_bpe
enc, dec = byte_bpe.byte_encoder(byte_bpe.VOCABULARY), byte_bpe.byte_decoder(byte_bpe.VOCABULARY)
r = random.Random(1)
words = ["".join(r.choice("abcdefghijklmnopq") for _ in range(r.randint(2, 9))) for _ in range(20_000)]
text = " ".join(r.choice(words) for _ in range(1_900_000))
ids, _ = enc.encode(pa.array([text], pa.large_string()))
assert len(text) > 12_000_000 and dec.decode(ids) == text.encode()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root})
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) < 400


def test_byte_round_trip_of_awkward_rows(spark):
    enc = byte_bpe.byte_encoder(byte_bpe.VOCABULARY)
    docs, want = awkward(spark), Counter()
    for r in docs.select("doc_id", "text").collect():
        ids, _ = enc.encode(pa.array([r.text or ""], pa.large_string()))
        want[r.doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.round_trip_digest(docs).collect()) == want
    assert byte_bpe.round_trip_digest(empty(spark)).count() == 0
