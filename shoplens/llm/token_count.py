"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic transducers take the place of the byte-level tokenizer:

* The pre-token transducer has eight states over character classes (with the
  one- or two-character lookahead of the pattern folded into the class). Its
  transitions say whether a pre-token begins. A run of texts is cut into
  fixed chunks; each chunk's map from entry state to exit state is computed
  for all states at once, the maps are composed by a parallel prefix scan,
  and the chunks are then walked from their known entry states.
* The byte-pair transducer reads the bytes of a pre-token. A state holds, for
  each suffix that may still grow into a vocabulary entry, its trie node, the
  last token before it and its count relative to now; a transition carries
  the change of the token count. A token may follow another exactly if the
  pair encodes to itself, and one candidate alone satisfies that. States and
  transitions are compiled as the data need them; the tables are bounded and
  start anew when full.

Character classes come from the tokenizer file's own pre-tokenizer, one
question for each new character. Special-token strings inside a text count as
one token each and cut the text, as the library does by default.

Defined cases: null and empty text have no bytes and no tokens; texts are never
cut; rows with the same doc_id are counted separately; an empty table gives
no rows; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import byte_characters, text_runs, tokenizer_file

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 128

# Classes of a character: letter, number, other, other that begins a one- or a
# two-letter contraction, white space that goes on, last space before text,
# other last white space before text.
LETTER, NUMBER, OTHER, SHORT, LONG, MORE, SPACE, ENDS = range(8)
# States: anything may begin, inside letters, numbers, others, white space,
# after a leading space, two letters or one letter of a contraction to come.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, LED, TWO_LEFT, ONE_LEFT = range(8)


def pre_token_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a pre-token begin) by state and class.

    Classes from 8 on are those of a text's first character, which ignores
    the state.
    """
    begins = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE_LEFT, LONG: TWO_LEFT,
              MORE: IN_WHITE, SPACE: LED, ENDS: FREE}
    goto, emit = np.zeros((8, 16), np.int8), np.ones((8, 16), bool)
    for state in range(8):
        for kind, new in begins.items():
            goto[state, kind] = goto[state, kind + 8] = new
    others = (OTHER, SHORT, LONG)
    stay = [(IN_LETTERS, LETTER, IN_LETTERS), (IN_NUMBERS, NUMBER, IN_NUMBERS), (IN_WHITE, MORE, IN_WHITE),
            (LED, LETTER, IN_LETTERS), (LED, NUMBER, IN_NUMBERS)]
    stay += [(s, k, IN_OTHERS) for s in (IN_OTHERS, LED) for k in others]
    stay += [(TWO_LEFT, k, ONE_LEFT) for k in range(8)] + [(ONE_LEFT, k, FREE) for k in range(8)]
    for state, kind, new in stay:
        goto[state, kind], emit[state, kind] = new, False
    return goto, emit


GOTO, EMIT = pre_token_transducer()


def starts_of(classes: np.ndarray) -> np.ndarray:
    """Does a pre-token begin at each character? Chunk maps, prefix scan, walk."""
    n = len(classes)
    if not n:
        return np.zeros(0, bool)
    rows = -(-n // CHUNK)
    padded = np.full(rows * CHUNK, OTHER, np.int8)
    padded[:n] = classes
    steps = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    flat, emit = GOTO.reshape(-1), EMIT.reshape(-1)
    maps = np.tile(np.arange(8, dtype=np.int8), (rows, 1))
    for kinds in steps:
        maps = flat[maps.astype(np.int16) * 16 + kinds[:, None]]
    # inclusive prefix scan: maps[i] becomes the map of chunks 0..i
    hop = 1
    while hop < rows:
        maps[hop:] = np.take_along_axis(maps[hop:], maps[:-hop].astype(np.int64), 1)
        hop *= 2
    state = np.concatenate([[FREE], maps[:-1, FREE]]).astype(np.int16)
    out = np.empty((CHUNK, rows), bool)
    for t, kinds in enumerate(steps):
        at = state * 16 + kinds
        out[t] = emit[at]
        state = flat[at].astype(np.int16)
    return out.T.reshape(-1)[:n]


class PairTransducer:
    """The byte-pair encoder as a lazily compiled transducer over bytes."""

    def __init__(self, vocabulary: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]],
                 limit: int = 1_000_000):
        self.words = {i: w for w, i in vocabulary.items()}
        self.single = [vocabulary[bytes([b])] for b in range(256)]
        self.merges, self.limit = merges, limit
        self.child: dict[int, int] = {}   # node * 256 + byte -> node
        self.token: list[int] = [-1]      # node -> token that ends there
        self.inner: list[bool] = [False]  # does anything go on from the node?
        for word, i in vocabulary.items():
            node = 0
            for b in word:
                key = node * 256 + b
                self.inner[node] = True
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        begin = ((0, -1, 0),)
        self.number = {begin: 0}
        self.states = [begin]
        self.moves: dict[int, tuple[int, int]] = {}  # state * 256 + byte -> (state, count change)

    def merged(self, ids: list[int]) -> list[int]:
        """Plain byte-pair encoding of a short id sequence; compiles pair tests."""
        find = self.merges.get
        while True:
            best = min(((r, i) for i in range(len(ids) - 1) if (r := find((ids[i], ids[i + 1])))), default=None)
            if best is None:
                return ids
            (_, new), i = best
            ids = ids[:i] + [new] + ids[i + 2:]

    def may_follow(self, last: int, token: int) -> bool:
        key = (last, token)
        got = self.fits.get(key)
        if got is None:
            if len(self.fits) > self.limit:
                self.fits.clear()
            before = self.words[last] if last >= 0 else b""
            ids = self.merged([self.single[b] for b in before + self.words[token]])
            got = self.fits[key] = ids == ([last, token] if last >= 0 else [token])
        return got

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        grown, token, change = [], -1, 0
        for node, last, count in self.states[state]:
            node = self.child.get(node * 256 + byte)
            if node is None:
                continue
            grown.append((node, last, count))
            # elements stand longest suffix first; one candidate alone fits
            if token < 0 and self.token[node] >= 0 and self.may_follow(last, self.token[node]):
                token, change = self.token[node], count + 1
        new = tuple((node, last, count - change) for node, last, count in grown if self.inner[node])
        new += ((0, token, 0),)
        at = self.number.get(new)
        if at is None:
            at = self.number[new] = len(self.states)
            self.states.append(new)
        return at, change

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        moves, state, total = self.moves, 0, 0
        for b in word:
            key = state * 256 + b
            step = moves.get(key)
            if step is None:
                step = moves[key] = self._compile(state, b)
            state, change = step
            total += change
        if len(moves) > self.limit:
            self._reset()
        return total


class TokenCounter:
    """Counts of whole texts as the tokenizer file's library gives them."""

    def __init__(self, path: str, limit: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in byte_characters().items()}
        vocabulary = {bytes(byte_of[c] for c in w): i for w, i in spec["model"]["vocab"].items()
                      if all(c in byte_of for c in w)}
        ids = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ask = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pairs = PairTransducer(vocabulary, merges)
        self.kinds = np.full(0x110000, -1, np.int8)
        self.limit = limit
        self.known: dict[bytes, int] = {}

    def _kind(self, point: int) -> int:
        c = chr(point)
        for probe, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.ask(probe + c)) == 1:
                return kind
        return MORE

    def classes(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Class of each character with its lookahead; ``first`` marks beginnings of texts."""
        kinds = self.kinds[points]
        if (kinds < 0).any():
            for p in np.unique(points[kinds < 0]):
                self.kinds[p] = self._kind(int(p))
            kinds = self.kinds[points]
        kinds = kinds.copy()
        n = len(points)
        inside = np.append(~first[1:], False)  # the next character is of the same text
        ahead = np.append(points[1:], 0) * inside
        second = np.zeros(n, points.dtype)
        second[:-1] = ahead[1:]
        second *= inside
        quote = points == 0x27
        at = np.flatnonzero(quote)
        a, b = ahead[at], second[at]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) \
            | ((a == ord("l")) & (b == ord("l")))
        kinds[at[one]] = SHORT
        kinds[at[two]] = LONG
        white = np.flatnonzero(kinds == MORE)
        last = white[inside[white] & (np.append(kinds[1:], MORE)[white] != MORE)]
        kinds[last] = np.where(points[last] == 0x20, SPACE, ENDS)
        kinds[first] += 8
        return kinds

    def _counts(self, items: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        known, out = self.known, np.empty(len(items), np.int64)
        for i, w in enumerate(items):
            n = known.get(w)
            if n is None:
                n = known[w] = self.pairs.count(w)
            out[i] = n
        return out

    def run(self, texts: list[str]) -> np.ndarray:
        """Token count of each text."""
        import pyarrow as pa

        total = np.zeros(len(texts), np.int64)
        pieces, owner = texts, np.arange(len(texts))
        if any(s in t for s in self.special for t in texts):
            pieces, owner = [], []
            for i, t in enumerate(texts):
                parts = [t]
                for s in self.special:
                    parts = [x for p in parts for x in p.split(s)]
                total[i] = len(parts) - 1
                pieces += parts
                owner += [i] * len(parts)
            owner = np.array(owner)
        text = "".join(pieces)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = (np.cumsum(size) - size)[size > 0]
        if not len(points):
            return total
        first = np.zeros(len(points), bool)
        first[begin] = True
        starts = np.flatnonzero(starts_of(self.classes(points, first)))
        wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        offset = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])
        bounds = np.append(offset[starts], offset[-1])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                      [None, pa.py_buffer(bounds), pa.py_buffer(text.encode("utf-8"))])
        coded = words.dictionary_encode()
        each = self._counts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sums = np.concatenate([[0], np.cumsum(each)])
        at = np.searchsorted(starts, np.concatenate([begin, [len(points)]]))
        np.add.at(total, owner[size > 0], sums[at[1:]] - sums[at[:-1]])
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = TokenCounter(tokenizer_file(tokenizer))
        counter = _COUNTERS[tokenizer]
        for batch in batches:
            for first, texts in text_runs(batch.column(1), 4_000_000):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pc.binary_length(texts).cast(pa.int64()),
                     pa.array(counter.run(texts.to_numpy(zero_copy_only=False).tolist()))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
