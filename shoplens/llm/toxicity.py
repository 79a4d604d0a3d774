"""Toxic spans by a two-state linear-chain conditional random field.

Fitting uses a bounded sample of labelled documents (``SAMPLE`` of each label,
those of the lowest id hash; near copies within it count once). A word's
features are the lower-cased word and its prefixes; features that occur far
more often in toxic documents than in clean ones label the tokens of toxic
documents, every token of a clean document is labelled clean, and the field's
weights are fitted to these labelled tokens by gradient ascent on the exact
conditional likelihood.

Scoring runs over every whole text. Words without a weighted feature all have
the same potentials, so runs of them are powers of one 2 x 2 matrix, and
forward-backward visits only the other words; the marginals are those of the
full chain. A document's spans are the words whose marginal reaches ``SPAN``;
its score is a logistic function, fitted to the same labelled documents, of
its largest marginal and of the expected number and share of toxic words, so
that a word which clean documents also hold now and then does not decide alone.

Defined cases: null and empty text score 0 and have no spans; without labelled
documents of both kinds every score is 0; a doc_id that is labelled more than
once counts as toxic if any label says so; rows with the same doc_id are scored
separately; input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import bounded, give_back, split_words, text_runs

SAMPLE = 2000       # labelled documents of each kind that fitting reads
SAMPLE_BYTES = 65_536  # of such a document; longer ones are judged, but not read for the fit
MAX_FEATURES = 5000
PREFIXES = (4, 5, 6, 7)
MIN_RATIO = 4.0     # times the share of clean documents that a feature must have of toxic ones
MIN_EVIDENCE = 18.0  # its log-likelihood ratio against independence of the label
WINDOW = 256        # words of a training sequence
SPAN = 0.5
EDGES = re.compile(r"^\W+|\W+$")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_features(word: str) -> list[str]:
    """The bare lower-cased word, marked as whole, and its prefixes."""
    bare = EDGES.sub("", word).lower()
    if not bare:
        return []
    return [bare + "$"] + [bare[:n] for n in PREFIXES if len(bare) >= n]


@dataclass
class Field:
    """Weights of the field; state 1 is toxic, scores of state 0 are 0."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    enter: float = 0.0  # 0 -> 1
    leave: float = 0.0  # 1 -> 0
    stay: float = 0.0   # 1 -> 1
    score: tuple[float, ...] = (0.0, 1.0, 0.0, 0.0)  # of the document: intercept, and by evidence()

    def __post_init__(self):
        self.known: dict[str, float] = {}
        self.step = np.exp(np.array([[0.0, self.enter], [self.leave, self.stay]]))

    def emission(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            w = self.weights
            got = self.known[word] = sum([w[f] for f in word_features(word) if f in w])
        return got

    def plain_power(self, gaps: np.ndarray) -> np.ndarray:
        """Powers of the matrix of a word without weighted features, scaled to stay finite."""
        a = self.step * np.exp([0.0, self.bias])
        values, vectors = np.linalg.eig(a)
        values, vectors = values.real, vectors.real  # positive matrix: both are real
        top = np.abs(values).max()
        back = np.linalg.inv(vectors)
        return np.einsum("ij,nj,jk->nik", vectors, (values / top)[None, :] ** gaps[:, None], back)

    def marginals(self, scores: np.ndarray, gaps: np.ndarray, bounds: np.ndarray,
                  tail: np.ndarray) -> np.ndarray:
        """Toxic marginal of each weighted word.

        ``scores`` and ``gaps`` (plain words before it, since the last weighted
        word) hold the weighted words of document i at bounds[i]:bounds[i + 1];
        ``tail`` counts the plain words after the last one. Documents are
        followed side by side; vectors are rescaled at each word.
        """
        n, size = len(scores), np.diff(bounds)
        out = np.zeros(n)
        if not n:
            return out
        power = self.plain_power(gaps)
        own = self.step[None] * np.stack([np.ones(n), np.exp(np.minimum(self.bias + scores, 60))], 1)[:, None, :]
        move = np.einsum("nij,njk->nik", power, own)
        order = np.argsort(-size, kind="stable")
        ahead = np.empty((n, 2))
        state = np.tile([1.0, 0.0], (len(size), 1))
        depth = int(size.max())
        counts = np.searchsorted(-size[order], -np.arange(depth) - 0.5, "left")  # documents with more than k
        for k in range(depth):
            doc = order[:counts[k]]
            at = bounds[doc] + k
            v = np.einsum("ni,nij->nj", state[doc], move[at])
            v /= v.sum(1, keepdims=True)
            ahead[at] = state[doc] = v
        behind = np.einsum("nij->ni", self.plain_power(tail))
        for k in range(depth - 1, -1, -1):
            doc = order[:counts[k]]
            at = bounds[doc] + k
            p = ahead[at] * behind[doc]
            out[at] = p[:, 1] / p.sum(1)
            w = np.einsum("nij,nj->ni", move[at], behind[doc])
            behind[doc] = w / w.sum(1, keepdims=True)
        return out


def sample_texts(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> tuple[list[str], list[str]]:
    """(toxic texts, clean texts) of at most ``limit`` labelled documents each.

    Only labels of documents that are there count, and only texts of up to
    ``SAMPLE_BYTES`` are read. Rows with crc32(doc_id as text) mod 4 = 2 are held out.
    """
    there = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).select("doc_id").distinct()
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).where(~held_out()).join(there, "doc_id", "left_semi")
    picked = [known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
              for kind in (1, 0)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * limit rows at most
    rows = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).select("doc_id", "text") \
        .join(ids, "doc_id").dropDuplicates(["doc_id"]).select("text", "toxic").toArrow()
    texts, kinds = rows.column("text").to_pylist(), rows.column("toxic").to_pylist()
    return tuple([t or "" for t, k in zip(texts, kinds) if k == kind] for kind in (1, 0))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def distinct_texts(texts: list[str]) -> list[list[str]]:
    """Words of the texts, leaving out near copies of an earlier one: texts that
    share two of their three smallest shingle hashes."""
    seen, out, pool = set(), [], {}
    for t in sorted(texts):
        words = [pool.setdefault(w, w) for w in WORD.findall(t)]  # one object for each word
        marks = sorted({crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))})[:3]
        pairs = set(combinations(marks, 2)) or set(marks)
        if words and not seen.intersection(pairs):
            out.append(words)
        seen.update(pairs)
    return out


def tells(toxic: int, clean: int, share: float) -> bool:
    """Does a feature of so many toxic and clean documents speak for toxicity?"""
    if (toxic + 0.5) * (1 - share) < MIN_RATIO * (clean + 0.5) * share:
        return False
    n = toxic + clean
    evidence = toxic * math.log(toxic / (n * share)) + (clean and clean * math.log(clean / (n * (1 - share))))
    return 2 * evidence >= MIN_EVIDENCE


def fit(toxic_texts: list[str], clean_texts: list[str], rounds: int = 60) -> Field:
    """Label tokens by feature ratios, then fit the field to them."""
    toxic, clean = distinct_texts(toxic_texts), distinct_texts(clean_texts)
    if not toxic or not clean:
        return Field()
    known: dict[str, list[str]] = {}

    def of(word: str) -> list[str]:
        if word not in known:
            if len(known) > 100_000:
                known.clear()
            known[word] = word_features(word)
        return known[word]

    share = len(toxic) / (len(toxic) + len(clean))
    in_toxic = Counter(f for words in toxic for f in {f for w in set(words) for f in of(w)})
    # rarer features cannot have the evidence, even if no clean document has them
    in_toxic = Counter({f: n for f, n in in_toxic.items() if tells(n, 0, share)})
    in_clean = Counter(f for words in clean for f in {f for w in set(words) for f in of(w) if f in in_toxic})
    chosen = sorted((f for f, n in in_toxic.items() if tells(n, in_clean[f], share)),
                    key=lambda f: (-in_toxic[f], f))[:MAX_FEATURES]
    if not chosen:
        return Field()
    number = {f: i for i, f in enumerate(chosen)}

    # windows of labelled words as (place, feature numbers); those of one length
    # without any feature are alike and share a lane
    runs, plain = [], Counter()
    for group, y in ((toxic, 1), (clean, 0)):
        for words in group:
            for i in range(0, len(words), WINDOW):
                part = words[i:i + WINDOW]
                held = [(t, ids) for t, w in enumerate(part) if (ids := [number[f] for f in of(w) if f in number])]
                if held:
                    runs.append((len(part), held, y))
                else:
                    plain[len(part)] += 1
    runs += [(n, [], 0) for n in sorted(plain)]
    lanes, length = len(runs), np.array([n for n, _, _ in runs])
    times = np.array([1 if held else plain[n] for n, held, _ in runs], float)
    steps = int(length.max())
    label = np.zeros((steps, lanes), bool)
    spots = np.array([t * lanes + k for k, (_, held, _) in enumerate(runs) for t, ids in held for _ in ids], np.int64)
    feats = np.array([f for _, held, _ in runs for _, ids in held for f in ids], np.int64)
    for k, (_, held, y) in enumerate(runs):
        for t, _ in held:
            label[t, k] = bool(y)
    model = _ascend(chosen, spots, feats, label, length, times, rounds)
    # the document score, from all labelled texts
    import pyarrow as pa
    texts = toxic_texts + clean_texts
    seen = np.concatenate([evidence(model, run)[0] for _, run in text_runs(pa.array(texts, pa.large_string()))])
    model.score = _logistic(seen, np.arange(len(texts)) < len(toxic_texts))
    model.known.clear()  # travels to the tasks
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Intercept and weights of a small logistic regression (Newton)."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return tuple(map(float, w))


def _ascend(chosen, spots, feats, label, length, times, rounds) -> Field:
    """Gradient ascent on the labelled windows' conditional likelihood (Adam);
    window k counts times[k] times."""
    n, (steps, lanes) = len(chosen), label.shape
    theta = np.concatenate([np.zeros(n), [-4.0, 0.0, 0.0, 0.0]])  # weights, bias, enter, leave, stay
    here = np.arange(steps)[:, None] < length[None, :]
    prev = np.vstack([np.zeros((1, lanes), bool), label[:-1]])
    seen = np.concatenate([np.bincount(feats[label.reshape(-1)[spots]], minlength=n),
                           [label.sum(), (label & ~prev & here).sum(), (~label & prev & here).sum(),
                            (label & prev & here).sum()]]).astype(float)
    m, v = np.zeros(n + 4), np.zeros(n + 4)
    for step in range(1, rounds + 1):
        move = np.exp(np.array([[0.0, theta[n + 1]], [theta[n + 2], theta[n + 3]]]))
        own = np.exp(np.clip(theta[n] + np.bincount(spots, weights=theta[feats], minlength=steps * lanes), -60, 60)) \
            .reshape(steps, lanes)
        ahead, state = np.empty((steps, lanes, 2)), np.tile([1.0, 0.0], (lanes, 1))
        for t in range(steps):
            x = state @ move
            x[:, 1] *= own[t]
            x /= x.sum(1, keepdims=True)
            ahead[t] = state = x
        behind, pairs, tokens = np.ones((lanes, 2)), np.zeros((2, 2)), np.zeros((steps, lanes))
        for t in range(steps - 1, -1, -1):
            p = ahead[t] * behind
            tokens[t] = np.where(here[t], p[:, 1] / p.sum(1), 0.0)
            old = ahead[t - 1] if t else np.tile([1.0, 0.0], (lanes, 1))
            right = behind.copy()
            right[:, 1] *= own[t]
            both = old[:, :, None] * move[None] * right[:, None, :]
            both /= both.sum((1, 2), keepdims=True)
            pairs += (both * (times * here[t])[:, None, None]).sum(0)
            x = right @ move.T
            behind = np.where(here[t][:, None], x / x.sum(1, keepdims=True), 1.0)
        expect = np.concatenate([np.bincount(feats, weights=tokens.reshape(-1)[spots], minlength=n),
                                 [(tokens * times).sum(), pairs[0, 1], pairs[1, 0], pairs[1, 1]]])
        grad = seen - expect - 0.05 * np.concatenate([theta[:n], np.zeros(1), theta[n + 1:]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += 0.25 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = {f: float(w) for f, w in zip(chosen, theta[:n]) if abs(w) > 1e-6}
    return Field(weights, *map(float, theta[n:]))


def tag(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, score and spans (start, end in code points, marginal) of every row."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("marginal", T.DoubleType())])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
                           T.StructField("spans", T.ArrayType(span))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                score, found = score_run(model, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(score), pa.array(found, spans_type)],
                    names=schema.names)

    return bounded(docs.select("doc_id", "text")).mapInArrow(run, schema)


def evidence(model: Field, texts):
    """(evidence of each text, p, doc, place): log of the expected toxic words,
    largest marginal and expected share, of an Arrow string array; and the
    marginal, text and word number of each weighted word."""
    bounds, codes, words = split_words(texts)
    weight = np.array([model.emission(w) for w in words.to_numpy(zero_copy_only=False)], float)
    each = weight[codes] if len(codes) else np.zeros(0)
    active = np.flatnonzero(each)
    doc = np.searchsorted(bounds, active, "right") - 1
    place = active - bounds[doc]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    gaps = place.copy()
    if len(active):
        gaps[1:] -= np.where(doc[1:] == doc[:-1], place[:-1] + 1, 0)
    size = np.diff(bounds)
    last = np.full(len(texts), -1)
    some = np.diff(cut) > 0
    last[some] = place[cut[1:][some] - 1]
    p = model.marginals(each[active], gaps, cut, size - last - 1)
    total, top = np.bincount(doc, weights=p, minlength=len(texts)), np.zeros(len(texts))
    np.maximum.at(top, doc, p)
    share = total / np.maximum(size, 1)
    return np.column_stack([np.log1p(total), top, 10 * np.sqrt(share)]), p, doc, place


def score_run(model: Field, texts) -> tuple[np.ndarray, list[list[dict]]]:
    """(scores, spans) of an Arrow string array."""
    seen, p, doc, place = evidence(model, texts)
    score = np.zeros(len(texts))
    if model.weights:
        score = 1 / (1 + np.exp(-np.clip(model.score[0] + seen @ np.array(model.score[1:]), -30, 30)))
        score[[not t.strip(" \t\n\v\f\r") for t in texts.to_pylist()]] = 0.0
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    found: list[list[dict]] = [[] for _ in range(len(texts))]
    hit = p >= SPAN
    for i in np.unique(doc[hit]):
        at = [m.span() for m in WORD.finditer(texts[int(i)].as_py())]
        for k in cut[i] + np.flatnonzero(hit[cut[i]:cut[i + 1]]):
            a, b = at[place[k]]
            found[i].append({"start": a, "end": b, "marginal": float(p[k])})
    return score, found


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and spans; the field is fitted to the labelled rows of ``docs``."""
    model = fit(*sample_texts(docs, labels))
    give_back()
    return tag(docs, model)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return detect(docs, labels).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
