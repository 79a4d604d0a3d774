"""URL filter: rules by host suffix and path prefix, then a linear classifier.

A url that a rule fits takes the longest rule's verdict. Any other url is
judged by logistic regression on hashed character n-grams of its host and
path, trained here from a small labelled url table: by default the urls that
the rules themselves decide, at most ``LABELLED`` of them (those of the lowest
url hash, and of ``LABELLED_BYTES`` at most), so that the model carries the rules over to look-alike hosts and
paths. Only the weights, ``BUCKETS`` numbers, travel to the tasks.

Defined cases: a null url and one without ``://`` have empty host and path;
no rule fits those, and the model judges them by its intercept; with no
labelled url every verdict of the model is allow; repeated urls are judged
alike; input columns other than page_id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import byte_runs

# (verdict, host, path prefix): the rules of the query's contract.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

LABELLED = 4096
LABELLED_BYTES = 2048   # of host and path; longer urls are judged, but not used for training
RUN_BYTES = 500_000     # of urls that are scored at once; a longer one makes a run of its own
BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host and path of each url."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return (pages.select("page_id", "url").withColumn("_rest", rest)
            .withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
            .select("page_id", F.translate("_host", UPPER, LOWER).alias("host"),
                    F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0).alias("path")))


def fitting_rule(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule that fits host and path, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # a later, longer rule wraps the shorter ones
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def gram_buckets(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds): the n-gram buckets of url i are buckets[bounds[i]:bounds[i + 1]].

    Host and path are marked at both ends and hashed with different seeds.
    """
    fields = [f"\x02{h}\x03".encode() for h in hosts] + [f"\x04{p}\x05".encode() for p in paths]
    size = np.fromiter(map(len, fields), np.int64, len(fields))
    raw = np.frombuffer(b"".join(fields), np.uint8).astype(np.uint64)
    field = np.repeat(np.arange(len(fields)), size)
    url = field % max(1, len(hosts))
    kind = (field >= len(hosts)).astype(np.uint64)
    keys, owners = [], []
    for n in GRAMS:
        m = len(raw) - n + 1
        if m < 1:
            continue
        h = kind[:m] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        for k in range(n):
            h = (h ^ raw[k:m + k]) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        inside = field[:m] == field[n - 1:]
        keys.append((h >> np.uint64(40))[inside].astype(np.int64) % BUCKETS)
        owners.append(url[:m][inside])
    keys, owners = np.concatenate(keys or [[]]).astype(np.int64), np.concatenate(owners or [[]]).astype(np.int64)
    at = np.argsort(owners, kind="stable")
    return keys[at], np.searchsorted(owners[at], np.arange(len(hosts) + 1))


def scores(hosts: list[str], paths: list[str], weights: np.ndarray, intercept: float) -> np.ndarray:
    """Probability that each url is to be blocked."""
    keys, bounds = gram_buckets(hosts, paths)
    return _forward(keys, bounds, weights, 1 / np.sqrt(np.maximum(1, np.diff(bounds))), intercept)


def train(hosts: list[str], paths: list[str], block: np.ndarray, steps: int = 200,
          rate: float = 1.0, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept of the regularised logistic regression (Adagrad)."""
    weights, intercept = np.zeros(BUCKETS), 0.0
    if not len(hosts):
        return weights, intercept
    keys, bounds = gram_buckets(hosts, paths)
    n, size = len(hosts), np.diff(bounds)
    owner, value = np.repeat(np.arange(n), size), 1 / np.sqrt(np.maximum(1, size))
    seen, seen0 = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        miss = _forward(keys, bounds, weights, value, intercept) - block
        grad = np.bincount(keys, weights=(miss * value)[owner], minlength=BUCKETS) / n + ridge * weights
        seen += grad * grad
        weights -= rate * grad / np.sqrt(seen)
        g0 = float(miss.mean())
        seen0 += g0 * g0
        intercept -= rate * g0 / np.sqrt(seen0)
    return weights, intercept


def _forward(keys, bounds, weights, value, intercept) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[keys])])
    z = (total[bounds[1:]] - total[bounds[:-1]]) * value + intercept
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def labelled_urls(judged: DataFrame, limit: int = LABELLED) -> DataFrame:
    """host, path and block (0 or 1) of at most ``limit`` urls that rules decide."""
    return (judged.where("rule_verdict is not null").select(
        "host", "path", (F.col("rule_verdict") == "block").cast("int").alias("block"))
        .where(F.octet_length("host") + F.octet_length("path") <= LABELLED_BYTES)
        .distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(limit))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES,
                labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (null where a rule decides).

    ``labelled`` (host, path, block) replaces the default labelled url table.
    """
    rule, verdict = fitting_rule(rules)
    judged = split_url(pages).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))
    table = (labelled_urls(judged) if labelled is None else labelled.limit(LABELLED)).toPandas()
    weights, intercept = train(table["host"].tolist(), table["path"].tolist(), table["block"].to_numpy(float))
    weights = weights.astype(np.float32)
    schema = T.StructType([judged.schema["page_id"], T.StructField("host", T.StringType()),
                           T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
                           T.StructField("verdict", T.StringType()), T.StructField("block_score", T.DoubleType())])

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            size = [pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False) for k in (1, 2)]
            for lo, hi in byte_runs(size[0] + size[1] + 50, RUN_BYTES):
                part = batch.slice(lo, hi - lo)
                got = scores(part.column(1).to_pylist(), part.column(2).to_pylist(), weights, intercept)
                ruled = part.column(4).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4],
                     pa.array([v or ("block" if p > 0.5 else "allow") for v, p in zip(ruled, got)], pa.string()),
                     pa.array([None if v else float(p) for v, p in zip(ruled, got)], pa.float64())],
                    names=schema.names)

    return judged.mapInArrow(judge, schema)
