"""Quality rules: base limits and robust multivariate outliers.

Each document gets counts (words, code points, symbols, repeated lines and
repeated three-word windows). Their transformed vectors are judged within
their language and source: a minimum-covariance-determinant estimate (from
each of three starts, concentration steps over the closest ``SUPPORT`` share of
the group's rows; the least determinant counts, and one more step over all rows
near it) gives centre and covariance, and a document is rejected when its
squared Mahalanobis distance exceeds ``CUTOFF``. The estimate withstands junk
in under half of a group's rows. A group whose centre lies beyond ``CUTOFF`` in
the estimate of its whole language is judged by that one, so a source of mostly
junk is found while it is under half of the language.
Every step is a mergeable aggregation over all rows, so a source that holds
most rows is summed by many tasks. A language and source with fewer than
``MIN_GROUP`` usable rows is judged with the other small ones of its language;
if these are too few as well, by all rows of the language, or of the table.

Defined cases: null text counts as empty; a text without a word fails the base
limits; documents that fail them have no part in the estimates; in a table
with fewer than ``MIN_GROUP`` usable rows only the base limits judge; null
language or source is a group of its own; rows with the same doc_id are judged
separately; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import bounded, materialise, small_side, split_words, text_runs

SYMBOLS = b"#*$%&|<>"
MIN_GROUP = 50
SUPPORT = 0.5  # withstands just under half of outliers
STEPS = 4
STARTS = 3
TABLE = "all"  # the group of all rows
# Squared distance, in units where a normal sample's median is that of a
# chi-squared variable with as many degrees of freedom as features: that
# variable's quantile of 1 - 1/10,000, so a normal sample loses so many.
CUTOFF = 23.5
# Least standard deviation of each feature: smaller spreads are noise, and a
# feature that most documents have at zero must not make any value an outlier.
# A document rejected by one feature alone differs from its group's centre by
# more than sqrt(CUTOFF) of these: words longer or shorter by a third, a symbol
# in seven words, a repeated line in 26 words, a third of the words repeated.
FLOORS = {"x_length": 0.06, "x_symbols": 0.08, "x_lines": 0.04, "x_repeats": 0.12}


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType([docs.schema[c] for c in ("doc_id", "lang", "source")]
                          + [T.StructField(n, T.LongType()) for n in names])

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for first, texts in text_runs(batch.column(3)):
                bounds, codes, words = split_words(texts)
                chars = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False)[codes])])
                symbols, lines = [], []
                for t in texts.to_numpy(zero_copy_only=False):
                    raw = t.encode("utf-8")
                    symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
                    # a line with nothing but separators has no word
                    full = [x for x in raw.split(b"\n") if x and not x.isspace()]
                    lines.append(len(full) - len(set(full)))
                out = [np.diff(bounds), np.diff(chars[bounds]), symbols, lines,
                       repeat_words(bounds, codes)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(first, len(texts)) for k in range(3)]
                    + [pa.array(np.asarray(x, np.int64)) for x in out], names=schema.names)

    return bounded(docs.select("doc_id", "lang", "source", "text")).mapInArrow(count, schema)


def repeat_words(bounds: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Words of each text inside a three-word window that the text holds twice or more."""
    n, size = len(codes), np.diff(bounds)
    if n < 3:
        return np.zeros(len(size), np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    # equal windows of one text get equal numbers: codes are packed exactly, in two steps
    pair = np.unique(codes[:-1] * (int(codes.max()) + 1) + codes[1:], return_inverse=True)[1].astype(np.int64)
    gram = pair[:-1] * (int(codes.max()) + 1) + codes[2:]
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    gram, owner = gram[inside], doc[inside]
    at = np.lexsort((gram, owner))
    same = (gram[at[1:]] == gram[at[:-1]]) & (owner[at[1:]] == owner[at[:-1]])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    start = inside[at[twice]]
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[start + k] = True
    return np.add.reduceat(np.append(marked, False).astype(np.int64), bounds[:-1]) * (size > 0)


def features(counts: DataFrame) -> DataFrame:
    """Adds base_failed and the transformed vector (null where the base limits fail)."""
    n = F.col("n_words").cast("double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rates = {"x_length": F.log(F.col("word_chars") / n), "x_symbols": F.sqrt(F.col("n_symbols") / n),
             "x_lines": F.sqrt(F.col("n_dup_lines") / n), "x_repeats": F.sqrt(F.col("n_repeat_words") / n)}
    out = counts.withColumn("base_failed", failed)
    return out.withColumns({k: F.when(~F.col("base_failed"), v) for k, v in rates.items()})


def _group(lang: Column | None, source: Column | None) -> Column:
    """Names the group; nulls and the pools of small groups differ from all texts."""
    def part(c: Column | None) -> Column:
        return F.lit("*") if c is None else F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    return F.concat_ws("\x1f", part(lang), part(source))


def assign_groups(rows: DataFrame) -> DataFrame:
    """Adds _wide: the whole language, or the whole table if the language has too few
    usable rows; and _group: language and source, the language's pool, or as _wide."""
    usable = rows.where(~F.col("base_failed"))
    sizes = usable.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.count("*").alias("_n"))
    small = sizes.where(F.col("_n") < MIN_GROUP).groupBy(F.col("_l").alias("_pl")).agg(F.sum("_n").alias("_pool"))
    whole = sizes.groupBy(F.col("_l").alias("_wl")).agg(F.sum("_n").alias("_all"))
    wide = F.when(F.col("_all") >= MIN_GROUP, F.concat_ws("\x1f", F.lit("all"), _group(F.col("_l"), None))) \
        .otherwise(TABLE)
    level = (sizes.join(small, F.col("_l").eqNullSafe(F.col("_pl")), "left")
             .join(whole, F.col("_l").eqNullSafe(F.col("_wl")))
             .select("_l", "_s", wide.alias("_wide"), F.when(F.col("_n") >= MIN_GROUP, _group(F.col("_l"), F.col("_s")))
                     .when(F.col("_pool") >= MIN_GROUP, _group(F.col("_l"), None))
                     .otherwise(wide).alias("_group")))
    return rows.join(group_table(level), F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")),
                     "left").drop("_l", "_s")


def distance(xs: list[str]) -> Column:
    """Squared Mahalanobis distance of a row joined with its estimate."""
    total = F.lit(0.0)
    for i, a in enumerate(xs):
        for j, b in enumerate(xs):
            total = total + (F.col(a) - F.col("centre")[i]) * (F.col(b) - F.col("centre")[j]) \
                * F.col("inverse")[i * len(xs) + j]
    return total


def invert(moments: DataFrame, xs: list[str], floors: list[float]) -> DataFrame:
    """_group, centre, inverse and the covariance's log determinant from one row of sums for each group."""
    p = len(xs)

    def solve(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            centre, inverse, size = [], [], []
            for r in rows:
                mean = np.array([r[f"m{i}"] for i in range(p)])
                cov = np.array([[r[f"s{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
                cov = cov - np.outer(mean, mean)
                cov[np.diag_indices(p)] = np.maximum(np.diag(cov), 0) + np.square(floors)
                centre.append(mean.tolist())
                inverse.append(np.linalg.inv(cov).reshape(-1).tolist())
                size.append(float(np.linalg.slogdet(cov)[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["_group"] for r in rows], pa.string()), pa.array(centre, pa.list_(pa.float64())),
                 pa.array(inverse, pa.list_(pa.float64())), pa.array(size, pa.float64())],
                names=["_group", "centre", "inverse", "logdet"])

    return moments.mapInArrow(solve, "_group string, centre array<double>, inverse array<double>, logdet double")


def moments(rows: DataFrame, xs: list[str]) -> DataFrame:
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    sums += [F.avg(F.col(a) * F.col(b)).alias(f"s{i}_{j}")
             for i, a in enumerate(xs) for j, b in enumerate(xs) if i <= j]
    return rows.groupBy("_group").agg(*sums)


def estimate(rows: DataFrame, floors: dict[str, float] = FLOORS, support: float = SUPPORT,
             steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate of each group.

    ``rows`` has _group and the features. Returns _group, centre, inverse and
    scale (what makes the median squared distance that of a normal sample).
    """
    xs, low = list(floors), list(floors.values())
    p = len(xs)
    # starts: squared distance from the medians, or either quartiles, in units of the spread around the medians
    mids = group_table(rows.groupBy("_group").agg(
        *[F.percentile_approx(x, [0.5, 0.25, 0.75], 2000).alias(f"q_{x}") for x in xs]))
    spreads = rows.join(mids, "_group").groupBy("_group").agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"q_{x}")[0]), 0.5, 2000).alias(f"w_{x}") for x in xs])
    begin = group_table(mids.join(spreads, "_group"))
    named = [F.concat("_group", F.lit(f"\x1e{k}")) for k in range(STARTS)]
    away = [sum((F.col(x) - F.col(f"q_{x}")[k]) ** 2 / (f * f + (1.4826 * F.col(f"w_{x}")) ** 2) for x, f in floors.items())
            for k in range(STARTS)]
    start = rows.join(begin, "_group").select(
        F.explode(F.array(*[F.struct(n.alias("_group"), d.alias("_d")) for n, d in zip(named, away)])).alias("_start"), *xs) \
        .select("_start._group", *xs, "_start._d")
    many = rows.select(F.explode(F.array(*named)).alias("_group"), *xs)
    fit = None
    for _ in range(steps):
        cuts = group_table(start.groupBy("_group").agg(F.percentile_approx("_d", support, 2000).alias("_cut")))
        near = start.join(cuts, "_group").where(F.col("_d") <= F.col("_cut"))
        fit = group_table(invert(moments(near, xs), xs, low))
        start = many.join(fit, "_group").withColumn("_d", distance(xs)).select("_group", *xs, "_d")
    best = fit.groupBy(F.expr("left(_group, length(_group) - 2)").alias("_group")).agg(
        F.min(F.struct("logdet", "centre", "inverse")).alias("_best")).select("_group", "_best.centre", "_best.inverse")
    # one step over all rows near the best, to a normal sample's 0.975 quantile
    best = group_table(best)
    start = rows.join(best, "_group").withColumn("_d", distance(xs)).select("_group", *xs, "_d")
    near = start.join(group_table(scales(start, p)), "_group") \
        .where(F.col("_d") * F.col("scale") <= chi_squared(p, 1.96)).select("_group", *xs)
    fit = group_table(invert(moments(near, xs), xs, low).drop("logdet"))
    half = scales(near.join(fit, "_group").select("_group", distance(xs).alias("_d")), p)
    return group_table(fit.join(half, "_group").select("_group", "centre", "inverse", "scale"))


def chi_squared(p: int, z: float) -> float:
    """Quantile of chi-squared at a normal deviate (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def scales(rows: DataFrame, p: int) -> DataFrame:
    """_group and what makes its median _d that of a normal sample; a group tighter
    than the floors is not stretched."""
    half = rows.groupBy("_group").agg(F.percentile_approx("_d", 0.5, 2000).alias("_mid"))
    return half.select("_group", F.least(F.lit(1.0), F.lit(chi_squared(p, 0)) / F.greatest("_mid", F.lit(1e-12))).alias("scale"))


def group_table(groups: DataFrame) -> DataFrame:
    """One small row for each group; broadcast where their number allows it, so
    that a group which holds most rows is never gathered by the join."""
    return small_side(groups, F.lit(40))


def judges(groups: DataFrame, fit: DataFrame, cutoff: float) -> DataFrame:
    """_g, _w and the estimate that judges the rows of each group: its own, or its
    language's where its own centre is an outlier there."""
    p = len(FLOORS)
    wide = fit.select(F.col("_group").alias("_w"), *[F.col(c).alias(f"w_{c}") for c in ("centre", "inverse", "scale")])
    apart = sum((F.col("centre")[i] - F.col("w_centre")[i]) * (F.col("centre")[j] - F.col("w_centre")[j])
                * F.col("w_inverse")[i * p + j] for i in range(p) for j in range(p)) * F.col("w_scale")
    both = groups.join(fit, "_group").select(F.col("_group").alias("_g"), F.col("_wide").alias("_w"), "centre", "inverse", "scale") \
        .join(wide, "_w", "left")
    return both.select("_g", "_w", *[F.when(apart > cutoff, F.col(f"w_{c}")).otherwise(F.col(c)).alias(c)
                                     for c in ("centre", "inverse", "scale")])


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Counts, base_failed, distance (null where none is defined) and kept for every row."""
    rows = materialise(features(text_counts(docs)), "quality-counts")
    rows = materialise(assign_groups(rows), "quality-groups")
    usable = rows.where(~F.col("base_failed"))
    levels = usable.where("_group != _wide").select("_group", *FLOORS).union(usable.select("_wide", *FLOORS))
    if not usable.where(F.col("_wide") == TABLE).isEmpty():
        levels = levels.union(usable.where(F.col("_wide") != TABLE).select(F.lit(TABLE), *FLOORS))
    sizes = levels.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") >= MIN_GROUP)
    fit = estimate(levels.join(group_table(sizes.select("_group")), "_group"))
    fit = group_table(judges(usable.select("_group", "_wide").distinct(), fit, cutoff))
    far = F.when(~F.col("base_failed"), distance(list(FLOORS)) * F.col("scale"))
    same = F.col("_group").eqNullSafe(F.col("_g")) & F.col("_wide").eqNullSafe(F.col("_w"))
    return rows.join(fit, same, "left").withColumn("distance", far).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)).alias("kept"), "distance")
