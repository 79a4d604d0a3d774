"""Awkward rows that every operator must take, and small brute-force helpers."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TABLE = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def prose(seed, words=80):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 8))) for _ in range(words))


def awkward(spark):
    """Null, empty, blank and very long texts, repeated rows, shared ids, odd characters,
    and columns whose names the operators use themselves."""
    near = prose(1).split()
    near[40] = "changed"
    rows = [(1, prose(1), "en", "a", 10), (2, prose(1), "en", "a", 10), (3, " ".join(near), "en", "b", 10),
            (4, None, "en", "a", None), (5, "", None, "a", 0), (6, " \n\t ", "en", None, 3),
            (7, LONG, "en", "a", len(LONG)), (8, LONG + " end", "en", "a", 1), (9, "one two", "de", "a", 7),
            (10, "One two", "de", "a", 7), (10, "One two", "de", "a", 7), (11, "é\u0301 漢字 😀 ß\x85y <|endoftext|> x", "fr", "a", 1),
            (None, prose(2), "en", "a", 1), (None, None, None, None, None),
            (12, prose(3) + "\n" + prose(4, 20), "en", "a", 1), (13, prose(4, 20) + "\n\n" + prose(5), "en", "a", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("piece", "ids", "start", "length", "n", "key", "cid", "line", "token", "prefix", "score",
                 "_group", "_rank", "_gone", "component", "id", "u", "v", "rank", "weight", "distance", "kept"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode().split()


def low_words(text):
    return (text or "").encode().translate(TABLE).split()


def shingles(text):
    w = low_words(text)
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


class Groups:
    """Union of keys; the root is the smallest."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)

DEALT_STAGES = ["quality_rules", "toxicity", "line_dedup", "ngram_jaccard_join", "best_fit_packing"]
