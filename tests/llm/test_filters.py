"""Operators 3, 5 and 6: url filter, quality rules, toxic spans."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from cases import awkward, empty, prose, words
from conftest import MEDIUM
from shoplens.llm import quality, toxicity, url_filter

URLS = [None, "", "no scheme", "http://A.Net", "http://a.net/", "HTTPS://Ex.EXAMPLE.net/en/1?q#f", "x://example.net/en",
        "http://example.net/en/", "http://notexample.net/en/", "http://example.com/de/x", "http://b.example.com/de/",
        "http://example.com/DE/", "http://q.org/fr/1", "http://org/fr/", "http://:80?x/y", "http://h#f/", "a://b://c/d",
        "http://é.net/ü?", "http://" + "l" * 50_000 + ".net/" + "p" * 50_000]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(len(h + p), h + p, kind) for kind, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_split_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3])], "page_id long, url string") \
        .selectExpr("*", "'x' AS host", "'x' AS path", "'x' AS rule", "null AS html")
    rows = url_filter.filter_urls(pages).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = parsed(URLS[r.page_id])
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(unlabelled).collect()] == ["allow"]


def test_url_model_on_held_out_urls(spark):
    """Trained on half of the urls that rules decide, judged on the other half."""
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    rule, verdict = url_filter.fitting_rule()
    rows = url_filter.split_url(pages).select("host", "path", verdict.alias("v")).where("v is not null").distinct().collect()
    y = np.array([r.v == "block" for r in rows], float)
    half = np.array([zlib.crc32((r.host + r.path).encode()) % 2 == 0 for r in rows])
    hosts, paths = np.array([r.host for r in rows], object), np.array([r.path for r in rows], object)
    w, b = url_filter.train(list(hosts[half]), list(paths[half]), y[half])
    p = url_filter.scores(list(hosts[~half]), list(paths[~half]), w, b)
    assert ((p > 0.5) == y[~half]).mean() >= 0.9


def test_long_urls_are_scored_in_bounded_runs(spark, monkeypatch):
    """Runs bound what is widened at once, and change no verdict."""
    base = [f"http://h{i}.com/" + "ab" * (50_000 if i % 40 == 0 else 20) for i in range(200)] + ["http://x.net/de/a", "http://y.org/fr/b"]
    pages = spark.createDataFrame(list(enumerate(base)), "page_id long, url string")
    got = {r.page_id: (r.verdict, r.block_score) for r in url_filter.filter_urls(pages).collect()}
    sizes = []
    one = url_filter.gram_buckets
    monkeypatch.setattr(url_filter, "gram_buckets", lambda h, p: sizes.append(sum(map(len, h + p))) or one(h, p))
    runs = list(url_filter.byte_runs([len(u) for u in base], url_filter.RUN_BYTES))
    for lo, hi in runs:
        url_filter.gram_buckets([""] * (hi - lo), base[lo:hi])
    assert max(sizes) <= url_filter.RUN_BYTES + 200 and len(runs) >= 2 and len(got) == len(base)


def brute_counts(text):
    w, t = words(text), text or ""
    seen, repeated = set(), 0
    for line in t.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), repeated, len(inside)


def test_quality_counts(spark):
    extra = ["a b c a b c a", "x\nx\n\n \n \nx", "## $% &|<>*", "a a a a", "\x1c\x85 y", "x\ty\x0bz\x0cq\rr"]
    docs = awkward(spark).select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame([(100 + i, t, "en", "z") for i, t in enumerate(extra)],
                              "doc_id long, text string, lang string, source string"))
    want = Counter()
    for r in docs.collect():
        n = brute_counts(r.text)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        want[(r.doc_id, *n, failed, not failed)] += 1
    rows = quality.judge(awkward(spark).unionByName(docs.limit(0), allowMissingColumns=True)).collect()
    assert len(rows) == awkward(spark).count()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in quality.judge(docs).collect())
    assert got == want
    assert quality.judge(empty(spark)).count() == 0


def test_outliers_go_and_plain_documents_stay(spark):
    rows = [(i, prose(i, 120), "en", "a" if i % 3 else "b") for i in range(240)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in prose(i, 120).split()), "en", "a") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert kept == set(range(240))


def test_each_feature_rejects(spark):
    """Long words, repeated lines, repeated windows and one-word lines, each beyond what the
    base limits see, in a clean group; a few repeats and symbols stay."""
    rows = [(i, prose(i, 150), "en", "a") for i in range(400)]
    bad = {}
    for i in range(20):
        w = prose(5000 + i, 150).split()
        long = " ".join("".join(prose(6000 + 200 * i + k, 12).split())[:30] for k in range(80))
        line = " ".join(w[:2])
        twice = w[:90] + w[:30] + w[90:120]
        bad[1000 + i] = long
        bad[2000 + i] = "\n".join([" ".join(w[4:60])] + [x for k in range(13) for x in (line, f"{w[60 + k]} {w[80 + k]}")])
        bad[3000 + i] = " ".join(twice)
        bad[4000 + i] = "\n".join([" ".join(w[:70])] + [x for k in range(30) for x in (w[100], w[101 + k])])
        light = w[:40] + ["see #1", "50%"] + w[40:120]
        rows.append((7000 + i, " ".join(light), "en", "a"))
    rows += [(k, t, "en", "a") for k, t in bad.items()]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == set(bad)


def test_junk_of_a_junk_heavy_source_goes(spark):
    """Sources with 30, 45 and 70 % of symbol-filled rows; the language is mostly clean."""
    rows, junk = [], set()
    for source, n, bad in (("a", 300, 0), ("b", 100, 30), ("c", 100, 45), ("d", 100, 70)):
        for i in range(n):
            key = len(rows)
            text = prose(key, 120)
            if i < bad:
                junk.add(key)
                text = " ".join(w + "%" * (3 + key % 3) for w in text.split())
            rows.append((key, text, "en", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.judge(docs).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == junk


def test_junk_of_small_groups_goes(spark):
    """A small source of a large language and a small language, too few to pool."""
    rows, junk = [], set()
    for lang, source, n, bad in (("en", "a", 200, 0), ("en", "b", 10, 4), ("fr", "a", 6, 2)):
        for i in range(n):
            key = len(rows)
            text = prose(key, 120)
            if i < bad:
                junk.add(key)
                text = " ".join(w + "%%%" for w in text.split())
            rows.append((key, text, lang, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.judge(docs).where("not kept").collect()} == junk


def test_estimate_withstands_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(1)
    good = rng.multivariate_normal([1, 2], [[1.0, 0.6], [0.6, 1.0]], 800)
    bad = rng.normal(30, 0.1, (160, 2))
    rows = [("g", float(a), float(b)) for a, b in np.vstack([good, bad])]
    fit = quality.estimate(spark.createDataFrame(rows, "_group string, a double, b double"), {"a": 0.01, "b": 0.01}).first()
    assert np.allclose(fit.centre, [1, 2], atol=0.2)
    cov = np.linalg.inv(np.array(fit.inverse).reshape(2, 2))
    assert 0.3 < cov[0, 1] / np.sqrt(cov[0, 0] * cov[1, 1]) < 0.8


def brute_marginals(model, weights):
    """Toxic marginal of every word, by summing over all label sequences."""
    n = len(weights)
    total, own = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        p, last = 1.0, 0
        for w, y in zip(weights, labels):
            p *= model.step[last, y] * (np.exp(model.bias + w) if y else 1.0)
            last = y
        total += p
        own += p * np.array(labels)
    return own / total


def test_marginals_are_those_of_the_full_chain():
    model = toxicity.Field({"bad$": 5.0, "worse$": 8.0}, -3.0, -0.5, 0.3, 1.2)
    texts = ["a bad b c worse bad", "bad", "a b c d", "worse worse x y z bad q", "", "x bad"]
    column = pa.array(texts, pa.large_string())
    seen, p, doc, place = toxicity.evidence(model, column)
    score, spans = toxicity.score_run(model, column)
    for i, t in enumerate(texts):
        w = t.split()
        weights = [model.emission(x) for x in w]
        want = brute_marginals(model, weights) if w else np.zeros(0)
        active = [k for k, x in enumerate(weights) if x]
        assert place[doc == i].tolist() == active and np.allclose(p[doc == i], want[active])
        assert np.isclose(seen[i, 0], np.log1p(want[active].sum()))
        assert [(x["start"], x["end"]) for x in spans[i]] == \
            [m.span() for k, m in enumerate(re.finditer(r"\S+", t)) if k in active and want[k] >= 0.5]
    assert score[texts.index("")] == 0 and ((0 <= score) & (score <= 1)).all()


def toxic_docs(n=600):
    rows, labels = [], []
    for i in range(n):
        w, bad = prose(i, 60).split(), i % 4 == 0
        if bad:
            w[7], w[30] = "scumbag.", "Loserly" if i % 8 else "loserish,"
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxic_documents_are_found_in_held_out_rows(spark):
    rows, labels = toxic_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (99_999, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.judge(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.doc_id % 4 == 0) == int(r.score >= 0.3)
    spans = toxicity.detect(docs, marks).where("doc_id = 4").first().spans
    text = rows[4][1]
    assert "scumbag." in [text[s.start:s.end] for s in spans]


def test_labels_of_absent_documents_do_not_use_up_the_sample(spark, monkeypatch):
    """A labels table wider than the documents, and texts too long for the fit."""
    monkeypatch.setattr(toxicity, "SAMPLE", 200)
    rows, labels = toxic_docs(400)
    rows += [(900, " ".join(prose(900, 20_000).split()), "en", "s", 1)]
    labels += [(i, 1, i % 2) for i in range(100_000, 105_000)] + [(900, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    texts = toxicity.sample_texts(docs, marks, 200)
    assert len(texts[0]) + len(texts[1]) >= 250 and max(map(len, texts[0])) <= toxicity.SAMPLE_BYTES
    got = {r.doc_id: r.predicted for r in toxicity.judge(docs, marks).collect()}
    assert all(got[i] == int(i % 4 == 0) for i in range(400)) and got[900] == 0


def test_toxicity_of_awkward_rows(spark):
    rows, labels = toxic_docs(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = awkward(spark)
    got = toxicity.judge(docs, marks).collect()  # few labelled rows: no field can be fitted
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert toxicity.judge(empty(spark), marks).count() == 0
    assert toxicity.judge(docs, marks.limit(0)).where("score > 0").count() == 0
