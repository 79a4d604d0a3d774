"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import (byte_bpe, cover_lloyd, fill_middle, forest_search, huffman, line_dedup, packing, quality,
                          rp_forest, token_count, toxicity, trie_join, url_filter)
from shoplens.llm.common import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_digest(read_table(spark, base, "documents"))


@query
def op2_token_file(spark: SparkSession, base: str) -> DataFrame:
    return huffman.round_trip_digest(read_table(spark, base, "documents"))


@query
def op3_url_filter(spark: SparkSession, base: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, base, "pages"))


@query
def op5_quality_outliers(spark: SparkSession, base: str) -> DataFrame:
    return quality.judge(read_table(spark, base, "documents"))


@query
def op6_toxic_spans(spark: SparkSession, base: str) -> DataFrame:
    return toxicity.judge(read_table(spark, base, "documents"), read_table(spark, base, "labels"))


@query
def op7_trie_join(spark: SparkSession, base: str) -> DataFrame:
    return trie_join.join_documents(read_table(spark, base, "documents"))


@query
def op8_token_counts(spark: SparkSession, base: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, base, "documents"))


@query
def op10_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    return byte_bpe.round_trip_digest(read_table(spark, base, "documents"))


@query
def op9_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    return line_dedup.dedup_report(read_table(spark, base, "documents"))


@query
def op4_embedding_forest(spark: SparkSession, base: str) -> DataFrame:
    return rp_forest.near_duplicates(read_table(spark, base, "embeddings"))


@query
def op11_cover_lloyd(spark: SparkSession, base: str) -> DataFrame:
    return cover_lloyd.compress(read_table(spark, base, "embeddings"))


@query
def op12_forest_search(spark: SparkSession, base: str) -> DataFrame:
    return forest_search.nearest(read_table(spark, base, "embeddings"))


@query
def op13_fill_middle(spark: SparkSession, base: str) -> DataFrame:
    return fill_middle.transform_digest(read_table(spark, base, "documents"))


ORACLE["op13_fill_middle"] = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# Every pair compared: what the search finds on tables that one leaf holds.
ORACLE["op12_forest_search"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


def lloyd_sql(parts: int = cover_lloyd.PARTS, entries: int = cover_lloyd.ENTRIES, rounds: int = cover_lloyd.ROUNDS) -> str:
    """Every entry compared in each round; ``book`` has a row for each part, entry and component."""
    steps = [f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
  FROM kept, range({parts}) r(p)),
book0 AS MATERIALIZED (
  SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM points)
  WHERE e < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f""",
near{k} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(a.x) AS x,
         min(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 256 + e) AS best
  FROM points a JOIN book{k} b USING (p) GROUP BY vec_id, p)""")
        if k < rounds:
            steps.append(f""",
mean{k} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS x
  FROM (SELECT p, best % 256 AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
        FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, best % 256, i)
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e)""")
    steps.append(f""",
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code,
         sum(best // 256)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded, digest""")
    return "".join(steps)


ORACLE["op11_cover_lloyd"] = lloyd_sql()

ORACLE["op4_embedding_forest"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id),
roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id),
degrees AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON roots.id = vec_id LEFT JOIN degrees ON degrees.id = vec_id
"""

SQL_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

# Every pair of documents that share a shingle is counted.
ORACLE["op7_trie_join"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
flat AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) + any_value(y.n) AS n, count(*) AS shared
                    FROM flat x JOIN flat y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  WHERE 100 * shared >= 75 * (n - shared)),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT id, min(root) AS component_id FROM reach GROUP BY id) ON id = doc_id
"""

# Lines one word edit apart share the line without that word, at one place or as a whole line.
ORACLE["op9_line_dedup"] = f"""
WITH split AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS MATERIALIZED (
  SELECT doc_id, line, {SQL_WORDS.format("lines[line + 1]")} AS w
  FROM (SELECT doc_id, lines, unnest(range(len(lines))) AS line FROM split)),
classes AS MATERIALIZED (
  SELECT w, min((doc_id, line)) AS first FROM lines WHERE len(w) >= 3 GROUP BY w),
variants AS MATERIALIZED (
  SELECT first, w, 0 AS spot, md5(array_to_string(w, ' ')) AS key FROM classes WHERE len(w) >= 5
  UNION ALL
  SELECT first, w, spot, md5(array_to_string(w[:spot - 1] || w[spot + 1:], ' '))
  FROM (SELECT first, w, unnest(range(1, len(w) + 1)) AS spot FROM classes WHERE len(w) >= 5)),
near AS (
  SELECT DISTINCT x.w FROM variants x JOIN variants y
  ON x.key = y.key AND x.first > y.first AND (x.spot = y.spot OR x.spot = 0 OR y.spot = 0)),
gone AS MATERIALIZED (
  SELECT doc_id, line FROM lines JOIN classes USING (w) WHERE first <> (doc_id, line)
  UNION SELECT doc_id, line FROM lines JOIN near USING (w)),
removed AS (SELECT doc_id, count(*) AS n, list(line) AS numbers FROM gone GROUP BY doc_id)
SELECT doc_id, len(lines) AS n_lines, coalesce(n, 0) AS n_removed,
       CASE WHEN n IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda x, i: NOT list_contains(numbers, i - 1)), chr(10)) END AS kept_text
FROM split LEFT JOIN removed USING (doc_id)
"""
