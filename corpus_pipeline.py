"""Corpus pipeline: quality, toxicity, repeated lines, near copies, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents. Decisions
are by doc_id, null included: rows that share one stay if any of them is to
stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import line_dedup, packing, quality, toxicity, trie_join
from shoplens.llm.common import fresh, materialise, read_table, small_side


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``kept``; texts move only if the ids are many."""
    name = fresh(docs, "_kept")
    ids = small_side(kept.select(F.col("doc_id").alias(name)).distinct(), F.lit(2))
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base limits that are no outliers of their language and source."""
    return _only(docs, quality.judge(docs).where("kept"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, fitted to the labelled ones among them, does not call toxic."""
    judged = toxicity.judge(docs, read_table(spark, sf_dir, "labels"))
    return _only(docs, judged.where("predicted = 0"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; those left empty go."""
    out, _, removed = line_dedup.dedup_lines(docs)
    return (out.where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))
            .select(*docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    groups = trie_join.join_documents(docs)
    return _only(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with sequence and offset."""
    return packing.pack_digest(docs)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity_filter), ("line_dedup", line_dedup_stage),
          ("ngram_jaccard_join", ngram_join), ("best_fit_packing", best_fit_packing)]

# Outliers, the random field and the joins are not expressible in SQL. Tests hold
# each stage against its operator, and the operators of line_dedup and
# ngram_jaccard_join against brute force; of quality_rules and toxicity only the
# counts and the marginals are, their verdicts are tested on made-up documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
