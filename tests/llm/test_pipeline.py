"""The pipeline: each stage on its own input, and the whole run."""

import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from cases import awkward, DEALT_STAGES
from conftest import SMALL
from shoplens.llm import line_dedup, packing, quality, toxicity, trie_join
from shoplens.llm.common import WordEncoder, tokenizer_file


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == DEALT_STAGES
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SMALL).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "quality_rules":
            kept = {r.doc_id for r in quality.judge(before).where("kept").collect()}
            assert {r.doc_id for r in after.collect()} == kept and 0 < len(kept) < before.count()
        if name == "toxicity":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            kept = {r.doc_id for r in toxicity.judge(before, labels).where("predicted = 0").collect()}
            assert {r.doc_id for r in after.collect()} == kept
        if name == "line_dedup":
            want = {r.doc_id: r.kept_text for r in line_dedup.dedup_report(before).collect()
                    if not r.n_removed or r.kept_text.strip()}
            assert {r.doc_id: r.text for r in after.collect()} == want
        if name == "ngram_jaccard_join":
            groups = trie_join.join_documents(before).collect()
            assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups}
        if k < 4:
            assert after.columns == columns
        before = after
    run = __spark_entry__.queries()["pipeline"](spark, SMALL)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(key).collect())) == sorted(map(tuple, before.select(key).collect()))


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        out.count()
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name


@pytest.mark.parametrize("text_operator", [
    packing.cut_pieces, quality.text_counts, line_dedup.line_table, trie_join.frequent_shingles,
    lambda docs: toxicity.tag(docs, toxicity.Field({}))])
def test_texts_reach_python_in_batches_bounded_by_bytes(spark, text_operator):
    docs = spark.newSession().range(0, 9_000, 1, 1).selectExpr(
        "id doc_id", "'en' lang", "'web' source", "repeat(concat(id, ' words '), 200) text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    text_operator(docs)
    got = docs.select("doc_id", "text").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 9_000 and max(r["size"] for r in got) < 5_000_000


def test_the_packing_table_of_words_is_small_and_may_start_anew():
    path = tokenizer_file("word_bpe_49k.json")
    small, texts = WordEncoder(path, 3), pa.array([f"a{i} b{i % 7} c" for i in range(50)], pa.large_string())
    for at in range(0, 50, 5):
        ids, bounds = small.encode(texts.slice(at, 5))
        for i in range(5):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == small.library.encode(
                texts[at + i].as_py(), add_special_tokens=False).ids
    assert packing.KNOWN_WORDS <= 160_000
