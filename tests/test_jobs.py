import tempfile

from conftest import SMALL
from shoplens.plans.jobs import parquet_sink, run_area_job, run_session_job
from shoplens.plans.model import DEFAULT_PARAMS, Model
from shoplens.plans.queries import REGISTRY
from shoplens.sinks.writers import replace_table, tag_run


def rows_of(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_session_job_outputs_equal_queries(spark):
    m = Model(spark, SMALL)
    out = tempfile.mkdtemp(prefix="job-")
    taskid = run_session_job(m.actions(DEFAULT_PARAMS), m.users(), m.products(), DEFAULT_PARAMS,
                             parquet_sink(out), sample_total=1000, seed="shoplens")
    stat = spark.read.parquet(f"{out}/session_stat")
    want = REGISTRY["session_stats"](spark, SMALL)
    assert rows_of(stat, want.columns) == rows_of(want, want.columns)
    assert {r.taskid for r in stat.collect()} == {taskid}
    top = spark.read.parquet(f"{out}/top10_category")
    want = REGISTRY["top10_categories"](spark, SMALL)
    assert rows_of(top, want.columns) == rows_of(want, want.columns)
    ext = spark.read.parquet(f"{out}/session_extract")
    want = REGISTRY["session_extract"](spark, SMALL)
    assert sorted(r.session_id for r in ext.collect()) == \
        sorted(r.session_id for r in want.collect())
    for name in ("session_detail", "top10_product", "top10_session"):
        assert spark.read.parquet(f"{out}/{name}").count() > 0


def test_area_job_appends(spark):
    m = Model(spark, SMALL)
    out = tempfile.mkdtemp(prefix="area-job-")
    run_area_job(m.actions(DEFAULT_PARAMS), m.products(), m.city_dim(), parquet_sink(out), taskid="t1")
    run_area_job(m.actions(DEFAULT_PARAMS), m.products(), m.city_dim(), parquet_sink(out), taskid="t2")
    got = spark.read.parquet(f"{out}/area_top3_product")
    n = REGISTRY["area_top3_products"](spark, SMALL).count()
    assert got.count() == 2 * n
    assert {r.taskid for r in got.select("taskid").distinct().collect()} == {"t1", "t2"}


def test_replace_table(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    replace_table(tag_run(df, "a"), "shoplens_replace_test")
    replace_table(tag_run(df.limit(2), "b"), "shoplens_replace_test")
    got = spark.table("shoplens_replace_test")
    assert got.count() == 2 and {r.taskid for r in got.collect()} == {"b"}
    spark.sql("DROP TABLE shoplens_replace_test")


def test_cli_runs_session_area_and_stream(spark):
    import json

    from shoplens.__main__ import main
    out = tempfile.mkdtemp(prefix="cli-")
    params = json.dumps({"startDate": "2024-01-01", "endDate": "2024-01-30",
                         "startAge": 20, "endAge": 50})
    assert main(["session", "--input", SMALL, "--output", out, "--params", params,
                 "--sample-total", "50", "--seed", "s"]) == 0
    assert main(["area", "--input", SMALL, "--output", out, "--params", params]) == 0
    assert spark.read.parquet(f"{out}/session_stat").count() == 1
    assert spark.read.parquet(f"{out}/area_top3_product").count() > 0
    assert main(["ads", "--input", SMALL, "--tables", f"{out}/ads", "--checkpoint",
                 f"{out}/ads-ckpt", "--threshold", "1", "--once"]) == 0
    from shoplens.streaming import ad_stream
    assert ad_stream.AdTables.at(spark, f"{out}/ads").ad_stat.read().count() > 0
