"""Physical-plan properties that matter at scale."""

import contextlib
import io

import pytest

from conftest import SMALL
from shoplens.plans.queries import REGISTRY

STREAM_OR_SINK = {n for n in REGISTRY if n.startswith("stream_")} | {
    "upsert_add", "upsert_set", "replace_groups"}
PLANNED = sorted(set(REGISTRY) - STREAM_OR_SINK)


def plan_of(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        REGISTRY[name](spark, SMALL).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan_of(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["session_stats", "session_filtered", "top10_categories",
                                  "area_top3_products", "scan_actions_range"])
def test_date_range_reaches_parquet(spark, name):
    p = plan_of(spark, name)
    assert "GreaterThanOrEqual(ts," in p and "LessThan" in p, name


@pytest.mark.parametrize("name", ["area_top3_products", "area_top3_orders", "province_top3",
                                  "top10_active_sessions", "session_extract"])
def test_partial_window_group_limit(spark, name):
    p = plan_of(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p, name


@pytest.mark.parametrize("name", ["top10_categories", "top10_products_universe"])
def test_global_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


def test_actions_scan_reads_needed_columns_only(spark):
    p = plan_of(spark, "area_top3_products")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
