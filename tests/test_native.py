"""The original's own tables: faulty rows, day partitions, buckets."""

import contextlib
import io
import tempfile

from conftest import SMALL
from shoplens.operators import sessions
from shoplens.plans.model import DEFAULT_PARAMS, Model
from shoplens.sources import native

COLUMNS = ("date string, user_id string, session_id string, page_id string, action_time string, search_keyword string, "
           "click_category_id string, click_product_id string, order_category_ids string, order_product_ids string, "
           "pay_category_ids string, pay_product_ids string, city_id string")
FINE = ("2024-01-05", "7", "s1", "3", "2024-01-05 5:03:09", "", "12", "", "1, 2,2", None, "-1", "", "4")


def raw(spark, *changes):
    rows = [tuple(c.get(i, v) for i, v in enumerate(FINE)) for c in changes]
    return spark.createDataFrame(rows, COLUMNS)


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fields_are_read(spark):
    row = native.actions(raw(spark, {})).collect()[0]
    assert str(row.date) == "2024-01-05" and str(row.action_time) == "2024-01-05 05:03:09"
    assert (row.user_id, row.page_id, row.city_id, row.click_category_id) == (7, 3, 4, 12)
    assert row.click_product_id is None and row.search_keyword is None
    assert row.order_category_ids == [1, 2, 2] and row.order_product_ids is None and row.pay_category_ids is None


def test_faulty_rows_are_rejected_with_their_field(spark):
    faults = {0: "2024-13-01", 1: "x", 2: " ", 3: "p", 4: "noon", 6: "1x", 7: "--1", 8: "1,,2", 11: "9;9", 12: "c"}
    rows = raw(spark, {}, *[{i: v} for i, v in faults.items()], {0: None}, {1: None}, {2: None}, {4: None}, {3: None}, {6: None})
    assert native.actions(rows).count() == 3                       # page and click category may be missing
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    got = sorted(r.reason for r in native.rejected(rows).collect())
    assert got == sorted([names[i] for i in faults] + ["date", "user_id", "session_id", "action_time"])
    assert all('"session_id"' in r.record or r.reason == "session_id" for r in native.rejected(rows).collect())


def test_admitted_days_are_pruned_and_columns_cut(spark):
    folder = tempfile.mkdtemp(prefix="admit-")
    m = Model(spark, SMALL)
    native.store_actions(m.actions(None)).write.partitionBy("date").parquet(f"{folder}/user_visit_action")
    stored = native.NativeModel(spark, folder)
    native.admit(stored.raw_actions(), f"{folder}/admitted")
    p = plan_of(native.NativeModel(spark, folder, f"{folder}/admitted").actions(DEFAULT_PARAMS).select("session_id"))
    assert "PartitionFilters: [isnotnull(date" in p and "ReadSchema: struct<session_id:string>" in p
    assert "PartitionFilters: [" in plan_of(stored.actions(DEFAULT_PARAMS)) and "2024-01-30" in plan_of(stored.actions(DEFAULT_PARAMS))
    assert spark.read.parquet(f"{folder}/admitted/rejected").count() == 0
    a = native.NativeModel(spark, folder, f"{folder}/admitted").actions(DEFAULT_PARAMS)
    b = stored.actions(DEFAULT_PARAMS)
    assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(b.columns))).count() == 0 and a.count() == b.count()


def test_native_model_pins_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        native.NativeModel(spark, "nowhere")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bucketed_actions_do_not_move(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    name = "shoplens_bucketed_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    acts = native.bucketed(Model(spark, SMALL).actions(DEFAULT_PARAMS), name, tempfile.mkdtemp(prefix="b-") + "/t", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in plan_of(sessions.sessionize(acts))
        kept = sessions.sessionize(acts).where("step_length > 1").select("session_id")
        assert "Exchange" not in plan_of(sessions.filtered_actions(acts, kept))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE {name}")
