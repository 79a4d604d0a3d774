"""Stream = batch, replay, restart and late-data tests of the ad stream."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from shoplens.operators import ads
from shoplens.plans.model import Model
from shoplens.schemas import AD_LOG
from shoplens.session import folder_names
from shoplens.sources import adlog
from shoplens.streaming import ad_stream

SPLITS = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def to_parquet(pdf, path):
    pdf.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)


def write_split(spark, log, folder, i):
    lo, hi = SPLITS[i], SPLITS[i + 1]
    part = log.filter((F.col("ts") >= F.lit(lo).cast("timestamp"))
                      & (F.col("ts") < F.lit(hi).cast("timestamp"))).toPandas()
    part["ts"] = part["ts"].dt.tz_localize("UTC")
    to_parquet(part, os.path.join(folder, f"log_{i}.parquet"))


@pytest.fixture(scope="module")
def log(spark):
    return Model(spark, MEDIUM).ad_log().persist()


def run(spark, folder, root, threshold):
    tables = ad_stream.AdTables.at(spark, f"{root}/tables")
    stream = adlog.file_stream(spark, folder, AD_LOG, max_files_per_trigger=1)
    q = ad_stream.start_ad_pipeline(stream, tables, f"{root}/ckpt", threshold,
                                    trigger={"availableNow": True})
    q.awaitTermination()
    return tables, q


def sequential_batches(spark, log, threshold, n=3):
    """Brute force: the batch definitions applied batch after batch."""
    blacklist = log.select("userid").limit(0)
    totals, city = None, None
    for i in range(n):
        lo, hi = SPLITS[i], SPLITS[i + 1]
        b = log.filter((F.col("ts") >= F.lit(lo).cast("timestamp"))
                       & (F.col("ts") < F.lit(hi).cast("timestamp")))
        clean, _, totals, added = ads.blacklist_step(b, blacklist, totals, threshold)
        blacklist = blacklist.unionByName(added)
        city = ads.add_counts(city, ads.clicks_by_city_ad_day(clean), ads.CITY_AD_KEYS)
    return blacklist, totals, city


def test_stream_equals_batch_without_blocking(spark, log):
    folder = tempfile.mkdtemp(prefix="adlog-")
    for i in range(3):
        write_split(spark, log, folder, i)
    tables, q = run(spark, folder, tempfile.mkdtemp(prefix="adrun-"), threshold=10 ** 9)
    assert q.lastProgress is not None
    assert rows_of(tables.ad_stat.read()) == rows_of(ads.clicks_by_city_ad_day(log))
    assert rows_of(tables.click_trend.read()) == \
        rows_of(ads.minute_counts(log).drop("minute_start"))
    assert rows_of(tables.province_top3.read()) == \
        rows_of(ads.top_n_per_province(ads.province_counts(log), 3))
    assert tables.blocked().count() == 0


def test_stream_blacklist_feedback_equals_sequential_batches(spark, log):
    folder = tempfile.mkdtemp(prefix="adlog-")
    for i in range(3):
        write_split(spark, log, folder, i)
    tables, _ = run(spark, folder, tempfile.mkdtemp(prefix="adrun-"), threshold=1)
    blacklist, totals, city = sequential_batches(spark, log, 1)
    assert rows_of(tables.blocked()) == rows_of(blacklist)
    assert rows_of(tables.user_clicks.read()) == rows_of(totals)
    assert rows_of(tables.ad_stat.read()) == rows_of(city)


def test_restart_from_checkpoint(spark, log):
    folder = tempfile.mkdtemp(prefix="adlog-")
    root = tempfile.mkdtemp(prefix="adrun-")
    write_split(spark, log, folder, 0)
    write_split(spark, log, folder, 1)
    run(spark, folder, root, threshold=1)
    write_split(spark, log, folder, 2)
    tables, _ = run(spark, folder, root, threshold=1)      # same checkpoint
    blacklist, totals, city = sequential_batches(spark, log, 1)
    assert rows_of(tables.blocked()) == rows_of(blacklist)
    assert rows_of(tables.ad_stat.read()) == rows_of(city)


def test_replayed_batch_is_idempotent(spark, log):
    root = tempfile.mkdtemp(prefix="adrun-")
    tables = ad_stream.AdTables.at(spark, root)
    b0 = log.filter(F.col("ts") < F.lit(SPLITS[1]).cast("timestamp"))
    b1 = log.filter(F.col("ts") >= F.lit(SPLITS[1]).cast("timestamp"))
    ad_stream.process_batch(tables, b0, 0, 1)
    ad_stream.process_batch(tables, b1, 1, 1)
    before = [rows_of(t.read()) for t in tables.all()]
    ad_stream.process_batch(tables, b1, 1, 1)                # replay of batch 1
    after = [rows_of(t.read()) for t in tables.all()]
    assert before == after


def test_late_rows_dropped_by_watermark(spark):
    folder = tempfile.mkdtemp(prefix="late-")
    d0 = dt.datetime(2024, 1, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
    import pandas as pd
    # A row is late once the watermark of the batch before it has passed its
    # window (Spark checks late input against the previous batch's watermark,
    # the one that evicted the window's state).
    batches = [
        [(d0, "P", "C", 1, 1)],
        [(d0 + dt.timedelta(days=3), "P", "C", 1, 1)],        # moves the watermark on
        [(d0 + dt.timedelta(days=3, minutes=1), "P", "C", 2, 1)],  # day 1 evicted here
        [(d0, "P", "C", 2, 1), (d0 + dt.timedelta(days=3, minutes=2), "P", "C", 2, 1)],
    ]
    for i, b in enumerate(batches):
        pd.DataFrame(b, columns=["ts", "province", "city", "userid", "adid"]) \
            .pipe(to_parquet, os.path.join(folder, f"b{i}.parquet"))
    root = tempfile.mkdtemp(prefix="late-run-")
    from shoplens.sinks.running import RunningTable
    table = RunningTable(spark, f"{root}/t", ad_stream.AD_STAT)
    stream = adlog.file_stream(spark, folder, AD_LOG, max_files_per_trigger=1)
    q = ad_stream.write_set_stream(ad_stream.running_city_counts(stream, "1 hour"), table, ads.CITY_AD_KEYS,
                                   f"{root}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    got = {(r.date, r.click_count) for r in table.read().collect()}
    assert got == {("20240101", 1), ("20240104", 3)}          # the late row is not counted
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    assert dropped == 1


def day_rows(spark, *rows):
    """AD_STAT rows of (day, ad, clicks)."""
    return spark.createDataFrame([(f"2024010{d}", "P", "C", a, n) for d, a, n in rows], ad_stream.AD_STAT)


ADD = ad_stream.adding(ads.CITY_AD_KEYS)
SET = ad_stream.setting(ads.CITY_AD_KEYS)


def stat_table(spark):
    from shoplens.sinks.running import RunningTable
    return RunningTable(spark, tempfile.mkdtemp(prefix="stat-"), ad_stream.AD_STAT)


def held(table):
    return sorted((int(r.date[-1]), r.adid, r.click_count) for r in table.read().collect())


def test_merge_rewrites_only_touched_partitions(spark):
    table = stat_table(spark)
    table.merge(day_rows(spark, (1, 1, 5), (2, 1, 6), (3, 1, 7)), 0, ADD)
    before = {d: folder_names(spark, f"{table.path}/date=2024010{d}") for d in (1, 2, 3)}
    table.merge(day_rows(spark, (2, 1, 1), (2, 2, 9)), 1, ADD)
    after = {d: folder_names(spark, f"{table.path}/date=2024010{d}") for d in (1, 2, 3)}
    assert after[1] == before[1] and after[3] == before[3] and after[2] != before[2]
    assert held(table) == [(1, 1, 5), (2, 1, 7), (2, 2, 9), (3, 1, 7)]
    table.merge(day_rows(spark, (2, 1, 100), (4, 1, 1)), 2, SET)
    assert held(table) == [(1, 1, 5), (2, 1, 100), (2, 2, 9), (3, 1, 7), (4, 1, 1)]
    assert folder_names(spark, table.batches) == ["batch_id=2"]


@pytest.mark.parametrize("combine", [ADD, SET])
def test_merge_survives_a_crash_at_any_step(spark, monkeypatch, combine):
    """The batch dies before its folder is complete, before the table is
    overwritten, or between two partitions of the overwrite; then it is replayed."""
    from shoplens.sinks.running import RunningTable
    first, second = day_rows(spark, (1, 1, 5), (2, 1, 6)), day_rows(spark, (1, 1, 1), (2, 2, 3))
    want = None
    for step in ("none", "folder", "overwrite", "half"):
        table = stat_table(spark)
        table.merge(first, 0, combine)
        if step == "folder":        # files of a writer that never committed
            day_rows(spark, (1, 1, 999)).write.parquet(f"{table.batches}/batch_id=1")
            os.remove(f"{table.batches}/batch_id=1/_SUCCESS")
        if step in ("overwrite", "half"):
            def dies(self, rows, step=step, replace=RunningTable.replace):
                if step == "half":
                    replace(self, rows.where("date = '20240101'"))
                raise OSError("lost")
            with monkeypatch.context() as patch:
                patch.setattr(RunningTable, "replace", dies)
                with pytest.raises(OSError):
                    table.merge(second, 1, combine)
        table = RunningTable(spark, table.path, ad_stream.AD_STAT)      # the restarted job
        returned = table.merge(second, 1, combine)
        assert rows_of(returned) == rows_of(table.read())
        table.merge(second, 1, combine)                                 # and replayed once more
        want = want or held(table)
        assert held(table) == want == [(1, 1, 6 if combine is ADD else 1), (2, 1, 6), (2, 2, 3)], step


def test_replace_overwrites_whole_groups(spark):
    from shoplens.sinks.running import RunningTable
    table = RunningTable(spark, tempfile.mkdtemp(prefix="groups-"), ad_stream.PROVINCE_TOP3, ("date", "province"))

    def rows(*r):
        return spark.createDataFrame(r, ad_stream.PROVINCE_TOP3)
    table.replace(rows(("20240101", "P", 1, 9), ("20240101", "P", 2, 8), ("20240101", "Q", 1, 7), ("20240102", "P", 1, 6)))
    for _ in range(2):                                                  # replay changes nothing
        table.replace(rows(("20240101", "P", 3, 20)))
        assert rows_of(table.read()) == [("20240101", "P", 3, 20), ("20240101", "Q", 1, 7), ("20240102", "P", 1, 6)]


def test_text_line_stream_equals_batch(spark, log):
    """Log lines (the Kafka value format) from text files, bad lines included."""
    from shoplens.sources.adapters import ad_log_lines
    from shoplens.streaming.sources import line_ad_stream
    folder = tempfile.mkdtemp(prefix="lines-")
    lines = [r.value for r in ad_log_lines(log).collect()] + ["garbage line", "1 2 3"]
    with open(os.path.join(folder, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    root = tempfile.mkdtemp(prefix="lines-run-")
    tables = ad_stream.AdTables.at(spark, f"{root}/tables")
    q = ad_stream.start_ad_pipeline(line_ad_stream(spark, "text", path=folder), tables,
                                    f"{root}/ckpt", 10 ** 9, trigger={"availableNow": True})
    q.awaitTermination()
    assert rows_of(tables.ad_stat.read()) == rows_of(ads.clicks_by_city_ad_day(log))


def test_blacklist_after_an_empty_first_batch(spark):
    """Batch 0 blocks nobody (the blacklist folder exists but holds no rows),
    batch 1 blocks user 1, batch 2 drops user 1's clicks."""
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)

    def b(*rows):
        return spark.createDataFrame(
            [(t0 + dt.timedelta(seconds=s), "P", "C", u, 1) for s, u in rows], AD_LOG)

    tables = ad_stream.AdTables.at(spark, tempfile.mkdtemp(prefix="bl-empty-"))
    ad_stream.process_batch(tables, b((0, 1), (1, 2)), 0, 1)
    assert tables.blocked().count() == 0
    ad_stream.process_batch(tables, b((10, 1)), 1, 1)
    assert [r.userid for r in tables.blocked().collect()] == [1]
    ad_stream.process_batch(tables, b((20, 1), (21, 2)), 2, 1)
    assert sorted(r.userid for r in tables.blocked().collect()) == [1, 2]
    totals = {r.userid: r.click_count for r in tables.user_clicks.read().collect()}
    assert totals == {1: 2, 2: 2}


def test_preaggregated_clicks_equal_row_log(spark, log):
    """Raw clicks + dimension (pre-aggregated per minute, user, ad inside the
    batch) give the same tables as the row-level log, blacklist included."""
    from shoplens.sources import adapters
    m = Model(spark, MEDIUM)
    clicks = adapters.ad_clicks(m.tables.events)
    geo = adapters.user_geo(m.tables.customer, m.tables.nation, m.tables.region)
    tables = ad_stream.AdTables.at(spark, tempfile.mkdtemp(prefix="preagg-"))
    for i in range(3):
        part = clicks.filter((F.col("ts") >= F.lit(SPLITS[i]).cast("timestamp"))
                             & (F.col("ts") < F.lit(SPLITS[i + 1]).cast("timestamp")))
        ad_stream.process_batch(tables, part, i, 1, geo=geo)
    blacklist, totals, city = sequential_batches(spark, log, 1)
    assert rows_of(tables.blocked()) == rows_of(blacklist)
    assert rows_of(tables.user_clicks.read()) == rows_of(totals)
    assert rows_of(tables.ad_stat.read()) == rows_of(city)


def test_folder_layout_gives_the_same_rows(spark):
    """events.parquet as one file and as a folder of parts."""
    from shoplens.plans.queries import REGISTRY
    folder = tempfile.mkdtemp(prefix="parts-")
    for name in ("customer", "nation", "region"):
        os.symlink(f"{SMALL}/{name}.parquet", f"{folder}/{name}.parquet")
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    for name in ("stream_province_city_clicks", "stream_running_city_counts", "stream_running_minute_counts"):
        want = rows_of(REGISTRY[name](spark, SMALL))
        assert want and rows_of(REGISTRY[name](spark, folder)) == want


def test_no_matching_events_is_an_error(spark):
    from shoplens.streaming.sources import event_files
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no events"):
        event_files(spark, tempfile.mkdtemp(prefix="none-"))


def test_a_table_whose_folder_is_gone_is_an_error(spark):
    from shoplens.sinks.running import RunningTable
    path = tempfile.mkdtemp(prefix="gone-")
    table = RunningTable(spark, f"{path}/t", ad_stream.AD_STAT)
    assert table.read().count() == 0
    table.path = f"{path}/other"
    with pytest.raises(Exception):
        table.read().count()


def test_a_day_with_most_rows_has_many_writers(spark):
    table = stat_table(spark)
    table.merge(spark.range(200_000).selectExpr("'20240101' AS date", "'P' AS province", "'C' AS city", "id AS adid",
                                                "1L AS click_count"), 0, ADD)
    files = [f for f in folder_names(spark, f"{table.path}/date=20240101") if f.startswith("part-")]
    assert len(files) >= 3 and table.read().count() == 200_000


def test_bad_lines_are_kept(spark):
    from shoplens.streaming.sources import parsed_line_stream
    folder, root = tempfile.mkdtemp(prefix="bad-"), tempfile.mkdtemp(prefix="bad-run-")
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write("1704110400000 P C 1 2\ngarbage\ngarbage\n1 2 3\n")
    tables = ad_stream.AdTables.at(spark, f"{root}/tables")
    ad_stream.start_line_pipeline(parsed_line_stream(spark, "text", path=folder), tables, f"{root}/c",
                                  trigger={"availableNow": True}).awaitTermination()
    assert {(r.raw, r.lines) for r in tables.bad_lines.read().collect()} == {("garbage", 2), ("1 2 3", 1)}
    assert tables.ad_stat.read().count() == 1


# -- counts in two stateful steps ------------------------------------------------

def click_files(spark, folder, batches):
    """One file of (ts, userid, adid) for each list of (minutes from T0, user, ad)."""
    import pandas as pd
    t0 = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    for i, rows in enumerate(batches):
        pdf = pd.DataFrame([(t0 + dt.timedelta(minutes=m), u, a) for m, u, a in rows], columns=["ts", "userid", "adid"])
        to_parquet(pdf, os.path.join(folder, f"b{i}.parquet"))
        os.utime(os.path.join(folder, f"b{i}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))


def chain(spark, folder, root, keys, duration, slide=None, watermark="10 minutes"):
    clicks = adlog.file_stream(spark, folder, "ts timestamp, userid long, adid long", max_files_per_trigger=1)
    geo = spark.createDataFrame([(1, "P", "C"), (2, "P", "D"), (3, "Q", "E")], "userid long, province string, city string")
    counts = ad_stream.chained_counts(clicks, geo, keys, duration, slide, watermark)
    ad_stream.start_closed(counts, f"{root}/out", f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    closed = spark.read.schema(counts.schema).parquet(f"{root}/out")
    return closed, ad_stream.open_counts(spark, f"{root}/ckpt", geo, keys, duration, slide)


def test_chained_counts_equal_plain_counts_and_evict(spark):
    """Closed and open windows together are all windows; the state holds open ones alone."""
    batches = [[(m, m % 4, m % 3) for m in range(lo, lo + 60)] for lo in range(0, 480, 60)]
    folder, root = tempfile.mkdtemp(prefix="chain-"), tempfile.mkdtemp(prefix="chain-run-")
    click_files(spark, folder, batches)
    closed, opened = chain(spark, folder, root, ["adid"], "60 minutes", "1 minute")
    got = {(r.start, r.adid): r.click_count for r in ad_stream.all_counts(closed, opened, ["adid"]).collect()}
    want, t0 = {}, dt.datetime(2024, 1, 1, 12)
    for m, u, a in sum(batches, []):
        if u:                                    # user 0 is unknown
            for k in range(60):
                key = (t0 + dt.timedelta(minutes=m - k), a)
                want[key] = want.get(key, 0) + 1
    assert got == want
    newest = t0 + dt.timedelta(minutes=479)
    for step in ad_stream.state_of(spark, f"{root}/ckpt"):
        rows = step.select("key.window.*", "key.*").collect()
        assert rows and all(r.end > newest - dt.timedelta(minutes=10) for r in rows)
        # eight hours went in; the state holds the minutes of the delay, or the windows that reach into it
        assert len(rows) <= 3 * 4 * (11 + 60)
    # written by RocksDB as changelogs
    names = sum([f for _, _, f in os.walk(f"{root}/ckpt/state")], [])
    assert any(n.endswith(".changelog") for n in names) and not any(n.endswith(".delta") for n in names)


def test_chained_counts_restart(spark):
    batches = [[(m, 1 + m % 3, m % 2) for m in range(lo, lo + 30)] for lo in (0, 30, 60)]
    folder, root = tempfile.mkdtemp(prefix="chain2-"), tempfile.mkdtemp(prefix="chain2-run-")
    for n in (1, 2, 3):
        click_files(spark, folder, batches[:n])
        closed, opened = chain(spark, folder, root, ["province", "city", "adid"], "30 minutes")
    rows = ad_stream.all_counts(closed, opened, ["province", "city", "adid"]).collect()
    assert sum(r.click_count for r in rows) == 90 and len(rows) == 3 * 3 * 2
    assert closed.count() and opened.count()


def test_no_raw_click_reaches_the_user_join(spark):
    """With users too many to broadcast, the join's stream side is the first step's state."""
    import contextlib
    import io

    from shoplens.streaming.sources import events_click_stream
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        clicks, geo = events_click_stream(spark, SMALL)
        counts = ad_stream.chained_counts(clicks, geo, ["province", "city", "adid"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            counts.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = [line for line in buf.getvalue().splitlines() if line.strip()]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin [userid" in line)
    saves = [i for i, line in enumerate(plan) if "StateStoreSave" in line]
    scan = next(i for i, line in enumerate(plan) if "StreamingRelation" in line or "MicroBatchScan" in line)
    assert len(saves) == 2 and saves[0] < join < saves[1] < scan and depth(plan[saves[1]]) < depth(plan[scan])


def test_timed_triggers_start_batches(spark, log):
    """Two files, a batch each, started by a one-second timer; then the query is stopped."""
    import time
    folder, root = tempfile.mkdtemp(prefix="timed-"), tempfile.mkdtemp(prefix="timed-run-")
    write_split(spark, log, folder, 0)
    tables = ad_stream.AdTables.at(spark, f"{root}/tables")
    stream = adlog.file_stream(spark, folder, AD_LOG, max_files_per_trigger=1)
    q = ad_stream.start_ad_pipeline(stream, tables, f"{root}/ckpt", 10 ** 9, trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        write_split(spark, log, folder, 1)
        deadline = time.time() + 60
        while time.time() < deadline and sum(p["numInputRows"] > 0 for p in q.recentProgress) < 2:
            time.sleep(0.2)
        starts = [p["timestamp"] for p in q.recentProgress if p["numInputRows"] > 0]
    finally:
        q.stop()
    assert len(starts) == 2 and starts[0] < starts[1] and not q.isActive
    part = log.filter(F.col("ts") < F.lit(SPLITS[2]).cast("timestamp"))
    assert rows_of(tables.ad_stat.read()) == rows_of(ads.clicks_by_city_ad_day(part))



def test_a_table_by_month_has_few_partitions_and_the_same_rows(spark):
    """400 days in 14 folders; a second batch, replayed, touches two of the months and a null date."""
    from shoplens.sinks.running import RunningTable

    def days(first, last, clicks):
        return spark.range(first, last).selectExpr(
            "date_format(date_add(DATE '2024-01-01', CAST(id AS INT)), 'yyyyMMdd') AS date", "'P' AS province",
            "'C' AS city", "id AS adid", f"CAST({clicks} AS BIGINT) AS click_count")

    none = spark.sql("SELECT CAST(NULL AS STRING) AS date, 'P' AS province, 'C' AS city, 7L AS adid, 4L AS click_count")
    tables = [RunningTable(spark, tempfile.mkdtemp(prefix="month-"), ad_stream.AD_STAT, months=m) for m in (True, False)]
    for table in tables:
        table.merge(days(0, 400, 1).unionByName(none), 0, ADD)
        before = {n: folder_names(spark, f"{table.path}/{n}") for n in folder_names(spark, table.path) if "=" in n}
        more = days(20, 40, 5).unionByName(none)
        for _ in range(2):
            table.merge(more, 1, ADD, [r[0] for r in more.select("date").distinct().collect()])
        after = {n: folder_names(spark, f"{table.path}/{n}") for n in before}
        if table.months:
            assert len(before) == 15        # 14 months and the null date
            assert sorted(n for n in after if after[n] != before[n]) == \
                ["month=202401", "month=202402", "month=__HIVE_DEFAULT_PARTITION__"]
    rows = [sorted(map(tuple, t.read().collect()), key=str) for t in tables]
    assert rows[0] == rows[1] and len(rows[0]) == 401 and (None, "P", "C", 7, 8) in rows[0]
    with pytest.raises(ValueError, match="partitioned by month"):
        RunningTable(spark, tables[0].path, ad_stream.AD_STAT)


def test_backlog_queries_keep_their_tables_by_month(spark):
    from shoplens.plans import queries as q
    m = Model(spark, SMALL)
    for table in [*q.batched_tables(m).all(), q.late_run(m)[0]]:
        names = [n for n in folder_names(spark, table.path) if "=" in n]
        assert names == ["month=202401"], table.path
