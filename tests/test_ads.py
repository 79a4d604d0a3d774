import datetime as dt

from shoplens.operators import ads
from shoplens.schemas import AD_LOG
from shoplens.sources import adlog

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def log_df(spark, rows):
    """rows: (seconds offset, province, city, userid, adid)."""
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), p, c, u, a) for s, p, c, u, a in rows], AD_LOG)


def test_bad_lines_routed_aside(spark):
    lines = spark.createDataFrame(
        [("1704110400000 P C 7 3",), ("  1704110400000  P  C 7 3 ",), ("1704110400000 P C 7",),
         ("17041x0400000 P C 7 3",), ("1704110400000 P C seven 3",), ("",), (None,)], "value string")
    parsed = adlog.parse_ad_log(lines)
    good = adlog.valid_lines(parsed).collect()
    assert len(good) == 2
    assert good[0].ts == dt.datetime(2024, 1, 1, 12, 0) and good[0].userid == 7
    assert adlog.invalid_lines(parsed).count() == 5


def test_blacklist_threshold_is_strict_over_two_batches(spark):
    b1 = log_df(spark, [(i, "P", "C", 1, 1) for i in range(60)]
                + [(i, "P", "C", 2, 1) for i in range(60)])
    b2 = log_df(spark, [(100 + i, "P", "C", 1, 1) for i in range(40)]       # user 1: 100
                + [(100 + i, "P", "C", 2, 1) for i in range(41)])           # user 2: 101
    empty = b1.select("userid").limit(0)
    _, _, totals, added1 = ads.blacklist_step(b1, empty, None, 100)
    assert added1.count() == 0
    _, _, totals2, added2 = ads.blacklist_step(b2, empty, totals, 100)
    assert [r.userid for r in added2.collect()] == [2]
    tot = {r.userid: r.click_count for r in totals2.collect()}
    assert tot == {1: 100, 2: 101}
    # a blocked user clicking again is dropped before counting
    b3 = log_df(spark, [(300, "P", "C", 2, 5), (301, "P", "C", 1, 1)])
    clean, counts, _, added3 = ads.blacklist_step(b3, added2, totals2, 100)
    assert [r.userid for r in clean.collect()] == [1]
    assert [r.userid for r in added3.collect()] == [1]   # 101 now


def test_upserts(spark):
    k = ["k"]
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, click_count bigint")
    new = spark.createDataFrame([("b", 5), ("c", 7)], "k string, click_count bigint")
    add = {r.k: r.click_count for r in ads.add_counts(old, new, k).collect()}
    assert add == {"a": 1, "b": 7, "c": 7}
    st = {r.k: r.click_count for r in ads.set_counts(old, new, k).collect()}
    assert st == {"a": 1, "b": 5, "c": 7}
    g_old = spark.createDataFrame([("g1", 1, 9), ("g1", 2, 8), ("g2", 1, 5)],
                                  "g string, adid bigint, click_count bigint")
    g_new = spark.createDataFrame([("g1", 3, 20)], "g string, adid bigint, click_count bigint")
    rep = sorted(tuple(r) for r in ads.replace_groups(g_old, g_new, ["g"]).collect())
    assert rep == [("g1", 3, 20), ("g2", 1, 5)]


def test_province_top3_ties(spark):
    rows = [(i, "P", "C", 1, a) for i, a in enumerate([5, 5, 4, 4, 3, 3, 2, 2, 9])]
    top = ads.top_n_per_province(ads.province_counts(log_df(spark, rows)), 3).collect()
    assert [(r.adid, r.click_count) for r in sorted(top, key=lambda r: (-r.click_count, r.adid))] \
        == [(2, 2), (3, 2), (4, 2)]


def test_minute_trend_and_last_hour(spark):
    rows = [(0, "P", "C", 1, 1), (30, "P", "C", 1, 1), (61, "P", "C", 1, 1),
            (3600 * 2, "P", "C", 1, 2), (3600 * 2 + 5, "P", "C", 1, 2)]
    log = log_df(spark, rows)
    m = {(r.hour, r.minute, r.adid): r.click_count
         for r in ads.minute_counts(log).collect()}
    assert m == {("12", "00", 1): 2, ("12", "01", 1): 1, ("14", "00", 2): 2}
    last = ads.last_hour_trend(log).collect()
    assert [(r.hour, r.minute, r.click_count) for r in last] == [("14", "00", 2)]


def test_sliding_counts_match_naive(spark):
    rows = [(s, "P", "C", 1, s % 2) for s in range(0, 7200, 97)]
    log = log_df(spark, rows)
    got = {(r.window_start, r.adid): r.click_count for r in ads.sliding_counts(log).collect()}
    want = {}
    for s, *_ , a in rows:
        t = T0 + dt.timedelta(seconds=s)
        m = t.replace(second=0)
        for back in range(60):
            ws = m - dt.timedelta(minutes=back)
            key = (ws.strftime("%Y-%m-%d %H:%M"), a)
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_preaggregated_hot_user_counts(spark):
    geo = spark.createDataFrame([(1, "P", "C"), (2, "Q", "D")], "userid bigint, province string, city string")
    rows = [(s, "x", "x", 1, s % 3) for s in range(0, 600, 2)] + [(5, "x", "x", 2, 0)]
    raw = log_df(spark, rows)
    clicks = raw.select("ts", "userid", "adid")
    pre = ads.preaggregate_clicks(clicks, geo)
    assert pre.count() == 31 and raw.count() == 301   # 10 minutes x 3 ads + 1
    row_level = raw.drop("province", "city").join(geo, "userid")
    for fn in (ads.clicks_by_user_ad_day, ads.clicks_by_city_ad_day, ads.province_counts):
        assert sorted(tuple(r) for r in fn(pre).collect()) == \
            sorted(tuple(r) for r in fn(row_level).collect())
    assert sorted(tuple(r) for r in ads.minute_counts(pre).drop("minute_start").collect()) == \
        sorted(tuple(r) for r in ads.minute_counts(row_level).drop("minute_start").collect())


def test_day_change_at_midnight_utc(spark):
    rows = [(11 * 3600 + 59 * 60 + 59, "P", "C", 1, 1), (12 * 3600, "P", "C", 1, 1)]
    # T0 is 12:00 UTC, so offsets 11:59:59 and 12:00:00 land at 23:59:59 and 00:00:00
    got = {(r.date, r.click_count) for r in ads.clicks_by_city_ad_day(log_df(spark, rows)).collect()}
    assert got == {("20240101", 1), ("20240102", 1)}
    m = {(r.date, r.hour, r.minute) for r in ads.minute_counts(log_df(spark, rows)).collect()}
    assert m == {("20240101", "23", "59"), ("20240102", "00", "00")}
