import datetime as dt

from pyspark.sql import functions as F

from fixtures import action, actions_df, users_df
from shoplens.operators import categories, sessions
from shoplens.params import TaskParams

VISIT_EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEP_EDGES = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def _visit_bucket(v):
    for name, lo, hi in sessions.VISIT_BUCKETS:
        if v >= lo and (hi is None or v <= hi):
            return name
    return None


def _step_bucket(s):
    for name, lo, hi in sessions.STEP_BUCKETS:
        if s >= lo and (hi is None or s <= hi):
            return name
    return None


def test_bucket_edges(spark):
    rows = []
    for v in VISIT_EDGES:
        rows.append(action(f"v{v}", seconds=0))
        if v:
            rows.append(action(f"v{v}", seconds=v))
    for s in STEP_EDGES:
        rows += [action(f"s{s}", seconds=0) for _ in range(s)]
    sess = sessions.sessionize(actions_df(spark, rows))
    got = sessions.visit_histogram(sess).first().asDict()
    got.update(sessions.step_histogram(sess).first().asDict())
    lengths = {f"v{v}": (v, 2 if v else 1) for v in VISIT_EDGES}
    lengths.update({f"s{s}": (0, s) for s in STEP_EDGES})
    assert got["session_count"] == len(lengths)
    want = {name: 0 for name, _, _ in sessions.VISIT_BUCKETS + sessions.STEP_BUCKETS}
    for v, s in lengths.values():
        if _visit_bucket(v):
            want[_visit_bucket(v)] += 1
        want[_step_bucket(s)] += 1
    for k, n in want.items():
        assert got[k] == n, k
    # H5: zero-length sessions fall in no visit bucket but count in the total
    visit_total = sum(got[n] for n, _, _ in sessions.VISIT_BUCKETS)
    assert visit_total + got["visit_length_0s"] == got["session_count"]


def test_keywords_are_exact_distinct_sorted(spark):
    rows = [action("a", keyword="apple pie"), action("a", seconds=1, keyword="apple"),
            action("a", seconds=2, keyword="apple"), action("a", seconds=3, keyword="")]
    r = sessions.sessionize(actions_df(spark, rows)).first()
    assert r.search_keywords == ["apple", "apple pie"]


def test_category_codes_dedupe_by_value(spark):
    rows = [action("c", seconds=i, click=c) for i, c in enumerate([12, 44, 48, 57, 12])]
    r = sessions.sessionize(actions_df(spark, rows)).first()
    assert r.click_category_ids == [12, 44, 48, 57]
    assert r.step_length == 5 and r.visit_length == 4


def _enriched(spark):
    rows = [action("s1", user_id=1, keyword="kw1", click=3),
            action("s2", user_id=2, click=7),
            action("s3", user_id=3, keyword="kw2"),
            action("s4", user_id=99, click=3)]          # user not in user_info
    users = users_df(spark, [(1, 25, "p1", "c1", "male"), (2, 40, "p2", "c2", "female"),
                             (3, None, "p1", "c1", "female")])
    return sessions.enrich(sessions.sessionize(actions_df(spark, rows)), users)


def _ids(df):
    return sorted(r.session_id for r in df.select("session_id").collect())


def test_unknown_user_drops(spark):
    assert _ids(_enriched(spark)) == ["s1", "s2", "s3"]


def test_filters(spark):
    e = _enriched(spark)
    base = dict(start_date="2024-01-01", end_date="2024-12-31")
    f = lambda **kw: _ids(sessions.filter_sessions(e, TaskParams(**base, **kw)))
    assert f() == ["s1", "s2", "s3"]
    assert f(start_age=20, end_age=30) == ["s1"]             # missing age fails
    assert f(start_age=20) == ["s1", "s2", "s3"]             # H15: one end = no filter
    assert _ids(sessions.filter_sessions(
        e, TaskParams(**base, start_age=30, strict_bounds=False))) == ["s2"]
    assert f(professionals=("p1",)) == ["s1", "s3"]
    assert f(cities=("c2", "c9")) == ["s2"]
    assert f(sex="female") == ["s2", "s3"]
    assert f(keywords=("kw2", "nope")) == ["s3"]
    assert f(category_ids=(3,)) == ["s1"]                    # H1: on clicked categories
    assert f(sex="female", keywords=("kw1",)) == []


def test_params_empty_and_missing_mean_no_filter():
    p = TaskParams.from_json('{"startDate": "2024-01-01", "endDate": "2024-01-02", '
                             '"startAge": "", "professionals": "", "cities": "a, b", '
                             '"categoryIds": "1,2", "targetPageFlow": "1,2,3"}')
    assert p.start_age is None and p.professionals == () and p.sex is None
    assert p.cities == ("a", "b") and p.category_ids == (1, 2)
    assert p.target_page_flow == (1, 2, 3)


def test_no_match_gives_zero(spark):
    e = _enriched(spark)
    none = sessions.filter_sessions(e, TaskParams("2024-01-01", "2024-01-02", sex="other"))
    r = sessions.session_ratios(none).first()
    assert r.session_count == 0
    assert all(v == 0.0 for k, v in r.asDict().items() if k.endswith("_ratio"))


def test_ratio_rounding_half_up(spark):
    # 1 of 8 = 0.125 -> 0.13 (half up)
    rows = [action(f"r{i}", seconds=0) for i in range(7)]
    rows += [action("r7", seconds=0), action("r7", seconds=2)]
    r = sessions.session_ratios(sessions.sessionize(actions_df(spark, rows))).first()
    assert r.visit_length_1s_3s_ratio == 0.13


def test_unpadded_hour_parses(spark):
    from shoplens.functions.expr import format_time, parse_time
    df = spark.createDataFrame([("2020-01-01 5:03:09",), ("2020-01-01 15:03:09",), ("bad",)], "s string")
    got = [r[0] for r in df.select(format_time(parse_time("s"))).collect()]
    assert got == ["2020-01-01 05:03:09", "2020-01-01 15:03:09", None]


def test_mixed_action_universe(spark):
    rows = [action("m", click=1, orders=[2, 2], pays=[3]), action("m", seconds=1, orders=[4]),
            action("m", seconds=2, pays=[5])]
    acts = actions_df(spark, rows)
    all_ = sorted(r[0] for r in categories.category_universe(acts).collect())
    first = sorted(r[0] for r in categories.category_universe(acts, "first_action").collect())
    assert all_ == [1, 2, 3, 4, 5]
    assert first == [1, 4, 5]
    counts = {r.category_id: (r.click_count, r.order_count, r.pay_count)
              for r in categories.category_funnel_counts(acts).collect()}
    assert counts == {1: (1, 0, 0), 2: (0, 2, 0), 3: (0, 0, 1), 4: (0, 1, 0), 5: (0, 0, 1)}


def test_top_categories_ties_and_naive_sort(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        kind = rnd.choice(["click", "order", "pay"])
        c = rnd.randrange(30)
        rows.append(action(f"t{i % 40}", seconds=i, click=c if kind == "click" else None,
                           orders=[c] if kind == "order" else None,
                           pays=[c] if kind == "pay" else None))
    acts = actions_df(spark, rows)
    counts = categories.category_funnel_counts(acts)
    got = [tuple(r) for r in categories.top_categories(counts, 10).collect()]
    allc = [tuple(r) for r in counts.collect()]
    want = sorted(allc, key=lambda t: (-t[1], -t[2], -t[3], t[0]))[:10]
    assert got == want


def test_top_products_universe_keeps_zero_rows(spark):
    from fixtures import products_df
    acts = actions_df(spark, [action("p", click=2), action("p", seconds=1, click=500)])
    prods = products_df(spark, [(i, f"p{i}", '{"product_status": 0}') for i in range(5)])
    counts = categories.category_funnel_counts(acts)
    got = [tuple(r) for r in categories.top_products_universe(prods, counts, 3).collect()]
    assert got == [(2, 1, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0)]


def test_filtered_actions_semi_join(spark):
    acts = actions_df(spark, [action("a"), action("a", seconds=1), action("b")])
    kept = acts.filter(F.col("session_id") == "a").select("session_id").distinct()
    assert sessions.filtered_actions(acts, kept).count() == 2
    assert acts.first().date == dt.date(2024, 3, 1)


def test_session_count_path_equals_row_path(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        c = rnd.randrange(12)
        kind = rnd.choice(["click", "click", "order", "pay", "mixed"])
        rows.append(action(f"s{rnd.randrange(15)}", seconds=i,
                           click=c if kind in ("click", "mixed") else None,
                           orders=[c, (c + 1) % 12] if kind in ("order", "mixed") else None,
                           pays=[c] if kind == "pay" else None))
    acts = actions_df(spark, rows)
    sc = categories.session_category_counts(acts)
    for universe in ("all", "first_action"):
        a = sorted(tuple(r) for r in categories.funnel_from_session_counts(sc, universe).collect())
        b = sorted(tuple(r) for r in categories.category_funnel_counts(acts, universe).collect())
        assert a == b, universe
    top = categories.top_categories(categories.category_funnel_counts(acts), 5)
    a = sorted(tuple(r) for r in categories.top_sessions_from_session_counts(sc, top, 3).collect())
    b = sorted(tuple(r) for r in categories.top_sessions_per_category(acts, top, 3).collect())
    assert a == b
