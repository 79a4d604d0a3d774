import datetime as dt
import math
from collections import Counter

from fixtures import action, actions_df
from shoplens.operators import sampling, sessions


def _sessions(spark):
    # 2 days, uneven hours
    rows = []
    plan = {(1, 9): 7, (1, 10): 2, (1, 23): 1, (2, 0): 5, (2, 12): 13}
    for (day, hour), n in plan.items():
        for i in range(n):
            base = dt.datetime(2024, 1, day, hour, 0, 0)
            rows.append(action(f"d{day}h{hour}n{i}", seconds=i, base=base))
    return sessions.sessionize(actions_df(spark, rows)), plan


def _quota(plan, total):
    days = {d for d, _ in plan}
    per_day = total // len(days)
    out = {}
    for (d, h), n in plan.items():
        day_n = sum(v for (dd, _), v in plan.items() if dd == d)
        out[(d, h)] = min(math.floor(n / day_n * per_day), n)
    return out


def test_quotas_match_formula(spark):
    sess, plan = _sessions(spark)
    for total in (10, 3, 100):
        got = {(int(r.date[-2:]), int(r.hour)): r.quota
               for r in sampling.hour_quotas(sess, total).collect()}
        assert got == _quota(plan, total)


def test_extract_sizes_and_repeatability(spark):
    sess, plan = _sessions(spark)
    for total in (10, 100):
        got = sampling.stratified_extract(sess, total, "seed-a").collect()
        per = Counter((int(r.date[-2:]), int(r.hour)) for r in got)
        want = {k: v for k, v in _quota(plan, total).items() if v}
        assert dict(per) == want
        assert len({r.session_id for r in got}) == len(got)
    a = sorted(r.session_id for r in sampling.stratified_extract(sess, 10, "s1").collect())
    b = sorted(r.session_id for r in sampling.stratified_extract(sess, 10, "s1").collect())
    assert a == b


def test_extract_empty_input(spark):
    sess, _ = _sessions(spark)
    assert sampling.stratified_extract(sess.limit(0), 10, "x").count() == 0
