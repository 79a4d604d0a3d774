"""Property tests: operators against plain-Python brute force on random input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import action, actions_df
from shoplens.operators import sessions

ROW = st.tuples(
    st.sampled_from(["a", "b", "c", "d"]),                 # session
    st.integers(min_value=0, max_value=4000),              # second offset
    st.one_of(st.none(), st.sampled_from(["kw1", "kw2", "kw10", ""])),
    st.one_of(st.none(), st.integers(min_value=0, max_value=20)),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=40))
def test_sessionize_and_histograms_match_brute_force(spark, rows):
    df = actions_df(spark, [action(s, seconds=t, keyword=k, click=c) for s, t, k, c in rows])
    got = {r.session_id: r for r in sessions.sessionize(df).collect()}
    by = {}
    for s, t, k, c in rows:
        by.setdefault(s, []).append((t, k, c))
    assert set(got) == set(by)
    for s, acts in by.items():
        r = got[s]
        ts = [t for t, _, _ in acts]
        assert r.step_length == len(acts)
        assert r.visit_length == max(ts) - min(ts)
        assert r.search_keywords == sorted({k for _, k, _ in acts if k})
        assert r.click_category_ids == sorted({c for _, _, c in acts if c is not None})
    sess = sessions.sessionize(df)
    hist = sessions.visit_histogram(sess).first().asDict()
    hist.update(sessions.step_histogram(sess).first().asDict())
    for name, lo, hi in sessions.VISIT_BUCKETS:
        want = sum(1 for a in by.values()
                   if max(t for t, _, _ in a) - min(t for t, _, _ in a) >= lo
                   and (hi is None or max(t for t, _, _ in a) - min(t for t, _, _ in a) <= hi))
        assert hist[name] == want, name
    for name, lo, hi in sessions.STEP_BUCKETS:
        want = sum(1 for a in by.values() if len(a) >= lo and (hi is None or len(a) <= hi))
        assert hist[name] == want, name
    assert hist["session_count"] == len(by)
