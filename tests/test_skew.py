"""One session holding a third of all actions: skew-safe operators stay exact."""

import random

from fixtures import action, actions_df
from shoplens.operators import categories, funnel, sessions


def _rows():
    rnd = random.Random(5)
    rows = []
    for i in range(600):                                   # the hot session
        rows.append(action("hot", seconds=i * 7, page_id=rnd.randrange(6),
                           keyword=f"kw{rnd.randrange(4)}", click=rnd.randrange(9)))
    for s in range(300):                                   # 300 small sessions
        for j in range(4):
            rows.append(action(f"s{s}", seconds=j * 40, page_id=rnd.randrange(6),
                               orders=[rnd.randrange(9)] if j == 2 else None))
    return rows


def test_hot_session(spark):
    rows = _rows()
    acts = actions_df(spark, rows).repartition(8)
    hot = [r for r in rows if r[2] == "hot"]
    assert 3 * len(hot) == len(rows)                      # a third of all actions

    s = {r.session_id: r for r in sessions.sessionize(acts).collect()}
    assert s["hot"].step_length == 600 and s["hot"].visit_length == 599 * 7
    assert s["hot"].search_keywords == ["kw0", "kw1", "kw2", "kw3"]

    moves = {}
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[4], r[3]))
    for seq in by.values():
        seq.sort()
        for (_, a), (_, b) in zip(seq, seq[1:]):
            moves[(a, b)] = moves.get((a, b), 0) + 1
    got = {}
    for r in funnel.page_steps(acts).collect():
        got[(r.page_id, r.next_page_id)] = got.get((r.page_id, r.next_page_id), 0) + 1
    assert got == moves

    a = sorted(tuple(r) for r in categories.funnel_from_session_counts(
        categories.session_category_counts(acts)).collect())
    b = sorted(tuple(r) for r in categories.category_funnel_counts(acts).collect())
    assert a == b


def test_hot_session_is_split_by_the_join(spark):
    """Staged session ids have an exchange of their own, so AQE splits the hot session."""
    from pyspark.sql import functions as F

    from shoplens.sinks.writers import staged
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
           "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        acts = spark.range(0, 120_000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 900)).alias("session_id"),
            "id", F.md5(F.col("id").cast("string")).alias("page"))
        kept = staged(acts.select("session_id").distinct(), "kept")
        out = sessions.filtered_actions(acts, kept)
        assert out.count() == 120_000
        rows = sessions.filtered_actions(acts, kept)
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
