import random

from fixtures import action, actions_df
from shoplens.operators import funnel


def _naive_moves(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[4], r[3]))
    moves = {}
    for seq in by.values():
        seq.sort()
        for (_, a), (_, b) in zip(seq, seq[1:]):
            moves[(a, b)] = moves.get((a, b), 0) + 1
    return moves


def test_chunked_steps_equal_per_session_lead(spark):
    rnd = random.Random(3)
    rows = []
    for s in range(6):
        t = 0
        for _ in range(rnd.randrange(1, 40)):
            t += rnd.choice([0, 1, 5, 59, 61, 300])
            rows.append(action(f"s{s}", seconds=t, page_id=rnd.randrange(5)))
    got = {}
    for r in funnel.page_steps(actions_df(spark, rows)).collect():
        got[(r.page_id, r.next_page_id)] = got.get((r.page_id, r.next_page_id), 0) + 1
    assert got == _naive_moves(rows)


def test_conversion_rates(spark):
    seq = [1, 2, 3, 1, 2, 9, 1]
    rows = [action("a", seconds=i * 70, page_id=p) for i, p in enumerate(seq)]
    got = [(r.step, r.step_count, r.rate)
           for r in funnel.page_flow_conversion(spark, actions_df(spark, rows), [1, 2, 3, 4])
           .orderBy("step_index").collect()]
    assert got == [("1", 3, 1.0), ("1_2", 2, 0.67), ("2_3", 1, 0.5), ("3_4", 0, 0.0)]
