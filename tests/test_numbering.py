from __future__ import annotations

import random

import pytest

from hearthline.operators.numbering import group_ids, number_rows


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_rows_are_numbered_without_gaps(frame, parts):
    keys = random.Random(1).sample(range(10_000), 500)
    df = frame([(k, str(k)) for k in keys] + [(None, "none")], "k long, t string").repartition(5)
    got = number_rows(df, ["k"], "nth", parts)
    assert got.columns == ["k", "t", "nth"]
    want = [None, *sorted(keys)]
    assert [(r.k, r.nth) for r in got.orderBy("nth").collect()] == [(k, i + 1) for i, k in enumerate(want)]


def test_groups_are_numbered_by_dense_rank(frame):
    r = random.Random(2)
    rows = [(r.choice([None, "a", "b", ""]), r.choice([None, 1, 2])) for _ in range(200)] + [("hot", 9)] * 100
    got = group_ids(frame(rows, "x string, y int").repartition(4), ["x", "y"]).collect()
    order = sorted(set(rows), key=lambda k: (k[0] is not None, k[0] or "", k[1] is not None, k[1] or 0))
    assert len(got) == len(rows)
    assert {(g.x, g.y): g.group_id for g in got} == {k: i for i, k in enumerate(order)}


def test_numbering_of_an_empty_table(frame):
    assert number_rows(frame([], "k long"), ["k"]).count() == 0
    assert group_ids(frame([], "k long"), ["k"]).count() == 0


def test_no_task_holds_the_table(frame):
    df = frame([(i,) for i in range(100)], "k long")
    plan = number_rows(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    # The only window without partitions runs over one row per partition, below the broadcast.
    assert plan.count("Window") <= 2 and "BroadcastHashJoin" in plan
