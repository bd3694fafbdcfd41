"""Polls are merged into intervals without a walk over a run."""

import math

import numpy as np

from shapeloom.operators import intervals


def walk(polls, least):
    """One run after the other, poll by poll."""
    runs = {}
    for run, at, n in polls:
        if at is not None:
            own = runs.setdefault(run, {})
            own[at] = own.get(at, 0) + (n or 0)
    out = set()
    for run, own in runs.items():
        since, waiting = min(own), 0
        for at in sorted(own)[1:]:
            waiting += own[at]
            if at >= since + least:
                out.add((run, at, waiting, at - since))
                since, waiting = at, 0
    return out


def merged(spark, polls, least):
    frame = spark.createDataFrame(polls, "run string, at double, images long").repartition(3)
    rows = intervals.merge_polls(frame, ["run"], "at", "images", least).collect()
    assert len(rows) == len({(r.run, r.at) for r in rows})
    return {(r.run, r.at, r.images, r.seconds) for r in rows}


def test_against_a_walk(spark, monkeypatch):
    monkeypatch.setattr(intervals, "_HOPS", 4)
    monkeypatch.setattr(intervals, "_DOUBLINGS", 2)
    monkeypatch.setattr(intervals, "_SEARCH", 3)
    draw = np.random.default_rng(3)
    polls = []
    for run, step in (("dense", 0.03), ("even", 0.5), ("sparse", 2.0), ("gaps", 0.2)):
        at = np.cumsum(draw.exponential(step, 150) + (draw.random(150) < 0.03) * (40 if run == "gaps" else 0)).round(3)
        polls += [(run, float(t), int(n)) for t, n in zip(at, draw.integers(0, 9, 150))]
    polls += [("even", float(t), 1) for t in np.arange(100, 110, 0.5)] + polls[:20] + [("dense", None, 5), ("dense", 1.0, None), (None, 1.0, 2), (None, 1.25, 3), (None, 3.5, 4), ("one", 7.0, 3)]
    polls += [("before", -3.25 + 0.25 * i, 1) for i in range(30)]
    assert merged(spark, polls, 0.5) == walk(polls, 0.5)


def test_no_polls(spark):
    assert merged(spark, [("a", 1.0, 1)], 0.5) == set()
    empty = spark.createDataFrame([], "run string, at double, images long")
    assert intervals.merge_polls(empty, ["run"], "at", "images", 0.5).count() == 0
    frame = spark.createDataFrame([(0.0, 1), (0.3, 2), (0.6, 4), (5.0, 8)], "at double, images long")
    assert [tuple(r) for r in intervals.merge_polls(frame, [], "at", "images").orderBy("at").collect()] == [(0.6, 6, 0.6), (5.0, 8, 4.4)]


def test_plan_has_no_python_and_no_run_in_one_task(spark, plan):
    polls = spark.createDataFrame([("a", 0.1 * i, 1) for i in range(100)], "run string, at double, images long")
    found = intervals.successors(polls.selectExpr("run", "at"), "run", "at", 0.5)
    text = plan(found)
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    rows = {round(r.at, 1): r.next for r in found.collect()}
    assert all(math.isclose(rows[round(0.1 * i, 1)], 0.1 * (i + 5), abs_tol=0.11) for i in range(95))
    assert sum(v is None for v in rows.values()) in (5, 6)


def test_a_long_chain_goes_through_several_levels(spark):
    polls = [("r", 0.25 * i, 1) for i in range(3000)]
    assert merged(spark, polls, 0.5) == walk(polls, 0.5)
