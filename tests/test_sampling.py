from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from tests.helpers import final_plan_of, plan_of, sessions
from visitloom.operators import sampling as M
from visitloom.operators import bounded


def spread(spark, per_hour: dict[tuple[int, int], int]):
    rows = [
        (f"d{day}h{hour}n{n}", f"2024-01-{day:02d} {hour:02d}:10:00", 1, 1)
        for (day, hour), count in per_hour.items()
        for n in range(count)
    ]
    return sessions(spark, rows)


def quotas(spark, df, total):
    got = M.extract_quota_per_hour(df, total).collect()
    return {(r["date"].day, r["hour"]): r["quota"] for r in got}


def test_quota_is_proportional_and_cut(spark):
    df = spread(spark, {(1, 0): 30, (1, 5): 10, (2, 3): 7})
    assert quotas(spark, df, 100) == {(1, 0): 30, (1, 5): 10, (2, 3): 7}
    assert quotas(spark, df, 21) == {(1, 0): 7, (1, 5): 2, (2, 3): 7}


def test_more_days_than_total_draws_nothing(spark):
    df = spread(spark, {(day, 0): 2 for day in range(1, 12)})
    assert set(quotas(spark, df, 10).values()) == {0}
    assert M.draw_sessions(df, 1, 10).count() == 0


def test_draw_keeps_quota_and_repeats_with_seed(spark):
    df = spread(spark, {(1, 0): 60, (1, 5): 20, (2, 3): 40})
    expected = quotas(spark, df, 40)
    drawn = [r["session_id"] for r in M.draw_sessions(df, 5, 40).collect()]
    assert len(set(drawn)) == len(drawn)
    per_hour = Counter(name.split("n")[0] for name in drawn)
    assert per_hour == {f"d{d}h{h}": q for (d, h), q in expected.items() if q}
    assert sorted(drawn) == sorted(r["session_id"] for r in M.draw_sessions(df, 5, 40).collect())
    other = [r["session_id"] for r in M.draw_sessions(df, 6, 40).collect()]
    assert sorted(other) != sorted(drawn)


def test_large_total_gives_the_same_draw_without_group_limit(spark, monkeypatch):
    df = spread(spark, {(1, 0): 300, (1, 5): 100, (2, 3): 200})
    normal = sorted(r["session_id"] for r in M.draw_sessions(df, 5, 90).collect())
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    monkeypatch.setattr(bounded, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(M, "STATE_ROWS", 10)
    try:
        salted_plan = M.draw_sessions(df, 5, 90)
        assert sorted(r["session_id"] for r in salted_plan.collect()) == normal
        assert "_salt" in plan_of(salted_plan)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def places(df):
    return sorted((r["session_id"], r["place"], r["visit_length"]) for r in df.collect())


@pytest.mark.parametrize("total", [1, 7, 40, 999])
def test_states_of_hours_draw_what_ranking_draws(spark, total):
    df = spread(spark, {(1, 0): 60, (1, 5): 20, (2, 3): 40, (9, 23): 1}).repartition(5)
    # Rows that repeated users made, and sessions without a start.
    df = df.unionByName(df.where("hour(start_time) = 3")).unionByName(
        sessions(spark, [("a", None, None, 1)])
    )
    drawn = M.draw_sessions(df, "s", total)
    assert places(drawn) == places(M._draw_by_rank(df, "s", total))
    assert drawn.columns == [*df.columns, "place"]


def test_sessions_are_read_once(spark, tmp_path):
    path = str(tmp_path / "sessions")
    spread(spark, {(day, hour): 9 for day in range(1, 6) for hour in range(24)}).write.parquet(path)
    drawn = M.draw_sessions(spark.read.parquet(path), 3, 200)
    assert drawn.count() == 5 * 24
    drawn.collect()
    # The days are counted from the same states.
    plan = final_plan_of(drawn)
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange [date") == 1


def test_states_hold_no_more_than_asked(spark):
    df = spread(spark, {(1, 0): 60, (2, 3): 4}).repartition(3)
    states = {r["hour"]: r for r in M.first_sessions_per_hour(df, 1, 5).collect()}
    assert {h: (r["session_count"], len(r["first"])) for h, r in states.items()} == {0: (60, 5), 3: (4, 4)}
    for r in states.values():
        hashes = [x["_draw"] for x in r["first"]]
        assert hashes == sorted(hashes)
    everything = [r for r in df.collect() if r["start_time"].hour == 0]
    least = sorted(hashlib.md5(f"{r['session_id']}#1".encode()).hexdigest() for r in everything)[:5]
    assert [x["_draw"] for x in states[0]["first"]] == least


def test_hour_is_cut_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(M, "STATE_ROWS", 10)
    plan = plan_of(M.draw_sessions(spread(spark, {(1, 0): 5}), 5))
    assert plan.count("WindowGroupLimit") == 2


def test_empty(spark):
    empty = spread(spark, {})
    assert M.extract_quota_per_hour(empty).count() == 0
    assert M.draw_sessions(empty, 1).count() == 0


def test_sessions_without_start_are_left_out(spark):
    df = sessions(spark, [("a", None, None, 1), ("b", "2024-01-01 00:00:00", 0, 1)])
    assert [r["session_count"] for r in M.sessions_per_hour(df).collect()] == [1]
    assert [r["session_count"] for r in M.sessions_per_day(df).collect()] == [1]
    assert [r["session_id"] for r in M.draw_sessions(df, 1).collect()] == ["b"]
