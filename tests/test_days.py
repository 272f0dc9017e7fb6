"""States of days: merged, they give what the actions give."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import action, plan_of, raw_actions
from visitloom.operators import days, sessions
from visitloom.params import TaskParams
from visitloom.schemas import SESSION_DAY
from visitloom.sources.tables import scan_actions

DAYS = [f"2024-01-{n:02d}" for n in range(1, 11)]
RANGES = [(None, None), (DAYS[2], DAYS[6]), (DAYS[4], DAYS[4]), (None, DAYS[3]), ("2025-01-01", None)]
PARAMS = TaskParams(keywords=("lamp", "rug"), category_ids=("3", "5", "x"))


def some_actions(spark, dates, seed=1):
    rng = random.Random(seed)
    rows = []
    for date in dates:
        for _ in range(60):
            time = f"{date} {rng.randrange(24)}:{rng.randrange(60):02d}:00"
            word = rng.choice([None, None, "", "lamp", "rug", "a,b", "|"])
            row = action(f"s{rng.randrange(25)}", rng.choice([time, time, "at noon"]), rng.randrange(4))
            rows.append({**row, "date": date, "search_keyword": word, "click_category_id": rng.choice([None, None, 1, 3, 5, 40])})
        rows.append({**action(None, f"{date} 1:00:00"), "date": date})
    return raw_actions(spark, rows)


@pytest.fixture(scope="module")
def raw(spark):
    return some_actions(spark, DAYS).cache()


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("days") / "states")
    days.add_days(scan_actions(raw), path, DAYS)
    return path


def rows(df, columns=None):
    return sorted(map(tuple, df.select(columns or df.columns).collect()), key=repr)


@pytest.mark.parametrize(("start", "end"), RANGES)
def test_any_range_equals_the_rollup_of_its_actions(spark, raw, stored, start, end):
    actions, states = scan_actions(raw, start, end), days.scan_days(spark, stored, start, end)
    plain = sessions.session_rollup(actions, PARAMS).na.fill(False, ["keyword_hit", "category_hit"])
    assert rows(days.rollup_of_days(states, PARAMS), plain.columns) == rows(plain)
    records = sessions.session_records(actions)
    assert rows(days.records_of_days(states), records.columns) == rows(records)
    weeks = days.merged_states(states, F.date_trunc("week", F.col("date").cast("date")))
    assert [f.simpleString() for f in weeks.schema] == [f.simpleString() for f in SESSION_DAY]
    assert rows(days.records_of_days(weeks), records.columns) == rows(records)
    assert rows(days.rollup_of_days(weeks, PARAMS), plain.columns) == rows(plain)


def test_merged_states_are_the_states_of_the_span(raw, stored, spark):
    whole = days.merged_states(days.scan_days(spark, stored), F.lit("all"))
    assert rows(whole) == rows(days.day_states(scan_actions(raw).withColumn("date", F.lit("all"))))


def test_a_new_day_reads_and_writes_that_day_only(spark, raw, tmp_path):
    source, path = str(tmp_path / "actions"), str(tmp_path / "states")
    raw.write.partitionBy("date").parquet(source)
    actions = scan_actions(spark.read.schema(raw.schema).parquet(source))
    days.add_days(actions, path, DAYS[:-1])

    def files(date):
        return sorted((p.name, os.stat(p).st_mtime_ns) for p in Path(path, f"date={date}").glob("*.parquet"))

    before = {d: files(d) for d in DAYS[:-1]}
    plan = plan_of(days.day_states(actions.where(F.col("date").isin(DAYS[-1]))))
    assert DAYS[-1] in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    # The other days' files are gone: reading them would fail.
    for date in DAYS[:-1]:
        for file in Path(source, f"date={date}").glob("*.parquet"):
            file.write_bytes(b"no longer readable")
    days.add_days(actions, path, DAYS[-1:])
    assert {d: files(d) for d in DAYS[:-1]} == before and files(DAYS[-1])
    told = days.rollup_of_days(days.scan_days(spark, path))
    assert rows(told) == rows(sessions.session_rollup(scan_actions(raw)), told.columns)


def test_a_day_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "states")
    days.add_days(scan_actions(some_actions(spark, DAYS[:3], 1)), path, DAYS[:3])
    again = some_actions(spark, DAYS[1:2], 2)
    days.add_days(scan_actions(again), path, DAYS[1:2])
    days.add_days(scan_actions(again), path, [])
    now = days.rollup_of_days(days.scan_days(spark, path, DAYS[1], DAYS[1]))
    assert rows(now) == rows(sessions.session_rollup(scan_actions(again)), now.columns)


def test_dates_prune_the_stored_states(spark, stored):
    plan = plan_of(days.rollup_of_days(days.scan_days(spark, stored, DAYS[2], DAYS[3])))
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert DAYS[2] in filters and DAYS[3] in filters
    schema = plan.split("ReadSchema: struct<")[1]
    assert "keywords" not in schema and "clicks" not in schema


def test_no_states(spark):
    states = days.day_states(scan_actions(raw_actions(spark, [])))
    assert states.count() == days.rollup_of_days(states, PARAMS).count() == days.records_of_days(states).count() == 0
