"""The physical plans hold what the operators promise at scale."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

from tests.helpers import action, final_plan_of, plan_of, raw_actions, users
from visitloom.operators import categories, details, sampling, sessions, topn
from visitloom.params import TaskParams
from visitloom.plans.catalog import QUERIES
from visitloom.sources.tables import scan_actions, scan_users, store_actions

SMALL = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **values):
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Actions as stored on a cluster: parquet directories by date."""
    path = str(tmp_path_factory.mktemp("stored") / "actions")
    rows = [
        action(f"s{i % 40}", f"2024-01-0{i % 5 + 1} 1:00:{i % 60:02d}", i % 7, click_category_id=i % 9)
        for i in range(400)
    ]
    store_actions(raw_actions(spark, rows), path, 6)
    return path


@pytest.fixture
def acts(spark, stored):
    return scan_actions(spark.read.parquet(stored))


@pytest.fixture
def people(spark):
    return scan_users(users(spark, *((i, 20, "a", "x", "male") for i in range(7))))


def test_stored_actions_are_whole(spark, acts):
    assert acts.count() == 400
    assert acts.schema["date"].dataType.simpleString() == "string"


def test_dates_prune_partitions_and_columns(spark, stored):
    df = scan_actions(spark.read.parquet(stored), "2024-01-02", "2024-01-03")
    plan = plan_of(sessions.session_rollup(df))
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "2024-01-02" in partition_filters and "2024-01-03" in partition_filters
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == [
        "action_time", "session_id", "user_id",
    ]


def test_literal_ids_reach_the_reader(spark, stored):
    df = details.restrict_to_ids(scan_actions(spark.read.parquet(stored)), ["s1", "s2"])
    assert "In(session_id, [s1,s2])" in plan_of(df)


def test_rollup_is_one_hash_aggregate_with_map_side_combine(acts):
    plan = plan_of(sessions.session_rollup(acts, TaskParams(keywords=("a",), category_ids=("1",))))
    assert plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_activity_joins_before_or_after_the_aggregate_by_size(spark, acts, people, tmp_path):
    chosen = sessions.select_sessions(acts, people, TaskParams()).select("session_id")
    with conf(spark, **{"spark_sql_autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(categories.session_category_activity(acts, chosen))
        # Reading down: the join stands above the aggregate of the events.
        assert plan.index("LeftSemi") < plan.index("HashAggregate")
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    chosen.write.parquet(str(tmp_path / "sessions"))
    few = spark.read.parquet(str(tmp_path / "sessions"))
    plan = plan_of(categories.session_category_activity(acts, few))
    assert plan.index("HashAggregate") < plan.index("LeftSemi")
    assert "BroadcastHashJoin" in plan


def test_top_categories_restrict_clicks_below_their_aggregate(spark, acts):
    top = categories.top_categories(categories.category_counts(acts), 3)
    plan = plan_of(topn.top_category_session_counts(top, topn.session_category_clicks(acts), 3))
    assert plan.index("HashAggregate") < plan.index("LeftSemi")
    assert "TakeOrderedAndProject" in plan


def test_top_sessions_cut_each_category_before_the_shuffle(acts):
    plan = plan_of(topn.top_sessions(topn.session_category_clicks(acts)))
    assert plan.index("Final") < plan.index("hashpartitioning(category_id") < plan.index("Partial")


def test_chosen_details_do_not_shuffle_the_actions(spark, acts):
    chosen = spark.createDataFrame([("s1",)], "session_id string")
    for df in (details.detail_of_few(acts, chosen, 100), details.detail_of_each(acts, chosen, 100)):
        assert "hashpartitioning" not in plan_of(df)


def test_broadcast_hint_ends_at_the_bound(spark, acts):
    chosen = spark.createDataFrame([("s1",)], "session_id string")
    with conf(spark, **{"spark_sql_autoBroadcastJoinThreshold": "-1"}):
        assert "BroadcastHashJoin" in plan_of(details.detail_of_few(acts, chosen, 10_000))
        assert "SortMergeJoin" in plan_of(details.detail_of_few(acts, chosen, 10_001))


def test_actions_of_a_hot_session_are_split(spark, tmp_path):
    """A third of the actions are one session's: the semi join takes several tasks for it."""
    path = str(tmp_path / "hot")
    spark.range(0, 300_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id)) as session_id", "uuid() as filler"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    ids = df.groupBy("session_id").count()
    values = {
        "spark_sql_autoBroadcastJoinThreshold": "-1",
        "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "100000",
        "spark_sql_adaptive_advisoryPartitionSizeInBytes": "200000",
        "spark_sql_adaptive_skewJoin_skewedPartitionFactor": "2",
    }
    with conf(spark, **values):
        kept = details.session_detail_filtered(df, ids)
        assert len(kept.collect()) == 300_000
        assert "skew=true" in plan_of(kept)


def test_quota_aggregate_runs_once(spark, acts, people):
    quota = sampling.extract_quota_per_hour(sessions.select_sessions(acts, people, TaskParams()))
    quota.collect()
    assert "ReusedExchange" in plan_of(quota) or "ReusedSubquery" in plan_of(quota)


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "InPandas" not in plan


def reads_of_events(query) -> int:
    """How often a query that ran has read the events; a reused exchange reads nothing."""
    query.collect()
    return len(re.findall(r"FileScan parquet \[[^\n]*events\.parquet", final_plan_of(query)))


@pytest.mark.parametrize(
    ("name", "reads"),
    [
        ("session_rollup", 1),
        ("session_full_info", 1),
        ("kv_pack", 1),
        ("session_random_extract", 2),
        ("extract_session_detail", 2),
        ("top_category_session_counts", 2),
        ("top10_session", 2),
        ("top10_session_detail", 3),
    ],
)
def test_events_are_read_so_often(spark, name, reads):
    with conf(spark, spark_sql_maxMetadataStringLength="400"):
        assert reads_of_events(QUERIES[name](spark, SMALL)) == reads


def test_dates_bound_the_stored_time(spark):
    plan = plan_of(QUERIES["scan_actions_by_date"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-03", plan)
    assert re.search(r"LessThan\(ts,2024-01-29", plan)


def test_stored_days_stay(spark, tmp_path):
    def day(n, *names):
        rows = [action(name, f"2024-01-0{n} 1:00:00") for name in names]
        store_actions(raw_actions(spark, rows), str(tmp_path / "acts"), 2)
        stored = spark.read.parquet(str(tmp_path / "acts"))
        return sorted((str(r["date"])[-1], r["session_id"]) for r in stored.collect())

    assert day(1, "a", "b") == [("1", "a"), ("1", "b")]
    assert day(2, "c") == [("1", "a"), ("1", "b"), ("2", "c")]
    assert day(1, "d") == [("1", "d"), ("2", "c")]
