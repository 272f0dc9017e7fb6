from __future__ import annotations

from pathlib import Path

import pytest

from tests.helpers import action, raw_actions, users
from visitloom.operators import days
from visitloom.params import TaskParams
from visitloom.plans import catalog, job
from visitloom.schemas import RESULT_TABLES, TASK
from visitloom.sinks import FileSink, SnapshotSink
from visitloom.sources import star
from visitloom.sources.tables import Tables, scan_actions, store_actions

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_job_writes_the_same_as_the_queries(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    tables = star.tables(spark, SMALL)
    for _ in range(2):  # a second run replaces the first
        job.run(spark, tables, 1, sink, TaskParams(), job.Settings(seed=catalog.SEED))

    def query(name):
        return catalog.QUERIES[name](spark, SMALL)

    for table, schema in RESULT_TABLES.items():
        assert sink.read(spark, table).schema == schema
    for table in ("session_aggr_stat", "session_random_extract", "top10_category", "top10_session"):
        assert rows(sink.read(spark, table)) == rows(query(table))
    details = query("extract_session_detail").union(query("top10_session_detail"))
    assert rows(sink.read(spark, "session_detail")) == rows(details)


@pytest.mark.parametrize("stop", [None, *RESULT_TABLES])
def test_job_that_stops_leaves_the_old_snapshot(spark, tmp_path, monkeypatch, stop):
    people = users(spark, (1, 20, "a", "x", "male"))

    def run(sink, *names):
        acts = [action(n, click_category_id=5) for n in names]
        job.run(spark, Tables(raw_actions(spark, acts), people), 3, sink, TaskParams())

    run(SnapshotSink(str(tmp_path)), "a")
    later, write = SnapshotSink(str(tmp_path)), SnapshotSink.write

    def stopping(self, table, result, taskid):
        write(self, table, result, taskid)
        if table == stop:
            raise RuntimeError("lost")

    monkeypatch.setattr(SnapshotSink, "write", stopping)
    if stop:
        with pytest.raises(RuntimeError):
            run(later, "b", "c")
    else:
        run(later, "b", "c")
    found = later.snapshot(spark, 3)
    assert {t: found[t].schema for t in found} == RESULT_TABLES
    names = ["a"] if stop else ["b", "c"]
    assert found["session_aggr_stat"].first()["session_count"] == len(names)
    assert sorted(r["sessionid"] for r in found["top10_session"].collect()) == names
    assert {r["sessionid"] for r in found["session_detail"].collect()} == set(names)


def test_job_from_states_of_days(spark, tmp_path):
    """Sessions from the days' states, details by Bloom filters: the same results."""
    tables, found = star.tables(spark, SMALL), []
    path = str(tmp_path / "states")
    acts = scan_actions(tables.actions)
    days.add_days(acts, path, [f"2024-01-{n:02d}" for n in range(1, 31)], 2)
    store_actions(tables.actions, str(tmp_path / "actions"), 4)
    kept = Tables(spark.read.parquet(str(tmp_path / "actions")), tables.users, tables.tasks, days.scan_days(spark, path))
    params = TaskParams(start_date="2024-01-03", end_date="2024-01-28", start_age=10, end_age=50, category_ids=("3", "26", "5"))
    for given, settings in ((tables, job.Settings(seed=1)), (kept, job.Settings(seed=1, session_filters=True))):
        sink = SnapshotSink(str(tmp_path / f"out{len(found)}"))
        job.run(spark, given, 1, sink, params, settings)
        found.append({t: rows(df) for t, df in sink.snapshot(spark, 1).items()})
    assert found[0] == found[1] and found[0]["top10_session"]


def test_job_reads_its_parameters_from_the_task(spark, tmp_path):
    document = '{"startDate":["2024-01-02"],"sex":["male"]}'
    task = spark.createDataFrame([(7, "t", None, None, None, "s", "n", document)], TASK)
    tables = Tables(
        raw_actions(
            spark,
            [
                action("old", "2024-01-01 1:00:00", 1),
                action("m", "2024-01-02 1:00:00", 1, click_category_id=5),
                action("m", "2024-01-02 1:00:02", 1, order_category_ids="5,6"),
                action("f", "2024-01-02 1:00:00", 2, click_category_id=5),
            ],
        ),
        users(spark, (1, 20, "a", "x", "male"), (2, 20, "a", "x", "female")),
        task,
    )
    sink = FileSink(str(tmp_path))
    job.run(spark, tables, 7, sink)
    stat = sink.read(spark, "session_aggr_stat").first()
    assert (stat["taskid"], stat["session_count"], stat["visit_length_1s_3s_ratio"]) == (7, 1, 1.0)
    assert rows(sink.read(spark, "top10_category")) == [(7, 5, 1, 1, 0), (7, 6, 0, 1, 0)]
    assert rows(sink.read(spark, "top10_session")) == [(7, 5, "m", 1)]
    assert rows(sink.read(spark, "session_random_extract")) == [
        (7, "m", "2024-01-02 01:00:00", None, "5")
    ]
    times = [r["action_time"] for r in sink.read(spark, "session_detail").collect()]
    assert sorted(times) == ["2024-01-02 1:00:00"] * 2 + ["2024-01-02 1:00:02"] * 2


def test_repeated_user_rows_repeat_their_sessions(spark, tmp_path):
    tables = Tables(
        raw_actions(spark, [action("s", click_category_id=5), action("s")]),
        users(spark, (1, 20, "a", "x", "male"), (1, 30, "a", "x", "male")),
    )
    sink = FileSink(str(tmp_path))
    job.run(spark, tables, 3, sink, TaskParams())
    assert sink.read(spark, "session_aggr_stat").first()["session_count"] == 2
    extract = [(3, "s", "2024-01-01 05:00:00", None, "5")] * 2
    assert rows(sink.read(spark, "session_random_extract")) == extract
    assert rows(sink.read(spark, "top10_category")) == [(3, 5, 1, 0, 0)]


def test_job_without_any_session(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    empty = Tables(raw_actions(spark, []), users(spark, (1, 20, "a", "x", "male")))
    job.run(spark, empty, 3, sink, TaskParams())
    assert sink.read(spark, "session_aggr_stat").first()["session_count"] == 0
    for table in ("session_random_extract", "session_detail", "top10_category", "top10_session"):
        assert sink.read(spark, table).count() == 0


def test_job_needs_parameters_and_a_shared_folder(spark, tmp_path):
    tables = Tables(raw_actions(spark, []), users(spark))
    with pytest.raises(ValueError):
        job.run(spark, tables, 3, FileSink(str(tmp_path)))


def test_stages_use_the_session_folder_first(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert job.Stages(spark, "/elsewhere").root.startswith(folder)


def test_stages_go_when_the_results_are_written(spark, tmp_path):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = {p for p in Path(folder).glob("visitloom-*")}
    tables = Tables(raw_actions(spark, [action("s")]), users(spark, (1, 20, "a", "x", "male")))
    job.run(spark, tables, 3, FileSink(str(tmp_path)), TaskParams())
    assert {p for p in Path(folder).glob("visitloom-*")} == before


def test_results_are_written_after_all_are_computed(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(job.details, "shape_detail", fail)
    tables = Tables(raw_actions(spark, [action("s")]), users(spark, (1, 20, "a", "x", "male")))
    with pytest.raises(RuntimeError):
        job.run(spark, tables, 3, FileSink(str(tmp_path / "results")), TaskParams())
    assert not (tmp_path / "results").exists()


def test_local_folders_are_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError):
        job.Stages(spark)


@pytest.mark.parametrize("source", ["paths", "catalog"])
def test_job_loads_the_stored_task(spark, tmp_path, source):
    document = '{"sex":["male"]}'
    people = users(spark, (1, 20, "a", "x", "male"), (2, 20, "a", "x", "female"))
    stored = {
        "user_visit_action": raw_actions(spark, [action("m", user=1), action("f", user=2)]),
        "user_info": people,
        "task": spark.createDataFrame([(7, "t", None, None, None, "s", "n", document)], TASK),
    }
    spark.sql("create database if not exists source_tables")
    for name, df in stored.items():
        if source == "paths":
            df.write.parquet(f"{tmp_path}/in/{name}")
        else:
            df.write.mode("overwrite").saveAsTable(f"source_tables.{name}")
    if source == "paths":
        tables = Tables.from_paths(spark, f"{tmp_path}/in")
    else:
        tables = Tables.from_catalog(spark, "source_tables")
    sink = FileSink(str(tmp_path / "out"))
    job.run(spark, tables, 7, sink)
    assert sink.read(spark, "session_aggr_stat").first()["session_count"] == 1


def test_unseeded_runs_draw_differently(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    tables = star.tables(spark, SMALL)
    draws = set()
    for _ in range(2):
        job.run(spark, tables, 1, sink, TaskParams(), job.Settings(extract_total=60))
        extract = sink.read(spark, "session_random_extract")
        draws.add(tuple(sorted(r["sessionid"] for r in extract.collect())))
    assert len(draws) == 2
