"""The whole analysis of one task."""

from __future__ import annotations

import secrets
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from visitloom.operators import categories, days, details, sampling, sessions, stats, topn
from visitloom.params import TaskParams
from visitloom.sinks import Sink
from visitloom.sources.tables import Tables, scan_actions, scan_users
from visitloom.sources.tasks import load_params

LITERAL_IDS = 1000


class Stages:
    """Intermediate results kept as parquet in the cluster's shared checkpoint folder.

    A stored stage survives lost executors, cuts the lineage, reads column by
    column, and has a known size, by which Spark decides about broadcasts.
    A run deletes its own folder when its results are written; that of a failed run is left to the
    shared folder's clean-up, as checkpoints are. On a cluster, a path without another scheme than
    ``file`` is refused: executors would write it to their own disks.
    """

    def __init__(self, spark: SparkSession, checkpoint_dir: str | None = None) -> None:
        self._spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir
        if not shared:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark._jvm.org.apache.hadoop.fs.Path(shared)
        self._files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if self._files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{shared} is local to each machine; name a shared folder")
        self.root = f"{shared.rstrip('/')}/visitloom-{secrets.token_hex(8)}"

    def store(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        self._files.delete(self._spark._jvm.org.apache.hadoop.fs.Path(self.root), True)


@dataclass(frozen=True)
class Settings:
    extract_total: int = sampling.EXTRACT_TOTAL
    top_categories: int = categories.TOP_CATEGORIES
    top_sessions: int = topn.TOP_SESSIONS
    seed: int | str | None = None  # None: drawn once per run
    checkpoint_dir: str | None = None  # used only where spark.checkpoint.dir is unset
    session_filters: bool = False  # the actions are stored with Bloom filters of session_id


def run(
    spark: SparkSession,
    tables: Tables,
    taskid: int,
    sink: Sink,
    params: TaskParams | None = None,
    settings: Settings = Settings(),
) -> None:
    """Compute the five results of a task, write each of them once, then publish them.

    All results are stages before the first is written, so a failure while computing leaves the
    results of earlier runs as they were; so does one while writing if the sink publishes in one step.

    The actions are read four times: once each for sessions, category activity
    and the lists of the drawn sessions, with few columns; and once in full
    width for the chosen sessions only. They are shuffled in the first two. Where ``tables`` have
    the states of the days, sessions come from these instead of the actions.
    """
    if params is None:
        if tables.tasks is None:
            raise ValueError("give params, or tables with a task table")
        params = load_params(tables.tasks, taskid)
    seed = settings.seed if settings.seed is not None else secrets.token_hex(8)
    stages = Stages(spark, settings.checkpoint_dir)
    results: dict[str, DataFrame] = {}

    def keep(table: str, result: DataFrame) -> None:
        results[table] = stages.store(table, result)

    actions = scan_actions(tables.actions, params.start_date, params.end_date)

    if tables.days is None:
        rolled = sessions.session_rollup(actions, params)
    else:
        some = days.days_between(tables.days, params.start_date, params.end_date)
        rolled = days.rollup_of_days(some, params)
    full = sessions.session_full_info(rolled, scan_users(tables.users))
    selected = stages.store(
        "sessions",
        sessions.filter_sessions(full, params).select(
            "session_id", "start_time", "visit_length", "step_length"
        ),
    )
    keep("session_aggr_stat", stats.session_aggr_stat(selected, taskid))

    drawn = stages.store(
        "drawn", sampling.draw_sessions(selected, seed, settings.extract_total)
    )
    activity = stages.store("activity", categories.session_category_activity(actions, selected))

    top = stages.store(
        "top_categories",
        categories.top_categories(categories.sum_activity(activity), settings.top_categories),
    )
    keep("top10_category", categories.top10_category(top, taskid))

    clicks = activity.where("click_count > 0").select("session_id", "category_id", "click_count")
    busiest = stages.store(
        "top_sessions",
        topn.top_sessions(
            topn.top_category_session_counts(top, clicks, settings.top_categories),
            settings.top_sessions,
        ),
    )
    keep("top10_session", topn.top10_session(busiest, taskid))

    extract = sampling.session_random_extract(
        _near(actions, drawn, settings.extract_total, settings.session_filters), drawn, taskid, settings.extract_total
    )
    keep("session_random_extract", extract)

    # Both producers of session details in one read and one write: a session
    # comes out once if it was drawn, and once more per top list it is in.
    chosen = drawn.select("session_id").distinct().union(busiest.select("session_id"))
    chosen_rows = settings.extract_total + settings.top_categories * settings.top_sessions
    near = _near(actions, chosen, chosen_rows, settings.session_filters)
    detail = details.detail_of_each(near, chosen, chosen_rows)
    keep("session_detail", details.shape_detail(detail, taskid))

    for table, result in results.items():
        sink.write(table, result, taskid)
    sink.publish(spark, taskid)
    stages.delete()


def _near(actions: DataFrame, chosen: DataFrame, max_rows: int, filtered: bool) -> DataFrame:
    """Narrow the scan by the chosen ids themselves where their number is small.

    The join that follows is exact by itself; this only lets the reader skip.
    """
    if max_rows > LITERAL_IDS:
        return actions
    ids = [row["session_id"] for row in chosen.select("session_id").distinct().collect()]
    return details.restrict_to_ids(actions, ids, filtered)
