"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.functions import text, times
from visitloom.functions.predicates import equal
from visitloom.operators import categories, days, details, sampling, sessions, stats, topn
from visitloom.params import TaskParams
from visitloom.schemas import TIME_FORMAT, USER_VISIT_ACTION
from visitloom.sources import audit, star
from visitloom.sources.tables import scan_actions, scan_products, scan_users
from visitloom.sources.tasks import task_by_id, task_params

Query = Callable[[SparkSession, str], DataFrame]

TASKID = 1
SEED = 7
LOOKUP_TASK = 42

EVERYTHING = TaskParams()
DATES = {"startDate": "2024-01-03", "endDate": "2024-01-28"}
AGES = {"startAge": "10", "endAge": "50"}
KEYWORDS = {"keywords": "lamp,rug,pillow"}
CATEGORIES = {"categoryIds": "1,3,5,26,61,96"}
SEGMENTS = {"professionals": "BUILDING,MACHINERY"}
CITIES = {"cities": "NATION_1,NATION_2,NATION_10,NATION_17"}
TASK_FILTER = TaskParams.from_values({**DATES, **AGES})

# Names of the packed session record's fields.
PACKED = {
    "sessionId": "session_id",
    "searchKeyWords": "search_keywords",
    "clickCategoryIds": "click_category_ids",
    "visitLength": "visit_length",
    "stepLength": "step_length",
    "startTime": "start_time",
}

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams = EVERYTHING) -> DataFrame:
    dates = params.start_date, params.end_date
    return scan_actions(star.user_visit_action(spark, sf_dir, *dates), *dates)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_users(star.user_info(spark, sf_dir))


def _selected(spark: SparkSession, sf_dir: str, params: TaskParams = EVERYTHING) -> DataFrame:
    actions, users = _actions(spark, sf_dir, params), _users(spark, sf_dir)
    return sessions.select_sessions(actions, users, params)


def _with_text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, TIME_FORMAT) for c in columns})


# --- sources ----------------------------------------------------------------------


@_query
def scan_actions_by_date(spark, sf_dir):
    actions = _actions(spark, sf_dir, TaskParams.from_values(DATES))
    return actions.select(*USER_VISIT_ACTION.fieldNames())


@_query
def scan_user_info(spark, sf_dir):
    return _users(spark, sf_dir)


@_query
def scan_product_info(spark, sf_dir):
    return scan_products(star.product_info(spark, sf_dir))


@_query
def task_by_id_(spark, sf_dir):
    return task_by_id(star.task(spark, sf_dir), LOOKUP_TASK)


@_query
def task_params_(spark, sf_dir):
    return task_params(star.task(spark, sf_dir))


# --- sessions ---------------------------------------------------------------------


@_query
def session_rollup(spark, sf_dir):
    rolled = sessions.session_rollup(_actions(spark, sf_dir))
    return _with_text_times(rolled, "start_time", "end_time")


@_query
def session_keywords(spark, sf_dir):
    return sessions.session_keywords(_actions(spark, sf_dir))


@_query
def session_click_categories(spark, sf_dir):
    return sessions.session_click_categories(_actions(spark, sf_dir))


@_query
def session_list_entries(spark, sf_dir):
    return sessions.session_list_entries(_actions(spark, sf_dir))


@_query
def session_full_info(spark, sf_dir):
    records = sessions.session_records(_actions(spark, sf_dir))
    full = sessions.session_full_info(records, _users(spark, sf_dir))
    return _with_text_times(full, "start_time", "end_time")


def _filtered(values: dict[str, str]) -> Query:
    params = TaskParams.from_values(values)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _with_text_times(_selected(spark, sf_dir, params), "start_time", "end_time")

    return query


FILTERS = {
    "filter_age_between": AGES,
    "filter_age_one_sided": {"startAge": "10"},
    "filter_professional_in": SEGMENTS,
    "filter_city_in": CITIES,
    "filter_sex_in": {"sex": "male"},
    "filter_keywords_any": KEYWORDS,
    "filter_categories_any": CATEGORIES,
    "filter_sessions": {**DATES, **AGES, **KEYWORDS},
    "filter_sessions_by_category": {**DATES, **AGES, **CATEGORIES},
    "filter_sessions_by_user": {**DATES, **SEGMENTS, **CITIES, "sex": "male,female"},
}
QUERIES.update({name: _filtered(values) for name, values in FILTERS.items()})


@_query
def filter_equal(spark, sf_dir):
    full = _selected(spark, sf_dir).where(equal(F.col("city"), "NATION_1"))
    return _with_text_times(full, "start_time", "end_time")


@_query
def session_detail_filtered(spark, sf_dir):
    actions = _actions(spark, sf_dir, TASK_FILTER)
    kept = details.session_detail_filtered(actions, _selected(spark, sf_dir, TASK_FILTER))
    return kept.select(*USER_VISIT_ACTION.fieldNames())


# --- sessions from states of each day -------------------------------------------------


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.day_states(_actions(spark, sf_dir))


@_query
def session_day_states(spark, sf_dir):
    states = _with_text_times(_days(spark, sf_dir), "first_ts", "last_ts")
    clicks = F.expr("array_join(transform(clicks, c -> concat(c.category, ':', c.n)), ',')")
    return states.withColumns({"keywords": F.array_join("keywords", ","), "clicks": clicks})


@_query
def session_rollup_of_days(spark, sf_dir):
    some = days.days_between(_days(spark, sf_dir), *DATES.values())
    return _with_text_times(days.rollup_of_days(some), "start_time", "end_time")


@_query
def filter_sessions_of_days(spark, sf_dir):
    params = TaskParams.from_values({**DATES, **AGES, **KEYWORDS, **CATEGORIES})
    some = days.days_between(_days(spark, sf_dir), params.start_date, params.end_date)
    full = sessions.session_full_info(days.rollup_of_days(some, params), _users(spark, sf_dir))
    return _with_text_times(sessions.filter_sessions(full, params), "start_time", "end_time")


@_query
def session_records_of_months(spark, sf_dir):
    months = days.merged_states(_days(spark, sf_dir), F.substring("date", 1, 7))
    full = sessions.session_full_info(days.records_of_days(months), _users(spark, sf_dir))
    return _with_text_times(full, "start_time", "end_time")


# --- statistics ---------------------------------------------------------------------


@_query
def session_band_counts(spark, sf_dir):
    return stats.session_band_counts(_selected(spark, sf_dir))


@_query
def session_aggr_stat(spark, sf_dir):
    return stats.session_aggr_stat(_selected(spark, sf_dir), TASKID)


@_query
def session_aggr_stat_filtered(spark, sf_dir):
    return stats.session_aggr_stat(_selected(spark, sf_dir, TASK_FILTER), TASKID)


# --- sampling -----------------------------------------------------------------------


def _text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@_query
def sessions_per_hour(spark, sf_dir):
    return _text_date(sampling.sessions_per_hour(_selected(spark, sf_dir)))


@_query
def sessions_per_day(spark, sf_dir):
    return _text_date(sampling.sessions_per_day(_selected(spark, sf_dir)))


@_query
def extract_quota_per_hour(spark, sf_dir):
    return _text_date(sampling.extract_quota_per_hour(_selected(spark, sf_dir)))


def _drawn(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return sampling.draw_sessions(_selected(spark, sf_dir, params), SEED)


def _random_extract(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    drawn = _drawn(spark, sf_dir, params)
    return sampling.session_random_extract(_actions(spark, sf_dir, params), drawn, TASKID)


@_query
def session_random_extract(spark, sf_dir):
    return _random_extract(spark, sf_dir, EVERYTHING)


@_query
def session_random_extract_filtered(spark, sf_dir):
    return _random_extract(spark, sf_dir, TASK_FILTER)


@_query
def extract_session_detail(spark, sf_dir):
    drawn = _drawn(spark, sf_dir, EVERYTHING)
    own = details.detail_of_few(_actions(spark, sf_dir), drawn, sampling.EXTRACT_TOTAL)
    return details.shape_detail(own, TASKID)


# --- categories ---------------------------------------------------------------------


@_query
def category_click_count(spark, sf_dir):
    return categories.category_click_count(_actions(spark, sf_dir))


@_query
def category_order_count(spark, sf_dir):
    return categories.category_order_count(_actions(spark, sf_dir))


@_query
def category_pay_count(spark, sf_dir):
    return categories.category_pay_count(_actions(spark, sf_dir))


@_query
def visited_categories(spark, sf_dir):
    return categories.visited_categories(_actions(spark, sf_dir))


@_query
def category_counts(spark, sf_dir):
    return categories.category_counts(_actions(spark, sf_dir))


@_query
def category_counts_by_join(spark, sf_dir):
    return categories.category_counts_by_join(_actions(spark, sf_dir))


@_query
def categories_ranked(spark, sf_dir):
    return categories.categories_ranked(categories.category_counts(_actions(spark, sf_dir)))


def _activity(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return categories.session_category_activity(
        _actions(spark, sf_dir, params), _selected(spark, sf_dir, params)
    )


def _top_categories(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return categories.top_categories(categories.sum_activity(_activity(spark, sf_dir, params)))


@_query
def session_category_activity(spark, sf_dir):
    return _activity(spark, sf_dir, EVERYTHING)


@_query
def top10_category(spark, sf_dir):
    return categories.top10_category(_top_categories(spark, sf_dir, EVERYTHING), TASKID)


@_query
def top10_category_filtered(spark, sf_dir):
    return categories.top10_category(_top_categories(spark, sf_dir, TASK_FILTER), TASKID)


def _explode(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    actions = _actions(spark, sf_dir).select("session_id", "action_time", "page_id", column)
    return text.explode_ids(actions, column, "category_id")


@_query
def explode_order_categories(spark, sf_dir):
    return _explode(spark, sf_dir, "order_category_ids")


@_query
def explode_pay_categories(spark, sf_dir):
    return _explode(spark, sf_dir, "pay_category_ids")


# --- top sessions -------------------------------------------------------------------


@_query
def session_category_clicks(spark, sf_dir):
    return topn.session_category_clicks(_actions(spark, sf_dir))


def _top_counts(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    activity = _activity(spark, sf_dir, params)
    top = categories.top_categories(categories.sum_activity(activity))
    # The counts that are never negative keep this plan equal to the one above up to the shuffle,
    # so that Spark reads the actions once for both.
    clicked = "click_count > 0 and order_count >= 0 and pay_count >= 0"
    clicks = activity.where(clicked).select("session_id", "category_id", "click_count")
    return topn.top_category_session_counts(top, clicks, categories.TOP_CATEGORIES)


@_query
def top_category_session_counts(spark, sf_dir):
    return _top_counts(spark, sf_dir, EVERYTHING)


def _busiest(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return topn.top_sessions(_top_counts(spark, sf_dir, params))


@_query
def top10_session(spark, sf_dir):
    return topn.top10_session(_busiest(spark, sf_dir, EVERYTHING), TASKID)


@_query
def top10_session_filtered(spark, sf_dir):
    return topn.top10_session(_busiest(spark, sf_dir, TASK_FILTER), TASKID)


@_query
def top10_session_detail(spark, sf_dir):
    rows = categories.TOP_CATEGORIES * topn.TOP_SESSIONS
    detail = details.detail_of_each(
        _actions(spark, sf_dir), _busiest(spark, sf_dir, EVERYTHING), rows
    )
    return details.shape_detail(detail, TASKID)


# --- column operators ---------------------------------------------------------------


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _actions(spark, sf_dir).select("session_id", "page_id", "date", "action_time")


@_query
def parse_action_times(spark, sf_dir):
    """Actions of most pages hold a time that is not written as it should be."""
    time = F.col("action_time")
    malformed = [
        F.col("date"),
        F.concat(F.lit("at "), time),
        F.concat(time, F.lit("Z")),
        F.concat(time, F.lit("+08:00")),
        F.concat(time, F.lit(".5xyz")),
        F.concat(time, F.lit(" ")),
        F.replace(time, F.lit(" "), F.lit("T")),
        F.replace(time, F.lit("-0"), F.lit("-")),
    ]
    damaged = time
    for page, text_of_page in enumerate(malformed):
        damaged = F.when(F.col("page_id") == page, text_of_page).otherwise(damaged)
    damaged = _times(spark, sf_dir).withColumn("action_time", damaged)
    return _with_text_times(times.parse_action_times(damaged, "action_time", "parsed"), "parsed")


@_query
def time_keys(spark, sf_dir):
    return times.add_time_keys(_times(spark, sf_dir), "action_time")


@_query
def parse_date_keys(spark, sf_dir):
    keyed = times.add_time_keys(_times(spark, sf_dir), "action_time")
    damaged = keyed.withColumn(
        "date_key", F.when(F.col("page_id") == 0, F.col("date")).otherwise(F.col("date_key"))
    )
    parsed = times.parse_date_keys(damaged, "date_key", "parsed")
    return parsed.select(
        "session_id", "page_id", "date_key", F.date_format("parsed", "yyyy-MM-dd").alias("parsed")
    )


@_query
def elapsed_seconds(spark, sf_dir):
    """Actions against half past midnight; those of page 0 against malformed text."""
    pairs = _times(spark, sf_dir).withColumn(
        "other_time",
        F.when(F.col("page_id") == 0, F.col("date")).otherwise(
            F.concat("date", F.lit(" 0:30:00"))
        ),
    )
    return times.add_elapsed(pairs, "action_time", "other_time")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sessions.session_records(_actions(spark, sf_dir))
    packed = text.pack_kv(_with_text_times(records, "start_time"), PACKED)
    return packed.select("packed")


@_query
def kv_pack(spark, sf_dir):
    return _packed(spark, sf_dir)


@_query
def kv_unpack(spark, sf_dir):
    return text.unpack_kv(_packed(spark, sf_dir), "packed", PACKED)


@_query
def kv_set(spark, sf_dir):
    return text.set_kv(_packed(spark, sf_dir), "packed", "stepLength", "0")


#: Values with every character that structures packed text, missing and empty ones, by page.
ODD_VALUES = (
    """case page_id when 0 then null when 1 then '' when 2 then '%00' when 3 then '%7C'
        else concat(session_id, '|', action_time, '=%,', coalesce(search_keyword, ''), '|=') end as odd""",
    """case page_id when 0 then null when 1 then array() when 2 then array('') when 3 then array('', null)
        else array(search_keyword, concat('a,', session_id), '%01') end as odd_list""",
)


def _packed_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = _actions(spark, sf_dir).selectExpr("session_id", "page_id", "click_category_id", *ODD_VALUES)
    fields = {"sessionId": "session_id", "odd": "odd", "list": "odd_list", "category": "click_category_id"}
    return text.pack_exact(odd, fields)


@_query
def kv_pack_exact(spark, sf_dir):
    return _packed_exactly(spark, sf_dir).select("session_id", "page_id", "packed")


@_query
def kv_unpack_exact(spark, sf_dir):
    fields = {"odd": "odd", "list": "items", "category": "category", "none": "not_there"}
    packed = _packed_exactly(spark, sf_dir).select("session_id", "page_id", "packed")
    read = text.unpack_exact(packed, "packed", fields, lists=["list"])
    items = F.transform("items", lambda item: F.coalesce(item, F.lit("<null>")))
    return read.withColumn("items", F.array_join(items, "; ")).drop("packed")


# --- raw actions that cannot be read ----------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions as text; those of some pages are damaged in some columns."""
    raw = star.user_visit_action(spark, sf_dir)
    raw = raw.select(*(F.col(c).cast("string").alias(c) for c in raw.columns))
    damages = {
        "user_id": "if(page_id = '1', concat(user_id, 'x'), if(page_id = '2', '', user_id))",
        "session_id": "if(page_id = '2', null, session_id)",
        "action_time": "case page_id when '3' then replace(action_time, ' ', 'T') "
        "when '4' then concat(date_add(to_date(date), 1), ' 1:00:00') else action_time end",
        "date": "if(page_id = '5', replace(date, '-', '/'), date)",
        "click_category_id": "if(page_id = '6', concat(click_category_id, '.5'), click_category_id)",
        "order_category_ids": "if(page_id = '7', concat(order_category_ids, ',,'), order_category_ids)",
    }
    return raw.withColumns({name: F.expr(damage) for name, damage in damages.items()})


@_query
def reject_counts(spark, sf_dir):
    return audit.reject_counts(audit.audited_actions(_raw(spark, sf_dir)))


@_query
def rejected_actions(spark, sf_dir):
    refused = audit.rejected(audit.audited_actions(_raw(spark, sf_dir)))
    page = F.get_json_object("row", "$.page_id")
    return refused.select("column", "reason", "value", page.alias("page_id"))


@_query
def accepted_actions(spark, sf_dir):
    return audit.accepted(audit.audited_actions(_raw(spark, sf_dir)))


@_query
def clean_lists(spark, sf_dir):
    lists = _actions(spark, sf_dir).select(
        "session_id",
        "page_id",
        F.concat(
            F.lit(","), F.coalesce("order_category_ids", F.lit("")), F.lit(","), "pay_category_ids"
        ).alias("ids"),
    )
    ragged = lists.withColumn(
        "ids", F.coalesce("ids", F.when(F.col("page_id") % 2 == 0, ",").otherwise("1,2,,"))
    )
    return text.clean_lists(ragged, "ids")
