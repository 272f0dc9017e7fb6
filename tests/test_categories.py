from __future__ import annotations

from tests.helpers import action, actions
from visitloom.operators import categories as C
from visitloom.operators import details, topn

ROWS = [
    action("s", click_category_id=1),
    action("s", order_category_ids="1,2,2"),
    action("t", pay_category_ids="3,,x,2,,"),
    action("t", click_category_id=1, order_category_ids=","),
    action("t"),
    action(None, click_category_id=4),
]


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


COUNTS = ("category_id", "click_count", "order_count", "pay_count")


def test_counts_in_both_forms(spark):
    df = actions(spark, ROWS)
    expected = [(1, 2, 1, 0), (2, 0, 2, 1), (3, 0, 0, 1), (4, 1, 0, 0)]
    assert rows(C.category_counts(df), *COUNTS) == expected
    assert rows(C.category_counts_by_join(df), *COUNTS) == expected


def test_activity_of_given_sessions(spark):
    df = actions(spark, ROWS)
    only_t = spark.createDataFrame([("t",)], "session_id string")
    activity = C.session_category_activity(df, only_t)
    assert rows(activity, "session_id", *COUNTS) == [
        ("t", 1, 1, 0, 0), ("t", 2, 0, 0, 1), ("t", 3, 0, 0, 1),
    ]
    assert rows(C.sum_activity(activity), *COUNTS) == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 0, 0, 1)]


def test_ranking_breaks_ties_in_order(spark):
    counts = spark.createDataFrame(
        [(5, 1, 1, 1), (4, 1, 1, 1), (3, 1, 1, 2), (2, 1, 2, 0), (1, 2**40, 0, 0), (0, 2, 9, 9)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    )
    assert [r["category_id"] for r in C.categories_ranked(counts).collect()] == [1, 0, 2, 3, 4, 5]
    assert [r["category_id"] for r in C.top_categories(counts, 3).collect()] == [1, 0, 2]


CLICKS = "session_id string, category_id bigint, click_count bigint"


def test_top_sessions_with_few_and_ties(spark):
    clicks = spark.createDataFrame(
        [("a", 1, 5), ("b", 1, 7), ("c", 1, 5), ("d", 2, 1), ("e", 3, 9)], CLICKS
    )
    top = spark.createDataFrame([(1,), (2,)], "category_id bigint")
    counts = topn.top_category_session_counts(top, clicks, 10)
    assert rows(topn.top_sessions(counts, 2), "category_id", "session_id", "click_count") == [
        (1, "a", 5), (1, "b", 7), (2, "d", 1),
    ]


def test_top_sessions_salted(spark):
    clicks = spark.createDataFrame(
        [(f"s{i}", i % 2, i * 37 % 11) for i in range(200)], CLICKS
    )
    normal = rows(topn.top_sessions(clicks, 20), *clicks.columns)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        assert rows(topn.top_sessions(clicks, 20), *clicks.columns) == normal
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert len(normal) == 40


def test_details_once_or_per_list(spark):
    df = actions(spark, [action("s", page_id=1), action("s", page_id=2), action("t", page_id=3)])
    twice = spark.createDataFrame([("s", 1), ("s", 2), ("u", 1)], "session_id string, c bigint")
    assert rows(details.detail_of_few(df, twice, 3), "page_id") == [(1,), (2,)]
    assert rows(details.detail_of_each(df, twice, 3), "page_id") == [(1,), (1,), (2,), (2,)]
    assert rows(details.session_detail_filtered(df, twice), "page_id") == [(1,), (2,)]
    assert details.restrict_to_ids(df, []).count() == 0
    assert details.restrict_to_ids(df, ["t"]).count() == 1
