"""Codes without loss, and raw rows that cannot be read."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import plan_of
from visitloom.functions import text
from visitloom.schemas import USER_VISIT_ACTION
from visitloom.sources import audit
from visitloom.sources.tables import scan_actions

SIGNS = st.text(alphabet="%|=,0127CD5a \n\\é", max_size=12)
ROW = st.tuples(st.none() | SIGNS, st.none() | SIGNS, st.none() | st.lists(st.none() | SIGNS, max_size=4))


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=100, max_size=200))
def test_unpacking_gives_back_what_was_packed(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c array<string>")
    packed = text.pack_exact(df, {"a": "a", "x.b": "b", "c": "c"}).select("packed")
    read = text.unpack_exact(packed, "packed", {"a": "a", "x.b": "b", "c": "c", "d": "d"}, ["c"])
    assert [(r["a"], r["b"], r["c"]) for r in read.collect()] == rows
    assert read.where("d is not null").count() == 0


def test_plain_values_are_packed_as_before(spark):
    df = spark.createDataFrame([("s1", 5)], "a string, n bigint")
    fields = {"id": "a", "n": "n"}
    assert text.pack_exact(df, fields).first()["packed"] == text.pack_kv(df, fields).first()["packed"]
    with pytest.raises(ValueError):
        text.pack_exact(df, {"a=b": "a"})


GOOD = {
    "date": "2024-01-02", "user_id": "7", "session_id": "s", "page_id": "0", "action_time": "2024-01-02 5:00:00",
    "search_keyword": "", "click_category_id": "-3", "order_category_ids": "1,2", "city_id": None,
}
CASES = [
    ({}, []),
    ({"user_id": "9223372036854775808"}, [("user_id", "not a whole number")]),
    ({"user_id": " 7"}, [("user_id", "not a whole number")]),
    ({"user_id": None, "session_id": ""}, [("user_id", "missing"), ("session_id", "missing")]),
    ({"date": "2024-02-30"}, [("date", "not a date")]),
    ({"date": None}, [("date", "missing")]),
    ({"action_time": "2024-01-02 25:00:00"}, [("action_time", "not a time")]),
    ({"action_time": "2024-01-03 5:00:00"}, [("action_time", "on another date")]),
    ({"order_category_ids": "1,,2"}, [("order_category_ids", "not a list of whole numbers")]),
    ({"pay_product_ids": "99999999999999999999"}, [("pay_product_ids", "not a list of whole numbers")]),
    ({"page_id": "1.0", "city_id": "x"}, [("page_id", "not a whole number"), ("city_id", "not a whole number")]),
]


@pytest.fixture(scope="module")
def audited(spark):
    rows = [tuple({**GOOD, **change}.get(n) for n in audit.RAW_ACTION.fieldNames()) for change, _ in CASES]
    return audit.audited_actions(spark.createDataFrame(rows, audit.RAW_ACTION))


def test_every_problem_is_told(audited):
    found = [sorted((p["column"], p["reason"]) for p in r["problems"]) for r in audited.collect()]
    assert found == [sorted(problems) for _, problems in CASES]


def test_clean_and_refused_rows_are_all_rows(spark, audited, tmp_path):
    path = str(tmp_path / "audited")
    audit.store_audited(audited, path)
    clean, refused = (audit.read_audited(spark, path, side) for side in (True, False))
    both = sorted(map(str, [*clean.collect(), *refused.collect()]))
    assert both == sorted(map(str, audited.collect())) and refused.count() == len(CASES) - 1
    assert "clean" in plan_of(clean).split("PartitionFilters: [")[1].split("]")[0]
    typed = audit.accepted(clean)
    assert typed.schema == USER_VISIT_ACTION and scan_actions(typed).first()["action_ts"].hour == 5
    assert (typed.first()["search_keyword"], typed.first()["click_category_id"]) == (None, -3)


def test_refused_rows_keep_what_was_found(audited):
    told = audit.rejected(audited).where("reason = 'not a date'").first()
    assert (told["column"], told["value"]) == ("date", "2024-02-30")
    assert json.loads(told["row"])["session_id"] == "s"
    counts = {(r["column"], r["reason"]): r["row_count"] for r in audit.reject_counts(audited).collect()}
    assert counts["", "none"] == 1 and counts["", "any"] == len(CASES) - 1 and counts["user_id", "not a whole number"] == 2


def test_counts_read_the_rows_once(spark):
    rows = spark.createDataFrame([], audit.RAW_ACTION)
    assert plan_of(audit.reject_counts(audit.audited_actions(rows))).count("Exchange") == 1
