from __future__ import annotations

import re
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitloom.functions import text, times


def column(spark, values, name="c"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def values(df, name="c"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_parse_times(spark):
    given_texts = [
        "2024-01-01 5:07:09", "2024-01-01 05:07:09", "2024-1-1 5:7:9", "2024-01-01 05:07:09.9",
        "2024-01-01 5:07:09Z", "2024-01-01 5:07:09+08:00", "2024-01-01 5:07:09 ", "2024-01-01 5:07:09\n", "2024-01-01", "2024-01-01 05:07", "2024-01-01T05:07:09", "05:07:09", "2024-13-01 05:07:09",
        "2024-01-01 25:07:09", "", "x y:z:w", None,
    ]
    parsed = values(times.parse_action_times(column(spark, given_texts), "c"))
    assert parsed == [datetime(2024, 1, 1, 5, 7, 9)] * 2 + [None] * 15


def test_parse_date_keys(spark):
    df = column(spark, ["20240131", "2024-01-31", "20240231", "202401311", None])
    assert values(times.parse_date_keys(df, "c", "d"), "d") == [date(2024, 1, 31)] + [None] * 4


def test_time_keys(spark):
    row = times.add_time_keys(column(spark, ["2024-03-04 5:06:07"]), "c").first()
    assert row["date"] == "2024-03-04"
    assert row["time"] == "2024-03-04 05:06:07"
    assert row["date_key"] == "20240304"
    assert row["minute_key"] == "202403040506"
    assert row["date_hour"] == "2024-03-04_05"


def test_elapsed(spark):
    rows = [
        ("2024-01-01 0:00:05", "2024-01-01 0:00:01", (False, True, 4)),
        ("2024-01-01 0:00:01", "2024-01-02 0:00:01", (True, False, -86400)),
        ("2024-01-01 0:00:01", "2024-01-01 0:00:01", (False, False, 0)),
        ("bad", "2024-01-01 0:00:01", (False, False, 0)),
        ("2024-01-01 0:00:01", None, (False, False, 0)),
        ("2124-01-01 0:00:01", "2024-01-01 0:00:01", (False, True, 3155673600)),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a string, b string")
    got = times.add_elapsed(df, "a", "b").collect()
    assert [(r["is_before"], r["is_after"], r["elapsed"]) for r in got] == [r[2] for r in rows]


def test_explode_ids(spark):
    df = column(spark, [",", "1,,2", "1,2,,", "x,3", None, "", "4,4", "-5"])
    got = text.explode_ids(df, "c", "n").orderBy("i", "n").collect()
    assert [(r["i"], r["n"]) for r in got] == [
        (1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (6, 4), (6, 4), (7, -5),
    ]


def test_clean_lists(spark):
    df = column(spark, [",1,2,", "1,2", ",,1,,", ",", ",,", "", None, "1,\n"])
    assert values(text.clean_lists(df, "c")) == [
        "1,2", "1,2", ",1,", "", "", "", None, "1,\n",
    ]


def test_unpack(spark):
    df = column(
        spark, ["a=1|b=|x=1=2", "ba=9|a=2|a=3", "a=|a=4", "a=5==|", "b=1", "", None, "a=1=2|a=6"]
    )
    assert values(text.unpack_kv(df, "c", {"a": "v"}), "v") == [
        "1", "2", "4", "5", None, None, None, "6",
    ]
    assert text.unpack_kv(df, "c", ["a", "b", "x"]).where("i = 0").first()[2:] == ("1", None, None)


def test_unpack_takes_names_literally(spark):
    df = column(spark, ["a+b=1|axb=2"])
    assert values(text.unpack_kv(df, "c", {"a+b": "v", "a.b": "w"}), "v") == ["1"]
    assert values(text.unpack_kv(df, "c", {"a.b": "w"}), "w") == [None]


def test_set(spark):
    df = column(spark, ["a=1|b=2", "b=2|a=1|a=3", "b=2", "a|b=1", "a=1=2", "aa=1||a=1||", None])
    assert values(text.set_kv(df, "c", "a", "$9\\")) == [
        "a=$9\\|b=2", "b=2|a=$9\\|a=3", "b=2", "a=$9\\|b=1", "a=$9\\", "aa=1||a=$9\\", None,
    ]


def test_set_from_column(spark):
    df = text.set_kv(column(spark, ["a=1"]), "c", "a", F.col("i") + 41)
    assert values(df) == ["a=41"]


def test_pack_and_back(spark):
    df = spark.createDataFrame([(0, "k", None, 7)], "i int, a string, b string, n bigint")
    packed = text.pack_kv(df, {"A": "a", "B": "b", "N": "n"})
    assert packed.first()["packed"] == "A=k|B=|N=7"
    assert text.unpack_kv(packed.select("packed"), "packed", ["A", "B", "N"]).first()[1:] == (
        "k", None, "7",
    )


PIECES = st.lists(st.sampled_from(["a", "b", "=", "|", "1", ""]), max_size=12).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES, min_size=40, max_size=40))
def test_unpack_follows_the_pair_rule(spark, samples):
    """Readable pairs have exactly two parts once '=' at their end is gone; the first one wins."""

    def first_value(packed):
        for pair in packed.split("|"):
            parts = re.sub("=+$", "", pair).split("=")
            if len(parts) == 2 and parts[0] == "a":
                return parts[1]
        return None

    got = values(text.unpack_kv(column(spark, samples), "c", {"a": "v"}), "v")
    assert got == [first_value(s) for s in samples]
