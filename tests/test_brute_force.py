"""The whole job on ragged, skewed random input, against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from datetime import datetime
from fractions import Fraction

import pytest

from tests.helpers import action, raw_actions, users
from visitloom.params import TaskParams
from visitloom.plans import job
from visitloom.schemas import BANDS, USER_VISIT_ACTION
from visitloom.sinks import FileSink
from visitloom.sources.tables import Tables

WORDS = ["lamp", "desk lamp", "a,b", "", "x=y|z", None]
LISTS = ["1", "2,3,3", "4,,5,", ",", "", "x,6", None, None]
TIMES = ["{d} {h}:{m:02d}:{s:02d}", "{d} {h:02d}:{m:02d}:{s:02d}", "{d}", "broken"]


def make_rows(seed: int) -> list[dict]:
    """A third of the actions belong to one session, user, hour and category."""
    draw = random.Random(seed)
    rows = []
    for n in range(600):
        hot = n % 3 == 0
        user = 1 if hot else draw.choice([1, 2, 3, 4, 5, 99, None])
        session = "hot" if hot else draw.choice([f"s{draw.randrange(90)}_{user}", None])
        day = "2024-01-0" + ("2" if hot else str(draw.randrange(1, 5)))
        time = draw.choices(TIMES, [5, 5, 0 if hot else 1, 0 if hot else 1])[0].format(
            d=day, h=7 if hot else draw.randrange(24), m=draw.randrange(60), s=draw.randrange(60)
        )
        rows.append(
            action(
                session, time, user, date=day,
                page_id=n,
                search_keyword=draw.choice(WORDS),
                click_category_id=7 if hot else draw.choice([None, *range(15)]),
                order_category_ids=draw.choice(LISTS),
                pay_category_ids=draw.choice(LISTS),
            )
        )
    return rows


PEOPLE = [
    (1, 20, "a", "x", "male"), (2, 30, "b", "y", "female"), (3, None, "a", "z", "male"),
    (4, 40, None, "y", "male"), (5, 50, "b", "x", None),
]

PARAMS = [
    TaskParams(),
    TaskParams(start_date="2024-01-02", end_date="2024-01-03", sex=("male",)),
    TaskParams(start_age=20, end_age=40, keywords=("lamp", "a,b")),
    TaskParams(category_ids=("7", "3"), cities=("x", "y"), professionals=("a",)),
    TaskParams(sex=()),
]


def parse(text):
    for pattern in ("%Y-%m-%d %H:%M:%S",):
        try:
            return datetime.strptime(text, pattern)
        except (TypeError, ValueError):
            return None


def numbers(text):
    return [int(p) for p in (text or "").split(",") if p.isdigit()]


def expected(rows, params, taskid, seed, total, top_n, top_m):
    rows = [
        r for r in rows
        if r["session_id"] is not None
        and (params.start_date or "") <= r["date"] <= (params.end_date or "9")
    ]
    groups = defaultdict(list)
    for r in rows:
        groups[r["session_id"]].append(r)
    people = {p[0]: p[1:] for p in PEOPLE}
    chosen = {}
    for name, own in groups.items():
        ids = [r["user_id"] for r in own if r["user_id"] is not None]
        if not ids or min(ids) not in people:
            continue
        age, job_name, city, sex = people[min(ids)]
        keywords = {r["search_keyword"] for r in own} - {None, ""}
        clicked = sorted(r["click_category_id"] for r in own if r["click_category_id"] is not None)
        if params.start_age is not None and params.end_age is not None:
            if age is None or not params.start_age <= age <= params.end_age:
                continue
        choices = [
            (params.professionals, {job_name}), (params.cities, {city}), (params.sex, {sex}),
            (params.keywords, keywords), (params.category_ids, {str(c) for c in clicked}),
        ]
        if any(wanted is not None and not set(wanted) & have for wanted, have in choices):
            continue
        times = [t for t in (parse(r["action_time"]) for r in own) if t]
        chosen[name] = {
            "start": min(times, default=None),
            "visit_length": int((max(times) - min(times)).total_seconds()) if times else None,
            "step_length": len(own),
            "keywords": ",".join(sorted(keywords, key=str.encode)) or None,
            "clicked": ",".join(map(str, clicked)) or None,
        }

    def share(measure, low, high):
        hits = sum(
            s[measure] is not None and low <= s[measure] <= (high or 10**9) for s in chosen.values()
        )
        if not chosen:
            return None
        return int(Fraction(100 * hits, len(chosen)) + Fraction(1, 2)) / 100

    stat = (taskid, len(chosen), *(share(m, low, high) for m, _, low, high in BANDS))

    hours = Counter((s["start"].date(), s["start"].hour) for s in chosen.values() if s["start"])
    days = Counter()
    for (day, _), count in hours.items():
        days[day] += count
    drawn = []
    for (day, hour), count in hours.items():
        quota = min(int(count / days[day] * (total // len(days))), count)
        pool = [
            n for n, s in chosen.items()
            if s["start"] and (s["start"].date(), s["start"].hour) == (day, hour)
        ]
        pool.sort(key=lambda n: (hashlib.md5(f"{n}#{seed}".encode()).hexdigest(), n))
        drawn += pool[:quota]
    extract = [
        (taskid, n, str(chosen[n]["start"]), chosen[n]["keywords"], chosen[n]["clicked"])
        for n in drawn
    ]

    counts = defaultdict(lambda: [0, 0, 0])
    per_session = Counter()
    for name in chosen:
        for r in groups[name]:
            if r["click_category_id"] is not None:
                counts[r["click_category_id"]][0] += 1
                per_session[r["click_category_id"], name] += 1
            for c in numbers(r["order_category_ids"]):
                counts[c][1] += 1
            for c in numbers(r["pay_category_ids"]):
                counts[c][2] += 1
    ranked = sorted(counts.items(), key=lambda kv: ([-n for n in kv[1]], kv[0]))[:top_n]
    top = [(taskid, c, *n) for c, n in ranked]
    busiest = []
    for c, _ in ranked:
        own = [(-n, name) for (cat, name), n in per_session.items() if cat == c]
        busiest += [(taskid, c, name, -n) for n, name in sorted(own)[:top_m]]
    detail = [
        (taskid, r["user_id"], n, r["page_id"], r["action_time"], r["search_keyword"],
         *(r[c] for c in USER_VISIT_ACTION.fieldNames()[6:12]))
        for n in [*drawn, *(b[2] for b in busiest)] for r in groups[n]
    ]
    return {
        "session_aggr_stat": [stat], "session_random_extract": extract, "session_detail": detail,
        "top10_category": top, "top10_session": busiest,
    }


@pytest.mark.parametrize("case", range(len(PARAMS)))
def test_job_equals_plain_python(spark, tmp_path, case):
    rows = make_rows(case)
    sink = FileSink(str(tmp_path))
    settings = job.Settings(extract_total=60, top_categories=4, top_sessions=3, seed="z")
    tables = Tables(raw_actions(spark, rows), users(spark, *PEOPLE))
    job.run(spark, tables, 9, sink, PARAMS[case], settings)
    for table, wanted in expected(rows, PARAMS[case], 9, "z", 60, 4, 3).items():
        got = [tuple(r) for r in sink.read(spark, table).collect()]
        assert Counter(got) == Counter(wanted), table
