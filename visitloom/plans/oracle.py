"""The catalog's queries in plain SQL, written apart from the operators to check them."""

from __future__ import annotations

from visitloom.schemas import TASK_PARAM_FIELDS

ACTION_COLUMNS = """date, user_id, session_id, page_id, action_time, search_keyword,
    click_category_id, click_product_id, order_category_ids, order_product_ids,
    pay_category_ids, pay_product_ids, city_id"""

SESSION_COLUMNS = "session_id, user_id, start_time, end_time, step_length, visit_length"
USER_COLUMNS = "age, professional, city, sex"

ADAPTER = """
ev as (
    select *,
        cast(json_extract_string(props, '$.k') as bigint) as k,
        hour(ts) * 3600 + minute(ts) * 60 + cast(floor(second(ts)) as bigint) as sod,
        [3600, 600, 60, 1][1 + (user_id // 5) % 4] as dv,
        [1, 1, 1, 7, 30][1 + user_id % 5] as span
    from events
),
ev2 as (
    select *, cast(sod // dv as bigint) as sec from ev
),
all_actions as (
    select
        strftime(ts, '%Y-%m-%d') as date,
        case when user_id % 17 = 0 then user_id + 1000000000 else user_id end as user_id,
        'u' || user_id || '_' || ((day(ts) - 1) // span) as session_id,
        event_id % 10 as page_id,
        strftime(ts, '%Y-%m-%d') || ' ' || (sec // 3600) || ':'
            || lpad(cast(sec // 60 % 60 as varchar), 2, '0') || ':'
            || lpad(cast(sec % 60 as varchar), 2, '0') as action_time,
        case when event_type = 'view' then
            ['lamp', 'rug', 'mirror', 'bookshelf', 'clock',
             'desk lamp', 'vase', 'candle', 'pillow', 'curtain'][1 + k % 10] end as search_keyword,
        case when event_type = 'click' then k end as click_category_id,
        case when event_type = 'click' then event_id % 100 end as click_product_id,
        case when event_type = 'purchase' then
            case when event_id % 3 = 0 then k || ',' || ((7 * k + 1) % 100)
                 else cast(k as varchar) end end as order_category_ids,
        case when event_type = 'purchase' then cast(event_id % 100 as varchar) end
            as order_product_ids,
        case when event_type = 'signup' then
            case when event_id % 4 = 0 then k || ',' || ((3 * k + 2) % 100)
                 else cast(k as varchar) end end as pay_category_ids,
        case when event_type = 'signup' then cast(event_id % 100 as varchar) end
            as pay_product_ids,
        user_id % 10 as city_id,
        cast(cast(ts as date) as timestamp) + to_seconds(sec) as action_ts
    from ev2
),
users as (
    select c_custkey as user_id, 'user' || c_custkey as username, c_name as name,
        cast((c_custkey * 37) % 60 as integer) as age, c_mktsegment as professional,
        n_name as city, case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
    from customer join nation on c_nationkey = n_nationkey
),
tasks as (
    select o_orderkey as task_id, 'task' || o_orderkey as task_name,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as start_time,
        cast(null as varchar) as finish_time,
        o_orderpriority as task_type, o_orderstatus as task_status,
        '{"startDate":["2024-01-' || lpad(cast(o_orderkey % 10 + 1 as varchar), 2, '0') || '"]'
        || case when o_orderkey % 4 <> 0 then ',"endDate":["2024-01-'
                || lpad(cast(o_orderkey % 11 + 20 as varchar), 2, '0') || '"]' else '' end
        || case when o_orderkey % 2 = 0 then ',"startAge":["' || (o_orderkey % 30) || '"]'
                else '' end
        || case when o_orderkey % 3 = 0 then ',"endAge":["' || (o_orderkey % 30 + 25) || '"]'
                else '' end
        || case when o_orderkey % 5 = 0 then ',"keywords":["lamp,rug,pillow"]' else '' end
        || case when o_orderkey % 7 = 0 then ',"categoryIds":["' || (o_orderkey % 100) || ','
                || (o_orderkey % 13) || '"]' else '' end
        || case when o_orderkey % 6 = 0 then ',"sex":[]' else '' end
        || '}' as task_param
    from orders
)"""


def _sql(body: str, where: str = "true", sessions: str = "true") -> str:
    """Query over the adapted tables: date restriction of the actions, session restriction."""
    return f"""with {ADAPTER},
actions as (select * from all_actions where {where}),
rolled as (
    select session_id, min(user_id) as user_id, min(action_ts) as t0, max(action_ts) as t1,
        count(*) as step_length,
        cast(floor(epoch(max(action_ts)) - epoch(min(action_ts))) as bigint) as visit_length,
        strftime(min(action_ts), '%Y-%m-%d %H:%M:%S') as start_time,
        strftime(max(action_ts), '%Y-%m-%d %H:%M:%S') as end_time,
        list(distinct search_keyword) filter (search_keyword is not null) as keywords,
        list(click_category_id order by click_category_id)
            filter (click_category_id is not null) as clicked
    from actions group by session_id
),
chosen as (
    select rolled.*, age, professional, city, sex
    from rolled join users using (user_id)
    where {sessions}
),
events_of as (
    select session_id, 'click' as kind, click_category_id as category_id
    from actions where click_category_id is not null
    union all
    select session_id, 'order', cast(unnest(string_split(order_category_ids, ',')) as bigint)
    from actions where order_category_ids is not null
    union all
    select session_id, 'pay', cast(unnest(string_split(pay_category_ids, ',')) as bigint)
    from actions where pay_category_ids is not null
)
{body}"""


DATES = "date between '2024-01-03' and '2024-01-28'"
AGES = "age between 10 and 50"
KEYWORDS = "list_has_any(keywords, ['lamp', 'rug', 'pillow'])"
CLICKED = "list_has_any(clicked, [1, 3, 5, 26, 61, 96])"
SEGMENTS = "professional in ('BUILDING', 'MACHINERY')"
CITIES = "city in ('NATION_1', 'NATION_2', 'NATION_10', 'NATION_17')"

FILTERED = {"where": DATES, "sessions": AGES}

LISTS = """array_to_string(list_sort(keywords), ',') as search_keywords,
    array_to_string(clicked, ',') as click_category_ids"""

CATEGORY_COUNTS = """select category_id,
    cast(count(*) filter (kind = 'click') as bigint) as click_count,
    cast(count(*) filter (kind = 'order') as bigint) as order_count,
    cast(count(*) filter (kind = 'pay') as bigint) as pay_count
from events_of"""

OWN = "session_id in (select session_id from chosen)"

# Measure, band, first and last value that counts; written out apart from the engine's.
BANDS = (
    ("visit_length", "visit_length_1s_3s", 1, 3),
    ("visit_length", "visit_length_4s_6s", 4, 6),
    ("visit_length", "visit_length_7s_9s", 7, 9),
    ("visit_length", "visit_length_10s_30s", 10, 30),
    ("visit_length", "visit_length_30s_60s", 31, 60),
    ("visit_length", "visit_length_1m_3m", 61, 180),
    ("visit_length", "visit_length_3m_10m", 181, 600),
    ("visit_length", "visit_length_10m_30m", 601, 1800),
    ("visit_length", "visit_length_30m", 1801, None),
    ("step_length", "step_length_1_3", 1, 3),
    ("step_length", "step_length_4_6", 4, 6),
    ("step_length", "step_length_7_9", 7, 9),
    ("step_length", "step_length_10_30", 10, 30),
    ("step_length", "step_length_30_60", 31, 60),
    ("step_length", "step_length_60", 61, None),
)

BAND_COUNTS = "select count(*) as session_count, " + ", ".join(
    f"cast(count(*) filter ({measure} >= {low}"
    + (f" and {measure} <= {high}" if high is not None else "")
    + f") as bigint) as {band}"
    for measure, band, low, high in BANDS
)

AGGR_STAT = (
    f", counts as ({BAND_COUNTS} from chosen) select cast(1 as bigint) as taskid, session_count, "
    + ", ".join(
        f"cast((200 * {band} + session_count) // nullif(2 * session_count, 0) as double)"
        f" / cast(100 as double) as {band}_ratio"
        for _, band, _, _ in BANDS
    )
    + " from counts"
)

HOURS = """, hours as (
    select strftime(t0, '%Y-%m-%d') as date, cast(hour(t0) as integer) as hour,
        count(*) as session_count
    from chosen group by 1, 2
),
quotas as (
    select date, hour, session_count, day_count,
        least(cast(floor(cast(session_count as double) / cast(day_count as double) * per_day)
            as bigint), session_count) as quota
    from (
        select *, cast(sum(session_count) over (partition by date) as bigint) as day_count,
            100 // (select count(distinct date) from hours) as per_day
        from hours
    )
)"""

DRAWN = (
    HOURS
    + """, drawn as (
    select * from (
        select c.*, q.quota,
            row_number() over (
                partition by q.date, q.hour order by md5(session_id || '#7'), session_id
            ) as place
        from chosen c join quotas q
            on strftime(c.t0, '%Y-%m-%d') = q.date and hour(c.t0) = q.hour
    ) where place <= quota
)"""
)

RANDOM_EXTRACT = (
    DRAWN
    + f""" select cast(1 as bigint) as taskid, session_id as sessionid, start_time, {LISTS}
from drawn"""
)

DETAIL = """select cast(1 as bigint) as taskid, a.user_id as userid, a.session_id as sessionid,
    a.page_id as pageid, a.action_time, a.search_keyword, a.click_category_id,
    a.click_product_id, a.order_category_ids, a.order_product_ids, a.pay_category_ids,
    a.pay_product_ids
from actions a"""

TOP = f""", top as (
    {CATEGORY_COUNTS} where {OWN} group by category_id
    order by click_count desc, order_count desc, pay_count desc, category_id limit 10
),
counts as (
    select click_category_id as category_id, session_id, count(*) as click_count
    from actions
    where {OWN} and click_category_id in (select category_id from top)
    group by all
),
busiest as (
    select * from (
        select *, row_number() over (
            partition by category_id order by click_count desc, session_id) as place
        from counts
    ) where place <= 10
)"""

TOP_CATEGORY = (
    TOP
    + """ select cast(1 as bigint) as taskid, category_id as categoryid, click_count,
    order_count, pay_count from top"""
)

TOP_SESSION = (
    TOP
    + """ select cast(1 as bigint) as taskid, category_id as categoryid,
    session_id as sessionid, click_count from busiest"""
)

PACKED = """select 'sessionId=' || session_id
    || '|searchKeyWords=' || coalesce(array_to_string(list_sort(keywords), ','), '')
    || '|clickCategoryIds=' || coalesce(array_to_string(clicked, ','), '')
    || '|visitLength=' || visit_length || '|stepLength=' || step_length
    || '|startTime=' || start_time as packed
from rolled"""

CHOSEN = f"select {SESSION_COLUMNS}, {USER_COLUMNS} from chosen"




def _coded(value: str) -> str:
    """A value in packed text, its signs written as codes."""
    for sign, code in (("%", "%25"), ("|", "%7C"), ("=", "%3D"), (",", "%2C")):
        value = f"replace({value}, '{sign}', '{code}')"
    return f"coalesce({value}, '%00')"


ODD = """(
    select session_id, page_id, click_category_id as category,
        case page_id when 0 then null when 1 then '' when 2 then '%00' when 3 then '%7C'
            else session_id || '|' || action_time || '=%,' || coalesce(search_keyword, '') || '|=' end as odd,
        case page_id when 0 then null when 1 then [] when 2 then [''] when 3 then ['', null]
            else [search_keyword, 'a,' || session_id, '%01'] end as items
    from actions
)"""

# Damaged rows and what is wrong with them, by page.
DAMAGED = """, damaged as (
    select cast(page_id as varchar) as page_id, date as day, action_time as time,
        unnest(case page_id
            when 1 then [{'c': 'user_id', 'r': 'not a whole number', 'v': user_id || 'x'}]
            when 2 then [{'c': 'user_id', 'r': 'missing', 'v': ''}, {'c': 'session_id', 'r': 'missing', 'v': null}]
            when 3 then [{'c': 'action_time', 'r': 'not a time', 'v': replace(action_time, ' ', 'T')}]
            when 4 then [{'c': 'action_time', 'r': 'on another date',
                'v': strftime(cast(date as date) + interval 1 day, '%Y-%m-%d') || ' 1:00:00'}]
            when 5 then [{'c': 'date', 'r': 'not a date', 'v': replace(date, '-', '/')}]
            when 6 then case when click_category_id is null then []
                else [{'c': 'click_category_id', 'r': 'not a whole number', 'v': click_category_id || '.5'}] end
            when 7 then case when order_category_ids is null then []
                else [{'c': 'order_category_ids', 'r': 'not a list of whole numbers', 'v': order_category_ids || ',,'}] end
            else [] end, recursive := true)
    from actions
)"""
SOUND = """page_id in (0, 8, 9) or (page_id = 6 and click_category_id is null)
    or (page_id = 7 and order_category_ids is null)"""

TIMES = "session_id, page_id, date, action_time"
STAMP = "%Y-%m-%d %H:%M:%S"

ORACLE_SQL: dict[str, str] = {
    "scan_actions_by_date": _sql(f"select {ACTION_COLUMNS} from actions", where=DATES),
    "scan_user_info": _sql("select * from users"),
    "scan_product_info": """select p_partkey as product_id, p_name as product_name,
        '{"product_status": ' || (p_partkey % 2) || '}' as extend_info,
        cast(p_partkey % 2 as integer) as product_status from part""",
    "task_by_id": _sql("select * from tasks where task_id = 42"),
    "task_params": _sql(
        "select task_id, "
        + ", ".join(
            f"json_extract_string(task_param, '$.{name}[0]') as \"{name}\""
            for name in TASK_PARAM_FIELDS
        )
        + " from tasks"
    ),
    "session_rollup": _sql(f"select {SESSION_COLUMNS} from rolled"),
    "session_keywords": _sql(
        "select session_id, array_to_string(list_sort(keywords), ',') as search_keywords"
        " from rolled where keywords is not null"
    ),
    "session_click_categories": _sql(
        "select session_id, array_to_string(clicked, ',') as click_category_ids"
        " from rolled where clicked is not null"
    ),
    "session_list_entries": _sql("""
        select session_id, 'keyword' as kind, search_keyword as value, count(*) as n
        from actions where search_keyword is not null group by all
        union all
        select session_id, 'category', cast(click_category_id as varchar), count(*)
        from actions where click_category_id is not null group by all"""),
    "session_full_info": _sql(f"select {SESSION_COLUMNS}, {USER_COLUMNS}, {LISTS} from chosen"),
    "session_day_states": _sql(f"""
        select date, session_id, min(user_id) as user_id, strftime(min(action_ts), '{STAMP}') as first_ts,
            strftime(max(action_ts), '{STAMP}') as last_ts, count(*) as steps,
            coalesce(string_agg(distinct search_keyword, ',' order by search_keyword), '') as keywords,
            coalesce(any_value(clicks), '') as clicks
        from actions left join (
            select date, session_id, string_agg(category || ':' || n, ',' order by category) as clicks
            from (select date, session_id, click_category_id as category, count(*) as n
                from actions where click_category_id is not null group by all)
            group by all) using (date, session_id)
        group by date, session_id"""),
    "session_rollup_of_days": _sql(f"select {SESSION_COLUMNS} from rolled", where=DATES),
    "filter_sessions_of_days": _sql(
        CHOSEN, where=DATES, sessions=f"{AGES} and {KEYWORDS} and {CLICKED}"
    ),
    "session_records_of_months": _sql(
        f"select {SESSION_COLUMNS}, {USER_COLUMNS}, {LISTS} from chosen"
    ),
    "filter_age_between": _sql(CHOSEN, sessions=AGES),
    "filter_age_one_sided": _sql(CHOSEN),
    "filter_professional_in": _sql(CHOSEN, sessions=SEGMENTS),
    "filter_city_in": _sql(CHOSEN, sessions=CITIES),
    "filter_sex_in": _sql(CHOSEN, sessions="sex = 'male'"),
    "filter_keywords_any": _sql(CHOSEN, sessions=KEYWORDS),
    "filter_categories_any": _sql(CHOSEN, sessions=CLICKED),
    "filter_sessions": _sql(CHOSEN, where=DATES, sessions=f"{AGES} and {KEYWORDS}"),
    "filter_sessions_by_category": _sql(CHOSEN, where=DATES, sessions=f"{AGES} and {CLICKED}"),
    "filter_sessions_by_user": _sql(
        CHOSEN, where=DATES, sessions=f"{SEGMENTS} and {CITIES} and sex in ('male', 'female')"
    ),
    "filter_equal": _sql(CHOSEN, sessions="city = 'NATION_1'"),
    "session_detail_filtered": _sql(
        f"select {ACTION_COLUMNS} from actions where {OWN}", **FILTERED
    ),
    "session_band_counts": _sql(f"{BAND_COUNTS} from chosen"),
    "session_aggr_stat": _sql(AGGR_STAT),
    "session_aggr_stat_filtered": _sql(AGGR_STAT, **FILTERED),
    "sessions_per_hour": _sql(HOURS + " select date, hour, session_count from hours"),
    "sessions_per_day": _sql(
        "select strftime(t0, '%Y-%m-%d') as date, count(*) as session_count from chosen group by 1"
    ),
    "extract_quota_per_hour": _sql(
        HOURS + " select date, hour, session_count, day_count, quota from quotas"
    ),
    "session_random_extract": _sql(RANDOM_EXTRACT),
    "session_random_extract_filtered": _sql(RANDOM_EXTRACT, **FILTERED),
    "extract_session_detail": _sql(
        f"{DRAWN} {DETAIL} where session_id in (select session_id from drawn)"
    ),
    "category_click_count": _sql(
        "select click_category_id as category_id, count(*) as click_count"
        " from actions where click_category_id is not null group by 1"
    ),
    "category_order_count": _sql(
        "select category_id, count(*) as order_count from events_of"
        " where kind = 'order' group by 1"
    ),
    "category_pay_count": _sql(
        "select category_id, count(*) as pay_count from events_of where kind = 'pay' group by 1"
    ),
    "visited_categories": _sql("select distinct category_id from events_of"),
    "category_counts": _sql(f"{CATEGORY_COUNTS} group by category_id"),
    "category_counts_by_join": _sql("""
        select category_id, coalesce(c.n, 0) as click_count, coalesce(o.n, 0) as order_count,
            coalesce(p.n, 0) as pay_count
        from (select distinct category_id from events_of)
        left join (select category_id, count(*) as n from events_of
                   where kind = 'click' group by 1) c using (category_id)
        left join (select category_id, count(*) as n from events_of
                   where kind = 'order' group by 1) o using (category_id)
        left join (select category_id, count(*) as n from events_of
                   where kind = 'pay' group by 1) p using (category_id)"""),
    "categories_ranked": _sql(
        f"{CATEGORY_COUNTS} group by category_id"
        " order by click_count desc, order_count desc, pay_count desc, category_id"
    ),
    "session_category_activity": _sql(
        CATEGORY_COUNTS.replace("select ", "select session_id, ", 1)
        + f" where {OWN} group by session_id, category_id"
    ),
    "top10_category": _sql(TOP_CATEGORY),
    "top10_category_filtered": _sql(TOP_CATEGORY, **FILTERED),
    "explode_order_categories": _sql("""
        select session_id, action_time, page_id, order_category_ids,
            cast(unnest(string_split(order_category_ids, ',')) as bigint) as category_id
        from actions where order_category_ids is not null"""),
    "explode_pay_categories": _sql("""
        select session_id, action_time, page_id, pay_category_ids,
            cast(unnest(string_split(pay_category_ids, ',')) as bigint) as category_id
        from actions where pay_category_ids is not null"""),
    "session_category_clicks": _sql(
        "select session_id, click_category_id as category_id, count(*) as click_count"
        " from actions where click_category_id is not null group by all"
    ),
    "top_category_session_counts": _sql(
        TOP + " select category_id, session_id, click_count from counts"
    ),
    "top10_session": _sql(TOP_SESSION),
    "top10_session_filtered": _sql(TOP_SESSION, **FILTERED),
    "top10_session_detail": _sql(f"{TOP} {DETAIL} join busiest using (session_id)"),
    "parse_action_times": _sql(f"""
        select session_id, page_id, date, action_time,
            case when regexp_full_match(action_time,
                    '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}')
                then strftime(try_strptime(action_time, '{STAMP}'), '{STAMP}') end as parsed
        from (
            select session_id, page_id, date,
                case page_id when 0 then date when 1 then 'at ' || action_time
                    when 2 then action_time || 'Z' when 3 then action_time || '+08:00'
                    when 4 then action_time || '.5xyz' when 5 then action_time || ' '
                    when 6 then replace(action_time, ' ', 'T')
                    when 7 then replace(action_time, '-0', '-')
                    else action_time end as action_time
            from actions
        )"""),
    "time_keys": _sql(f"""
        select session_id, page_id, action_time, strftime(action_ts, '%Y-%m-%d') as date,
            strftime(action_ts, '{STAMP}') as time, strftime(action_ts, '%Y%m%d') as date_key,
            strftime(action_ts, '%Y%m%d%H%M') as minute_key,
            strftime(action_ts, '%Y-%m-%d_%H') as date_hour
        from actions"""),
    "parse_date_keys": _sql("""
        select session_id, page_id,
            case when page_id = 0 then date else strftime(action_ts, '%Y%m%d') end as date_key,
            case when page_id <> 0 then strftime(action_ts, '%Y-%m-%d') end as parsed
        from actions"""),
    "elapsed_seconds": _sql(f"""
        select {TIMES},
            case when page_id = 0 then date else date || ' 0:30:00' end as other_time,
            page_id <> 0 and action_ts < noon as is_before,
            page_id <> 0 and action_ts > noon as is_after,
            case when page_id = 0 then 0
                else cast(floor(epoch(action_ts) - epoch(noon)) as bigint) end as elapsed
        from (select *, cast(date || ' 00:30:00' as timestamp) as noon from actions)"""),
    "kv_pack": _sql(PACKED),
    "kv_unpack": _sql(f"""
        select packed, {", ".join(
            f"(list_filter(list_transform(string_split(packed, '|'), "
            f"lambda p: string_split(p, '=')), "
            f"lambda p: len(p) = 2 and p[1] = '{field}' and p[2] <> '')[1])[2] as {name}"
            for field, name in (
                ("sessionId", "session_id"), ("searchKeyWords", "search_keywords"),
                ("clickCategoryIds", "click_category_ids"), ("visitLength", "visit_length"),
                ("stepLength", "step_length"), ("startTime", "start_time"),
            )
        )}
        from ({PACKED})"""),
    "kv_set": _sql(
        "select regexp_replace(packed, 'stepLength=[0-9]+', 'stepLength=0') as packed"
        f" from ({PACKED})"
    ),
    "kv_pack_exact": _sql(f"""
        select session_id, page_id, 'sessionId=' || {_coded("session_id")} || '|odd=' || {_coded("odd")}
            || '|list=' || case when items is null then '%02' when items = [''] then '%01'
                else coalesce(array_to_string(list_transform(items, lambda x: {_coded("x")}), ','), '') end
            || '|category=' || {_coded("cast(category as varchar)")} as packed
        from {ODD}"""),
    "kv_unpack_exact": _sql(f"""
        select session_id, page_id, odd,
            array_to_string(list_transform(items, lambda x: coalesce(x, '<null>')), '; ') as items,
            cast(category as varchar) as category, cast(null as varchar) as not_there
        from {ODD}"""),
    "reject_counts": _sql(f"""{DAMAGED}
        select c as "column", r as reason, count(*) as row_count from damaged group by all
        union all
        select '', case when {SOUND} then 'none' else 'any' end, count(*) from actions group by all"""),
    "rejected_actions": _sql(
        f"""{DAMAGED} select c as "column", r as reason, v as value, page_id from damaged"""
    ),
    "accepted_actions": _sql(f"select {ACTION_COLUMNS} from actions where {SOUND}"),
    "clean_lists": _sql("""
        select session_id, page_id,
            case when pay_category_ids is not null
                then coalesce(order_category_ids, '') || ',' || pay_category_ids
                when page_id % 2 = 0 then '' else '1,2,' end as ids
        from actions"""),
}
