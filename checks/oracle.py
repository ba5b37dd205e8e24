"""DuckDB SQL for the registered queries.

Written in the direct form (one row per event, windows per run, a look into the
past per run) rather than the form the Spark operators use, so that the two
agree only if both are right.
"""

from __future__ import annotations

# The test table `events` as clickstream events.
EV = """ev AS (
  SELECT ts AS "timestamp",
    'sdk_' || (user_id % 3) AS sdk_key,
    'c' || user_id AS client_id,
    's' || (user_id % 5) AS session_id,
    CASE event_type WHEN 'click' THEN 'auto_click' WHEN 'view' THEN 'page_view'
      ELSE event_type END AS event_name,
    CASE WHEN k % 10 = 0 THEN '' ELSE '/p' || (k % 10) END AS page_path,
    CASE WHEN k % 6 = 0 THEN '' ELSE 'btn' || (k % 6) END AS target_text,
    CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'female'
      ELSE 'male' END AS user_gender,
    CAST(CASE WHEN user_id % 11 = 0 THEN NULL ELSE 5 + (user_id * 7) % 70 END AS INTEGER)
      AS user_age,
    CASE user_id % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'search' WHEN 2 THEN 'social'
      ELSE 'ad' END AS traffic_source,
    CASE WHEN user_id % 13 = 0 THEN '' WHEN user_id % 2 = 0 THEN 'mobile'
      ELSE 'desktop' END AS device_type,
    value AS time_on_page_seconds,
    event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

B10 = "time_bucket(INTERVAL '10 minutes', \"timestamp\")"
SEOUL = "CAST(timezone('Asia/Seoul', timezone('UTC', \"timestamp\")) AS DATE)"
AGE = """CASE WHEN user_age BETWEEN 10 AND 19 THEN '10s' WHEN user_age BETWEEN 20 AND 29 THEN '20s'
  WHEN user_age BETWEEN 30 AND 39 THEN '30s' WHEN user_age BETWEEN 40 AND 49 THEN '40s'
  WHEN user_age BETWEEN 50 AND 59 THEN '50s' WHEN user_age >= 60 THEN '60s+'
  ELSE 'unknown' END"""


def week(day: str) -> str:
    start = "DATE '2024-01-01'"
    return f"CAST({start} + CAST(({day} - {start}) // 7 * 7 AS INTEGER) AS DATE)"


def half_even(x: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"round_even(({x}) * {scale}, 0) / {scale}"


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join([EV, *ctes]) + "\n" + select


# Metrics: the session length of a run, and whether a visitor had come before it.


def minutes_metrics(run: str, name: str = "m1", bucket: str = B10, key: str = "date_time") -> list[str]:
    return [
        f"""{name}_run AS (
  SELECT *, {run} AS run FROM ev)""",
        f"""{name}_e AS (
  SELECT *, date_diff('second',
      min("timestamp") OVER (PARTITION BY run, client_id, sdk_key),
      max("timestamp") OVER (PARTITION BY run, client_id, sdk_key)) AS session_duration,
    EXISTS (SELECT 1 FROM ev p WHERE p.client_id = {name}_run.client_id
      AND p.sdk_key = {name}_run.sdk_key AND p."timestamp" < {name}_run.run) AS came_before
  FROM {name}_run)""",
        f"""{name} AS (
  SELECT {bucket} AS {key},
    count(*) FILTER (event_name = 'auto_click') AS clicks,
    count(DISTINCT client_id) AS visitors,
    count(DISTINCT CASE WHEN NOT came_before THEN client_id END) AS new_visitors,
    count(DISTINCT CASE WHEN came_before THEN client_id END) AS existing_visitors,
    coalesce(CAST(trunc(avg(session_duration) FILTER (session_duration > 0)) AS BIGINT), 0)
      AS avg_session_seconds,
    sdk_key
  FROM {name}_e GROUP BY ALL)""",
    ]


def roll_metrics(name: str, lower: str, period: str, key: str) -> str:
    return f"""{name} AS (
  SELECT p AS {key}, CAST(sum(clicks) AS BIGINT) AS clicks,
    CAST(sum(visitors) AS BIGINT) AS visitors,
    CAST(sum(new_visitors) AS BIGINT) AS new_visitors,
    CAST(sum(existing_visitors) AS BIGINT) AS existing_visitors,
    CAST(trunc(avg(avg_session_seconds)) AS BIGINT) AS avg_session_seconds, sdk_key
  FROM (SELECT *, {period} AS p FROM {lower}) GROUP BY p, sdk_key)"""


M1 = minutes_metrics(B10)
H1 = [*M1, roll_metrics("h1", "m1", "date_trunc('hour', date_time)", "date_time")]
D1 = [*H1, roll_metrics("d1", "h1", "CAST(date_time AS DATE)", '"date"')]
W1 = [*D1, roll_metrics("w1", "d1", week('"date"'), '"date"')]

# Pages.

PV = f"""pv AS (
  SELECT *, {B10} AS date_time,
    lead(page_path) OVER (PARTITION BY {B10}, session_id ORDER BY "timestamp", event_id)
      AS next_page
  FROM ev WHERE page_path <> '')"""

# Without event_id, views at one moment follow each other by what else they hold.
PV_NO_ID = PV.replace("event_id)", "page_path, sdk_key, time_on_page_seconds NULLS FIRST)")


def mean(x: str) -> str:
    """A mean whose last digits do not depend on the order rows are added in: whole
    1024ths and what is left of them are each added up without loss."""
    units = f"({x}) * 1024"
    return f"(sum(floor({units})) + sum({units} - floor({units}))) / 1024 / count({x})"


M2 = [
    PV,
    f"""m2_moves AS (
  SELECT date_time, page_path, sdk_key, next_page AS "to", count(*) AS n
  FROM pv WHERE next_page IS NOT NULL GROUP BY ALL)""",
    """m2_lists AS (
  SELECT date_time, page_path, sdk_key, string_agg("to", '|' ORDER BY n DESC, "to") AS next_to,
    string_agg(CAST(n AS VARCHAR), '|' ORDER BY n DESC, "to") AS next_count
  FROM m2_moves GROUP BY ALL)""",
    f"""m2_sums AS (
  SELECT date_time, page_path, sdk_key, count(*) AS page_views,
    count(*) FILTER (next_page IS NULL) AS page_exits,
    {half_even(mean("time_on_page_seconds"), 2)}
      AS avg_time_on_page_seconds
  FROM pv GROUP BY ALL)""",
    f"""m2 AS (
  SELECT date_time, page_path, page_views, page_exits,
    {half_even("page_exits / page_views", 3)} AS drop_rate,
    coalesce(next_to, '') AS next_to, coalesce(next_count, '') AS next_count,
    avg_time_on_page_seconds, sdk_key
  FROM m2_sums LEFT JOIN m2_lists USING (date_time, page_path, sdk_key))""",
]


def roll_pages(name: str, lower: str, lower_key: str, period: str, key: str) -> str:
    return f"""{name} AS (
  SELECT *, {half_even("page_exits / page_views", 3)} AS drop_rate FROM (
    SELECT p AS {key}, page_path, CAST(sum(page_views) AS BIGINT) AS page_views,
      CAST(sum(page_exits) AS BIGINT) AS page_exits,
      arg_min(next_to, {lower_key}) AS next_to, arg_min(next_count, {lower_key}) AS next_count,
      {half_even(mean("avg_time_on_page_seconds"), 2)}
        AS avg_time_on_page_seconds, sdk_key
    FROM (SELECT *, {period} AS p FROM {lower}) GROUP BY p, page_path, sdk_key))"""


H2 = [*M2, roll_pages("h2", "m2", "date_time", "date_trunc('hour', date_time)", "date_time")]
D2 = [*H2, roll_pages("d2", "h2", "date_time", "CAST(date_time AS DATE)", '"date"')]
W2 = [*D2, roll_pages("w2", "d2", '"date"', week('"date"'), '"date"')]


def merged(period: str, key: str) -> str:
    """Lists added up over a longer period, straight from the ten-minute moves."""
    return with_(
        M2,
        f"""SELECT a.{key}, a.page_path, a.sdk_key, coalesce(next_to, '') AS next_to,
  coalesce(next_count, '') AS next_count
FROM (SELECT DISTINCT {period} AS {key}, page_path, sdk_key FROM m2) a LEFT JOIN (
  SELECT {key}, page_path, sdk_key, string_agg("to", '|' ORDER BY n DESC, "to") AS next_to,
    string_agg(CAST(n AS VARCHAR), '|' ORDER BY n DESC, "to") AS next_count
  FROM (SELECT {period} AS {key}, page_path, sdk_key, "to", CAST(sum(n) AS BIGINT) AS n
    FROM m2_moves GROUP BY ALL) GROUP BY ALL) b
ON a.{key} = b.{key} AND a.page_path = b.page_path AND a.sdk_key = b.sdk_key""",
    )


def page_rows(ctes: list[str], name: str, key: str) -> str:
    return with_(
        ctes,
        f"""SELECT {key}, page_path, page_views, page_exits, drop_rate, avg_time_on_page_seconds,
  sdk_key FROM {name}""",
    )


def page_lists(ctes: list[str], name: str, key: str, columns: str = "next_to, next_count") -> str:
    return with_(ctes, f"SELECT {key}, page_path, sdk_key, {columns} FROM {name}")


# Users: one pass per segment type, put together.

SEGMENTS = [
    ("user_gender", "user_gender"),
    ("traffic_source", "traffic_source"),
    ("device_type", "device_type"),
    ("user_age", AGE),
]


def segmented(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{name}' AS segment_type, {value} AS segment_value FROM {source}"
        f" WHERE {value} IS NOT NULL"
        for name, value in SEGMENTS
    )


def clicks(period: str, key: str, where: str = "TRUE") -> list[str]:
    return [
        f"""clicks AS (
  SELECT *, {period} AS {key} FROM ev WHERE event_name = 'auto_click' AND {where})""",
        f"seg AS ({segmented('clicks')})",
    ]


def summary(name: str, key: str) -> str:
    ratio = half_even("count(*) / count(DISTINCT client_id)", 1)
    return f"""{name} AS (
  SELECT {key}, segment_type, segment_value, count(*) AS total_clicks,
    count(DISTINCT client_id) AS total_users, {ratio} AS avg_clicks_per_user, sdk_key
  FROM seg GROUP BY {key}, segment_type, segment_value, sdk_key)"""


def ranked(name: str, source: str, key: str) -> str:
    return f"""{name} AS (
  SELECT {key}, segment_type, segment_value, element, total_clicks, user_count, "rank", sdk_key
  FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY {key}, segment_type, segment_value, sdk_key
      ORDER BY total_clicks DESC, element) AS INTEGER) AS "rank" FROM {source})
  WHERE "rank" <= 3)"""


def top(name: str, key: str) -> list[str]:
    return [
        f"""{name}_sums AS (
  SELECT {key}, segment_type, segment_value, target_text AS element, count(*) AS total_clicks,
    count(DISTINCT client_id) AS user_count, sdk_key
  FROM seg WHERE length(target_text) > 0
  GROUP BY {key}, segment_type, segment_value, target_text, sdk_key)""",
        ranked(name, f"{name}_sums", key),
    ]


def distribution(name: str, key: str) -> str:
    one = f"""SELECT {key}, segment_type, segment_value, '%s' AS dist_type, %s AS dist_value,
    count(DISTINCT client_id) AS user_count, sdk_key
  FROM seg WHERE %s GROUP BY ALL"""
    age = one % ("ageGroup", AGE, "user_age IS NOT NULL")
    device = one % ("device", "device_type", "length(device_type) > 0")
    return f"{name} AS (\n  {age}\n  UNION ALL {device})"


def roll_summary(name: str, lower: str, period: str, key: str) -> str:
    return f"""{name} AS (
  SELECT p AS {key}, segment_type, segment_value, CAST(sum(total_clicks) AS BIGINT) AS total_clicks,
    CAST(sum(total_users) AS BIGINT) AS total_users,
    {half_even("sum(total_clicks) / sum(total_users)", 1)} AS avg_clicks_per_user, sdk_key
  FROM (SELECT *, {period} AS p FROM {lower}) GROUP BY p, segment_type, segment_value, sdk_key)"""


def roll_top(name: str, lower: str, period: str, key: str) -> list[str]:
    return [
        f"""{name}_sums AS (
  SELECT p AS {key}, segment_type, segment_value, element,
    CAST(sum(total_clicks) AS BIGINT) AS total_clicks,
    CAST(sum(user_count) AS BIGINT) AS user_count, sdk_key
  FROM (SELECT *, {period} AS p FROM {lower})
  GROUP BY p, segment_type, segment_value, element, sdk_key)""",
        ranked(name, f"{name}_sums", key),
    ]


def roll_distribution(name: str, lower: str, period: str, key: str) -> str:
    return f"""{name} AS (
  SELECT p AS {key}, segment_type, segment_value, dist_type, dist_value,
    CAST(sum(user_count) AS BIGINT) AS user_count, sdk_key
  FROM (SELECT *, {period} AS p FROM {lower})
  GROUP BY p, segment_type, segment_value, dist_type, dist_value, sdk_key)"""


# Ten-minute runs closed at both ends: a click at a run's end counts in it as well.
CLOSED_RUNS = [
    f"""clicks AS (
  SELECT *, {B10} AS date_time, {B10} AS run FROM ev WHERE event_name = 'auto_click'
  UNION ALL SELECT *, {B10}, {B10} - INTERVAL 10 MINUTES FROM ev
  WHERE event_name = 'auto_click' AND "timestamp" = {B10})""",
    f"seg AS ({segmented('clicks')})",
]
MIN = clicks(B10, "date_time")
DAY = clicks(SEOUL, '"date"')
HOUR = "date_trunc('hour', date_time)"
WEEK = week('"date"')
M3 = [*MIN, summary("m3", "date_time")]
M4 = [*MIN, *top("m4", "date_time")]
M5 = [*MIN, distribution("m5", "date_time")]
D3 = [*DAY, summary("d3", '"date"')]
D4 = [*DAY, *top("d4", '"date"')]
D5 = [*DAY, distribution("d5", '"date"')]


def rows(ctes: list[str], name: str) -> str:
    return with_(ctes, f"SELECT * FROM {name}")


def rows_without_run(ctes: list[str], name: str) -> str:
    return with_(ctes, f"SELECT * EXCLUDE (run) FROM {name}")


def events_where(columns: str, where: str) -> str:
    return with_([], f"SELECT {columns} FROM ev WHERE {where}")


def counted(key: str, name: str) -> str:
    return with_([], f"SELECT {key} AS {name}, count(*) AS events FROM ev GROUP BY ALL")


FORTNIGHT = "\"timestamp\" >= TIMESTAMP '2024-01-08' AND \"timestamp\" < TIMESTAMP '2024-01-22'"


def moves(period: str, key: str) -> str:
    """Transitions of a longer period, straight from the page views."""
    return with_(
        [PV],
        f"""SELECT {period} AS {key}, page_path, sdk_key, next_page, count(*) AS to_count
FROM pv GROUP BY ALL""",
    )


def _direct() -> dict[str, str]:
    session = [
        f"""run AS (SELECT *, {B10} AS date_time FROM ev)""",
        """sessions AS (
  SELECT DISTINCT date_time, sdk_key, client_id, date_diff('second',
    min("timestamp") OVER (PARTITION BY date_time, client_id, sdk_key),
    max("timestamp") OVER (PARTITION BY date_time, client_id, sdk_key)) AS session_duration
  FROM run)""",
    ]
    last_day = '(SELECT CAST(max(CAST("timestamp" AS DATE)) AS TIMESTAMP) FROM ev)'
    first_seen = with_(
        [], 'SELECT client_id, sdk_key, min("timestamp") AS first_seen FROM ev GROUP BY ALL'
    )
    new_vs_existing = with_(
        [
            f"""e AS (SELECT * FROM ev WHERE "timestamp" >= {last_day})""",
            f"""past AS (SELECT DISTINCT client_id, sdk_key FROM ev WHERE "timestamp" < {last_day})""",
        ],
        """SELECT time_bucket(INTERVAL '10 minutes', e."timestamp") AS date_time, e.sdk_key,
  count(DISTINCT e.client_id) AS visitors,
  count(DISTINCT CASE WHEN past.client_id IS NULL THEN e.client_id END) AS new_visitors,
  count(DISTINCT CASE WHEN past.client_id IS NOT NULL THEN e.client_id END) AS existing_visitors
FROM e LEFT JOIN past ON e.client_id = past.client_id AND e.sdk_key = past.sdk_key
GROUP BY ALL""",
    )
    day_run = 'CAST(CAST("timestamp" AS DATE) AS TIMESTAMP)'
    exact = minutes_metrics(day_run, "x1", 'CAST("timestamp" AS DATE)', '"date"')
    last = '(SELECT max(CAST("timestamp" AS DATE)) FROM ev)'
    # The segment tables of a day are in report days, one more than base days may be.
    complete = f'WHERE "date" + 6 <= {last}'
    closed_day = (
        f"timezone('Asia/Seoul', timezone('UTC', \"timestamp\")) <= CAST({SEOUL} AS TIMESTAMP)"
        " + INTERVAL 86399 SECONDS"
    )
    next_rows = "event_id, date_time, session_id, sdk_key, page_path, next_page"
    m2 = page_rows(M2, "m2", "date_time")
    m2_lists = page_lists(M2, "m2", "date_time")
    return {
        "scan_events_range": events_where("*", FORTNIGHT),
        "sink_roundtrip": rows(H1, "h1"),
        "sink_overwrite_partition": rows(D1, "d1"),
        "filter_half_open": events_where('event_id, "timestamp"', FORTNIGHT),
        "filter_closed": events_where(
            'event_id, "timestamp"',
            "\"timestamp\" BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-22'",
        ),
        "filter_clicks": events_where("event_id, event_name", "event_name = 'auto_click'"),
        "filter_nonempty": events_where(
            "event_id, page_path, target_text", "page_path <> '' AND length(target_text) > 0"
        ),
        "filter_not_null": events_where(
            "event_id, user_age", "user_age IS NOT NULL AND user_gender IS NULL"
        ),
        "segments_long": with_(
            [f"seg AS ({segmented('ev')})"], "SELECT event_id, segment_type, segment_value FROM seg"
        ),
        "new_vs_existing_join": new_vs_existing,
        "new_vs_existing_state": new_vs_existing,
        "first_seen": first_seen,
        "first_seen_state": first_seen,
        "agg_count": with_([], "SELECT sdk_key, event_name, count(*) AS n FROM ev GROUP BY ALL"),
        "agg_count_if": with_(
            [],
            """SELECT sdk_key, CAST("timestamp" AS DATE) AS "date",
  count(*) FILTER (event_name = 'auto_click') AS clicks FROM ev GROUP BY ALL""",
        ),
        "agg_count_distinct": with_(
            [],
            "SELECT sdk_key, page_path, count(DISTINCT client_id) AS clients FROM ev GROUP BY ALL",
        ),
        "agg_count_distinct_if": with_(
            [],
            """SELECT "date", sdk_key, count(DISTINCT CASE WHEN clicked THEN client_id END) AS clickers,
  count(DISTINCT CASE WHEN NOT clicked THEN client_id END) AS others
FROM (SELECT *, CAST("timestamp" AS DATE) AS "date", bool_or(event_name = 'auto_click')
  OVER (PARTITION BY CAST("timestamp" AS DATE), sdk_key, client_id) AS clicked FROM ev)
GROUP BY ALL""",
        ),
        "agg_avg_of_avg": with_(H1, "SELECT date_time, sdk_key, avg_session_seconds FROM h1"),
        "agg_avg_if": with_(
            session,
            """SELECT CAST(date_time AS DATE) AS "date", sdk_key, coalesce(CAST(trunc(
  avg(session_duration) FILTER (session_duration > 0)) AS BIGINT), 0) AS avg_session_seconds
FROM sessions GROUP BY ALL""",
        ),
        "agg_any": page_lists(H2, "h2", "date_time"),
        "agg_collect": page_lists(M2, "m2", "date_time", "next_to"),
        "session_duration": rows(session, "sessions"),
        "next_page": with_([PV], f"SELECT {next_rows} FROM pv"),
        "page_exits": with_(
            [PV],
            """SELECT event_id, date_time, page_path,
  CAST(CASE WHEN next_page IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_exit FROM pv""",
        ),
        "page_transitions": with_(
            [PV],
            """SELECT date_time, page_path, sdk_key, next_page, count(*) AS to_count
FROM pv GROUP BY ALL""",
        ),
        "hourly_page_transitions": moves("date_trunc('hour', date_time)", "date_time"),
        "daily_page_transitions": moves("CAST(date_time AS DATE)", '"date"'),
        "weekly_page_transitions": moves(week("CAST(date_time AS DATE)"), '"date"'),
        "page_stats_sliced_sessions": m2,
        "fn_ten_minutes": counted(B10, "date_time"),
        "fn_hour": counted("date_trunc('hour', \"timestamp\")", "date_time"),
        "fn_date": counted('CAST("timestamp" AS DATE)', '"date"'),
        "fn_seoul_date": counted(SEOUL, '"date"'),
        "filter_seoul_day": events_where('event_id, "timestamp"', f"{SEOUL} = DATE '2024-01-15'"),
        "fn_age_band": counted(AGE, "age_band"),
        "fn_round_half_even": with_(
            [],
            f"""SELECT event_id, {half_even("time_on_page_seconds / 4", 1)} AS one_digit,
  {half_even("time_on_page_seconds / 8", 2)} AS two_digits FROM ev""",
        ),
        "fn_safe_ratio": with_(
            [],
            """SELECT sdk_key, page_path, event_name,
  count(*) / nullif(count(*) FILTER (event_name = 'auto_click'), 0) AS ratio
FROM ev GROUP BY ALL""",
        ),
        "fn_nested_fields": with_(
            M2, 'SELECT date_time, page_path, sdk_key, "to", n AS "count" FROM m2_moves'
        ),
        "minutes_metrics": rows(M1, "m1"),
        "minutes_metrics_hour_run": rows(minutes_metrics("date_trunc('hour', \"timestamp\")"), "m1"),
        "minutes_metrics_day_run": rows(minutes_metrics(day_run), "m1"),
        "minutes_page_stats": m2,
        "minutes_page_stats_next": m2_lists,
        "minutes_click_summary": rows(M3, "m3"),
        "minutes_top_elements": rows(M4, "m4"),
        "minutes_user_distribution": rows(M5, "m5"),
        "minutes_click_summary_closed": rows_without_run(
            [*CLOSED_RUNS, summary("c3", "run, date_time")], "c3"
        ),
        "minutes_top_elements_closed": rows_without_run(
            [*CLOSED_RUNS, *top("c4", "run, date_time")], "c4"
        ),
        "minutes_user_distribution_closed": rows_without_run(
            [*CLOSED_RUNS, distribution("c5", "run, date_time")], "c5"
        ),
        "hourly_metrics": rows(H1, "h1"),
        "hourly_page_stats": page_rows(H2, "h2", "date_time"),
        "hourly_page_stats_next": page_lists(H2, "h2", "date_time"),
        "hourly_page_stats_merged": merged(HOUR, "date_time"),
        "hourly_click_summary": rows([*M3, roll_summary("h3", "m3", HOUR, "date_time")], "h3"),
        "hourly_click_summary_closed": rows(
            [
                *CLOSED_RUNS,
                summary("c3", "run, date_time"),
                roll_summary("h3", "c3", HOUR, "date_time"),
            ],
            "h3",
        ),
        "hourly_top_elements": rows([*M4, *roll_top("h4", "m4", HOUR, "date_time")], "h4"),
        "hourly_user_distribution": rows(
            [*M5, roll_distribution("h5", "m5", HOUR, "date_time")], "h5"
        ),
        "daily_metrics": rows(D1, "d1"),
        "daily_metrics_exact": rows(exact, "x1"),
        "daily_visitors_exact": with_(
            [],
            """SELECT CAST("timestamp" AS DATE) AS "date", sdk_key,
  count(DISTINCT client_id) AS visitors FROM ev GROUP BY ALL""",
        ),
        "weekly_visitors_exact": with_(
            [],
            f"""SELECT {week('CAST("timestamp" AS DATE)')} AS "date", sdk_key,
  count(DISTINCT client_id) AS visitors FROM ev GROUP BY ALL""",
        ),
        "daily_page_stats": page_rows(D2, "d2", '"date"'),
        "daily_page_stats_next": page_lists(D2, "d2", '"date"'),
        "daily_page_stats_merged": merged("CAST(date_time AS DATE)", '"date"'),
        "daily_click_summary": rows(D3, "d3"),
        "daily_click_summary_closed": rows(
            [*clicks(SEOUL, '"date"', closed_day), summary("d3", '"date"')], "d3"
        ),
        "daily_top_elements": rows(D4, "d4"),
        "daily_user_distribution": rows(D5, "d5"),
        "weekly_metrics": rows(W1, "w1"),
        "weekly_page_stats": page_rows(W2, "w2", '"date"'),
        "weekly_page_stats_next": page_lists(W2, "w2", '"date"'),
        "weekly_page_stats_merged": merged(week("CAST(date_time AS DATE)"), '"date"'),
        "weekly_click_summary": rows([*D3, roll_summary("w3", "d3", WEEK, '"date"')], "w3"),
        "weekly_top_elements": rows([*D4, *roll_top("w4", "d4", WEEK, '"date"')], "w4"),
        "weekly_user_distribution": rows([*D5, roll_distribution("w5", "d5", WEEK, '"date"')], "w5"),
        "run_periods": with_(
            [
                """at_ AS (SELECT DISTINCT "timestamp" AS t, date_trunc('day', "timestamp") AS d,
  date_trunc('hour', "timestamp") AS h FROM ev)""",
                """m_ AS (SELECT *, h + to_minutes(CAST(date_part('minute', t) // 10 * 10 AS INTEGER)) AS m FROM at_)""",
            ],
            """SELECT t AS started, unnest(['minutes', 'hourly', 'daily', 'weekly', 'backfill', 'backfill_weeks']) AS run,
  unnest([m - INTERVAL 10 MINUTES, h - INTERVAL 1 HOUR, d - INTERVAL 1 DAY, d - INTERVAL 7 DAYS,
    d - INTERVAL 10 DAYS, d - INTERVAL 10 DAYS]) AS first,
  unnest([m, h, d, d, d + INTERVAL 1 DAY, d - INTERVAL 3 DAYS]) AS end_before FROM m_""",
        ),
        "backfill_daily_metrics": rows(D1, "d1"),
        "backfill_daily_page_stats": page_rows(D2, "d2", '"date"'),
        # The last day of the report zone is not over when the data ends.
        "backfill_daily_click_summary": with_(D3, f'SELECT * FROM d3 WHERE "date" <= {last}'),
        "backfill_daily_top_elements": with_(D4, f'SELECT * FROM d4 WHERE "date" <= {last}'),
        "backfill_daily_user_distribution": with_(D5, f'SELECT * FROM d5 WHERE "date" <= {last}'),
        "backfill_weekly_metrics": with_(W1, f"SELECT * FROM w1 {complete}"),
        "backfill_weekly_page_stats": with_(
            W2, f"SELECT * EXCLUDE (next_to, next_count) FROM w2 {complete}"
        ),
        "backfill_weekly_click_summary": with_(
            [*D3, roll_summary("w3", "d3", WEEK, '"date"')], f"SELECT * FROM w3 {complete}"
        ),
        "backfill_weekly_top_elements": with_(
            [*D4, *roll_top("w4", "d4", WEEK, '"date"')], f"SELECT * FROM w4 {complete}"
        ),
        "backfill_weekly_user_distribution": with_(
            [*D5, roll_distribution("w5", "d5", WEEK, '"date"')], f"SELECT * FROM w5 {complete}"
        ),
        "sink_narrow_runs": rows(M3, "m3"),
        "minutes_page_stats_no_event_id": page_rows([PV_NO_ID, *M2[1:]], "m2", "date_time"),
        "stream_minutes_metrics": rows(M1, "m1"),
        "stream_minutes_page_stats": m2,
        "stream_minutes_click_summary": rows(M3, "m3"),
        "stream_minutes_top_elements": rows(M4, "m4"),
        "stream_minutes_user_distribution": rows(M5, "m5"),
        "stream_into_backfilled_store": rows(M1, "m1"),
        "stream_restarted": rows(M1, "m1"),
        "stream_files_given_twice": rows(M1, "m1"),
        "stream_clicks_10m": with_(
            [],
            f"""SELECT {B10} AS date_time, sdk_key,
  count(*) FILTER (event_name = 'auto_click') AS clicks FROM ev GROUP BY ALL""",
        ),
    }


# Tables that streams and late files have made are those of a backfill, or of the rollups.
SAME = {
    "refreshed_hourly_metrics": "hourly_metrics",
    "refreshed_hourly_page_stats": "hourly_page_stats",
    "refreshed_hourly_top_elements": "hourly_top_elements",
    "refreshed_daily_page_stats": "daily_page_stats",
    "refreshed_daily_click_summary": "daily_click_summary",
    "refreshed_weekly_metrics": "backfill_weekly_metrics",
    "refreshed_weekly_user_distribution": "backfill_weekly_user_distribution",
    "arrived_daily_metrics": "daily_metrics",
    "arrived_weekly_top_elements": "backfill_weekly_top_elements",
    "stream_clicks_kept": "stream_clicks_10m",
    "backfill_hourly_page_transitions": "hourly_page_transitions",
    "backfill_daily_page_transitions": "daily_page_transitions",
    "refreshed_daily_page_transitions": "daily_page_transitions",
    "backfill_hourly_metrics": "hourly_metrics",
    "backfill_hourly_page_stats": "hourly_page_stats",
    "backfill_hourly_click_summary": "hourly_click_summary",
    "backfill_hourly_top_elements": "hourly_top_elements",
    "backfill_hourly_user_distribution": "hourly_user_distribution",
}


def all_sql() -> dict[str, str]:
    direct = _direct()
    return direct | {name: direct[other] for name, other in SAME.items()}
