"""DuckDB SQL giving the expected rows of every registered query.

The texts are direct statements of the definitions (self joins, range joins, distinct
counts over raw rows), not of the plans Spark is given.
"""

from __future__ import annotations

from .sources.binding import AGE_GROUPS, DEVICES, FIRST_SIGNUP, PLATFORM_KEYS, SEGMENTS
from .sources.seeds import EVENT_TYPE_KEYS, EVENT_TYPES, PLATFORMS


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _values(rows: list[tuple]) -> str:
    def literal(value):
        return str(value).upper() if isinstance(value, bool) else f"'{value}'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _pick(values: list[str], number: str) -> str:
    return f"list_extract({_list(values)}, CAST({number} % {len(values)} + 1 AS INT))"


def _ctes(as_of: str, day: str, redelivered: str) -> dict[str, tuple[list[str], str]]:
    """name -> (CTEs it reads, body)."""
    user_columns = f"""
        CAST(c_custkey AS VARCHAR) AS user_id, n_name AS country,
        {_pick(AGE_GROUPS, 'c_custkey')} AS age_group,
        {_pick(DEVICES, 'c_custkey')} AS device_type,
        SEGMENT AS user_segment,
        DATE '{FIRST_SIGNUP}' + CAST(c_custkey % 28 AS INT) AS signup_date,
        {_pick(PLATFORM_KEYS, 'c_custkey')} AS primary_platform
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""
    segment = _pick(SEGMENTS, "c_custkey % 9")
    k = "CAST(json_extract_string(props, '$.k') AS INT)"
    cohort = "CAST(date_trunc('week', signup_date) AS DATE)"
    ctes = {
        "raw_users": (
            [],
            f"SELECT {user_columns.replace('SEGMENT', segment)}",
        ),
        "second_load": (
            [],
            "SELECT "
            + user_columns.replace(
                "SEGMENT", f"CASE WHEN c_acctbal > 5000 THEN 'power' ELSE {segment} END"
            )
            + f""" UNION ALL SELECT 'nation-' || n_nationkey, n_name, {_pick(AGE_GROUPS, 'n_nationkey')},
                {_pick(DEVICES, 'n_nationkey')}, 'casual', DATE '2024-01-31',
                {_pick(PLATFORM_KEYS, 'n_nationkey')} FROM nation""",
        ),
        "raw_events": (
            [],
            f"""SELECT CAST(event_id AS VARCHAR) AS event_id,
                CASE WHEN event_id % 50 = 49 THEN 'visitor-' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id,
                CASE WHEN event_type = 'error' THEN 'error' ELSE {_pick(EVENT_TYPE_KEYS, k)} END AS event_type,
                {_pick(PLATFORM_KEYS, f"({k} // 15)")} AS platform,
                ts AS event_timestamp, n_name AS country,
                {_pick(DEVICES, 'user_id')} AS device_type,
                CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d%H') AS session_id
                FROM events LEFT JOIN customer ON user_id = c_custkey
                LEFT JOIN nation ON c_nationkey = n_nationkey""",
        ),
        "first_events": (
            ["raw_events"],
            """SELECT * FROM raw_events WHERE event_id IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp NULLS LAST,
                 user_id NULLS LAST, event_type NULLS LAST, platform NULLS LAST,
                 session_id NULLS LAST, country NULLS LAST, device_type NULLS LAST) = 1""",
        ),
        "clean": (
            ["first_events"],
            f"""SELECT * FROM first_events
                WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
                  AND list_contains({_list(EVENT_TYPE_KEYS)}, event_type)
                  AND event_timestamp <= TIMESTAMP '{as_of}'""",
        ),
        "dim_users": (
            ["raw_users"],
            """SELECT left(md5(user_id), 12) AS user_key, user_id, country, age_group, device_type,
               user_segment, signup_date, primary_platform, signup_date AS effective_from,
               CAST(NULL AS DATE) AS effective_to, TRUE AS is_current FROM raw_users""",
        ),
        "dim_platform": (
            [],
            f"SELECT * FROM (VALUES {_values(PLATFORMS)}) t(platform_key, platform_name, platform_family)",
        ),
        "dim_event_type": (
            [],
            f"""SELECT * FROM (VALUES {_values(EVENT_TYPES)})
                t(event_type_key, event_type_name, event_category, is_active_event)""",
        ),
        "fct_events": (
            ["clean", "dim_users"],
            """SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS date_key, user_key,
               platform AS platform_key, event_type AS event_type_key, session_id, c.country,
               c.device_type, CAST(1 AS INT) AS event_count,
               CAST(event_timestamp AS DATE) AS _partition_date
               FROM clean c JOIN dim_users u USING (user_id)""",
        ),
        # every day from the first to the last, also those without facts
        "per_day": (
            ["fct_events"],
            """SELECT s.date_key, coalesce(n, 0) AS events
               FROM (SELECT CAST(unnest(generate_series(min(date_key), max(date_key), INTERVAL 1 DAY)) AS DATE) AS date_key FROM fct_events) s
               LEFT JOIN (SELECT date_key, count(*) AS n FROM fct_events GROUP BY date_key) USING (date_key)""",
        ),
        # raw events by the day that delivered them, less the odd ones of the day in question
        "delivered": (
            ["numbered"],
            f"""SELECT * EXCLUDE (n, own) FROM (
                  SELECT *, own + CASE WHEN n % 17 = 0 THEN 1 WHEN n % 19 = 0 THEN -1 ELSE 0 END AS delivered FROM numbered
                  UNION ALL SELECT * REPLACE (event_timestamp + INTERVAL 1 DAY AS event_timestamp), own + 1 FROM numbered WHERE n % 23 = 0)
                WHERE event_id IS NOT NULL AND NOT (delivered = DATE '{redelivered}' AND n % 2 = 1)""",
        ),
        "numbered": (
            ["raw_events"],
            """SELECT *, coalesce(CAST(event_id AS BIGINT), 0) AS n,
                 coalesce(CAST(event_timestamp AS DATE), DATE '2024-01-01') AS own FROM raw_events""",
        ),
        "active": (
            ["fct_events", "dim_event_type"],
            "SELECT user_key, date_key FROM fct_events SEMI JOIN "
            "(FROM dim_event_type WHERE is_active_event) USING (event_type_key)",
        ),
        "user_day": (["fct_events"], "SELECT DISTINCT user_key, date_key FROM fct_events"),
        "dim_date": (
            ["fct_events"],
            """SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
               CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
               CAST(week(d) AS INT) AS week_of_year, CAST(day(d) AS INT) AS day_of_month,
               CAST(isodow(d) - 1 AS INT) AS day_of_week, dayname(d) AS day_name,
               isodow(d) >= 6 AS is_weekend,
               'FY' || (year(d) % 100 + CAST(month(d) >= 10 AS INT)) || '-Q' || quarter(d) AS fiscal_quarter
               FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(date_key)),
                       date_trunc('year', max(date_key)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                       INTERVAL 1 DAY)) AS DATE) AS d FROM fct_events)""",
        ),
        "daily": (
            ["fct_events", "dim_users"],
            """SELECT date_key, platform_key, count(DISTINCT user_key) AS dau,
               count(DISTINCT user_key) FILTER (signup_date = date_key) AS new_users,
               count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,
               count(*) FILTER (event_type_key = 'content_create') AS content_creates,
               count(*) FILTER (event_type_key = 'like') AS likes,
               count(*) FILTER (event_type_key = 'comment') AS comments,
               count(*) FILTER (event_type_key = 'share') AS shares,
               count(*) FILTER (event_type_key = 'message_sent') AS messages_sent,
               count(*) FILTER (event_type_key = 'ad_impression') AS ad_impressions,
               count(*) FILTER (event_type_key = 'ad_click') AS ad_clicks
               FROM fct_events LEFT JOIN (SELECT user_key, signup_date FROM dim_users) USING (user_key)
               WHERE platform_key IS NOT NULL GROUP BY ALL""",
        ),
        "agg_daily_metrics": (
            ["daily"],
            """SELECT *, CASE WHEN total_sessions > 0
                 THEN round(CAST(total_events AS DOUBLE) / total_sessions, 2) ELSE 0 END AS avg_session_events
               FROM daily""",
        ),
        "agg_user_engagement": (
            ["fct_events"],
            f"""SELECT user_key, DATE '{day}' AS date_key, l1_active, l7_days > 0 AS l7_active,
                TRUE AS l28_active, CAST(l7_days AS INT) AS l7_days_active,
                CAST(l28_days AS INT) AS l28_days_active, total_events_l7, total_events_l28,
                CAST(platforms AS INT) AS platforms_used_l7,
                round((CASE WHEN l1_active THEN 100.0::DOUBLE ELSE greatest(0, 100.0::DOUBLE - 10 * gap) END) * 0.30::DOUBLE
                  + least(100, l7_days::DOUBLE / 7 * 100) * 0.30::DOUBLE
                  + least(100, platforms::DOUBLE / 5 * 100) * 0.20::DOUBLE
                  + least(100, total_events_l7::DOUBLE / 50 * 100) * 0.20::DOUBLE, 1) AS engagement_score
                FROM (SELECT user_key, bool_or(date_key = DATE '{day}') AS l1_active,
                  DATE '{day}' - max(date_key) AS gap,
                  count(DISTINCT date_key) FILTER (date_key >= DATE '{day}' - 6) AS l7_days,
                  count(DISTINCT date_key) AS l28_days,
                  count(*) FILTER (date_key >= DATE '{day}' - 6) AS total_events_l7,
                  count(*) AS total_events_l28,
                  count(DISTINCT platform_key) FILTER (date_key >= DATE '{day}' - 6) AS platforms
                  FROM fct_events WHERE date_key BETWEEN DATE '{day}' - 27 AND DATE '{day}'
                  GROUP BY user_key)""",
        ),
        "agg_retention_cohorts": (
            ["dim_users", "user_day"],
            f"""SELECT cohort_week, platform_key, weeks_since_signup, cohort_size, retained_users,
                round(retained_users::DOUBLE / cohort_size, 4) AS retention_rate
                FROM (SELECT {cohort} AS cohort_week, primary_platform AS platform_key,
                        CAST((date_key - {cohort}) // 7 AS INT) AS weeks_since_signup,
                        count(DISTINCT user_key) AS retained_users
                      FROM dim_users JOIN user_day USING (user_key)
                      WHERE is_current AND date_key >= {cohort} GROUP BY ALL)
                JOIN (SELECT {cohort} AS cohort_week, primary_platform AS platform_key,
                        count(DISTINCT user_key) AS cohort_size
                      FROM dim_users WHERE is_current GROUP BY ALL) USING (cohort_week, platform_key)""",
        ),
        "ranked": (
            ["fct_events"],
            """SELECT n, percent_rank() OVER (ORDER BY n DESC) AS r
               FROM (SELECT count(*) AS n FROM fct_events GROUP BY user_key)""",
        ),
        "churn_features": (
            ["agg_user_engagement"],
            """SELECT user_key, engagement_score, l7_days_active, l28_days_active,
               round(l7_days_active * 4.0::DOUBLE / nullif(l28_days_active, 0), 2) AS l7_l28_ratio,
               total_events_l7, total_events_l28,
               round(total_events_l7 * 4.0::DOUBLE / nullif(total_events_l28, 0), 2) AS event_trend_ratio,
               platforms_used_l7,
               CASE WHEN l7_days_active = 0 THEN 'churned'
                    WHEN l7_days_active < 3 AND engagement_score < 30 THEN 'high_risk'
                    WHEN l7_days_active < 5 AND engagement_score < 50 THEN 'medium_risk'
                    ELSE 'low_risk' END AS churn_risk
               FROM agg_user_engagement""",
        ),
        "platform_status": (
            ["fct_events", "dim_users"],
            """SELECT t.date_key, t.platform_key, t.user_key, u.signup_date, y.user_key IS NOT NULL AS stayed
               FROM (SELECT DISTINCT user_key, date_key, platform_key FROM fct_events) t
               JOIN dim_users u ON u.user_key = t.user_key AND u.is_current
               LEFT JOIN (SELECT DISTINCT user_key, date_key, platform_key FROM fct_events) y
                 ON y.user_key = t.user_key AND y.platform_key = t.platform_key
                AND y.date_key + 1 = t.date_key""",
        ),
        "accounting": (
            ["platform_status"],
            """SELECT date_key, platform_key,
               count(*) FILTER (signup_date = date_key) AS new_users,
               count(*) FILTER (stayed AND signup_date IS DISTINCT FROM date_key) AS retained,
               count(*) FILTER (NOT stayed AND signup_date IS DISTINCT FROM date_key) AS resurrected,
               count(*) AS total_dau FROM platform_status GROUP BY ALL""",
        ),
        "checks": (
            ["fct_events", "dim_users", "dim_platform", "dim_event_type", "dim_date", "agg_daily_metrics"],
            _suite(),
        ),
    }
    # the facts' definition over delivered events
    for name, source in (("first_events", "raw_events"), ("clean", "first_events"), ("fct_events", "clean")):
        needs, body = ctes[name]
        of = "delivered" if source == "raw_events" else f"{source}_delivered"
        needs = [of if n == source else n for n in needs]
        ctes[f"{name}_delivered"] = (needs, body.replace(f"FROM {source}", f"FROM {of}"))
    return ctes


def _suite() -> str:
    def row_count(table, minimum):
        return f"""SELECT 'row_count' AS check_name, '{table}' AS table_name, 'critical' AS severity,
            CASE WHEN count(*) >= {minimum} THEN 'passed' ELSE 'failed' END AS status,
            format('{{:,}} rows, {minimum:,} or more expected', count(*)) AS message FROM {table}"""

    def unique(table, column):
        return f"""SELECT 'uniqueness_{column}', '{table}', 'critical',
            CASE WHEN count(*) = count(DISTINCT {column}) THEN 'passed' ELSE 'failed' END,
            format('{{:,}} of {{:,}} rows repeat a value', count(*) - count(DISTINCT {column}), count(*))
            FROM {table}"""

    def null_rate(table, column):
        rate = f"(count(*) - count({column}))::DOUBLE / nullif(count(*), 0)"
        return f"""SELECT 'null_rate_{column}', '{table}',
            CASE WHEN count(*) = 0 THEN 'warning' ELSE 'critical' END,
            CASE WHEN count(*) = 0 THEN 'skipped' WHEN {rate} <= 0.01 THEN 'passed' ELSE 'failed' END,
            CASE WHEN count(*) = 0 THEN '{table} has no rows'
                 ELSE printf('%.4f%% of the values are missing, up to 1.00%% allowed', 100 * {rate}) END FROM {table}"""

    def integrity(key, dim):
        return f"""SELECT 'ref_integrity_{key}', 'fct_events', 'critical',
            CASE WHEN count(*) FILTER (d.{key} IS NULL) = 0 THEN 'passed' ELSE 'failed' END,
            format('{{:,}} of {{:,}} keys are not in the dimension',
                   count(*) FILTER (d.{key} IS NULL), count(*))
            FROM (SELECT DISTINCT {key} FROM fct_events WHERE {key} IS NOT NULL) f
            LEFT JOIN (SELECT DISTINCT {key} FROM {dim}) d ON f.{key} = d.{key}"""

    def value_range(column, low, high):
        below = f"min({column}) < {low}"
        above = f"max({column}) > {high}" if high is not None else "FALSE"
        return f"""SELECT 'value_range_{column}', 'agg_daily_metrics', 'warning',
            CASE WHEN {below} OR {above} THEN 'failed' ELSE 'passed' END,
            'values from ' || coalesce(min({column})::VARCHAR, 'nothing') || ' to '
              || coalesce(max({column})::VARCHAR, 'nothing') || ': ' || coalesce(nullif(concat_ws('; ',
                CASE WHEN {below} THEN min({column}) || ' is below {low}' END,
                CASE WHEN {above} THEN max({column}) || ' is above {high}' END), ''), 'all within bounds')
            FROM agg_daily_metrics"""

    return " UNION ALL ".join(
        [
            row_count("fct_events", 1000),
            unique("fct_events", "event_id"),
            *[null_rate("fct_events", c) for c in ("user_key", "event_type_key", "date_key")],
            integrity("user_key", "dim_users"),
            integrity("platform_key", "dim_platform"),
            integrity("event_type_key", "dim_event_type"),
            row_count("dim_users", 100),
            unique("dim_users", "user_key"),
            null_rate("dim_users", "user_id"),
            row_count("dim_platform", 5),
            row_count("dim_event_type", 10),
            row_count("dim_date", 365),
            row_count("agg_daily_metrics", 5),
            value_range("dau", 0, None),
            value_range("avg_session_events", 0, 1000),
        ]
    )


def _bodies(as_of: str, start: str, day: str, load_date: str, raw_range: tuple[str, str]) -> dict:
    """query -> (CTEs it reads, SELECT)."""

    def pct(top, bottom, digits=2):
        return f"round({top} * 100.0::DOUBLE / nullif({bottom}, 0), {digits})"

    def check(like):
        return (["checks"], f"FROM checks WHERE {like}")

    def shares(digits, name):
        return f"round(num_users * 100.0::DOUBLE / sum(num_users) OVER (), {digits}) AS {name}"

    def retained(n):
        return f"count(DISTINCT user_key) FILTER (date_key = signup_date + {n})"

    def retention(column, n):
        return (
            ["dim_users", "user_day"],
            f"""SELECT {column}, count(DISTINCT user_key) AS cohort_size, {retained(n)} AS retained,
                {pct(retained(n), "count(DISTINCT user_key)")} AS retention_pct
                FROM dim_users LEFT JOIN user_day USING (user_key) WHERE is_current GROUP BY {column}""",
        )

    def cohorts(days, rates):
        return (
            ["dim_users", "user_day"],
            f"""SELECT CAST(date_trunc('week', signup_date) AS DATE) AS cohort_week,
                count(DISTINCT user_key) AS cohort_size,
                {", ".join(f"{retained(n)} AS retained_d{n}" for n in days)},
                {", ".join(f"{pct(retained(n), 'count(DISTINCT user_key)')} AS {name}" for n, name in rates)}
                FROM dim_users LEFT JOIN user_day USING (user_key) WHERE is_current GROUP BY 1""",
        )

    def matrix(where, value):
        return (
            ["agg_retention_cohorts"],
            f"""SELECT cohort_week, 'Week ' || weeks_since_signup AS week, max({value}) AS rate
                FROM agg_retention_cohorts WHERE platform_key = {where} GROUP BY ALL""",
        )

    in_range = (
        ["raw_events"],
        f"""FROM raw_events WHERE CAST(event_timestamp AS DATE)
            BETWEEN DATE '{raw_range[0]}' AND DATE '{raw_range[1]}'""",
    )

    def reached(event_type):
        return f"count(DISTINCT user_key) FILTER (event_type_key = '{event_type}')"

    steps = {
        "viewers": "content_view",
        "likers": "like",
        "commenters": "comment",
        "sharers": "share",
        "creators": "content_create",
    }
    funnel = ", ".join(f"{reached(t)} AS {s}" for s, t in steps.items())
    report_day = f"date_key = DATE '{day}'"
    tiers = """CASE WHEN r <= 0.01 THEN 'Top 1%' WHEN r <= 0.05 THEN 'Top 5%' WHEN r <= 0.1 THEN 'Top 10%'
        WHEN r <= 0.2 THEN 'Top 20%' WHEN r <= 0.5 THEN 'Top 50%' ELSE 'Bottom 50%' END"""
    interactions = "CAST(sum(likes + comments + shares) AS BIGINT) AS interactions"
    trend = """SELECT date_key, CAST(sum(dau) AS BIGINT) AS dau, CAST(sum(total_events) AS BIGINT) AS total_events,
        CAST(sum(total_sessions) AS BIGINT) AS total_sessions FROM agg_daily_metrics GROUP BY date_key"""
    average = "avg(dau) OVER (ORDER BY date_key ROWS 6 PRECEDING)"
    tracked = "country, age_group, device_type, user_segment, signup_date, primary_platform"
    dim_columns = f"user_key, user_id, {tracked}, effective_from, effective_to, is_current"
    same = " AND ".join(f"o.{c.strip()} IS NOT DISTINCT FROM n.{c.strip()}" for c in tracked.split(","))
    old = ", ".join(f"o.{c.strip()}" for c in tracked.split(","))
    new = ", ".join(f"n.{c.strip()}" for c in tracked.split(","))
    stats_tables = [
        "dim_date", "dim_users", "dim_platform", "dim_event_type", "fct_events",
        "agg_daily_metrics", "agg_user_engagement", "agg_retention_cohorts",
    ]
    return {
        "clean_events": (["clean"], "FROM clean"),
        "clean_report": (
            ["raw_events", "first_events", "clean"],
            f"""SELECT initial_events, initial_events - firsts - least(null_ids, 1) AS duplicates_removed,
                no_user + least(null_ids, 1) AS null_keys_removed,
                bad_time AS bad_timestamps_removed, bad_type AS invalid_types_removed,
                future AS future_removed, final_events, initial_events - final_events AS total_removed
                FROM (SELECT count(*) AS initial_events, count(*) FILTER (event_id IS NULL) AS null_ids FROM raw_events),
                 (SELECT count(*) AS firsts, count(*) FILTER (user_id IS NULL) AS no_user,
                    count(*) FILTER (user_id IS NOT NULL AND event_timestamp IS NULL) AS bad_time,
                    count(*) FILTER (user_id IS NOT NULL AND event_timestamp IS NOT NULL
                      AND coalesce(NOT list_contains({_list(EVENT_TYPE_KEYS)}, event_type), TRUE)) AS bad_type,
                    count(*) FILTER (user_id IS NOT NULL AND event_timestamp > TIMESTAMP '{as_of}'
                      AND list_contains({_list(EVENT_TYPE_KEYS)}, event_type)) AS future FROM first_events),
                 (SELECT count(*) AS final_events FROM clean)""",
        ),
        "dim_users": (["dim_users"], "FROM dim_users"),
        "scd2_merge": (
            ["dim_users", "second_load"],
            f"""SELECT {dim_columns} FROM dim_users o WHERE NOT EXISTS (
                  SELECT 1 FROM second_load n WHERE n.user_id = o.user_id AND NOT ({same}))
                UNION ALL
                SELECT o.user_key, o.user_id, {old}, o.effective_from, DATE '{load_date}' - 1, FALSE
                FROM dim_users o JOIN second_load n USING (user_id) WHERE NOT ({same})
                UNION ALL
                SELECT left(md5(n.user_id), 12), n.user_id, {new}, DATE '{load_date}', NULL, TRUE
                FROM dim_users o JOIN second_load n USING (user_id) WHERE NOT ({same})
                UNION ALL
                SELECT left(md5(n.user_id), 12), n.user_id, {new}, n.signup_date, NULL, TRUE
                FROM second_load n ANTI JOIN dim_users o USING (user_id)""",
        ),
        "daily_metrics_over_history": (["agg_daily_metrics"], "FROM agg_daily_metrics"),
        "retention_over_history": (
            ["second_load", "user_day"],
            f"""SELECT user_segment, count(DISTINCT user_id) AS cohort_size, {retained(7)} AS retained,
                {pct(retained(7), "count(DISTINCT user_id)")} AS retention_pct
                FROM second_load LEFT JOIN user_day ON user_key = left(md5(user_id), 12) GROUP BY user_segment""",
        ),
        "fct_events": (["fct_events"], "FROM fct_events"),
        "incremental_facts": (["fct_events"], "FROM fct_events"),
        "interrupted_load": (["fct_events_delivered"], "FROM fct_events_delivered"),
        "raw_events_range": in_range,
        "raw_events_text_times": in_range,
        "raw_events_number_times": in_range,
        "raw_events_mixed_times": in_range,
        "raw_events_one_day": (
            ["raw_events"],
            f"SELECT * FROM raw_events WHERE CAST(event_timestamp AS DATE) = DATE '{raw_range[0]}'",
        ),
        # a run passes when there are rows enough: nothing else is wrong with these tables
        "daily_run": (
            ["fct_events", "raw_users", "second_load"],
            f"""SELECT CAST(n AS BIGINT) AS events_processed, CASE WHEN passes THEN 'build_aggregates' ELSE 'quality_alert' END AS branch,
                passes AS aggregates_built, CASE WHEN passes THEN of_platforms ELSE 0 END AS total_events, user_versions
                FROM (SELECT count(*) FILTER (date_key = DATE '{raw_range[1]}') AS n,
                        count(*) FILTER (date_key = DATE '{raw_range[1]}' AND platform_key IS NOT NULL) AS of_platforms,
                        count(*) >= 1000 AND (SELECT count(*) FROM second_load) >= 100 AS passes,
                        (SELECT count(*) FROM second_load) + (SELECT count(*) FROM raw_users o JOIN second_load s USING (user_id)
                          WHERE o.user_segment <> s.user_segment AND o.signup_date < DATE '{raw_range[1]}') AS user_versions
                      FROM fct_events)""",
        ),
        "raw_days": (
            ["raw_events"],
            "SELECT DISTINCT CAST(event_timestamp AS DATE) AS dt FROM raw_events WHERE event_timestamp IS NOT NULL",
        ),
        "dimension_modes": (
            ["second_load"],
            f"""SELECT left(md5(user_id), 12) AS user_key, user_id, {new.replace("n.", "")},
                signup_date AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current FROM second_load""",
        ),
        "replaced_fact_day": (
            ["fct_events"],
            f"SELECT * FROM fct_events WHERE date_key <> DATE '{raw_range[0]}' OR platform_key = 'facebook'",
        ),
        "replaced_metrics": (
            ["agg_daily_metrics"],
            f"""SELECT * REPLACE (CASE WHEN date_key = DATE '{raw_range[0]}' THEN 0 ELSE total_sessions END AS total_sessions)
                FROM agg_daily_metrics""",
        ),
        "full_refresh_metrics": (["agg_daily_metrics"], "FROM agg_daily_metrics"),
        "verified_facts": (
            ["fct_events"],
            "SELECT count(*) AS row_count, least(count(*), 5) AS sample_rows FROM fct_events",
        ),
        "quality_gate": (
            ["checks"],
            """SELECT CASE WHEN count(*) > 0 AND count(*) FILTER (status = 'failed') = 0
                 THEN 'build_aggregates' ELSE 'quality_alert' END AS branch FROM checks""",
        ),
        "unknown_user_events": (
            ["clean", "dim_users"],
            "SELECT count(*) AS unknown_user_events FROM clean ANTI JOIN dim_users USING (user_id)",
        ),
        "dim_date": (["dim_date"], "FROM dim_date"),
        "dim_platform": (
            ["dim_platform", "fct_events"],
            """SELECT platform_key, platform_name, platform_family, count(event_id) AS fact_rows
               FROM dim_platform LEFT JOIN fct_events USING (platform_key) GROUP BY ALL""",
        ),
        "dim_event_type": (
            ["dim_event_type", "fct_events"],
            """SELECT event_type_key, event_type_name, event_category, is_active_event,
               count(event_id) AS fact_rows
               FROM dim_event_type LEFT JOIN fct_events USING (event_type_key) GROUP BY ALL""",
        ),
        "table_stats": (
            stats_tables,
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in stats_tables
            ),
        ),
        "fact_date_bounds": (
            ["fct_events"],
            "SELECT min(date_key) AS min_date, max(date_key) AS max_date FROM fct_events",
        ),
        "agg_daily_metrics": (
            ["fct_events", "dim_users"],
            """SELECT date_key, platform_key, count(DISTINCT user_key) AS dau,
               count(DISTINCT user_key) FILTER (signup_date = date_key) AS new_users,
               count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,
               count(*) FILTER (event_type_key = 'content_create') AS content_creates,
               count(*) FILTER (event_type_key = 'like') AS likes,
               count(*) FILTER (event_type_key = 'comment') AS comments,
               count(*) FILTER (event_type_key = 'share') AS shares,
               count(*) FILTER (event_type_key = 'message_sent') AS messages_sent,
               count(*) FILTER (event_type_key = 'ad_impression') AS ad_impressions,
               count(*) FILTER (event_type_key = 'ad_click') AS ad_clicks,
               round(count(*)::DOUBLE / nullif(count(DISTINCT session_id), 0), 2) AS avg_session_events
               FROM fct_events JOIN (SELECT user_key, signup_date FROM dim_users) USING (user_key)
               GROUP BY date_key, platform_key""",
        ),
        "agg_daily_metrics_etl": (["agg_daily_metrics"], "FROM agg_daily_metrics"),
        "agg_user_engagement": (["agg_user_engagement"], "FROM agg_user_engagement"),
        "agg_retention_cohorts": (["agg_retention_cohorts"], "FROM agg_retention_cohorts"),
        "dau_wau_mau": (
            ["active"],
            f"""SELECT DATE '{day}' AS report_date, dau, wau, mau,
                CASE WHEN mau > 0 THEN round(dau::DOUBLE / mau * 100, 2) ELSE 0 END AS dau_mau_ratio,
                CASE WHEN wau > 0 THEN round(dau::DOUBLE / wau * 100, 2) ELSE 0 END AS dau_wau_ratio
                FROM (SELECT count(DISTINCT user_key) FILTER ({report_day}) AS dau,
                  count(DISTINCT user_key) FILTER (date_key BETWEEN DATE '{day}' - 6 AND DATE '{day}') AS wau,
                  count(DISTINCT user_key) FILTER (date_key BETWEEN DATE '{day}' - 27 AND DATE '{day}') AS mau
                  FROM active)""",
        ),
        "dau_trend_wow": (
            ["agg_daily_metrics"],
            f"""SELECT date_key, dau, round({average}, 0) AS dau_7d_ma,
                round(avg(dau) OVER (ORDER BY date_key ROWS 27 PRECEDING), 0) AS dau_28d_ma,
                lag(dau, 7) OVER (ORDER BY date_key) AS dau_wow,
                {pct("(dau - lag(dau, 7) OVER (ORDER BY date_key))", "lag(dau, 7) OVER (ORDER BY date_key)")}
                  AS wow_growth_pct FROM ({trend})""",
        ),
        "dau_trend": (
            ["agg_daily_metrics"],
            f"""SELECT *, round({average}, 0) AS dau_7d_ma,
                round(total_events::DOUBLE / dau, 1) AS events_per_dau
                FROM ({trend}) WHERE date_key BETWEEN DATE '{start}' AND DATE '{day}'""",
        ),
        "dau_trend_chart": (
            ["agg_daily_metrics"],
            f"""SELECT *, {average} AS dau_7d_ma, round(total_events::DOUBLE / dau, 1) AS events_per_dau
                FROM ({trend})""",
        ),
        "stickiness": (
            ["active", "dim_date"],
            f"""SELECT date_key, dau, mau, {pct("dau", "mau")} AS dau_mau_ratio_pct
                FROM (SELECT date_key, count(DISTINCT user_key) AS dau FROM active GROUP BY date_key)
                JOIN (SELECT d.date_key, count(DISTINCT user_key) AS mau FROM dim_date d
                      JOIN active a ON a.date_key BETWEEN d.date_key - 27 AND d.date_key
                      GROUP BY d.date_key) USING (date_key)""",
        ),
        "engagement_distribution": (
            ["agg_user_engagement", "dim_users"],
            """SELECT user_segment, count(*) AS num_users,
               round(CAST(sum(CAST(round(engagement_score * 10) AS BIGINT)) AS DOUBLE) / (10 * count(*)), 1) AS avg_score,
               round(quantile_cont(engagement_score, 0.25), 1) AS p25,
               round(quantile_cont(engagement_score, 0.5), 1) AS p50,
               round(quantile_cont(engagement_score, 0.75), 1) AS p75,
               round(avg(l7_days_active), 1) AS avg_l7_days,
               round(avg(platforms_used_l7), 1) AS avg_platforms
               FROM agg_user_engagement JOIN (SELECT user_key, user_segment FROM dim_users WHERE is_current)
               USING (user_key) GROUP BY user_segment""",
        ),
        "engagement_histogram": (
            ["agg_user_engagement", "dim_users"],
            """SELECT user_segment, score_bin, count(*) AS users, (score_bin - 1) * 2.0::DOUBLE AS bin_start
               FROM (SELECT user_segment, CAST(least(floor(engagement_score / 2) + 1, 50) AS INT) AS score_bin
                     FROM agg_user_engagement JOIN dim_users USING (user_key) WHERE is_current)
               GROUP BY user_segment, score_bin""",
        ),
        "platform_engagement": (
            ["agg_daily_metrics", "dim_platform"],
            f"""SELECT platform_key, platform_name, dau, total_events, total_sessions, content_creates,
                likes + comments + shares AS interactions, ad_impressions, ad_clicks,
                CASE WHEN ad_impressions > 0 THEN round(ad_clicks * 100.0::DOUBLE / ad_impressions, 2)
                     ELSE 0 END AS ad_ctr_pct, avg_session_events
                FROM agg_daily_metrics JOIN dim_platform USING (platform_key) WHERE {report_day}""",
        ),
        "cross_platform_usage": (
            ["fct_events"],
            f"""SELECT *, {shares(2, "pct_users")} FROM (SELECT platforms_used, count(*) AS num_users
                FROM (SELECT count(DISTINCT platform_key) AS platforms_used FROM fct_events GROUP BY user_key)
                GROUP BY platforms_used)""",
        ),
        "cross_platform_daily": (
            ["fct_events"],
            f"""SELECT *, {shares(2, "pct_of_users")} FROM (
                SELECT platforms_used, count(DISTINCT user_key) AS num_users
                FROM (SELECT user_key, date_key, count(DISTINCT platform_key) AS platforms_used
                      FROM fct_events GROUP BY ALL) GROUP BY platforms_used)""",
        ),
        "user_platform_lists": (
            ["fct_events"],
            """SELECT user_key, date_key, count(DISTINCT platform_key) AS platforms_used,
               string_agg(DISTINCT platform_key, ',' ORDER BY platform_key) AS platform_list
               FROM fct_events GROUP BY ALL""",
        ),
        "power_users": (
            ["ranked"],
            f"""SELECT {tiers} AS user_tier, count(*) AS num_users, CAST(sum(n) AS BIGINT) AS total_events,
                round(CAST(sum(n) AS DOUBLE) * 100 / (SELECT sum(n) FROM ranked), 2) AS pct_of_total_events
                FROM ranked GROUP BY 1""",
        ),
        "platform_comparison": (
            ["agg_daily_metrics"],
            f"""SELECT platform_key, CAST(sum(dau) AS DOUBLE) / count(DISTINCT date_key) AS avg_dau,
                CAST(sum(total_events) AS BIGINT) AS total_events,
                CAST(sum(content_creates) AS BIGINT) AS content_creates, {interactions}
                FROM agg_daily_metrics GROUP BY platform_key""",
        ),
        "platform_summary": (
            ["agg_daily_metrics", "dim_platform"],
            f"""SELECT platform_key, platform_name, round(avg(dau)) AS avg_dau,
                CAST(sum(total_events) AS BIGINT) AS total_events,
                CAST(sum(content_creates) AS BIGINT) AS content_creates, {interactions},
                CAST(sum(ad_impressions) AS BIGINT) AS ad_impressions,
                CAST(sum(ad_clicks) AS BIGINT) AS ad_clicks,
                round(CAST(sum(ad_clicks) AS DOUBLE) * 100 / nullif(sum(ad_impressions), 0), 3) AS ad_ctr
                FROM agg_daily_metrics JOIN dim_platform USING (platform_key) GROUP BY ALL""",
        ),
        "growth_accounting": (["accounting"], f"FROM accounting WHERE date_key BETWEEN DATE '{start}' AND DATE '{day}'"),
        "growth_accounting_retained_first": (
            ["platform_status"],
            """SELECT date_key, platform_key,
               count(*) FILTER (NOT stayed AND signup_date = date_key) AS new_users,
               count(*) FILTER (stayed) AS retained_users,
               count(*) FILTER (NOT stayed AND signup_date < date_key) AS resurrected_users,
               count(*) AS total_dau FROM platform_status GROUP BY ALL""",
        ),
        "growth_composition": (
            ["user_day", "dim_users"],
            """SELECT t.date_key, CASE WHEN signup_date = t.date_key THEN 'New'
                 WHEN y.user_key IS NOT NULL THEN 'Retained' ELSE 'Resurrected' END AS user_type,
               count(*) AS users
               FROM user_day t JOIN dim_users u ON u.user_key = t.user_key AND u.is_current
               LEFT JOIN user_day y ON y.user_key = t.user_key AND y.date_key + 1 = t.date_key GROUP BY ALL""",
        ),
        "quick_ratio": (
            ["accounting"],
            f"""SELECT *, round((new_users + resurrected)::DOUBLE / CASE churned WHEN 0 THEN 1 ELSE churned END, 2)
                  AS quick_ratio, new_users + resurrected - churned AS net_growth
                FROM (SELECT *, CASE WHEN prev_dau IS NOT NULL THEN greatest(prev_dau - retained, 0) END AS churned
                  FROM (SELECT *, lag(total_dau) OVER (PARTITION BY platform_key ORDER BY date_key) AS prev_dau
                    FROM accounting WHERE date_key BETWEEN DATE '{start}' AND DATE '{day}'))""",
        ),
        "churned_exact": (
            ["fct_events"],
            """WITH seen AS (SELECT DISTINCT user_key, date_key, platform_key FROM fct_events)
               SELECT y.date_key + 1 AS date_key, y.platform_key,
                 count(*) FILTER (t.user_key IS NULL) AS churned_users
               FROM seen y LEFT JOIN seen t ON t.user_key = y.user_key AND t.platform_key = y.platform_key
                 AND t.date_key = y.date_key + 1
               WHERE y.date_key < (SELECT max(date_key) FROM fct_events) GROUP BY ALL""",
        ),
        "funnel_platform": (
            ["fct_events"],
            f"""SELECT platform_key, {funnel}, {pct(reached('like'), reached('content_view'))} AS view_to_like_pct,
                {pct(reached('content_create'), reached('content_view'))} AS view_to_create_pct
                FROM fct_events WHERE {report_day} GROUP BY platform_key""",
        ),
        "funnel_daily": (
            ["fct_events"],
            f"""SELECT *, {pct("likers", "viewers")} AS view_to_like_pct,
                {pct("commenters", "viewers")} AS view_to_comment_pct,
                {pct("sharers", "viewers")} AS view_to_share_pct,
                {pct("creators", "viewers")} AS view_to_create_pct
                FROM (SELECT date_key, {funnel} FROM fct_events GROUP BY date_key)""",
        ),
        "funnel_overall": (["fct_events"], f"SELECT {funnel} FROM fct_events WHERE {report_day}"),
        "funnel_stages": (
            ["fct_events"],
            f"""SELECT stage_order, stage, users, {pct("users", "viewers", 1)} AS pct_of_initial
                FROM (SELECT {funnel} FROM fct_events WHERE {report_day}) f,
                LATERAL (VALUES (1, 'View Content', f.viewers), (2, 'Like', f.likers),
                  (3, 'Comment', f.commenters), (4, 'Share', f.sharers),
                  (5, 'Create Content', f.creators)) s(stage_order, stage, users)""",
        ),
        "geo_growth": (
            ["fct_events"],
            f"""WITH per_day AS (SELECT country, date_key, count(DISTINCT user_key) AS dau, count(*) AS n
                  FROM fct_events GROUP BY ALL),
                ends AS (SELECT country, min(date_key) AS a, max(date_key) AS z, sum(n) AS n
                  FROM per_day GROUP BY country)
                SELECT country, f.dau AS first_period_dau, l.dau AS last_period_dau,
                  {pct("(l.dau - f.dau)", "f.dau")} AS dau_growth_pct, CAST(e.n AS BIGINT) AS total_events
                FROM ends e JOIN per_day f USING (country) JOIN per_day l USING (country)
                WHERE f.date_key = a AND l.date_key = z""",
        ),
        "geo_distribution": (
            ["fct_events"],
            """SELECT country, count(DISTINCT user_key) AS total_users, count(*) AS total_events
               FROM fct_events GROUP BY country""",
        ),
        "geo_top10": (
            ["fct_events"],
            """SELECT country, count(DISTINCT user_key) AS users, count(*) AS events
               FROM fct_events GROUP BY country ORDER BY users DESC, country NULLS LAST LIMIT 10""",
        ),
        "demographics": (
            ["fct_events", "dim_users"],
            f"""SELECT u.age_group, u.device_type, count(DISTINCT user_key) AS dau, count(*) AS events,
                round(count(*)::DOUBLE / count(DISTINCT user_key), 1) AS events_per_user
                FROM fct_events f JOIN dim_users u USING (user_key)
                WHERE u.is_current AND {report_day} GROUP BY ALL""",
        ),
        "nday_retention": cohorts([1, 3, 7, 14, 30], [(n, f"d{n}_pct") for n in (1, 3, 7, 14, 30)]),
        "activation_retention": cohorts(
            [1, 7, 14, 30], [(1, "d1_retention_pct"), (7, "d7_retention_pct")]
        ),
        "retention_by_segment": retention("user_segment", 7),
        "retention_by_platform": retention("primary_platform", 7),
        "retention_by_country": retention("country", 7),
        "retention_matrix": matrix(
            """(SELECT platform_key FROM agg_retention_cohorts GROUP BY platform_key
                ORDER BY sum(cohort_size) DESC, platform_key LIMIT 1)""",
            "retention_rate",
        ),
        "retention_heatmap": matrix("'facebook'", "retention_rate * 100"),
        "churn_risk_features": (["churn_features"], "FROM churn_features"),
        "churn_risk_distribution": (
            ["churn_features"],
            "SELECT churn_risk AS risk_level, count(*) AS count FROM churn_features GROUP BY churn_risk",
        ),
        "dq_null_rate": check("check_name = 'null_rate_user_key'"),
        "dq_uniqueness": check("check_name = 'uniqueness_event_id'"),
        "dq_referential_integrity": check("check_name = 'ref_integrity_user_key'"),
        "dq_row_count": check("check_name = 'row_count' AND table_name = 'fct_events'"),
        "dq_value_range": check("check_name = 'value_range_avg_session_events'"),
        "dq_suite": (["checks"], "FROM checks"),
        "dq_summary": (
            ["checks"],
            """SELECT count(*) AS total_checks, count(*) FILTER (status = 'passed') AS passed,
               count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
               printf('%.1f%%', count(*) FILTER (status = 'passed')::DOUBLE / count(*) * 100) AS pass_rate
               FROM checks""",
        ),
        "dq_freshness": (
            ["fct_events"],
            f"""SELECT 'freshness' AS check_name, 'fct_events' AS table_name, 'warning' AS severity,
                CASE WHEN t IS NULL THEN 'skipped' WHEN h <= 48 THEN 'passed' ELSE 'failed' END AS status,
                CASE WHEN t IS NULL THEN 'no row has a time' ELSE printf('newest row of %s is %.1f hours old, up to 48 allowed',
                  CASE WHEN microsecond(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
                       ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%f') END, h) END AS message
                FROM (SELECT t, date_diff('microsecond', t, TIMESTAMP '{as_of}')::DOUBLE / 1e6 / 3600 AS h
                      FROM (SELECT max(event_timestamp) AS t FROM fct_events))""",
        ),
        "dq_duplicate_rate": (
            ["fct_events"],
            """SELECT 'duplicate_rate_event_id' AS check_name, 'fct_events' AS table_name, 'warning' AS severity,
               CASE WHEN n = 0 THEN 'skipped' WHEN r <= 0.001 THEN 'passed' ELSE 'failed' END AS status,
               CASE WHEN n = 0 THEN 'fct_events has no rows'
                    ELSE printf('%.4f%% of the rows are copies, up to 0.10%% allowed', 100 * r) END AS message
               FROM (SELECT count(*) AS n, 1 - count(DISTINCT event_id)::DOUBLE / nullif(count(*), 0) AS r
                     FROM fct_events)""",
        ),
        "dq_reconciliation": (
            ["fct_events", "agg_daily_metrics"],
            """SELECT date_key, coalesce(f, 0) AS fact_events, coalesce(a, 0) AS agg_events,
               coalesce(f, 0) - coalesce(a, 0) AS difference,
               CASE WHEN coalesce(f, 0) = coalesce(a, 0) THEN 'passed' ELSE 'failed' END AS status
               FROM (SELECT date_key, count(*) AS f FROM fct_events GROUP BY date_key)
               FULL JOIN (SELECT date_key, CAST(sum(total_events) AS BIGINT) AS a
                          FROM agg_daily_metrics GROUP BY date_key) USING (date_key)""",
        ),
        "dq_volume_anomaly": (
            ["per_day"],
            f"""SELECT date_key, events, round(m, 2) AS trailing_mean, {pct("(events - m)", "m")} AS deviation_pct,
                CASE WHEN m IS NULL THEN FALSE WHEN m = 0 THEN events > 0 ELSE abs(events - m) * 100 > m * 50 END AS is_anomaly,
                events < 1000 AS below_minimum, trailing_median,
                coalesce(abs(events - trailing_median) > 3 * 1.4826::DOUBLE * spread, FALSE) AS is_outlier
                FROM (
                  SELECT d.date_key, any_value(d.events) AS events, avg(e.events) AS m, median(e.events) AS trailing_median,
                    coalesce(median(abs(e.events - e.middle)), 0) AS spread
                  FROM per_day d LEFT JOIN (
                    SELECT p.date_key AS of, q.events, median(q.events) OVER (PARTITION BY p.date_key) AS middle
                    FROM per_day p JOIN per_day q ON q.date_key BETWEEN p.date_key - 7 AND p.date_key - 1) e ON e.of = d.date_key
                  GROUP BY d.date_key)""",
        ),
    }


def oracle_queries(
    as_of: str, start: str, day: str, load_date: str, raw_range: tuple[str, str], change_date: str
) -> dict[str, str]:
    """query -> SQL text, each with the CTEs it needs in front."""
    ctes = _ctes(as_of, day, raw_range[0])

    def needed(names: list[str]) -> list[str]:
        ordered: list[str] = []
        for name in names:
            for one in [*needed(ctes[name][0]), name]:
                if one not in ordered:
                    ordered.append(one)
        return ordered

    def text(names: list[str], body: str) -> str:
        parts = [f"{name} AS ({ctes[name][1]})" for name in needed(names)]
        return f"WITH {', '.join(parts)} {body if body.startswith('FROM') is False else 'SELECT * ' + body}"

    def nested(names: list[str], body: str) -> str:
        # A body with CTEs of its own becomes a subquery.
        return text(names, f"SELECT * FROM ({body})" if body.startswith("WITH") else body)

    bodies = _bodies(as_of, start, day, load_date, raw_range)
    bodies["segments_of_the_day"] = (
        ["fct_events", "raw_users", "second_load"],
        f"""SELECT date_key, CASE WHEN greatest(date_key, o.signup_date) >= DATE '{change_date}' THEN n.user_segment
              ELSE o.user_segment END AS user_user_segment, count(*) AS events
            FROM fct_events JOIN raw_users o ON user_key = left(md5(o.user_id), 12)
            JOIN second_load n ON n.user_id = o.user_id GROUP BY ALL""",
    )
    # the suite over facts of which one day's stand on another day as well
    bodies["dq_checks_of_days"] = (
        ["fct_events", "dim_users", "dim_platform", "dim_event_type", "dim_date", "agg_daily_metrics"],
        f"""WITH checked AS (FROM fct_events UNION ALL
              SELECT * REPLACE (DATE '{raw_range[1]}' AS date_key) FROM fct_events WHERE date_key = DATE '{raw_range[0]}')
            {_suite().replace("FROM fct_events", "FROM checked")}""",
    )
    # the order that each report's definition states, and the report's rows
    orders = {
        "power_users": ("user_tier", "list_position(['Top 1%', 'Top 5%', 'Top 10%', 'Top 20%', 'Top 50%', 'Bottom 50%'], user_tier)"),
        "dau_trend_wow": ("date_key", "date_key"),
        "funnel_stages": ("stage", "stage_order"),
        "geo_growth": ("country", "total_events DESC, country"),
        "demographics": ("age_group", "dau DESC, age_group, device_type"),
    }
    bodies["ordered_reports"] = (
        list(dict.fromkeys(n for report in orders for n in bodies[report][0])),
        " UNION ALL ".join(
            f"""SELECT '{report}' AS report, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place,
                CAST({key} AS VARCHAR) AS key FROM ({'' if bodies[report][1].lstrip().startswith(('SELECT', 'WITH')) else 'SELECT * '}{bodies[report][1]})"""
            for report, (key, order) in orders.items()
        ),
    )
    return {query: nested(names, body) for query, (names, body) in bodies.items()}
