"""SQL counterparts of the queries, for an independent engine over the same Parquet tables."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'u_' || CAST(user_id AS VARCHAR) AS user_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'click'
              WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'search'
              WHEN 'error' THEN 'add_to_cart' END AS event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         '/p' || CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 9 AS VARCHAR) AS page,
         's_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d%H') AS session_id,
         CASE WHEN user_id % 20 < 11 THEN 'mobile' WHEN user_id % 20 < 18 THEN 'desktop'
              ELSE 'tablet' END AS device,
         CASE WHEN event_type = 'purchase' THEN value END AS amount,
         ts AS event_ts,
         CAST(ts AS DATE) AS event_date,
         CAST(round(CASE WHEN event_type = 'purchase' THEN value END * 100) AS BIGINT) AS cents
  FROM events
)"""

FIELDS = 'event_id, user_id, event_type, "timestamp", page, session_id, device, amount'


def _with(*tables: str) -> str:
    return "WITH " + ",\n".join((EVENTS, *tables)) + "\n"


def _mean_cents(total: str, count: str) -> str:
    return f"(2 * {total} + {count}) // nullif(2 * {count}, 0) / 100.0"


def _tumbling(width: str) -> str:
    return f"""
m AS (
  SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start,
         time_bucket(INTERVAL '{width}', event_ts) + INTERVAL '{width}' AS window_end,
         count(*) AS total_events,
         count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions,
         count(*) FILTER (event_type = 'purchase') AS purchase_count,
         CAST(coalesce(sum(cents), 0) AS BIGINT) / 100.0 AS total_revenue,
         CAST({_mean_cents("sum(cents) FILTER (event_type = 'purchase')",
                           "count(cents) FILTER (event_type = 'purchase')")} AS DOUBLE) AS avg_order_value,
         count(*) FILTER (event_type = 'page_view') AS page_views,
         count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'search') AS searches
  FROM ev GROUP BY 1, 2
)"""


def _sliding(width: str, slide: str, panes: int) -> str:
    return f"""
m AS (
  SELECT window_start,
         window_start + INTERVAL '{width}' AS window_end,
         count(*) AS event_count,
         count(DISTINCT user_id) AS active_users,
         CAST(coalesce(sum(cents), 0) AS BIGINT) / 100.0 AS revenue,
         count(*) FILTER (event_type = 'page_view') AS count_pageview,
         count(*) FILTER (event_type = 'click') AS count_click,
         count(*) FILTER (event_type = 'purchase') AS count_purchase,
         count(*) FILTER (event_type = 'search') AS count_search
  FROM (SELECT *, time_bucket(INTERVAL '{slide}', event_ts) - k * INTERVAL '{slide}' AS window_start
        FROM ev, (SELECT unnest(range({panes})) AS k)) GROUP BY 1
)"""


SLIDING = _sliding("5 minutes", "30 seconds", 10)


def _pages(width: str) -> str:
    return f"""
pages_per AS (
  SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start, page, count(*) AS view_count
  FROM ev WHERE event_type = 'page_view' GROUP BY 1, 2
)"""


def _ranked(n: int) -> str:
    return f"""
ranked AS (
  SELECT * FROM pages_per
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY view_count DESC, page) <= {n}
)"""


def _devices(where: str = "true", name: str = "devices", width: str = "1 hour") -> str:
    return f"""
{name} AS (
  SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start, device,
         count(*) AS event_count, count(DISTINCT user_id) AS unique_users
  FROM ev WHERE {where} GROUP BY 1, 2
)"""


REVENUE = f"""
rev AS (
  SELECT time_bucket(INTERVAL '1 hour', event_ts) AS window_start,
         CAST(sum(cents) AS BIGINT) / 100.0 AS revenue,
         count(*) AS order_count,
         CAST({_mean_cents("sum(cents)", "count(*)")} AS DOUBLE) AS avg_order,
         max(cents) / 100.0 AS max_order
  FROM ev WHERE event_type = 'purchase' AND amount IS NOT NULL GROUP BY 1
)"""


def _traffic(width: str, key: str = "'all'", where: str = "true") -> str:
    return f"""
traffic AS (
  SELECT {key} AS series, time_bucket(INTERVAL '{width}', event_ts) AS window_start,
         count(*) AS event_count, CAST(coalesce(sum(cents), 0) AS BIGINT) AS revenue_cents,
         count(DISTINCT user_id) AS active_users
  FROM ev WHERE {where} GROUP BY 1, 2
)"""


# Amounts as the damaged wire has them, in ten-thousandths.
BAD_AMOUNTS = """
paid AS (
  SELECT time_bucket(INTERVAL '1 hour', event_ts) AS window_start, CAST(sum(part) AS BIGINT) AS parts, count(part) AS orders
  FROM (SELECT event_ts, CASE CAST(event_id AS BIGINT) % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
               WHEN 3 THEN 40 ELSE CAST(round(amount * 10000) AS BIGINT) END AS part
        FROM ev WHERE event_type = 'purchase')
  GROUP BY 1
)"""


def _escaped(column: str) -> str:
    """A key as the series name holds it."""
    return f"coalesce(replace(replace({column}, '\\', '\\\\'), '|', '\\p'), '\\0')"


SLIDING_TRAFFIC = """
traffic AS (
  SELECT 'all' AS series, window_start, event_count,
         CAST(round(revenue * 100) AS BIGINT) AS revenue_cents, active_users
  FROM m
)"""

CLOSED_SLIDING_TRAFFIC = SLIDING_TRAFFIC.replace(
    "FROM m", "FROM m WHERE window_end <= (SELECT max(event_ts) - INTERVAL '10 seconds' FROM ev)"
)


def _spine(step: str) -> str:
    return f"""
spine AS (
  SELECT s.series, s.window_start,
         row_number() OVER (PARTITION BY s.series ORDER BY s.window_start) AS window_no,
         coalesce(t.event_count, 0) AS event_count,
         coalesce(t.revenue_cents, 0) AS revenue_cents,
         coalesce(t.active_users, 0) AS active_users
  FROM (SELECT series, unnest(generate_series(min(window_start), max(window_start), INTERVAL '{step}')) AS window_start
        FROM traffic GROUP BY series) s
  LEFT JOIN traffic t ON t.series = s.series AND t.window_start = s.window_start
)"""


# Ten-minute windows of all events and, once more, of the first two days moved 19,000 days back; a segment is a series here.
SEGMENTED = f"""
moved AS (
  SELECT * FROM ev UNION ALL
  SELECT * REPLACE (event_ts - INTERVAL '19000 days' AS event_ts) FROM ev
  WHERE event_ts < (SELECT min(event_ts) FROM ev) + INTERVAL '2 days'
),
{_traffic("10 minutes").replace("FROM ev", "FROM moved").strip()},
cut AS (
  SELECT *, coalesce(epoch_us(window_start) - epoch_us(lag(window_start) OVER (ORDER BY window_start)) > 7 * 86400000000, true) AS opens
  FROM traffic
),
parts AS (SELECT *, sum(opens::INT) OVER (ORDER BY window_start) AS part FROM cut),
spans AS (
  SELECT part, min(window_start) AS low,
         CASE WHEN part = (SELECT max(part) FROM parts) THEN max(window_start) ELSE max(window_start) + INTERVAL '7 days' END AS high
  FROM parts GROUP BY part
),
spine AS (
  SELECT 'all#' || s.part::VARCHAR AS series, s.window_start,
         row_number() OVER (PARTITION BY s.part ORDER BY s.window_start) AS window_no,
         coalesce(t.event_count, 0) AS event_count, coalesce(t.revenue_cents, 0) AS revenue_cents,
         coalesce(t.active_users, 0) AS active_users
  FROM (SELECT part, unnest(generate_series(low, high, INTERVAL '10 minutes')) AS window_start FROM spans) s
  LEFT JOIN traffic t ON t.window_start = s.window_start
)"""


def _frame(value: str) -> str:
    return f"""count({value}) OVER w AS n, coalesce(sum({value}) OVER w, 0) AS s,
         coalesce(sum(CAST({value} AS HUGEINT) * {value}) OVER w, 0) AS q"""


# The last 20 samples before a row: by window for counts, by sample number for the others.
BASELINES = f"""
counted AS (
  SELECT *, {_frame("event_count")},
         coalesce(count(*) FILTER (revenue_cents > 0) OVER before, 0) AS rev_no,
         coalesce(count(*) FILTER (active_users > 0) OVER before, 0) AS usr_no
  FROM spine
  WINDOW w AS (PARTITION BY series ORDER BY window_no ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING),
         before AS (PARTITION BY series ORDER BY window_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
rev_samples AS (SELECT series, rev_no AS sample_no, revenue_cents AS v FROM counted WHERE revenue_cents > 0),
usr_samples AS (SELECT series, usr_no AS sample_no, active_users AS v FROM counted WHERE active_users > 0),
rev_stats AS (
  SELECT c.series, c.window_no, count(x.v) AS rn, coalesce(sum(x.v), 0) AS rs,
         coalesce(sum(CAST(x.v AS HUGEINT) * x.v), 0) AS rq
  FROM counted c LEFT JOIN rev_samples x
    ON x.series = c.series AND x.sample_no BETWEEN c.rev_no - 20 AND c.rev_no - 1
  GROUP BY 1, 2
),
usr_stats AS (
  SELECT c.series, c.window_no, count(x.v) AS un, coalesce(sum(x.v), 0) AS us,
         coalesce(sum(CAST(x.v AS HUGEINT) * x.v), 0) AS uq
  FROM counted c LEFT JOIN usr_samples x
    ON x.series = c.series AND x.sample_no BETWEEN c.usr_no - 20 AND c.usr_no - 1
  GROUP BY 1, 2
),
based AS (
  SELECT c.*, rn, rs, rq, un, us, uq,
         sqrt(CAST(n * q - s * s AS DOUBLE)) AS d, sqrt(CAST(rn * rq - rs * rs AS DOUBLE)) AS rd,
         sqrt(CAST(un * uq - us * us AS DOUBLE)) AS ud
  FROM counted c JOIN rev_stats USING (series, window_no) JOIN usr_stats USING (series, window_no)
),
scored AS (
  SELECT *,
         CASE WHEN d > 0 THEN CAST(n * event_count - s AS DOUBLE) / d ELSE 0.0 END AS z,
         CASE WHEN s > 0 THEN CAST(n * event_count - s AS DOUBLE) / CAST(s AS DOUBLE) ELSE 0.0 END AS pct,
         CASE WHEN rd > 0 THEN CAST(rn * revenue_cents - rs AS DOUBLE) / rd ELSE 0.0 END AS rz,
         CASE WHEN rs > 0 THEN CAST(rn * revenue_cents - rs AS DOUBLE) / CAST(rs AS DOUBLE) ELSE 0.0 END AS rpct,
         CASE WHEN ud > 0 THEN CAST(un * active_users - us AS DOUBLE) / ud ELSE 0.0 END AS uz,
         CASE WHEN us > 0 THEN CAST(un * active_users - us AS DOUBLE) / CAST(us AS DOUBLE) ELSE 0.0 END AS upct
  FROM based
)"""


def _half_up(numerator: str, denominator: str, scale: int) -> str:
    """Rounded half away from zero with integers."""
    return (
        f"(sign({numerator}) * ((2 * {scale} * abs({numerator}) + {denominator}) // nullif(2 * {denominator}, 0)))"
    )


def _round2(value: str) -> str:
    return f"(sign({value}) * floor(abs({value}) * 100 + 0.5) / 100.0)"


def _alerts(width: str) -> str:
    where = "CAST(epoch_us(window_start) AS VARCHAR)"
    excess, fall = "(n * event_count - s)", "(rn * revenue_cents - rs)"
    mean1 = f"CAST({_half_up('s', 'n', 10)} AS DOUBLE) / 10.0"
    percent1 = f"coalesce(CAST({_half_up(excess, 's', 1000)} AS DOUBLE) / 10.0, 0.0)"
    rmean = f"CAST({_half_up('rs', 'rn', 1)} AS DOUBLE) / 100.0"
    rpercent1 = f"CAST({_half_up(fall, 'rs', 1000)} AS DOUBLE) / 10.0"
    whole = f"CAST(coalesce(abs({_half_up(excess, 's', 100)}), 0) AS BIGINT)"
    rwhole = f"CAST(abs({_half_up(fall, 'rs', 100)}) AS BIGINT)"
    usual = f"CAST({_half_up('s', 'n', 1)} AS BIGINT)"
    tail = f"window_start, window_start + INTERVAL '{width}' AS window_end, series"
    spike = "n >= 10 AND z > 2.5 AND pct > 2.0"
    return f"""
alerts AS (
  SELECT 'spike_' || series || '_' || {where} AS alert_id, 'spike' AS alert_type,
         CASE WHEN z > 4 THEN 'high' ELSE 'medium' END AS severity, 'event_count' AS metric,
         CAST(event_count AS DOUBLE) AS current_val, {mean1} AS baseline, {_round2("z")} AS z_score,
         {percent1} AS pct_change,
         printf('Traffic spike: %d events (%d%% above baseline %d)', event_count, {whole}, {usual}) AS message,
         {tail}
  FROM scored WHERE {spike}
  UNION ALL
  SELECT 'drop_' || series || '_' || {where}, 'drop',
         CASE WHEN pct < -0.7 THEN 'critical' WHEN pct < -0.5 THEN 'high' ELSE 'medium' END, 'event_count',
         CAST(event_count AS DOUBLE), {mean1}, {_round2("z")}, {percent1},
         printf('Traffic drop: %d events (%d%% below baseline %d)', event_count, {whole}, {usual}), {tail}
  FROM scored WHERE n >= 10 AND NOT ({spike}) AND pct < -0.4
  UNION ALL
  SELECT 'rev_drop_' || series || '_' || {where}, 'revenue_drop',
         CASE WHEN rpct < -0.5 THEN 'critical' ELSE 'high' END, 'revenue',
         revenue_cents / 100.0, {rmean}, {_round2("rz")}, {rpercent1},
         printf('Revenue drop: $%.2f (%d%% below baseline $%.2f)', revenue_cents / 100.0, {rwhole}, {rmean}), {tail}
  FROM scored WHERE rn >= 10 AND revenue_cents > 0 AND rpct < -0.3
  UNION ALL
  SELECT 'zero_' || series || '_' || {where}, 'zero_events', 'critical', 'event_count', 0.0,
         CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / n ELSE 0.0 END, -99.0, -100.0,
         'CRITICAL: Zero events received — possible pipeline failure!', {tail}
  FROM scored WHERE event_count = 0 AND window_no > 3
)"""


def _detector(step: str, key: str = "'all'", width: str | None = None) -> str:
    return ",\n".join((_traffic(step, key), _spine(step), BASELINES, _alerts(width or step)))


ALERT_OUT = """
  SELECT alert_id, alert_type, severity, metric, current_val, baseline, z_score, pct_change, message,
         window_end AS "timestamp", window_start, window_end, series"""

DAMAGED = f"""
damaged AS (
  SELECT {FIELDS}, event_ts, event_date, 'whole' AS form FROM ev
  UNION ALL
  SELECT event_id, user_id, event_type, 'not a time', page, session_id, device, amount, NULL, NULL, 'undated' FROM ev
)"""

# Windows the watermark has closed by the end of the stream.
CLOSED = "(SELECT max(event_ts) - INTERVAL '10 seconds' FROM ev)"


def _closed(table: str, end: str = "window_start + INTERVAL '1 hour'") -> str:
    return f"SELECT * FROM {table} WHERE {end} <= {CLOSED}"


def _rule(rule: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER ({condition}) AS violations FROM damaged"


RULES = {
    "event_id_present": "event_id IS NULL",
    "user_id_present": "user_id IS NULL",
    "event_type_present": "event_type IS NULL",
    "timestamp_present": '"timestamp" IS NULL',
    "page_present": "page IS NULL",
    "session_id_present": "session_id IS NULL",
    "device_present": "device IS NULL",
    "event_type_known": "event_type NOT IN ('page_view', 'click', 'search', 'purchase', 'add_to_cart')",
    "device_known": "device NOT IN ('mobile', 'desktop', 'tablet')",
    "amount_is_finite": "amount IS NOT NULL AND NOT (abs(amount) <= 1e12)",
    "purchase_has_amount": "event_type = 'purchase' AND (amount IS NULL OR amount <= 0)",
    "other_has_no_amount": "event_type <> 'purchase' AND amount IS NOT NULL",
    "timestamp_is_iso": "NOT (\"timestamp\" LIKE '%T%' AND (\"timestamp\" LIKE '%Z' OR \"timestamp\" LIKE '%+%'))",
    "timestamp_readable": '"timestamp" IS NOT NULL AND event_ts IS NULL',
}


def _summary() -> str:
    newest = "QUALIFY row_number() OVER (PARTITION BY series ORDER BY window_no DESC) <= 20"
    sums = "count(*) AS n, sum(v) AS s, sum(CAST(v AS HUGEINT) * v) AS q"
    return f"""
last_counts AS (SELECT series, {sums} FROM (SELECT series, event_count AS v FROM spine {newest}) GROUP BY 1),
last_revenue AS (SELECT series, {sums} FROM (SELECT series, revenue_cents AS v FROM spine WHERE revenue_cents > 0 {newest}) GROUP BY 1)
SELECT p.series, p.batches_processed,
       (SELECT count(*) FROM alerts a WHERE a.series = p.series) AS total_alerts,
       CAST({_half_up("c.s", "c.n", 10)} AS DOUBLE) / 10.0 AS count_mean,
       floor(sqrt(CAST(c.n * c.q - c.s * c.s AS DOUBLE)) / c.n * 10 + 0.5) / 10.0 AS count_std,
       c.n AS count_samples,
       CAST({_half_up("r.s", "r.n", 1)} AS DOUBLE) / 100.0 AS revenue_mean,
       floor(sqrt(CAST(r.n * r.q - r.s * r.s AS DOUBLE)) / r.n + 0.5) / 100.0 AS revenue_std,
       r.n AS revenue_samples
FROM (SELECT series, count(*) AS batches_processed FROM spine GROUP BY 1) p
JOIN last_counts c USING (series) JOIN last_revenue r USING (series)"""


UPSERTED = """
  SELECT window_start, device, event_count, unique_users FROM fresh
  UNION ALL
  SELECT * FROM old WHERE (window_start, device) NOT IN (SELECT (window_start, device) FROM fresh)"""

OLD_AND_NEW = (_devices("event_type = 'page_view'", "old"), _devices("event_type = 'purchase'", "fresh"))

KPIS = """
two AS (SELECT * FROM m ORDER BY window_start DESC LIMIT 2),
now AS (SELECT * FROM two ORDER BY window_start DESC LIMIT 1),
prev AS (SELECT * FROM two ORDER BY window_start LIMIT 1)"""


def _card(place: int, kpi: str, metric: str, compared: bool) -> str:
    difference = f"(now.{metric} - prev.{metric})"
    change = f"CAST({_half_up(difference, f'(prev.{metric} + 1)', 1000)} AS DOUBLE) / 10.0" if compared else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT {place} AS place, '{kpi}' AS kpi, CAST(coalesce(now.{metric}, 0) AS DOUBLE) AS value, "
        f"{change} AS delta_pct FROM now, prev"
    )


def _job() -> str:
    """Rows and a total per table of the job, each from the part of a WITH list it needs."""
    sliding = _sliding("1 hour", "10 minutes", 6)
    ended = f"window_start + INTERVAL '1 hour' <= {CLOSED}"
    parts = {
        "raw": (_with(DAMAGED) + "SELECT", "count(event_ts) FROM damaged"),
        "rejects": (_with("twice AS (SELECT event_id FROM ev UNION ALL SELECT NULL FROM ev)") + "SELECT", "count(event_id) FROM twice"),
        "events": (_with() + "SELECT", "count(*) FROM ev"),
        "metrics_1min": (_with(_tumbling("1 hour")) + "SELECT", f"sum(total_events) FROM m WHERE {ended}"),
        "metrics_5min": (_with(sliding) + "SELECT", f"sum(event_count) FROM m WHERE {ended}"),
        "revenue": (_with(REVENUE) + "SELECT", f"sum(order_count) FROM rev WHERE {ended}"),
        "devices": (_with(_devices()) + "SELECT", f"sum(unique_users) FROM devices WHERE {ended}"),
        "page_counts": (_with(_pages("1 hour")) + "SELECT", f"sum(view_count) FROM pages_per WHERE {ended}"),
        "alerts": (
            _with(sliding, CLOSED_SLIDING_TRAFFIC, _spine("10 minutes"), BASELINES, _alerts("1 hour")) + "SELECT",
            "count(*) FILTER (severity = 'critical') FROM alerts",
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, n AS rows, CAST(total AS BIGINT) AS total FROM ("
        f"{head} count(*) AS n, {tail.replace(' FROM', ' AS total FROM', 1)})"
        for name, (head, tail) in parts.items()
    )


def oracle() -> dict[str, str]:
    """One statement per registered query."""
    metrics = _with(_tumbling("1 hour"))
    ten = _with(_detector("10 minutes"))
    hourly = _with(_detector("1 hour"))
    devices = _with(_detector("1 hour", "device"))
    roundtrip_fields = f"{FIELDS}, event_ts, event_date"
    cards = (
        (1, "Events / Min", "total_events", True),
        (2, "Active Users", "unique_users", True),
        (3, "Revenue / Min", "total_revenue", False),
        (4, "Purchases", "purchase_count", True),
        (5, "Avg Order", "avg_order_value", False),
    )
    return {
        "parse_roundtrip": _with(DAMAGED) + f"SELECT {roundtrip_fields} FROM damaged",
        "wire_encode": _with() + f"SELECT user_id AS key, {FIELDS}, true AS has_amount_field FROM ev",
        "wire_files": _with()
        + "SELECT event_id, user_id, event_type, page, session_id, device, amount, event_ts, event_date FROM ev",
        "count_rejects": _with()
        + "SELECT 2 * count(*) AS valid, 2 * count(*) AS rejected, count(*) AS without_time FROM ev",
        "rejected_rows": _with()
        + "SELECT event_type, count(*) AS rejected FROM ev GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM ev",
        "dedupe_events": _with()
        + "SELECT event_id, user_id, event_type, page, session_id, device, amount, event_ts, event_date FROM ev",
        "event_contract": _with(DAMAGED)
        + " UNION ALL ".join(_rule(rule, condition) for rule, condition in RULES.items())
        + """ UNION ALL SELECT 'views_outnumber_purchases',
                 CAST(count(*) FILTER (event_type = 'page_view') <= 3 * count(*) FILTER (event_type = 'purchase') AS BIGINT)
                 FROM damaged
             UNION ALL SELECT 'event_id_unique', count(*) - count(DISTINCT event_id) FROM damaged""",
        "metrics_tumbling": _with(_tumbling("1 minute")) + "SELECT * FROM m",
        "metrics_hourly": metrics + "SELECT * FROM m",
        "daily_from_minutes": _with()
        + """SELECT time_bucket(INTERVAL '1 day', event_ts) AS window_start, device, count(*) AS total_events,
               count(*) FILTER (event_type = 'purchase') AS purchase_count, CAST(coalesce(sum(cents), 0) AS BIGINT) / 100.0 AS total_revenue,
               count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions, true AS users_near, true AS sessions_near
             FROM ev GROUP BY 1, 2""",
        "metrics_sliding": _with(SLIDING) + "SELECT * FROM m",
        "metrics_sliding_long": _with(_sliding("1 hour", "30 seconds", 120)) + "SELECT * FROM m",
        "metrics_bad_amounts": _with(_tumbling("1 hour"), BAD_AMOUNTS)
        + f"""SELECT m.* REPLACE (CAST((2 * coalesce(parts, 0) + 100) // 200 AS BIGINT) / 100.0 AS total_revenue,
                CAST({_mean_cents("coalesce(parts, 0)", "100 * orders")} AS DOUBLE) AS avg_order_value)
              FROM m LEFT JOIN paid USING (window_start)""",
        "alerts_by_device_page": _with(
            """spelled AS (SELECT * REPLACE (
                 CASE WHEN device = 'tablet' AND page = '/p3' THEN 'tablet|a' ELSE device END AS device,
                 CASE page WHEN '/p0' THEN NULL WHEN '/p1' THEN '(none)' WHEN '/p2' THEN 'a|b' WHEN '/p3' THEN 'b'
                   ELSE 'c\\d' END AS page) FROM ev)""",
            _traffic("1 hour", f"{_escaped('device')} || '|' || {_escaped('page')}").replace("FROM ev", "FROM spelled"),
            _spine("1 hour"), BASELINES, _alerts("1 hour"),
        )
        + ALERT_OUT
        + " FROM alerts",
        "top_pages": _with(_pages("1 hour"), _ranked(3)) + "SELECT * FROM ranked",
        "page_counts": _with(_pages("1 minute")) + "SELECT * FROM pages_per",
        "device_breakdown": _with(_devices()) + "SELECT * FROM devices",
        "revenue_by_window": _with(REVENUE) + "SELECT * FROM rev",
        "window_spine": _with(_traffic("10 minutes"), _spine("10 minutes"))
        + """SELECT series, window_start, window_no, event_count, revenue_cents / 100.0 AS revenue, active_users
             FROM spine""",
        "rolling_baseline": _with(_traffic("10 minutes"), _spine("10 minutes"), BASELINES)
        + """SELECT series, window_start, window_no, event_count, revenue_cents / 100.0 AS revenue, active_users,
               n AS count_samples, round(coalesce(CAST(s AS DOUBLE) / nullif(n, 0), 0), 6) AS count_mean,
               round(coalesce(d / nullif(n, 0), 0), 6) AS count_std,
               round(z, 6) AS count_z, round(pct, 6) AS count_pct,
               rn AS revenue_samples, round(coalesce(CAST(rs AS DOUBLE) / nullif(rn, 0), 0) / 100.0, 6) AS revenue_mean,
               round(coalesce(rd / nullif(rn, 0), 0) / 100.0, 6) AS revenue_std,
               round(rz, 6) AS revenue_z, round(rpct, 6) AS revenue_pct,
               un AS users_samples, round(coalesce(CAST(us AS DOUBLE) / nullif(un, 0), 0), 6) AS users_mean,
               round(coalesce(ud / nullif(un, 0), 0), 6) AS users_std,
               round(uz, 6) AS users_z, round(upct, 6) AS users_pct
             FROM scored""",
        "alerts_spike_drop": ten + ALERT_OUT + " FROM alerts WHERE alert_type IN ('spike', 'drop')",
        "alerts_revenue": hourly + ALERT_OUT + " FROM alerts WHERE alert_type = 'revenue_drop'",
        "alerts_zero": ten + ALERT_OUT + " FROM alerts WHERE alert_type = 'zero_events'",
        "alerts_by_device": devices + ALERT_OUT + " FROM alerts",
        "alerts_sliding": _with(SLIDING, SLIDING_TRAFFIC, _spine("30 seconds"), BASELINES, _alerts("5 minutes"))
        + ALERT_OUT
        + " FROM alerts",
        "detector_summary": devices.rstrip() + "," + _summary(),
        "upsert_metrics": _with(*OLD_AND_NEW) + UPSERTED,
        "upsert_table": _with(*OLD_AND_NEW)
        + f"SELECT *, CAST(window_start AS DATE) AS event_date FROM ({UPSERTED})",
        "append_table": _with(REVENUE) + "SELECT *, CAST(window_start AS DATE) AS event_date FROM rev",
        "table_span": _with(REVENUE)
        + """SELECT *, CAST(window_start AS DATE) AS event_date FROM rev
             WHERE window_start >= TIMESTAMP '2024-01-08 06:00:00' AND window_start < TIMESTAMP '2024-01-15'""",
        "json_lines": metrics + "SELECT * FROM m",
        "alert_index": devices
        + ALERT_OUT
        + ", window_end AS indexed_at, CAST(window_start AS DATE) AS event_date FROM alerts",
        "metrics_index": _with(_devices())
        + """SELECT *, window_start + INTERVAL '1 hour' AS indexed_at, CAST(window_start AS DATE) AS event_date
             FROM devices""",
        "latest_metrics": metrics + "SELECT * FROM m ORDER BY window_start DESC LIMIT 100",
        "metrics_history": metrics
        + "SELECT * FROM (SELECT * FROM m ORDER BY window_start DESC LIMIT 60) ORDER BY window_start",
        "latest_pages": _with(_pages("1 hour"))
        + "SELECT * FROM pages_per ORDER BY window_start DESC, page, view_count LIMIT 20",
        "kpi_latest": _with(_tumbling("1 hour"), KPIS) + " UNION ALL ".join(_card(*card) for card in cards),
        "type_breakdown": _with(_tumbling("1 hour"), "last60 AS (SELECT * FROM m ORDER BY window_start DESC LIMIT 60)")
        + """SELECT 'Page Views' AS type, CAST(sum(page_views) AS BIGINT) AS count FROM last60
             UNION ALL SELECT 'Clicks', CAST(sum(clicks) AS BIGINT) FROM last60
             UNION ALL SELECT 'Searches', CAST(sum(searches) AS BIGINT) FROM last60""",
        "top5_share": _with(
            _pages("1 hour"),
            """top AS (SELECT page, CAST(sum(view_count) AS BIGINT) AS view_count FROM pages_per
               GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)""",
        )
        + """SELECT page, view_count,
               CAST(least(view_count * 100 // (SELECT max(view_count) + 1 FROM top), 100) AS BIGINT) AS bar_pct
             FROM top""",
        "alert_search": ten
        + ALERT_OUT
        + """, window_end AS indexed_at FROM alerts WHERE severity = 'critical' AND alert_type = 'drop'
             ORDER BY indexed_at DESC, alert_id LIMIT 20""",
        "recent_alerts": ten
        + """SELECT alert_id, severity, message, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS "time"
             FROM alerts ORDER BY window_end DESC, alert_id LIMIT 5""",
        "stream_metrics": metrics + _closed("m"),
        "stream_sliding": _with(SLIDING) + _closed("m", "window_end"),
        "stream_sliding_long": _with(_sliding("1 hour", "5 minutes", 12)) + _closed("m", "window_end"),
        "late_corrections": metrics + _closed("m"),
        "half_compacted": _with(REVENUE) + "SELECT *, CAST(window_start AS DATE) AS event_date FROM rev",
        "landing_restart": _with()
        + """SELECT 'event' AS kind, 2 * count(*) AS rows, count(*) AS dated, 0::BIGINT AS texts, 2 * count(*) AS named FROM ev
             UNION ALL SELECT 'reject', 2 * count(*), 2 * count(*), 2 * count(*), count(*) FROM ev""",
        "series_segments": _with(SEGMENTED, BASELINES, _alerts("10 minutes"))
        + ALERT_OUT.replace(", series", ", 'all' AS series").replace("alert_id,", "replace(alert_id, series, 'all') AS alert_id,")
        + " FROM alerts",
        "stream_device": _with(_devices()) + _closed("devices"),
        "stream_revenue": _with(REVENUE) + _closed("rev"),
        "stream_page_counts": _with(_pages("1 hour")) + _closed("pages_per"),
        "stream_top_pages": _with(_pages("1 hour"), _ranked(3)) + _closed("ranked"),
        "stream_archive": _with()
        + """SELECT event_date, event_type, count(*) AS events, CAST(coalesce(sum(cents), 0) AS BIGINT) AS cents
             FROM ev GROUP BY 1, 2""",
        "stream_dedupe": _with() + "SELECT event_id, user_id, event_type, page, amount FROM ev",
        "stream_alerts": _with(
            _traffic("1 hour", "device", f"time_bucket(INTERVAL '1 hour', event_ts) + INTERVAL '1 hour' <= {CLOSED}"),
            _spine("1 hour"), BASELINES, _alerts("1 hour"),
        )
        + ALERT_OUT
        + " FROM alerts",
        "stream_job": _job(),
        "stream_late": metrics + "SELECT * FROM m",
        "stream_restart": metrics + _closed("m"),
        "compact_table": _with(
            """quarters AS (SELECT *, least(floor(CAST(epoch_us(event_ts) - (SELECT min(epoch_us(event_ts)) FROM ev WHERE event_type = 'purchase') AS DOUBLE) * 4
                 / (SELECT max(epoch_us(event_ts)) - min(epoch_us(event_ts)) + 1 FROM ev WHERE event_type = 'purchase')), 3) AS part
               FROM ev WHERE event_type = 'purchase')"""
        )
        + """SELECT time_bucket(INTERVAL '1 hour', event_ts) AS window_start, device, count(*) AS event_count,
               count(DISTINCT user_id) AS unique_users, CAST(time_bucket(INTERVAL '1 hour', event_ts) AS DATE) AS event_date
             FROM quarters WHERE event_ts < TIMESTAMP '2024-01-20' GROUP BY part, 1, 2, 5""",
        "stream_landing": _with()
        + f"""SELECT 'raw' AS name, count(*) + count(*) FILTER (event_ts < (SELECT min(event_ts) FROM ev) + INTERVAL '1 hour') + 1
                AS rows FROM ev
              UNION ALL SELECT 'rejects', count(*) FROM ev WHERE page = '/p1'
              UNION ALL SELECT 'misdated', 1
              UNION ALL SELECT 'metric_events', count(*) FROM ev
                WHERE time_bucket(INTERVAL '1 hour', event_ts) + INTERVAL '1 hour' <= {CLOSED}""",
    }
