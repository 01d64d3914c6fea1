"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL runs on the raw parquet tables (views named after them).  It is
written from the query semantics, not from the Spark plans: sliding windows
are enumerated with ``generate_series`` (every window a row belongs to),
sequential rules use a recursive CTE.  Time is epoch-millisecond BIGINT.
"""

from __future__ import annotations

# Shared event model: same mapping as sources/tables.py.
EV = r"""
ev AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value,
         CAST(regexp_extract(props, '"k":\s*(\d+)', 1) AS BIGINT) AS item_id,
         event_id AS seq
  FROM events
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sliding_ends(ts_ms: str, size_ms: int, slide_ms: int) -> str:
    """All window ends of the sliding windows that contain ``ts_ms``."""
    first = f"(({ts_ms} // {slide_ms}) * {slide_ms} + {slide_ms})"
    return f"generate_series({first}, {first} + {size_ms - slide_ms}, {slide_ms})"


def ts_text(ms: str) -> str:
    """java Timestamp text of epoch ms in UTC (significant fraction digits)."""
    ms = f"({ms})"
    frac = f"({ms} % 1000)"
    return (
        f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S') || '.' || "
        f"CASE WHEN {frac} = 0 THEN '0' ELSE rtrim(lpad(CAST({frac} AS VARCHAR), 3, '0'), '0') END"
    )


def bound_text(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y/%m/%d-%H:%M:%S')"


PAGE_VIEWS = _with(EV) + """
SELECT (ts_ms // 3600000) * 3600000 + 3600000 AS window_end, count(*) AS pv
FROM ev WHERE event_type = 'view'
GROUP BY 1
"""

HOT_ITEM_COUNTS = f"""
views AS (SELECT item_id, unnest({sliding_ends('ts_ms', 3_600_000, 300_000)}) AS window_end
          FROM ev WHERE event_type = 'view'),
counts AS (SELECT item_id, window_end, count(*) AS cnt FROM views GROUP BY 1, 2),
ranked AS (SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end
                  ORDER BY cnt DESC, item_id) AS BIGINT) AS rnk, item_id, cnt FROM counts)"""

HOT_ITEMS = _with(EV, HOT_ITEM_COUNTS) + """
SELECT window_end, rnk, item_id, cnt FROM ranked WHERE rnk <= 3
"""

REPORT_RULE = "===================================="

HOT_ITEMS_REPORT = _with(EV, HOT_ITEM_COUNTS) + f"""
SELECT window_end,
       '{REPORT_RULE}' || chr(10) || '时间: ' || {ts_text('window_end')} || chr(10) ||
       string_agg('No' || rnk || ':  商品ID=' || item_id || '  浏览量=' || cnt || chr(10), ''
                  ORDER BY rnk) ||
       '{REPORT_RULE}' || chr(10) || chr(10) AS report
FROM ranked WHERE rnk <= 3
GROUP BY window_end
"""


HOT_URL_COUNTS = f"""
urls AS (SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '[.](css|js)$')),
hits AS (SELECT u.url, unnest({sliding_ends('ev.ts_ms', 600_000, 5_000)}) AS window_end
         FROM ev JOIN urls u ON u.page_id = ev.item_id),
counts AS (SELECT url, window_end, count(*) AS cnt FROM hits GROUP BY 1, 2),
ranked AS (SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end
                  ORDER BY cnt DESC, url) AS BIGINT) AS rnk, url, cnt FROM counts)"""

HOT_URLS = _with(EV, HOT_URL_COUNTS) + """
SELECT window_end, rnk, url, cnt FROM ranked WHERE rnk <= 5
"""

HOT_URLS_REPORT = _with(EV, HOT_URL_COUNTS) + f"""
SELECT window_end,
       '{REPORT_RULE}' || chr(10) || '时间: ' || {ts_text('window_end')} || chr(10) ||
       string_agg('No' || rnk || ':  URL=' || url || '  流量=' || cnt || chr(10), ''
                  ORDER BY rnk) ||
       '{REPORT_RULE}' || chr(10) || chr(10) AS report
FROM ranked WHERE rnk <= 5
GROUP BY window_end
"""

HOUR_END = "((ts_ms // 3600000) * 3600000 + 3600000)"

UNIQUE_VISITORS = _with(EV) + f"""
SELECT {HOUR_END} AS window_end, count(DISTINCT user_id) AS uv
FROM ev WHERE event_type = 'view' GROUP BY 1
"""

POLY_HASH = (
    "list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), "
    "lambda c: CAST(ascii(c) AS BIGINT)), lambda a, c: (a * 61 + c) % 536870912)"
)

UNIQUE_VISITORS_BITMAP = _with(EV) + f"""
SELECT {HOUR_END} AS window_end, CAST(count(DISTINCT {POLY_HASH}) AS BIGINT) AS uv_bitmap
FROM ev WHERE event_type = 'view' GROUP BY 1
"""

UNIQUE_VISITORS_RUNNING = _with(EV) + f"""
, firsts AS (
  SELECT {HOUR_END} AS window_end, user_id, ts_ms, seq,
         row_number() OVER (PARTITION BY {HOUR_END}, user_id ORDER BY ts_ms, seq) AS k
  FROM ev WHERE event_type = 'view')
SELECT window_end, user_id, ts_ms,
       CAST(row_number() OVER (PARTITION BY window_end ORDER BY ts_ms, seq) AS BIGINT) AS uv_running
FROM firsts WHERE k = 1
"""

MARKETING = f"""
mk AS (SELECT CAST(item_id % 6 AS VARCHAR) AS channel, event_type AS behavior,
              unnest({sliding_ends('ts_ms', 3_600_000, 1_000)}) AS end_ms
       FROM ev WHERE event_type <> 'error')"""

MARKETING_BY_CHANNEL = _with(EV, MARKETING) + f"""
SELECT {bound_text('end_ms - 3600000')} AS window_start, {bound_text('end_ms')} AS window_end,
       channel, behavior, count(*) AS cnt
FROM mk GROUP BY end_ms, channel, behavior
"""

MARKETING_TOTAL = _with(EV, MARKETING) + f"""
SELECT {bound_text('end_ms - 3600000')} AS window_start, {bound_text('end_ms')} AS window_end,
       'total' AS channel, 'total' AS behavior, count(*) AS cnt
FROM mk GROUP BY end_ms
"""


def _province_counts(src: str) -> str:
    return f"""
SELECT {bound_text('end_ms')} AS window_end, province, count(*) AS cnt
FROM (SELECT CAST(item_id % 6 AS VARCHAR) AS province,
             unnest({sliding_ends('ts_ms', 3_600_000, 5_000)}) AS end_ms
      FROM {src})
GROUP BY end_ms, province
"""


AD_BY_PROVINCE = _with(EV) + _province_counts("ev")

LIMITED = """
limited AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts_ms // 86400000 ORDER BY ts_ms, seq) AS rn
  FROM ev)"""

AD_LIMITED = _with(EV, LIMITED) + _province_counts("limited WHERE rn <= 2")

AD_BLACKLIST = _with(EV, LIMITED) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, ts_ms // 86400000 AS day,
       'Click over 1 times today.' AS msg
FROM limited WHERE rn = 3
"""

LOGIN_FAILURES = _with(EV) + """
, nxt AS (
  SELECT user_id, ts_ms, event_type, event_id,
         lead(event_type, 1) OVER w AS t2, lead(event_type, 2) OVER w AS t3,
         lead(event_id, 1) OVER w AS e2, lead(event_id, 2) OVER w AS e3,
         lead(ts_ms, 2) OVER w AS ts3
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq))
SELECT user_id, event_id AS first_event_id, e2 AS second_event_id, e3 AS third_event_id
FROM nxt
WHERE event_type = 'error' AND t2 = 'error' AND t3 = 'error' AND ts3 - ts_ms < 259200000
"""

SENSORS = """
sensors AS (SELECT CAST(user_id AS VARCHAR) AS id, ts_ms, seq, value AS temperature FROM ev)"""

SENSOR_REDUCE = _with(EV, SENSORS) + f"""
SELECT id, window_end, min(ts_ms) AS first_ts, min(temperature) AS min_temperature
FROM (SELECT *, unnest({sliding_ends('ts_ms', 43_200_000, 21_600_000)}) AS window_end FROM sensors)
GROUP BY id, window_end
"""

SENSOR_MINMAX = _with(EV, SENSORS) + """
SELECT id, min(temperature) AS min_temperature, max(temperature) AS max_temperature,
       (ts_ms // 21600000) * 21600000 + 21600000 AS window_end
FROM sensors GROUP BY id, window_end
"""

SENSOR_EARLY = _with(EV, SENSORS) + """
, fan AS (
  SELECT id, temperature, (ts_ms // 21600000) * 21600000 + 21600000 AS window_end,
         unnest(generate_series((ts_ms // 3600000) * 3600000 + 3600000,
                                (ts_ms // 21600000) * 21600000 + 21600000, 3600000)) AS pane_end
  FROM sensors)
SELECT id, window_end, pane_end, min(temperature) AS min_temperature,
       max(temperature) AS max_temperature, pane_end = window_end AS is_final
FROM fan GROUP BY id, window_end, pane_end
"""

# The rising rule as a recursive walk over each sensor's rows in (ts, seq) order.
RISING_ALERT = _with(EV, SENSORS).replace("WITH ", "WITH RECURSIVE ", 1) + """
, numbered AS (
  SELECT id, ts_ms, temperature,
         row_number() OVER (PARTITION BY id ORDER BY ts_ms, seq) AS rn,
         count(*) OVER (PARTITION BY id) AS n
  FROM sensors),
walk(id, rn, n, prev, armed, fired) AS (
  SELECT id, rn, n, temperature, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT x.id, x.rn, x.n, x.temperature,
         CASE WHEN x.temperature < w.prev THEN NULL
              WHEN x.temperature > w.prev
                   AND (w.armed IS NULL OR x.ts_ms >= w.armed) THEN x.ts_ms + 86400000
              WHEN w.armed IS NOT NULL AND x.ts_ms >= w.armed THEN NULL
              ELSE w.armed END,
         CASE WHEN w.armed IS NOT NULL AND x.ts_ms >= w.armed THEN w.armed END
  FROM walk w JOIN numbered x ON x.id = w.id AND x.rn = w.rn + 1)
SELECT id, alert_ts,
       '传感器id为: ' || id || '的传感器温度值已经连续1s上升了。' AS msg
FROM (SELECT id, fired AS alert_ts FROM walk WHERE fired IS NOT NULL
      UNION ALL
      SELECT id, armed FROM walk WHERE rn = n AND armed IS NOT NULL)
"""

GATED_READINGS = _with(EV) + """
SELECT r.user_id AS id, r.ts_ms, r.event_id, r.value AS temperature
FROM ev r
WHERE r.event_type <> 'signup'
  AND EXISTS (SELECT 1 FROM ev c
              WHERE c.event_type = 'signup' AND c.user_id = r.user_id
                AND c.ts_ms <= r.ts_ms AND r.ts_ms < c.ts_ms + 21600000)
"""

FREEZING_ALARM = _with(EV, SENSORS) + """
SELECT id, ts_ms, seq, 'Freezing Alarm for ' || id AS msg FROM sensors WHERE temperature < 32.0
"""

LOW_TEMPERATURE_ALARM = _with(EV, SENSORS) + """
SELECT id, ts_ms, seq, '温度小于32度' AS msg FROM sensors WHERE temperature < 1000.0
"""

ARRIVALS = """
arr AS (SELECT *, ts_ms + ((event_id * 7919) % 10007) * 1000 AS arrival_ms FROM ev),
wm AS (SELECT *, max(ts_ms) OVER (ORDER BY arrival_ms, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - 3600000 AS watermark
       FROM arr)"""

LATE_SPLIT = _with(EV, ARRIVALS) + """
SELECT event_id, ts_ms, arrival_ms,
       coalesce(ts_ms < watermark, false) AS is_late,
       CASE WHEN ts_ms < watermark THEN '这个元素迟到了！' END AS side_msg
FROM wm
"""

LATE_REVISION = _with(EV, ARRIVALS) + """
, marked AS (
  SELECT event_type, arrival_ms, seq, (ts_ms // 3600000) * 3600000 + 3600000 AS window_end,
         CASE WHEN watermark IS NULL OR watermark < (ts_ms // 3600000) * 3600000 + 3599999
              THEN 'on_time'
              WHEN watermark < (ts_ms // 3600000) * 3600000 + 3599999 + 7200000 THEN 'late'
              ELSE 'dropped' END AS state
  FROM wm),
on_time AS (SELECT event_type, window_end, count(*) AS n_on FROM marked
            WHERE state = 'on_time' GROUP BY 1, 2),
late AS (SELECT event_type, window_end,
                row_number() OVER (PARTITION BY event_type, window_end ORDER BY arrival_ms, seq) AS firing
         FROM marked WHERE state = 'late')
SELECT event_type, window_end, CAST(0 AS BIGINT) AS firing, n_on AS cnt, false AS is_update
FROM on_time
UNION ALL
SELECT l.event_type, l.window_end, l.firing, coalesce(o.n_on, 0) + l.firing AS cnt,
       coalesce(o.n_on, 0) > 0 OR l.firing > 1 AS is_update
FROM late l LEFT JOIN on_time o USING (event_type, window_end)
"""

WORD_COUNT = r"""
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""


ACTION_LINES = _with(EV) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
       CAST(item_id % 6 AS VARCHAR) AS category_id, event_type AS behavior,
       ts_ms // 1000 AS ts_s, (ts_ms // 1000) * 1000 AS ts_ms
FROM ev
"""

ACTION_LINE_COUNTS = _with(EV) + """
, n AS (SELECT count(*) AS n, count(*) FILTER (event_id % 11 = 0) AS bad FROM ev)
SELECT 'sent' AS output, n - bad AS n FROM n
UNION ALL SELECT 'unsent', bad FROM n
UNION ALL SELECT 'accepted', n - bad FROM n
UNION ALL SELECT 'rejected', 0 FROM n
"""

AD_CLICK_LINES = _with(EV) + f"""
SELECT CAST(item_id % 6 AS VARCHAR) AS province, {HOUR_END} AS window_end, count(*) AS cnt
FROM ev WHERE event_id % 7 <> 0 GROUP BY 1, 2
UNION ALL
SELECT 'rejected', 0, count(*) FROM ev WHERE event_id % 7 = 0
"""

ACCESS_LOG_LINES = _with(EV) + """
SELECT '/p' || item_id || CASE WHEN event_id % 4 = 2 THEN '.css?v=1' ELSE '' END AS url,
       (ts_ms // 86400000) * 86400000 + 86400000 AS window_end, count(*) AS cnt
FROM ev WHERE event_id % 17 <> 0 AND event_id % 3 <> 0 AND event_id % 4 >= 2 GROUP BY 1, 2
UNION ALL
SELECT 'rejected', 0, count(*) FROM ev WHERE event_id % 17 = 0
"""

KEYED_LINES = _with(EV) + f"""
SELECT event_type AS key, {HOUR_END} AS window_end, count(*) AS cnt FROM ev WHERE event_id % 9 <> 0 GROUP BY 1, 2
UNION ALL
SELECT 'rejected', 0, count(*) FROM ev WHERE event_id % 9 = 0
"""

# Stretches by gaps and islands over every window end.
MARKETING_RUNS = _with(EV, MARKETING) + """
, counts AS (SELECT channel, behavior, end_ms, count(*) AS cnt FROM mk GROUP BY ALL),
islands AS (
  SELECT *, end_ms - 1000 * row_number() OVER (PARTITION BY channel, behavior, cnt ORDER BY end_ms) AS island
  FROM counts)
SELECT min(end_ms) AS first_end, max(end_ms) AS last_end, channel, behavior, cnt
FROM islands GROUP BY channel, behavior, cnt, island
"""

LIMITED_PER_AD = """
limited AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id, ts_ms // 86400000 ORDER BY ts_ms, seq) AS rn
  FROM ev)"""

AD_LIMITED_PER_AD = _with(EV, LIMITED_PER_AD) + _province_counts("limited WHERE rn <= 1")

AD_BLACKLIST_PER_AD = _with(EV, LIMITED_PER_AD) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, ts_ms // 86400000 AS day,
       'Click over 0 times today.' AS msg
FROM limited WHERE rn = 2
"""

COOL_ALARM = _with(EV, SENSORS) + """
SELECT id, ts_ms, seq, '温度小于32度' AS msg FROM sensors WHERE temperature < 100.0
"""

def islands(rows: str, by: str, slide_ms: int, keep: str) -> str:
    """Stretches of window ends with equal ``by`` columns, by gaps and islands over every window end."""
    return f"""
, islands AS (
  SELECT *, window_end - {slide_ms} * row_number() OVER (PARTITION BY {by} ORDER BY window_end) AS island FROM {rows})
SELECT min(window_end) AS first_end, max(window_end) AS last_end, {keep} FROM islands GROUP BY {by}, island
"""


HOT_URLS_RUNS = _with(EV, HOT_URL_COUNTS) + """
, top AS (SELECT * FROM ranked WHERE rnk <= 5)""" + islands("top", "rnk, url, cnt", 5_000, "rnk, url, cnt")

UNIQUE_VISITORS_SLIDING = _with(EV) + f"""
SELECT window_end, count(DISTINCT user_id) AS uv
FROM (SELECT user_id, unnest({sliding_ends('ts_ms', 3_600_000, 5_000)}) AS window_end FROM ev WHERE event_type = 'view')
GROUP BY window_end
"""

STATION_MINMAX_RUNS = _with(EV) + f"""
, seen AS (
  SELECT station, window_end, min(value) AS min_temperature, max(value) AS max_temperature
  FROM (SELECT user_id % 16 AS station, value, unnest({sliding_ends('ts_ms', 3_600_000, 1_000)}) AS window_end FROM ev)
  GROUP BY station, window_end)""" + islands(
    "seen", "station, min_temperature, max_temperature", 1_000, "station, min_temperature, max_temperature"
)

AD_ROUTE_COUNTS = _with(EV, LIMITED) + """
SELECT route, count(rn) AS n
FROM (VALUES ('pass'), ('warn'), ('drop')) r(route)
LEFT JOIN limited ON route = CASE WHEN rn <= 2 THEN 'pass' WHEN rn = 3 THEN 'warn' ELSE 'drop' END
GROUP BY route
"""

UNIQUE_VISITORS_BITMAP_DAILY = _with(EV) + f"""
SELECT (ts_ms // 86400000) * 86400000 + 86400000 AS window_end, CAST(count(DISTINCT {POLY_HASH}) AS BIGINT) AS uv_bitmap
FROM ev WHERE event_type = 'view' GROUP BY 1
"""

UNIQUE_VISITORS_BITMAP_SLIDING = _with(EV) + f"""
SELECT window_end, CAST(count(DISTINCT h) AS BIGINT) AS uv_bitmap
FROM (SELECT {POLY_HASH} AS h, unnest({sliding_ends('ts_ms', 21_600_000, 3_600_000)}) AS window_end
      FROM ev WHERE event_type = 'view')
GROUP BY 1
"""

VALUE_QUANTILES = _with(EV) + """
, binned AS (
  SELECT event_type, ts_ms // 86400000 AS day, CAST(floor(value / 5.0) AS BIGINT) AS bin,
         row_number() OVER (PARTITION BY event_type, ts_ms // 86400000 ORDER BY value) AS k,
         count(*) OVER (PARTITION BY event_type, ts_ms // 86400000) AS n
  FROM ev WHERE value IS NOT NULL)
SELECT event_type, day, max(bin) FILTER (k = ceil(0.5 * n)) AS median_bin, max(bin) FILTER (k = ceil(0.95 * n)) AS p95_bin
FROM binned GROUP BY event_type, day
"""

WINDOWED_WORD_COUNT = _with(EV) + r"""
SELECT word, (ts_ms // 10000) * 10000 + 10000 AS window_end, count(*) AS cnt
FROM (SELECT ts_ms, unnest([event_type, 'item' || (item_id % 6)]
        || CASE WHEN event_id % 3 = 0 THEN ['new', 'item0'] ELSE [] END) AS word FROM ev)
GROUP BY 1, 2
"""

STATION_REDUCE_RUNS = _with(EV) + f"""
, seen AS (
  SELECT station, window_end, min(ts_ms) AS first_ts, min(value) AS min_temperature
  FROM (SELECT user_id % 16 AS station, ts_ms, value, unnest({sliding_ends('ts_ms', 3_600_000, 5_000)}) AS window_end FROM ev)
  GROUP BY station, window_end)""" + islands(
    "seen", "station, first_ts, min_temperature", 5_000, "station, first_ts, min_temperature"
)

EVENT_DOCUMENTS = _with(EV) + """
SELECT '{"data":"' || event_type || ':' || item_id || '"}' AS doc FROM ev
"""

PRINTED_WARNINGS = _with(EV, LIMITED) + """
SELECT 'black list> {"user_id":"' || user_id || '","day":' || (ts_ms // 86400000)
       || ',"msg":"Click over 1 times today."}' AS line
FROM limited WHERE rn = 3
"""

ID_STRINGS = "SELECT CAST(event_id AS VARCHAR) AS value FROM events"

# A result of 22.9 M rows at sf0.01; tests compare it with whole-table
# fingerprints, and row by row in the run form (``marketing_runs``).
FINGERPRINT_ONLY = {"marketing_by_channel": MARKETING_BY_CHANNEL}


def oracle_sql() -> dict[str, str]:
    return {
        "page_views": PAGE_VIEWS,
        "hot_items": HOT_ITEMS,
        "hot_items_report": HOT_ITEMS_REPORT,
        "hot_urls": HOT_URLS,
        "hot_urls_report": HOT_URLS_REPORT,
        "unique_visitors": UNIQUE_VISITORS,
        "unique_visitors_bitmap": UNIQUE_VISITORS_BITMAP,
        "unique_visitors_running": UNIQUE_VISITORS_RUNNING,
        "marketing_total": MARKETING_TOTAL,
        "ad_by_province": AD_BY_PROVINCE,
        "ad_limited": AD_LIMITED,
        "ad_blacklist": AD_BLACKLIST,
        "login_failures": LOGIN_FAILURES,
        "sensor_reduce": SENSOR_REDUCE,
        "sensor_minmax": SENSOR_MINMAX,
        "sensor_early": SENSOR_EARLY,
        "rising_alert": RISING_ALERT,
        "gated_readings": GATED_READINGS,
        "freezing_alarm": FREEZING_ALARM,
        "low_temperature_alarm": LOW_TEMPERATURE_ALARM,
        "late_split": LATE_SPLIT,
        "late_revision": LATE_REVISION,
        "word_count": WORD_COUNT,
        "action_lines": ACTION_LINES,
        "action_line_counts": ACTION_LINE_COUNTS,
        "ad_click_lines": AD_CLICK_LINES,
        "access_log_lines": ACCESS_LOG_LINES,
        "keyed_lines": KEYED_LINES,
        "marketing_by_channel": MARKETING_BY_CHANNEL,
        "marketing_runs": MARKETING_RUNS,
        "ad_limited_per_ad": AD_LIMITED_PER_AD,
        "ad_blacklist_per_ad": AD_BLACKLIST_PER_AD,
        "cool_alarm": COOL_ALARM,
        "hot_urls_runs": HOT_URLS_RUNS,
        "unique_visitors_sliding": UNIQUE_VISITORS_SLIDING,
        "station_minmax_runs": STATION_MINMAX_RUNS,
        "ad_route_counts": AD_ROUTE_COUNTS,
        "unique_visitors_bitmap_daily": UNIQUE_VISITORS_BITMAP_DAILY,
        "unique_visitors_bitmap_sliding": UNIQUE_VISITORS_BITMAP_SLIDING,
        "value_quantiles": VALUE_QUANTILES,
        "windowed_word_count": WINDOWED_WORD_COUNT,
        "station_reduce_runs": STATION_REDUCE_RUNS,
        "event_documents": EVENT_DOCUMENTS,
        "printed_warnings": PRINTED_WARNINGS,
        "id_strings": ID_STRINGS,
    }
