"""DuckDB SQL giving the result of each registered query from the same tables."""

from __future__ import annotations

from linewatch.functions.texts import SUMMARY_FIELDS
from linewatch.schemas import TABLES
from testbed.frames import STATUS, WEATHER_WORDS

_WORDS = "[" + ", ".join(f"'{w}'" for w in WEATHER_WORDS) + "]"
_KINDS = ", ".join(f"'{k}'" for k in STATUS)
_STATUS = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items()) + " END"
_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_PART = "CASE WHEN hour(ts) < 12 THEN 'ARRIVAL' ELSE 'DEPARTURE' END"


def _word(index: str) -> str:
    return f"list_extract({_WORDS}, CAST(({index}) % {len(WEATHER_WORDS)} + 1 AS INT))"


def _round(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18, 8)), 2) AS DOUBLE)"


# --- common table expressions, each named after what it stands for -------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(sql: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + sql


cte("stations", """
    SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, 'Line ' || CAST(s_suppkey // 4 AS VARCHAR) AS route
    FROM supplier""")
cte("routes", """
    SELECT 'Line ' || CAST(s_suppkey // 4 AS VARCHAR) AS route, arg_min(r_name, s_suppkey) AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1""")
cte("rail_bronze", f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS kafka_timestamp, CAST({_K} AS VARCHAR) AS train_id,
           date_trunc('second', ts) AS actual_timestamp, CAST(user_id AS VARCHAR) AS loc_stanox,
           date_trunc('second', ts) - to_minutes(CAST(floor(value) AS INT)) AS planned_timestamp,
           {_PART} AS event_type, CAST(floor(value) AS INT) AS delay_minutes,
           {_STATUS} AS variation_status, CAST(CAST(floor(value) AS INT) AS VARCHAR) AS next_report_stanox,
           value, user_id, event_type AS kind
    FROM events WHERE event_type IN ({_KINDS})""")
_CITY_EVENTS = """events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey"""
_MEASURES = f"""value AS temperature, round(value - 2, 2) AS feels_like, {{word}} AS weather_description,
           {_K} AS humidity, {_K} + 950 AS pressure, floor(value) / 10 AS wind_speed,
           CASE WHEN value < 100 THEN floor(value) / 4 END AS wind_gust, {_K} * 3 AS wind_direction"""
cte("weather_bronze", f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS kafka_timestamp, r_name AS city_name,
           date_trunc('second', ts) AS weather_timestamp, {_MEASURES.format(word=_word(_K))},
           round(value - 5, 2) AS temp_min, round(value + 5, 2) AS temp_max,
           {_K} + 1000 AS sea_level, {_K} + 900 AS ground_level
    FROM {_CITY_EVENTS} WHERE event_type = 'view'""")
cte("forecast_bronze", f"""
    SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS kafka_timestamp, r_name AS city_name,
           date_trunc('second', ts) AS forecast_timestamp, date_trunc('second', ts) AS forecast_time,
           {_MEASURES.format(word=_word("CAST(floor(value) AS INT)"))},
           {_K} * 100 AS visibility, round({_K} / 100, 2) AS precipitation_probability
    FROM {_CITY_EVENTS} WHERE event_type = 'click'""")
cte("movements", """
    SELECT * FROM rail_bronze QUALIFY row_number() OVER (
        PARTITION BY train_id, actual_timestamp, loc_stanox ORDER BY kafka_timestamp DESC, event_key DESC) = 1""",
    "rail_bronze")
cte("rail_silver", """
    SELECT m.train_id || '_' || strftime(m.actual_timestamp, '%Y-%m-%d %H:%M:%S') || '_' || m.loc_stanox AS event_id,
           m.train_id, 'S' || m.user_id AS train_service_code, r.city AS city_name, s.route, m.event_type,
           m.variation_status, m.actual_timestamp, m.planned_timestamp, m.delay_minutes, m.loc_stanox,
           s.name AS current_station_name, m.next_report_stanox, n.name AS next_station_name,
           m.value > 200 AS offroute_ind, m.value > 100 AS correction_ind, m.kind = 'signup' AS train_terminated,
           CASE WHEN m.value < 50 THEN true END AS delay_monitoring_point,
           CAST(m.actual_timestamp AS DATE) AS event_date, CAST(hour(m.actual_timestamp) AS INT) AS event_hour
    FROM movements m JOIN stations s ON m.loc_stanox = s.code JOIN routes r ON s.route = r.route
    LEFT JOIN stations n ON m.next_report_stanox = n.code""", "movements", "stations", "routes")
_SILVER_MEASURES = """temperature, feels_like, weather_description, humidity, pressure, wind_speed, wind_gust, wind_direction"""
for _name, _ts, _extra in (("weather", "weather_timestamp", ""), ("forecast", "forecast_timestamp", ", visibility")):
    cte(f"{_name}_silver", f"""
    SELECT city_name || '_' || strftime({_ts}, '%Y-%m-%d %H:%M:%S') AS event_id, city_name, {_ts},
           {_SILVER_MEASURES}{_extra}, CAST({_ts} AS DATE) AS event_date, CAST(hour({_ts}) AS INT) AS event_hour
    FROM {_name}_bronze
    QUALIFY row_number() OVER (PARTITION BY city_name, {_ts} ORDER BY kafka_timestamp DESC, event_key DESC) = 1""",
        f"{_name}_bronze")


def _asof(left: str, right: str, l_ts: str, r_ts: str, span: str, forward: bool, by: str, take: str, keep: str) -> str:
    compare = "<=" if forward else ">="
    inside = f"n.{r_ts} <= n.{l_ts} + {span}" if forward else f"n.{r_ts} >= n.{l_ts} - {span}"
    nulled = ", ".join(f"CASE WHEN {inside} THEN n.{c} END AS {c}" for c in [r_ts, *take.split()])
    return f"""
    SELECT {keep}, {nulled}
    FROM (SELECT l.*, {', '.join('r.' + c for c in [r_ts, *take.split()])}
          FROM {left} l ASOF LEFT JOIN {right} r ON l.{by} = r.{by} AND l.{l_ts} {compare} r.{r_ts}) n"""


_PREFIXED = {
    "weather": ("current", "weather_timestamp", "current_weather_timestamp"),
    "forecast": ("forecast", "forecast_timestamp", "forecast_weather_timestamp"),
}
for _name, (_prefix, _ts, _as) in _PREFIXED.items():
    cte(f"{_name}_near", f"SELECT city_name, {_ts} AS {_as}, " + ", ".join(
        (f"CAST({c} AS VARCHAR)" if c == "wind_direction" else c) + f" AS {_prefix}_{c}"
        for c in _SILVER_MEASURES.split(", ")
    ) + f" FROM {_name}_silver", f"{_name}_silver")
_CURRENT = " ".join("current_" + c for c in _SILVER_MEASURES.split(", "))
_FORECAST = " ".join("forecast_" + c for c in _SILVER_MEASURES.split(", "))
cte("trains_weather", _asof(
    "rail_silver", "weather_near", "actual_timestamp", "current_weather_timestamp", "INTERVAL 30 MINUTE", False,
    "city_name", _CURRENT, "n.* EXCLUDE (current_weather_timestamp, " + ", ".join(_CURRENT.split()) + ")",
), "rail_silver", "weather_near")
cte("trains_forecast", _asof(
    "rail_silver", "forecast_near", "actual_timestamp", "forecast_weather_timestamp", "INTERVAL 3 HOUR", True,
    "city_name", _FORECAST, "n.event_id, n.train_id, n.city_name, n.event_date",
), "rail_silver", "forecast_near")


def _calendar(ts: str) -> str:
    return f"""CAST(hour({ts}) AS INT) AS hour_of_day, dayname({ts}) AS day_of_week,
           dayofweek({ts}) IN (0, 6) AS weekend_flag,
           hour({ts}) BETWEEN 6 AND 9 OR hour({ts}) BETWEEN 16 AND 19 AS is_peak_hour,
           CAST(month({ts}) AS INT) AS month, CAST(year({ts}) AS INT) AS year"""


_FLAGS = """delay_minutes > 5 AND variation_status = 'LATE' AS is_delayed,
           delay_minutes >= 15 AND variation_status = 'LATE' AS is_major_delay,
           variation_status = 'CANCELLED' AS is_cancelled"""
cte("gold_weather", f"""
    SELECT CAST(actual_timestamp AS DATE) AS event_date, event_id, train_id, route, current_station_name, next_station_name, city_name, event_type, offroute_ind,
           train_terminated, variation_status, delay_minutes, actual_timestamp, planned_timestamp,
           current_weather_timestamp, {', '.join(_CURRENT.split())}, {_calendar('actual_timestamp')}, {_FLAGS}
    FROM trains_weather""", "trains_weather")


def _daily(source: str, dims: str) -> str:
    return f"""
    SELECT train_id, {dims}, CAST(actual_timestamp AS DATE) AS date, variation_status,
           max(delay_minutes) AS final_delay_minutes,
           CASE WHEN max(delay_minutes) <= 5 AND variation_status = 'LATE' THEN 'ON_TIME' ELSE 'LATE' END AS train_status
    FROM {source} GROUP BY train_id, {dims}, CAST(actual_timestamp AS DATE), variation_status"""


def _metrics(daily: str, dims: str) -> str:
    return f"""
    SELECT {dims}, date, count(DISTINCT train_id) AS scheduled_trains,
           count(DISTINCT CASE WHEN train_status = 'ON_TIME' THEN train_id END) AS on_time_trains,
           count(DISTINCT CASE WHEN train_status = 'LATE' THEN train_id END) AS late_trains,
           {_round('avg(final_delay_minutes)')} AS avg_delay,
           {_round('''count(DISTINCT CASE WHEN train_status = 'ON_TIME' THEN train_id END)
                      / count(DISTINCT train_id) * 100''')} AS reliability_index
    FROM ({daily}) GROUP BY {dims}, date"""


_STATION, _ROUTE = "current_station_name, event_type", "route"
cte("history_moves", """
    SELECT l_partkey AS train_id, s_name AS current_station_name, n_name AS route, l_linestatus AS event_type,
           date_trunc('year', l_shipdate) AS actual_timestamp,
           CASE l_returnflag WHEN 'R' THEN 'LATE' WHEN 'A' THEN 'EARLY' END AS variation_status,
           CAST(l_quantity AS INT) AS delay_minutes
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
cte("route_metrics", _metrics(_daily("rail_silver", _ROUTE), _ROUTE), "rail_silver")
cte("station_metrics", _metrics(_daily("rail_silver", _STATION), _STATION), "rail_silver")
_METRIC_COLUMNS = [
    ("average_delay", "avg_delay"), ("scheduled_trains", "scheduled_trains"), ("on_time_trains", "on_time_trains"),
    ("late_trains", "late_trains"), ("reliability_index", "reliability_index"),
]
cte("alerts", f"""
    SELECT w.event_id, w.train_id, w.route, w.current_station_name AS current_station,
           w.next_station_name AS next_station, w.city_name, w.event_type,
           CAST(w.actual_timestamp AS DATE) AS event_date, w.variation_status, w.delay_minutes, w.offroute_ind,
           w.train_terminated, w.planned_timestamp, w.actual_timestamp, w.current_weather_timestamp,
           {', '.join('w.' + c for c in _CURRENT.split())},
           f.forecast_weather_timestamp AS forecast_timestamp, {', '.join('f.' + c for c in _FORECAST.split())},
           w.hour_of_day, w.day_of_week, w.weekend_flag, w.is_peak_hour, w.is_cancelled, w.is_delayed, w.is_major_delay,
           {', '.join(f'r.{c} AS route_{n}' for n, c in _METRIC_COLUMNS)},
           {', '.join(f's.{c} AS station_{n}' for n, c in _METRIC_COLUMNS)},
           CAST(NULL AS VARCHAR) AS notification_status, CAST(NULL AS TIMESTAMP) AS notified_at
    FROM gold_weather w LEFT JOIN trains_forecast f ON w.event_id = f.event_id
    LEFT JOIN route_metrics r ON w.route = r.route AND CAST(w.actual_timestamp AS DATE) = r.date
    LEFT JOIN station_metrics s ON w.current_station_name = s.current_station_name AND w.event_type = s.event_type
         AND CAST(w.actual_timestamp AS DATE) = s.date
    WHERE w.is_delayed OR w.is_cancelled OR w.is_major_delay""",
    "gold_weather", "trains_forecast", "route_metrics", "station_metrics")
cte("prefs", """
    SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           ' LINE ' || CAST(c_custkey // 60 AS VARCHAR) || '  ' AS route, lower(s_name) AS station,
           CAST(floor(abs(c_acctbal) / 200) AS INT) AS delay_threshold_minute,
           c_mktsegment <> 'BUILDING' AS notify_delay, c_mktsegment <> 'MACHINERY' AS notify_cancellation,
           c_acctbal > 0 AS is_active
    FROM customer LEFT JOIN supplier ON CAST(floor(c_acctbal / 100) AS BIGINT) = s_suppkey""")
cte("sent", "SELECT CAST(o_orderkey AS VARCHAR) AS event_id FROM orders WHERE o_orderstatus = 'F'")
cte("simple_alerts", f"""
    SELECT CAST(e.event_id AS VARCHAR) AS event_id, 'Line ' || CAST(s_suppkey // 4 AS VARCHAR) AS route,
           s_name AS current_station, {_PART} AS event_type, CAST(ts AS DATE) AS event_date,
           CAST(floor(value) AS INT) AS delay_minutes,
           e.event_type = 'error' AND floor(value) > 5 AS is_delayed,
           e.event_type = 'error' AND floor(value) >= 15 AS is_major_delay,
           e.event_type = 'signup' AS is_cancelled,
           CASE WHEN x.event_id IS NOT NULL THEN 'SENT' END AS notification_status,
           CASE WHEN x.event_id IS NOT NULL THEN ts END AS notified_at
    FROM events e JOIN supplier ON user_id = s_suppkey LEFT JOIN sent x ON CAST(e.event_id AS VARCHAR) = x.event_id
    WHERE e.event_type IN ('error', 'signup')""", "sent")


def _matched(alerts: str) -> str:
    return f"""
    SELECT a.event_id, p.user_id, p.email, p.route, p.station, p.delay_threshold_minute
    FROM {alerts} a JOIN prefs p
      ON (lower(trim(a.route)) = lower(trim(p.route)) OR lower(trim(a.current_station)) = lower(trim(p.station)))
     AND ((a.is_delayed AND p.notify_delay AND p.delay_threshold_minute <= a.delay_minutes)
          OR (a.is_cancelled AND p.notify_cancellation))
    WHERE p.is_active"""


cte("simple_matched", _matched("simple_alerts"), "simple_alerts", "prefs")


def _recent(alerts: str, log: str, columns: str) -> str:
    """Pairs of an alert and one of its latest twenty sent predecessors."""
    return f"""
    SELECT a.event_id AS alert_id, {columns}
    FROM {alerts} a JOIN {log} h ON h.notification_status = 'SENT'
         AND (a.route = h.route OR a.current_station = h.current_station)
         AND h.event_date BETWEEN a.event_date - 7 AND a.event_date
    QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY h.event_date DESC, h.event_id DESC) <= 20"""


# Each phrase's place on the scale (clear 0, few clouds 1, broken clouds 2, mist and fog 3, light rain or
# snow 4, moderate 5, heavy 6, thunderstorm and severe 7; others none), and whether it can disrupt trains:
# rain, snow, storm, fog, ice, high wind, extreme heat or cold, and nothing mild.
_PHRASES = {
    "clear sky": (0, False), "few clouds": (1, False), "scattered clouds": (1, False), "broken clouds": (2, False),
    "overcast clouds": (2, False), "mist": (3, False), "fog": (3, True), "light rain": (4, True), "moderate rain": (5, True),
    "heavy snow": (6, True), "thunderstorm": (7, True), "high wind": (None, True), "light wind": (None, False),
    "wind": (None, False), "cold": (None, False), "mild cold": (None, False), "heat haze": (3, False),
    "light winds, sunny": (0, False), "extreme heat": (None, True), "extreme cold": (None, True), "icy roads": (None, True),
    "heavy rain": (6, True), "light snow": (4, True), "drizzle": (4, True), "sleet": (5, True), "freezing rain": (5, True),
    "hail": (None, True), "tropical storm": (7, True), "dense fog": (3, True), "warm": (None, False), "breezy": (None, False),
    "high winds and rain": (5, True), "overcast, light drizzle": (4, True),
}


def _severity(c: str) -> str:
    ranks = {r: [p for p, (x, _) in _PHRASES.items() if x == r] for r in range(8)}
    return "CASE " + " ".join(f"WHEN {c} IN ({', '.join(map(repr, ps))}) THEN {r}" for r, ps in ranks.items()) + " END"


def _disruptive(c: str) -> str:
    return f"coalesce({c} IN ({', '.join(repr(p) for p, (_, hit) in _PHRASES.items() if hit)}), false)"


def _drafts(alerts: str, matched: str, recent: str) -> str:
    now, later = "a.current_weather_description", "a.forecast_weather_description"
    lo, hi = _severity(now), _severity(later)
    return f"""
    SELECT m.event_id, m.user_id, m.email,
        CASE WHEN a.is_cancelled THEN 'Cancellation on ' || a.route || ' route at ' || a.current_station
             WHEN a.is_major_delay THEN 'Major delay at ' || a.current_station || ': ' || a.delay_minutes || ' min'
             ELSE 'Delay at ' || a.current_station || ': ' || a.delay_minutes || ' min' END AS subject,
        CASE WHEN a.is_cancelled
             THEN 'Your train on the ' || a.route || ' route via ' || a.current_station || ' has been cancelled.'
             ELSE 'The train on the ' || a.route || ' route '
                  || CASE WHEN a.is_major_delay THEN 'had a major delay of ' ELSE 'was delayed by ' END
                  || a.delay_minutes || ' minutes at ' || a.current_station || '.' END
        || ' ' || CASE
             WHEN {_disruptive(now)} THEN 'This may be linked to ' || {now} || ' in the area' || CASE
                  WHEN {hi} < {lo} THEN '; conditions are expected to ease.'
                  WHEN {hi} > {lo} THEN '; conditions are expected to worsen, so plan for possible further delays.'
                  WHEN {hi} = {lo} THEN '; similar conditions are expected to continue.' ELSE '.' END
             WHEN {_disruptive(later)} AND {hi} > {lo}
             THEN 'The cause is unclear, but ' || {later} || ' is forecast and conditions are expected to worsen.'
             ELSE 'The cause is unclear.' END
        || CASE WHEN coalesce({recent}, 0) >= 2
                THEN ' There have been several disruptions on this route or station recently.' ELSE '' END AS message
    FROM {matched} m JOIN {alerts} a ON m.event_id = a.event_id"""


cte("matched", _matched("alerts"), "alerts", "prefs")
cte("marked", """
    SELECT * EXCLUDE (notification_status),
           CASE WHEN hour(actual_timestamp) >= 12 THEN 'SENT' END AS notification_status FROM alerts""", "alerts")
cte("waiting", """
    SELECT * FROM marked WHERE notification_status IS NULL AND event_date >= DATE '2024-01-31' - 7""", "marked")
cte("waiting_matched", _matched("waiting"), "waiting", "prefs")
cte("recent_counts", "SELECT alert_id, count(*) AS n FROM (" + _recent("waiting", "marked", "h.event_id") + ") GROUP BY 1",
    "waiting", "marked")
cte("outbox", """
    SELECT sha256(event_id || '_' || user_id) AS notification_id, event_id, user_id, email, 's' AS subject,
           route AS message
    FROM simple_matched""", "simple_matched")
cte("delivered", """
    SELECT o.notification_id, o.event_id, o.user_id, o.email, CAST(NULL AS VARCHAR) AS route,
           CAST(NULL AS VARCHAR) AS station, o.subject, o.message,
           CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'AUTOMOBILE') THEN 'SENT' ELSE 'FAILED' END AS delivery_status
    FROM outbox o JOIN customer ON o.user_id = CAST(c_custkey AS VARCHAR)""", "outbox")

_WEATHER_OUT = [c for c in TABLES["weather_bronze"] if c not in ("raw_json", "ingest_timestamp")]
_FORECAST_OUT = [c for c in TABLES["forecast_bronze"] if c not in ("raw_json", "ingest_timestamp")]
_HISTORY_OUT = """h.event_id, h.route, h.current_station, h.event_type, h.delay_minutes, h.is_delayed,
           h.is_major_delay, h.is_cancelled, h.event_date, h.notified_at"""
_SIGNED = _daily("history_moves", _ROUTE).replace(
    "max(delay_minutes) <= 5 AND variation_status = 'LATE'",
    "max(delay_minutes) <= 5 AND variation_status = 'LATE' OR variation_status = 'EARLY'",
)
_ITEM_UPSERT = """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_shipdate END AS shipped, l_quantity, l_returnflag
    FROM lineitem WHERE l_returnflag <> '{skip}'
    QUALIFY row_number() OVER (PARTITION BY 1, l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_shipdate END
                               ORDER BY l_quantity DESC, l_returnflag DESC) = 1"""
_LINE_ORDER = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
    l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""


def _event_asof(kind: str, prefix: str, span: str, forward: bool) -> str:
    compare = "<=" if forward else ">="
    inside = f"{prefix}_ts <= ts + {span}" if forward else f"{prefix}_ts >= ts - {span}"
    return f"""
    SELECT event_id, rider, ts, amount, CASE WHEN {inside} THEN {prefix}_ts END AS {prefix}_ts,
           CASE WHEN {inside} THEN {prefix}_amount END AS {prefix}_amount
    FROM (SELECT event_id, user_id AS rider, ts, value AS amount FROM events WHERE event_type IN ({_KINDS})) l
    ASOF LEFT JOIN (SELECT user_id, ts AS {prefix}_ts, max(value) AS {prefix}_amount FROM events
                    WHERE event_type = '{kind}' GROUP BY 1, 2) r
      ON l.rider = r.user_id AND l.ts {compare} r.{prefix}_ts"""


cte("positions", f"""
    SELECT event_id, r_name AS city_name, date_trunc('second', ts) AS actual_timestamp
    FROM {_CITY_EVENTS} WHERE event_type IN ({_KINDS})""")
for _name, _ts, _kind in (("readings", "weather_timestamp", "view"), ("outlooks", "forecast_timestamp", "click")):
    cte(_name, f"""
    SELECT r_name AS city_name, date_trunc('second', ts) AS {_ts}, value AS temperature
    FROM {_CITY_EVENTS} WHERE event_type = '{_kind}'""")
    cte(f"{_name}_unique", f"SELECT city_name, {_ts}, max(temperature) AS temperature FROM {_name} GROUP BY 1, 2", _name)


def _position_asof(right: str, r_ts: str, span: str, forward: bool) -> str:
    return _asof("positions", right, "actual_timestamp", r_ts, span, forward, "city_name", "temperature",
                 "n.event_id, n.city_name, n.actual_timestamp")


ORACLES: dict[str, str] = {
    "scan_events": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "rider_preferences": with_ctes("SELECT * FROM prefs", "prefs"),
    "parse_rail_events": with_ctes("""
        SELECT event_key, kafka_timestamp, train_id, actual_timestamp, loc_stanox, planned_timestamp AS gbtt_timestamp,
               planned_timestamp, 'ARRIVAL' AS planned_event_type, event_type, 'AUTOMATIC' AS event_source,
               CAST(value > 100 AS VARCHAR) AS correction_ind, CAST(value > 200 AS VARCHAR) AS offroute_ind,
               'S' || user_id AS train_service_code, 'D' AS division_code, loc_stanox AS toc_id,
               next_report_stanox AS timetable_variation, variation_status, next_report_stanox,
               CAST(CAST(floor(value / 10) AS INT) AS VARCHAR) AS next_report_run_time,
               CAST(kind = 'signup' AS VARCHAR) AS train_terminated,
               CASE WHEN value < 50 THEN 'true' ELSE '' END AS delay_monitoring_point, loc_stanox AS reporting_stanox,
               'events' AS header_source, kind AS header_type
        FROM rail_bronze""", "rail_bronze"),
    "json_map": with_ctes("""
        SELECT event_key, 'source' AS name, 'events' AS content FROM rail_bronze
        UNION ALL SELECT event_key, 'msg_type', kind FROM rail_bronze""", "rail_bronze"),
    "parse_weather_events": with_ctes(f"SELECT {', '.join(_WEATHER_OUT)} FROM weather_bronze", "weather_bronze"),
    "parse_forecast_events": with_ctes(f"SELECT {', '.join(_FORECAST_OUT)} FROM forecast_bronze", "forecast_bronze"),
    "json_extract": f"SELECT event_id, {_K} AS k FROM events",
    "epoch_to_timestamp": """
        SELECT event_id, date_trunc('second', ts) AS from_millis, date_trunc('second', ts) AS from_seconds FROM events""",
    "parse_timestamp": "SELECT event_id, date_trunc('second', ts) AS parsed FROM events",
    "conform_schema": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INT) AS user_id,
               CAST(trunc(value) AS INT) AS value, CAST(ts AS DATE) AS event_date, event_type,
               CAST(NULL AS DOUBLE) AS props, CAST(NULL AS VARCHAR) AS missing FROM events""",
    "typed_casts": with_ctes("""
        SELECT event_key, value > 100 AS correction_ind, value > 200 AS offroute_ind,
               kind = 'signup' AS train_terminated, CASE WHEN value < 50 THEN true END AS delay_monitoring_point,
               delay_minutes AS timetable_variation, CAST(floor(value / 10) AS INT) AS next_report_run_time,
               CAST(user_id AS INT) AS toc_id FROM rail_bronze""", "rail_bronze"),
    "clean_not_null": with_ctes(
        "SELECT event_key, city_name, wind_gust FROM weather_bronze WHERE wind_gust IS NOT NULL", "weather_bronze"),
    "dedupe_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedupe_latest": f"""
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""",
    "surrogate_key": with_ctes("""
        SELECT event_key, concat_ws('_', train_id, strftime(actual_timestamp, '%Y-%m-%d %H:%M:%S'), loc_stanox) AS event_id
        FROM rail_bronze""", "rail_bronze"),
    "broadcast_left_lookup": with_ctes("""
        SELECT event_key, loc_stanox, name AS current_station_name, route
        FROM rail_bronze LEFT JOIN stations ON loc_stanox = code""", "rail_bronze", "stations"),
    "role_playing_lookup": with_ctes("""
        SELECT event_key, h.name AS current_station_name, n.name AS next_station_name
        FROM rail_bronze LEFT JOIN stations h ON loc_stanox = h.code LEFT JOIN stations n ON next_report_stanox = n.code
        """, "rail_bronze", "stations"),
    "silver_train_events": with_ctes("SELECT * FROM rail_silver", "rail_silver"),
    "silver_weather_current": with_ctes("SELECT * FROM weather_silver", "weather_silver"),
    "silver_weather_forecast": with_ctes("SELECT * FROM forecast_silver", "forecast_silver"),
    "calendar_features": f"SELECT event_id, ts, {_calendar('ts')} FROM events",
    "disruption_flags": f"""
        SELECT *, {_FLAGS} FROM (
            SELECT event_id, CAST(floor(value) AS INT) AS delay_minutes, {_STATUS} AS variation_status FROM events)""",
    "weather_severity": f"""
        SELECT event_id, {_severity('now')} AS severity_now, {_severity('later')} AS severity_later,
               {_disruptive('now')} AS disruptive,
               CASE WHEN {_severity('later')} < {_severity('now')} THEN 'EASE'
                    WHEN {_severity('later')} > {_severity('now')} THEN 'WORSEN'
                    WHEN {_severity('later')} = {_severity('now')} THEN 'PERSIST' END AS trend
        FROM (SELECT event_id, {_word(_K)} AS now, {_word('CAST(floor(value) AS INT)')} AS later FROM events)""",
    "interval_join": with_ctes("""
        SELECT t.event_id, t.city_name, t.actual_timestamp, w.weather_timestamp, w.temperature
        FROM positions t LEFT JOIN readings w ON t.city_name = w.city_name
         AND w.weather_timestamp BETWEEN t.actual_timestamp - INTERVAL 30 MINUTE AND t.actual_timestamp""",
        "positions", "readings"),
    "asof_backward": with_ctes(
        _position_asof("readings_unique", "weather_timestamp", "INTERVAL 30 MINUTE", False), "positions", "readings_unique"),
    "asof_forward": with_ctes(
        _position_asof("outlooks_unique", "forecast_timestamp", "INTERVAL 3 HOUR", True), "positions", "outlooks_unique"),
    "asof_backward_fill": _event_asof("view", "view", "INTERVAL 1 DAY", False),
    "asof_forward_fill": _event_asof("click", "click", "INTERVAL 6 HOUR", True),
    "top1_latest": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "top1_earliest": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "gold_weather_train": with_ctes("SELECT * FROM gold_weather", "gold_weather"),
    "gold_forecast_train": with_ctes("SELECT * FROM trains_forecast", "trains_forecast"),
    "train_daily_status_station": with_ctes(_daily("history_moves", _STATION), "history_moves"),
    "train_daily_status_route": with_ctes(_daily("history_moves", _ROUTE), "history_moves"),
    "station_reliability": with_ctes(_metrics(_daily("history_moves", _STATION), _STATION), "history_moves"),
    "route_reliability": with_ctes(_metrics(_daily("history_moves", _ROUTE), _ROUTE), "history_moves"),
    "route_reliability_signed": with_ctes(_metrics(_SIGNED, _ROUTE), "history_moves"),
    "upsert_single_key": """
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
               coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
               coalesce(s.o_totalprice + 1, t.o_totalprice) AS o_totalprice,
               coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate,
               coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
        FROM (SELECT * FROM orders WHERE o_orderstatus <> 'O') t
        FULL JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') s ON t.o_orderkey = s.o_orderkey""",
    "upsert_out_of_order": """
        WITH s AS (SELECT o_orderkey AS k, o_orderdate + to_days(CAST(o_orderkey % 5 - 2 AS INTEGER)) AS d, o_totalprice + 1 AS p FROM orders WHERE o_orderkey % 3 > 0)
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               CASE WHEN k IS NULL OR (o_orderkey % 7 > 0 AND d < o_orderdate) THEN o_totalprice ELSE p END AS o_totalprice,
               CASE WHEN k IS NULL OR (o_orderkey % 7 > 0 AND d < o_orderdate) THEN o_orderdate ELSE d END AS o_orderdate
        FROM orders LEFT JOIN s ON o_orderkey = k WHERE o_orderkey % 7 > 0 OR k IS NOT NULL""",
    "upsert_by_time": """
        WITH s AS (SELECT o_orderkey AS k, o_orderdate + to_days(CAST(o_custkey % 5 - 2 AS INTEGER)) AS d, o_totalprice + 1 AS p FROM orders WHERE o_orderstatus <> 'F')
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               CASE WHEN k IS NULL OR (o_orderstatus <> 'P' AND d < o_orderdate) THEN o_totalprice ELSE p END AS o_totalprice,
               CASE WHEN k IS NULL OR (o_orderstatus <> 'P' AND d < o_orderdate) THEN o_orderdate ELSE d END AS o_orderdate
        FROM orders LEFT JOIN s ON o_orderkey = k""",
    "upsert_composite_key": f"""
        SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey,
               coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
               coalesce(s.shipped, t.shipped) AS shipped, coalesce(s.l_quantity + 100, t.l_quantity) AS l_quantity,
               coalesce(s.l_returnflag, t.l_returnflag) AS l_returnflag
        FROM ({_ITEM_UPSERT.format(skip='N')}) t FULL JOIN ({_ITEM_UPSERT.format(skip='A')}) s
          ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
         AND t.shipped IS NOT DISTINCT FROM s.shipped""".replace("PARTITION BY 1, ", "PARTITION BY "),
    "mark_notified": with_ctes("""
        SELECT a.* EXCLUDE (notification_status, notified_at),
               CASE WHEN o_orderkey IS NOT NULL THEN 'SENT' ELSE notification_status END AS notification_status,
               CASE WHEN o_orderkey IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE notified_at END AS notified_at
        FROM simple_alerts a
        LEFT JOIN orders ON a.event_id = CAST(o_orderkey AS VARCHAR) AND o_orderstatus = 'O'""", "simple_alerts"),
    "alert_context": with_ctes("SELECT * FROM alerts", "alerts"),
    "pending_alerts": with_ctes("""
        SELECT event_id, event_date, delay_minutes FROM simple_alerts
        WHERE event_date >= DATE '2024-01-31' - 7 AND (is_delayed OR is_cancelled OR is_major_delay)
          AND event_id NOT IN (SELECT event_id FROM sent)""", "simple_alerts"),
    "match_riders": with_ctes("SELECT * FROM simple_matched", "simple_matched"),
    "match_riders_udtf": with_ctes("""
        SELECT user_id, email, route, station, delay_threshold_minute FROM prefs
        WHERE is_active AND notify_delay AND delay_threshold_minute <= 20
          AND (lower(trim(route)) = 'line 3' OR lower(trim(station)) = 'supplier#000000010')""", "prefs"),
    "alert_history": with_ctes(_recent("simple_alerts", "simple_alerts", _HISTORY_OUT), "simple_alerts"),
    "alert_history_udtf": with_ctes(f"""
        SELECT {_HISTORY_OUT} FROM simple_alerts h
        WHERE notification_status = 'SENT' AND (route = 'Line 2' OR current_station = 'Supplier#000000001')
          AND event_date BETWEEN DATE '2024-01-20' - 7 AND DATE '2024-01-20'
        ORDER BY event_date DESC, event_id DESC LIMIT 20""", "simple_alerts"),
    "alert_prompt": with_ctes(
        "SELECT event_id, concat_ws(' ', " + ", ".join(f"'{c}=' || {c}" for c in SUMMARY_FIELDS) + ") AS prompt FROM alerts",
        "alerts"),
    "draft_notifications": with_ctes(_drafts("alerts", "matched", "NULL"), "matched"),
    "extract_drafts": """
        SELECT CAST(o_custkey AS VARCHAR) AS event_id,
               CASE d WHEN 1 THEN CAST(o_custkey AS VARCHAR) ELSE 'second' END AS user_id,
               CASE d WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '@example.com' ELSE '' END AS email,
               o_orderpriority AS subject, 'said "' || o_orderkey || '"' AS message
        FROM (SELECT * FROM orders QUALIFY row_number() OVER (
                  PARTITION BY o_custkey ORDER BY o_orderdate + to_seconds(o_orderkey) DESC) = 1)
        CROSS JOIN (SELECT unnest([1, 2]) AS d)""",
    "outbox_rows": with_ctes("SELECT * FROM outbox", "outbox"),
    "dispatch_outbox": with_ctes(
        "SELECT sha256(event_id || '_' || user_id) AS notification_id, d.* FROM ("
        + _drafts("waiting", "waiting_matched", "(SELECT n FROM recent_counts c WHERE c.alert_id = m.event_id)") + ") d",
        "waiting_matched", "recent_counts"),
    "cursor_append": with_ctes("""
        SELECT event_id FROM sent UNION ALL
        SELECT event_id FROM simple_alerts
        WHERE event_date >= DATE '2024-01-31' - 7 AND (is_delayed OR is_cancelled OR is_major_delay)
          AND event_id NOT IN (SELECT event_id FROM sent)""", "simple_alerts"),
    "delivery_log": with_ctes("SELECT * FROM delivered", "delivered"),
    "delivery_partial": with_ctes(
        "SELECT d.* FROM delivered d JOIN customer ON d.user_id = CAST(c_custkey AS VARCHAR) WHERE c_mktsegment <> 'FURNITURE'", "delivered"),
    "delivery_summary": with_ctes("""
        SELECT event_id, count(*) FILTER (delivery_status = 'SENT') AS sent_count,
               count(*) FILTER (delivery_status = 'FAILED') AS failed_count
        FROM delivered GROUP BY event_id""", "delivered"),
    "tumbling_event_counts": """
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type AS host,
               count(*) AS event_count, count(DISTINCT user_id) AS unique_ips
        FROM events GROUP BY 1, 2, 3""",
    "tumbling_event_counts_stream": """
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type AS host,
               count(*) AS event_count, count(DISTINCT user_id) AS unique_ips
        FROM events GROUP BY 1, 2, 3
        HAVING window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "geo_enrich": """
        SELECT event_id, user_id AS ip, n_name AS country, r_name AS region, c_mktsegment AS city,
               CAST(c_acctbal AS VARCHAR) AS latitude, CAST(c_nationkey AS VARCHAR) AS longitude
        FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
}
ORACLES["asof_backward_range"] = ORACLES["asof_backward"]
ORACLES["asof_forward_range"] = ORACLES["asof_forward"]
ORACLES["unique_surrogate_key"] = r"""
    SELECT event_id, replace(replace(event_type || CASE WHEN user_id % 2 = 0 THEN '_' ELSE '\' END, '\', '\\'), '_', '\_')
           || '_' || rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')
           || '_' || CASE WHEN value > 20 THEN CAST(user_id AS VARCHAR) ELSE '\N' END AS id
    FROM events"""
ORACLES["delivery_outcomes"] = with_ctes("""
    SELECT notification_id, c_mktsegment IN ('BUILDING', 'MACHINERY') AS delivered,
           1 + CAST(c_mktsegment <> 'FURNITURE' AS BIGINT) + CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS attempts,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN TIMESTAMP '2024-02-03 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS attempted_at
    FROM outbox JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)""", "outbox")
ORACLES["locate_by_range"] = """
    WITH r AS (
        SELECT c_custkey AS a, c_custkey + CAST(floor(c_acctbal / 100) AS BIGINT) AS b, c_name AS holder, c_mktsegment AS kind FROM customer
        UNION ALL SELECT s_suppkey * 64, s_suppkey * 64 + 63, s_name, NULL FROM supplier
    ), e AS (SELECT event_id, user_id * 40 + CAST(floor(value) AS BIGINT) AS address FROM events)
    SELECT event_id, address, holder, kind FROM e LEFT JOIN r ON address BETWEEN a AND b
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY b - a, a DESC, holder, kind) = 1"""
# merged from parts, but the same metrics
for _name in ("station_reliability", "route_reliability"):
    ORACLES[f"{_name}_merged"] = ORACLES[_name]
ORACLES["route_reliability_merged_signed"] = ORACLES["route_reliability_signed"]
