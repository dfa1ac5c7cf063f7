"""Offsets, rolling values, baselines, as-of and interval joins, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import times as tm
from panelforge.operators import features as ft, joins as jn, panel as pn, timeseries as ts
from workload import derive as dv
from workload.registry import pick, query, tidy

KEYS = "city segment_id time_bucket"
LAGS = " ".join([f"speed_lag_{k}" for k in range(1, 13)] + [f"congestion_lag_{k}" for k in range(1, 13)])


def _shifted(n: int, name: str, source: str) -> str:
    """Correlated value of the same series n hours later (negative = earlier)."""
    return f"(SELECT b.{source} FROM based b WHERE b.city = a.city AND b.segment_id = a.segment_id AND b.time_bucket = a.time_bucket + to_hours({n})) AS {name}"


LAG_SQL = ", ".join(
    [_shifted(-k, f"speed_lag_{k}", "currentSpeed") for k in range(1, 13)] + [_shifted(-k, f"congestion_lag_{k}", "congestion_ratio") for k in range(1, 13)]
)
LAGGED = dv.BASED + f", lagged AS (SELECT a.*, {LAG_SQL} FROM based a)"
SPEED_LAGS = lambda n: [f"speed_lag_{k}" for k in range(1, n + 1)]
HORIZONS = (60, 180, 240)


def lagged(spark, sf):
    return ts.add_exact_lags(dv.based(spark, sf), dv.BUCKET)


@query("exact_lags", f"""WITH {LAGGED}, t AS (SELECT *, speed_lag_1 - speed_lag_2 AS speed_trend_1, speed_lag_2 - speed_lag_3 AS speed_trend_2,
    speed_lag_1 - 2 * speed_lag_2 + speed_lag_3 AS speed_acceleration FROM lagged)
    SELECT {pick(KEYS, LAGS + ' speed_trend_1 speed_trend_2 speed_acceleration')} FROM t""")
def exact_lags(spark, sf):
    return tidy(lagged(spark, sf).select(*KEYS.split(), *LAGS.split(), "speed_trend_1", "speed_trend_2", "speed_acceleration"))


@query("exact_targets", f"""WITH {dv.BASED}, t AS (SELECT a.*, {', '.join(_shifted(h // 60, f'future_speed_{h}m', 'currentSpeed') for h in HORIZONS)} FROM based a)
    SELECT {pick(KEYS, ' '.join(f'future_speed_{h}m' for h in HORIZONS))}, {', '.join(f'(future_speed_{h}m IS NOT NULL)::INTEGER AS has_exact_target_{h}m' for h in HORIZONS)} FROM t""")
def exact_targets(spark, sf):
    out = ts.add_exact_targets(dv.based(spark, sf), HORIZONS)
    return tidy(out.select(*KEYS.split(), *[f"future_speed_{h}m" for h in HORIZONS], *[f"has_exact_target_{h}m" for h in HORIZONS]))


def _avg(names: list[str]) -> str:
    return "(" + " + ".join(names) + f") / {len(names)}.0::DOUBLE"


def _std(names: list[str]) -> str:
    m = _avg(names)
    return "sqrt((" + " + ".join(f"({n} - {m}) * ({n} - {m})" for n in names) + f") / {len(names) - 1}.0::DOUBLE)"


ROLL = "speed_rolling_avg_15m speed_rolling_avg_30m speed_rolling_avg_60m congestion_rolling_avg_15m congestion_rolling_avg_30m congestion_rolling_avg_60m speed_volatility_15m speed_volatility_30m"
VALID = "valid_history_15m valid_history_30m valid_history_60m"
SPANS = {"15m": 3, "30m": 6, "60m": 12}
ROLL_SQL = ", ".join(
    [f"{_avg(SPEED_LAGS(n))} AS speed_rolling_avg_{s}" for s, n in SPANS.items()]
    + [f"{_avg([x.replace('speed', 'congestion') for x in SPEED_LAGS(n)])} AS congestion_rolling_avg_{s}" for s, n in SPANS.items()]
    + [f"{_std(SPEED_LAGS(SPANS[s]))} AS speed_volatility_{s}" for s in ("15m", "30m")]
    + [f"({' AND '.join(f'{x} IS NOT NULL' for x in SPEED_LAGS(n))})::INTEGER AS valid_history_{s}" for s, n in SPANS.items()]
)


@query("past_rolling", f"WITH {LAGGED}, t AS (SELECT *, {ROLL_SQL} FROM lagged) SELECT {pick(KEYS + ' ' + VALID, ROLL)} FROM t")
def past_rolling(spark, sf):
    return tidy(ts.add_past_rolling(lagged(spark, sf)).select(*KEYS.split(), *VALID.split(), *ROLL.split()))


RANGE_COLS = "speed_rolling_avg_60m speed_rolling_avg_180m speed_rolling_avg_360m congestion_rolling_avg_60m congestion_rolling_avg_180m congestion_rolling_avg_360m speed_volatility_180m"


@query("range_rolling", f"""WITH {dv.BASED}, t AS (SELECT *, {', '.join(
    f"avg({c}) OVER (PARTITION BY city, segment_id ORDER BY time_bucket RANGE BETWEEN INTERVAL {m} MINUTES PRECEDING AND CURRENT ROW) AS {n}_rolling_avg_{m}m"
    for m in (60, 180, 360) for c, n in (('currentSpeed', 'speed'), ('congestion_ratio', 'congestion')))},
    coalesce(stddev_samp(currentSpeed) OVER (PARTITION BY city, segment_id ORDER BY time_bucket RANGE BETWEEN INTERVAL 180 MINUTES PRECEDING AND CURRENT ROW), 0) AS speed_volatility_180m FROM based)
    SELECT {pick(KEYS, RANGE_COLS)} FROM t""")
def range_rolling(spark, sf):
    return tidy(ts.add_range_rolling(dv.based(spark, sf), (60, 180, 360)).select(*KEYS.split(), *RANGE_COLS.split()))


ROW_LAGS = "speed_lag_1 speed_lag_2 speed_lag_3 speed_lag_4 congestion_lag_1 congestion_lag_2 speed_trend_1 speed_trend_2 speed_acceleration"


@query("row_lags", f"""WITH {dv.BASED}, l AS (SELECT *, {', '.join(f'lag(currentSpeed, {k}) OVER w AS l{k}' for k in range(1, 5))}, lag(congestion_ratio, 1) OVER w AS c1, lag(congestion_ratio, 2) OVER w AS c2
    FROM based WINDOW w AS (PARTITION BY city, segment_id ORDER BY time_bucket)), t AS (SELECT *, {', '.join(f'coalesce(l{k}, 0) AS speed_lag_{k}' for k in range(1, 5))},
    coalesce(c1, 0) AS congestion_lag_1, coalesce(c2, 0) AS congestion_lag_2, coalesce(currentSpeed - l1, 0) AS speed_trend_1, coalesce(l1 - l2, 0) AS speed_trend_2,
    coalesce(currentSpeed - l1 - (l1 - l2), 0) AS speed_acceleration FROM l) SELECT {pick(KEYS, ROW_LAGS)} FROM t""")
def row_lags(spark, sf):
    return tidy(ts.add_row_lags(dv.based(spark, sf)).select(*KEYS.split(), *ROW_LAGS.split()))


@query("row_leads", f"""WITH {dv.BASED}, t AS (SELECT *, lead(currentSpeed, 1) OVER w AS future_speed_60m, lead(currentSpeed, 4) OVER w AS future_speed_240m FROM based
    WINDOW w AS (PARTITION BY city, segment_id ORDER BY time_bucket)) SELECT {pick(KEYS, 'future_speed_60m future_speed_240m')} FROM t WHERE future_speed_60m IS NOT NULL OR future_speed_240m IS NOT NULL""")
def row_leads(spark, sf):
    out = ts.add_row_leads(dv.based(spark, sf), {60: 1, 240: 4})
    return tidy(out.select(*KEYS.split(), "future_speed_60m", "future_speed_240m"))


@query("gap_flags", f"""WITH {dv.PANEL}, t AS (SELECT *, epoch(time_bucket - lag(time_bucket) OVER (PARTITION BY city, segment_id ORDER BY time_bucket)) / 60.0 AS time_gap_minutes FROM panel)
    SELECT {pick(KEYS, 'time_gap_minutes')}, CASE WHEN time_gap_minutes = 60 THEN 1 ELSE 0 END AS has_previous_exact_bucket, CASE WHEN time_gap_minutes > 60 THEN 1 ELSE 0 END AS has_large_gap_before FROM t""")
def gap_flags(spark, sf):
    out = dv.panel(spark, sf).withColumns(ts.gap_columns(60))
    return tidy(out.select(*KEYS.split(), "time_gap_minutes", "has_previous_exact_bucket", "has_large_gap_before"))


BASELINE = """, baseline AS (SELECT city, segment_id, hour_of_day, day_of_week, quantile_cont(currentSpeed, 0.15) AS p15, quantile_cont(currentSpeed, 0.5) AS p50, quantile_cont(currentSpeed, 0.85) AS p85
  FROM based GROUP BY ALL)"""


@query("percentile_baseline", f"WITH {dv.BASED}{BASELINE} SELECT {pick('city segment_id hour_of_day day_of_week', 'p15 p50 p85')} FROM baseline")
def percentile_baseline(spark, sf):
    return tidy(ts.percentile_baseline(dv.based(spark, sf)))


COMPARE = "p15 p50 p85 baseline_congestion_ratio speed_vs_p15 speed_vs_p50 speed_vs_p85 speed_percentile_position"
COMPARE_FLAGS = "is_below_p15 is_above_p85 is_between_p15_p50 is_anomaly_vs_baseline"
CLAMP = lambda x: f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {x}))"


@query("baseline_compare", f"""WITH {dv.BASED}{BASELINE}, t AS (SELECT a.*, p15, p50, p85, {CLAMP('1.0::DOUBLE - p50 / freeFlowSpeed')} AS baseline_congestion_ratio, currentSpeed - p15 AS speed_vs_p15,
    currentSpeed - p50 AS speed_vs_p50, currentSpeed - p85 AS speed_vs_p85, CASE WHEN abs(p85 - p15) > 0 THEN {CLAMP('(currentSpeed - p15) / (p85 - p15)')} ELSE 0.5 END AS speed_percentile_position,
    (currentSpeed < p15)::INTEGER AS is_below_p15, (currentSpeed > p85)::INTEGER AS is_above_p85, (currentSpeed >= p15 AND currentSpeed <= p50)::INTEGER AS is_between_p15_p50,
    (currentSpeed < p15 OR currentSpeed > p85)::INTEGER AS is_anomaly_vs_baseline FROM based a JOIN baseline USING (city, segment_id, hour_of_day, day_of_week))
    SELECT {pick(KEYS + ' ' + COMPARE_FLAGS, COMPARE)} FROM t""")
def baseline_compare(spark, sf):
    return tidy(ts.add_baseline(dv.based(spark, sf)).select(*KEYS.split(), *COMPARE_FLAGS.split(), *COMPARE.split()))


WEATHER_COLS = ["temp", "humidity", "rain_1h", "visibility", "wind_speed"]


@query("asof_backward", f"""WITH {dv.PANEL}, {dv.WEATHER} SELECT p.city, p.segment_id, p.time_bucket, round(w.temp, 6) + 0.0 AS temp, round(w.rain_1h, 6) + 0.0 AS rain_1h FROM panel p LEFT JOIN weather w
    ON w.city = p.city AND w.weather_cell_id = p.weather_cell_id AND w.time_bucket = (SELECT max(x.time_bucket) FROM weather x WHERE x.city = p.city AND x.weather_cell_id = p.weather_cell_id
      AND x.time_bucket <= p.time_bucket AND x.time_bucket >= p.time_bucket - INTERVAL 6 HOURS)""")
def asof_backward(spark, sf):
    out = jn.asof_backward(dv.panel(spark, sf), dv.weather(spark, sf), ["city", "weather_cell_id"], "time_bucket", ["temp", "rain_1h"], 6 * 3600)
    return tidy(out.select(*KEYS.split(), "temp", "rain_1h"))


FALLBACK = """, pooled AS (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY city, time_bucket ORDER BY weather_cell_id DESC) = 1),
own AS (SELECT p.*, EXISTS (SELECT 1 FROM weather k WHERE k.city = p.city AND k.weather_cell_id = p.weather_cell_id) AS known,
  (SELECT max(x.time_bucket) FROM weather x WHERE x.city = p.city AND x.weather_cell_id = p.weather_cell_id AND x.time_bucket <= p.time_bucket AND x.time_bucket >= p.time_bucket - INTERVAL 6 HOURS) AS t1,
  (SELECT max(x.time_bucket) FROM pooled x WHERE x.city = p.city AND x.time_bucket <= p.time_bucket AND x.time_bucket >= p.time_bucket - INTERVAL 6 HOURS) AS t2 FROM panel p),
joined AS (SELECT o.city, o.segment_id, o.time_bucket, coalesce(w.temp, q.temp) AS weather_temperature, coalesce(w.rain_1h, q.rain_1h) AS weather_rain_1h, coalesce(w.visibility, q.visibility) AS weather_visibility
  FROM own o LEFT JOIN weather w ON o.known AND w.city = o.city AND w.weather_cell_id = o.weather_cell_id AND w.time_bucket = o.t1
  LEFT JOIN pooled q ON NOT o.known AND q.city = o.city AND q.time_bucket = o.t2)"""


@query("asof_backward_fallback", f"""WITH {dv.PANEL}, {dv.WEATHER}{FALLBACK} SELECT {pick(KEYS, 'weather_temperature weather_rain_1h weather_visibility')}, (coalesce(weather_rain_1h, 0) > 0.1)::INTEGER AS has_rain,
    CASE WHEN coalesce(weather_visibility, 10000) < 1000 THEN 3 WHEN coalesce(weather_rain_1h, 0) > 10 THEN 2 WHEN coalesce(weather_rain_1h, 0) > 0.1 THEN 1 ELSE 0 END AS weather_severity FROM joined""")
def asof_backward_fallback(spark, sf):
    out = ft.add_weather(dv.panel(spark, sf), dv.weather(spark, sf), 360)
    return tidy(out.select(*KEYS.split(), "weather_temperature", "weather_rain_1h", "weather_visibility", "has_rain", "weather_severity"))


def _pooled(spark, sf):
    w = dv.weather(spark, sf)
    return jn.one_per_instant(w, ["city"], "time_bucket", ["temp", "rain_1h", "weather_cell_id"], "weather_cell_id")


NEAREST = """, pooled AS (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY city, time_bucket ORDER BY weather_cell_id DESC) = 1),
near AS (SELECT p.city, p.segment_id, p.time_bucket, w.temp, w.weather_cell_id AS matched_cell, abs(epoch(p.time_bucket) - epoch(w.time_bucket)) / 60.0 AS time_diff_minutes
  FROM panel p JOIN pooled w ON w.city = p.city AND w.time_bucket BETWEEN p.time_bucket - INTERVAL 180 MINUTES AND p.time_bucket + INTERVAL 180 MINUTES
  QUALIFY row_number() OVER (PARTITION BY p.city, p.segment_id, p.time_bucket ORDER BY abs(epoch(p.time_bucket) - epoch(w.time_bucket)), w.time_bucket) = 1)"""


def nearest(spark, sf):
    panel = dv.panel(spark, sf).drop("weather_cell_id")
    right = _pooled(spark, sf).withColumnRenamed("weather_cell_id", "matched_cell")
    return jn.asof_nearest(panel, right, ["city"], "time_bucket", ["temp", "matched_cell"], 180 * 60)


@query("asof_nearest", f"WITH {dv.PANEL}, {dv.WEATHER}{NEAREST} SELECT {pick(KEYS + ' matched_cell', 'temp time_diff_minutes')} FROM near")
def asof_nearest(spark, sf):
    return tidy(nearest(spark, sf).select(*KEYS.split(), "matched_cell", "temp", "time_diff_minutes"))


@query("match_gap", f"WITH {dv.PANEL}, {dv.WEATHER}{NEAREST} SELECT count(*) AS matched, round(avg(time_diff_minutes), 6) + 0.0 AS mean_gap_minutes FROM near")
def match_gap(spark, sf):
    return tidy(nearest(spark, sf).agg(F.count(F.lit(1)).alias("matched"), F.avg("time_diff_minutes").alias("mean_gap_minutes")))


@query("latest_weather_join", f"""WITH {dv.PANEL}, {dv.WEATHER}, n AS (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY city ORDER BY time_bucket DESC, weather_cell_id DESC) = 1)
    SELECT p.city, segment_id, p.time_bucket, round(coalesce(n.temp, 0), 6) + 0.0 AS weather_temperature, round(coalesce(n.rain_1h, 0), 6) + 0.0 AS weather_rain_1h,
    (coalesce(n.rain_1h, 0) > 0.1)::INTEGER AS has_rain FROM panel p LEFT JOIN n ON n.city = p.city""")
def latest_weather_join(spark, sf):
    out = ft.add_latest_weather(dv.panel(spark, sf), dv.weather(spark, sf))
    return tidy(out.select(*KEYS.split(), "weather_temperature", "weather_rain_1h", "has_rain"))


WITHIN = lambda back, ahead: f"e.city = g.city AND e.event_time BETWEEN g.time_bucket - INTERVAL {back} HOURS AND g.time_bucket + INTERVAL {ahead} HOURS"
KINDS = ("accident", "flood", "roadwork", "event")
NEARBY = f""", grid AS (SELECT DISTINCT city, time_bucket FROM panel),
nearby AS (SELECT g.city, g.time_bucket, {', '.join(f"coalesce(max((e.event_type = '{k}')::INTEGER), 0) AS has_{k}" for k in KINDS)},
  {', '.join(f"coalesce(max(e.severity) FILTER (e.event_type = '{k}' AND e.event_time <= g.time_bucket), 0) AS max_{k}_severity_1h" for k in KINDS)}
  FROM grid g LEFT JOIN road_events e ON {WITHIN(1, 1)} GROUP BY g.city, g.time_bucket)"""
NEARBY_COLS = [f"has_{k}" for k in KINDS] + [f"max_{k}_severity_1h" for k in KINDS]


@query("interval_join", f"""WITH {dv.PANEL}, {dv.ROAD_EVENTS}{NEARBY} SELECT p.city, p.segment_id, p.time_bucket, {', '.join(NEARBY_COLS)}, greatest(has_accident, has_flood, has_roadwork, has_event) AS has_any_event
    FROM panel p JOIN nearby n ON n.city = p.city AND n.time_bucket = p.time_bucket""")
def interval_join(spark, sf):
    out = ft.nearby_events(dv.panel(spark, sf), dv.road_events(spark, sf), 3600)
    return out.select(*KEYS.split(), *NEARBY_COLS, "has_any_event")


@query("max_severity_1h", f"""WITH {dv.PANEL}, {dv.ROAD_EVENTS}, grid AS (SELECT DISTINCT city, time_bucket FROM panel)
    SELECT g.city, g.time_bucket, max(e.severity) AS max_event_severity_1h FROM grid g LEFT JOIN road_events e ON {WITHIN(1, 0)} GROUP BY g.city, g.time_bucket""")
def max_severity_1h(spark, sf):
    return jn.window_aggregates(
        dv.panel(spark, sf), dv.road_events(spark, sf), ["city"], "time_bucket", "event_time", 3600, {}, {"max_event_severity_1h": (F.col("severity"), 3600, 0)}
    )


CATEGORY_MAP = "CASE event_type WHEN 'roadwork' THEN 'roadwork_active' WHEN 'event' THEN 'congestion' WHEN 'other' THEN 'weather_disruption' ELSE event_type END"


def categorized(spark, sf):
    kind = F.col("event_type")
    category = F.when(kind == "roadwork", "roadwork_active").when(kind == "event", "congestion").when(kind == "other", "weather_disruption").otherwise(kind)
    return dv.road_events(spark, sf).withColumns({"event_category": category, "severity_score": F.col("severity")}).withColumnRenamed("event_time", "event_time_start")


def _count(hours: int, cond: str = "true") -> str:
    return f"count(*) FILTER (e.event_time >= g.time_bucket - INTERVAL {hours} HOURS AND {cond})"


WINDOWS = f"""cat AS (SELECT *, {CATEGORY_MAP} AS c FROM road_events WHERE is_relevant_for_traffic_model = 1), grid AS (SELECT DISTINCT city, time_bucket FROM panel),
win AS (SELECT g.city, g.time_bucket, {_count(1)} AS news_event_count_1h, {_count(3)} AS news_event_count_3h, {_count(6)} AS news_event_count_6h, {_count(1, "c = 'accident'")} AS accident_count_1h,
  {_count(1, "c = 'congestion'")} AS congestion_news_count_1h, {_count(24, "c IN ('roadwork_active', 'roadwork_planned')")} AS roadwork_count_24h,
  {_count(6, "c IN ('weather_disruption', 'flood')")} AS weather_disruption_count_6h, {_count(6, "c = 'flood'")} AS flood_count_6h,
  coalesce(max(severity) FILTER (e.event_time >= g.time_bucket - INTERVAL 1 HOURS), 0) AS max_event_severity_1h, coalesce(max(severity) FILTER (e.event_time >= g.time_bucket - INTERVAL 6 HOURS), 0) AS max_event_severity_6h,
  coalesce(avg(traffic_relevance_score) FILTER (e.event_time >= g.time_bucket - INTERVAL 6 HOURS), 0) AS avg_traffic_relevance_score_6h
  FROM grid g LEFT JOIN cat e ON e.city = g.city AND e.event_time <= g.time_bucket AND e.event_time >= g.time_bucket - INTERVAL 24 HOURS GROUP BY g.city, g.time_bucket),
winf AS (SELECT *, (accident_count_1h > 0)::INTEGER AS has_recent_accident, (roadwork_count_24h > 0)::INTEGER AS has_recent_roadwork, (flood_count_6h > 0)::INTEGER AS has_recent_flood,
  (max_event_severity_6h >= 4)::INTEGER AS has_major_event, (weather_disruption_count_6h > 0)::INTEGER AS has_weather_disruption FROM win)"""
WIN_EXACT = [c for c in ft.EVENT_NUMBERS if c != "avg_traffic_relevance_score_6h"]


@query("event_windows", f"""WITH {dv.PANEL}, {dv.ROAD_EVENTS}, {WINDOWS} SELECT p.city, p.segment_id, p.time_bucket, {pick(' '.join(WIN_EXACT), 'avg_traffic_relevance_score_6h')}
    FROM panel p JOIN winf w ON w.city = p.city AND w.time_bucket = p.time_bucket""")
def event_windows(spark, sf):
    out = ft.event_windows(pn.bucket_grid(dv.panel(spark, sf)), categorized(spark, sf), 3600)
    return tidy(out.select(*KEYS.split(), *WIN_EXACT, "avg_traffic_relevance_score_6h"))


@query("event_feature_merge", f"""WITH {dv.PANEL}, {dv.ROAD_EVENTS}, {WINDOWS} SELECT p.city, p.segment_id, p.time_bucket, coalesce(has_recent_accident, 0) AS has_accident, coalesce(has_recent_flood, 0) AS has_flood,
    coalesce(has_recent_roadwork, 0) AS has_roadwork, (coalesce(news_event_count_6h, 0) > 0)::INTEGER AS has_any_event, coalesce(max_event_severity_1h, 0) AS max_event_severity_1h
    FROM panel p LEFT JOIN winf w ON w.city = p.city AND w.time_bucket = p.time_bucket AND hour(p.time_bucket) < 12""")
def event_feature_merge(spark, sf):
    panel = ft.add_placeholders(dv.panel(spark, sf))
    events = ft.event_windows(pn.bucket_grid(dv.panel(spark, sf)), categorized(spark, sf), 3600).filter(F.hour("time_bucket") < 12)
    return ft.merge_events(panel, events).select(*KEYS.split(), "has_accident", "has_flood", "has_roadwork", "has_any_event", "max_event_severity_1h")


@query("segment_dim_join", f"""WITH {dv.PANEL}, {dv.DIMENSION}, j AS (SELECT p.*, coalesce(road_class, 'unknown') AS road_class, coalesce(district, 'unknown') AS district, coalesce(length_m, 100) AS length_m,
    coalesce(speed_limit, 50) AS speed_limit FROM panel p LEFT JOIN dimension d ON d.segment_id = p.segment_id)
    SELECT {pick(KEYS + ' road_class district', 'length_m speed_limit')}, CASE road_class WHEN 'motorway' THEN 5 WHEN 'trunk' THEN 4 WHEN 'primary' THEN 3 WHEN 'secondary' THEN 2 WHEN 'residential' THEN 1 ELSE 0 END AS road_class_encoded,
    (length_m < 50)::INTEGER AS is_short_segment, CASE WHEN speed_limit >= 80 THEN 3 WHEN speed_limit >= 50 THEN 2 WHEN speed_limit >= 30 THEN 1 ELSE 0 END AS speed_limit_encoded,
    CASE WHEN lat > 20.8 AND lon > 105.8 THEN 1 WHEN lat > 20.8 AND lon <= 105.8 THEN 2 WHEN lat <= 20.8 AND lon > 105.8 THEN 3 ELSE 4 END AS direction_quadrant FROM j""")
def segment_dim_join(spark, sf):
    out = ft.add_segment_dimension(dv.panel(spark, sf), dv.road_dimension(spark, sf))
    return tidy(out.select(*KEYS.split(), "road_class", "district", "length_m", "speed_limit", "road_class_encoded", "is_short_segment", "speed_limit_encoded", "direction_quadrant"))


@query("district_density", f"""WITH {dv.PANEL}, {dv.DIMENSION}, j AS (SELECT p.city, p.segment_id, p.time_bucket, coalesce(district, 'unknown') AS district FROM panel p LEFT JOIN dimension d ON d.segment_id = p.segment_id)
    SELECT *, count(*) OVER (PARTITION BY city, district) AS district_segment_count FROM j""")
def district_density(spark, sf):
    out = ft.add_district_density(ft.add_segment_dimension(dv.panel(spark, sf), dv.road_dimension(spark, sf)))
    return out.select(*KEYS.split(), "district", "district_segment_count")


@query("stats_lookup_join", f"""WITH {dv.BASED}, s AS (SELECT segment_id, hour_of_day, day_of_week, quantile_cont(currentSpeed, 0.15) AS p15, quantile_cont(currentSpeed, 0.5) AS p50, quantile_cont(currentSpeed, 0.85) AS p85
    FROM based WHERE hour_of_day % 3 <> 0 GROUP BY ALL), t AS (SELECT a.*, coalesce(p15, 20) AS p15, coalesce(p50, 30) AS p50, coalesce(p85, 40) AS p85 FROM based a LEFT JOIN s USING (segment_id, hour_of_day, day_of_week)),
    u AS (SELECT *, CASE WHEN p50 > 0 THEN 1.0::DOUBLE - freeFlowSpeed * 0.8::DOUBLE / p50 ELSE 0.5 END AS baseline_congestion_ratio, CASE WHEN currentSpeed <= p15 THEN 0.0 WHEN currentSpeed >= p85 THEN 1.0 ELSE (currentSpeed - p15) / (p85 - p15) END AS speed_percentile_position FROM t)
    SELECT {pick(KEYS, 'p15 p50 p85 baseline_congestion_ratio speed_percentile_position')}, (currentSpeed >= p15 AND currentSpeed < p50)::INTEGER AS is_between_p15_p50, (abs(currentSpeed - p50) > 2 * p50)::INTEGER AS is_anomaly_vs_baseline FROM u""")
def stats_lookup_join(spark, sf):
    panel = dv.based(spark, sf)
    stats = ts.percentile_baseline(panel.filter(F.col("hour_of_day") % 3 != 0), ["segment_id", "hour_of_day", "day_of_week"])
    out = ft.add_stats_lookup(panel, stats)
    return tidy(out.select(*KEYS.split(), "p15", "p50", "p85", "baseline_congestion_ratio", "speed_percentile_position", "is_between_p15_p50", "is_anomaly_vs_baseline"))


CENTRAL = """central AS (SELECT 'S' || s_suppkey AS segment_id, (s_suppkey % 10)::DOUBLE / 10 AS degree_centrality, (s_suppkey % 7)::DOUBLE / 7 AS betweenness_centrality, (s_suppkey % 3)::DOUBLE / 3 AS closeness_centrality FROM supplier WHERE s_suppkey % 4 <> 0)"""


def centrality(spark, sf):
    k = F.col("s_suppkey")
    return dv.table(spark, sf, "supplier").filter(k % 4 != 0).select(
        F.concat(F.lit("S"), k.cast("string")).alias("segment_id"), (k % 10 / 10).alias("degree_centrality"), (k % 7 / 7).alias("betweenness_centrality"), (k % 3 / 3).alias("closeness_centrality")
    )


@query("centrality_features", f"""WITH {dv.PANEL}, {CENTRAL}, j AS (SELECT p.city, p.segment_id, p.time_bucket, coalesce(degree_centrality, 0.5::DOUBLE) AS d, coalesce(betweenness_centrality, 0.5::DOUBLE) AS b, coalesce(closeness_centrality, 0.5::DOUBLE) AS c
    FROM panel p LEFT JOIN central x ON x.segment_id = p.segment_id) SELECT city, segment_id, time_bucket, CASE WHEN d > 0.7::DOUBLE THEN 2 WHEN d > 0.3::DOUBLE THEN 1 ELSE 0 END AS degree_centrality_encoded,
    CASE WHEN b > 0.7::DOUBLE THEN 2 WHEN b > 0.3::DOUBLE THEN 1 ELSE 0 END AS betweenness_centrality_encoded, round(0.4::DOUBLE * d + 0.4::DOUBLE * b + 0.2::DOUBLE * c, 6) + 0.0 AS network_importance_score FROM j""")
def centrality_features(spark, sf):
    out = ft.add_centrality(dv.panel(spark, sf), centrality(spark, sf))
    return tidy(out.select(*KEYS.split(), "degree_centrality_encoded", "betweenness_centrality_encoded", "network_importance_score"))


@query("centrality_absent", f"WITH {dv.PANEL} SELECT city, segment_id, time_bucket, 1 AS degree_centrality_encoded, 0.5 AS network_importance_score FROM panel")
def centrality_absent(spark, sf):
    out = ft.add_centrality(dv.panel(spark, sf), None)
    return tidy(out.select(*KEYS.split(), "degree_centrality_encoded", "network_importance_score"))


@query("anti_existing", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def anti_existing(spark, sf):
    known = dv.table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return jn.not_yet_known(dv.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), known, "o_orderkey")


@query("placeholder_columns", f"WITH {dv.PANEL} SELECT city, segment_id, time_bucket, 0 AS has_accident, 0.0 AS length_m, 0 AS max_event_severity_1h, 7 AS is_holiday_vn FROM panel")
def placeholder_columns(spark, sf):
    out = ft.add_placeholders(dv.panel(spark, sf).withColumn("is_holiday_vn", F.lit(7)))
    return out.select(*KEYS.split(), "has_accident", "length_m", "max_event_severity_1h", "is_holiday_vn")


HOLIDAYS = ", ".join(f"'{d}'" for d in tm.HOLIDAYS)


@query("calendar_features", f"""SELECT event_id, hour(ts) AS hour_of_day, isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month, month(ts) AS month_of_year, week(ts) AS week_of_year, strftime(ts, '%Y-%m-%d') AS date,
    (isodow(ts) >= 6)::INTEGER AS is_weekend, (hour(ts) IN (7, 8, 9, 16, 17, 18, 19))::INTEGER AS is_peak_hour, (hour(ts) IN (7, 8, 9, 11, 12, 13, 17, 18, 19))::INTEGER AS is_lake_peak_hour,
    (strftime(ts, '%Y-%m-%d') IN ({HOLIDAYS}))::INTEGER AS is_holiday_vn FROM events""")
def calendar_features(spark, sf):
    t = F.col("ts")
    lake = tm.calendar(t, tm.LAKE_PEAK_HOURS)["is_peak_hour"].alias("is_lake_peak_hour")
    return dv.table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in tm.calendar(t).items()], lake, tm.is_holiday(t).alias("is_holiday_vn"))


@query("cyclic_time", """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos,
    round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_cos FROM events""")
def cyclic_time(spark, sf):
    (hs, hc), (ds, dc) = tm.cyclic(F.hour("ts"), 24), tm.cyclic(F.weekday("ts"), 7)
    return tidy(dv.table(spark, sf, "events").select("event_id", hs.alias("hour_sin"), hc.alias("hour_cos"), ds.alias("dow_sin"), dc.alias("dow_cos")))


@query("bucket_floors", """SELECT event_id, time_bucket(INTERVAL '25 minutes', ts, TIMESTAMP '1970-01-01') AS by_epoch, date_trunc('hour', ts) + to_minutes(25 * (minute(ts) // 25)) AS within_hour,
    date_trunc('second', ts + INTERVAL 7 HOURS) AS shifted FROM events""")
def bucket_floors(spark, sf):
    t = F.col("ts")
    return dv.table(spark, sf, "events").select(
        "event_id", tm.floor_bucket(t, 25).alias("by_epoch"), tm.floor_within_hour(t, 25).alias("within_hour"), tm.shift_hours(t).cast("timestamp_ntz").alias("shifted")
    )


@query("local_time_parse", """SELECT event_id, CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 2 = 0 THEN date_trunc('second', ts) + INTERVAL 7 HOURS ELSE date_trunc('second', ts) + INTERVAL 5 HOURS END AS local_time FROM events""")
def local_time_parse(spark, sf):
    n = F.col("event_id")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(n % 10 == 3, "not a time").when(n % 2 == 0, F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("+02:00")))
    return dv.table(spark, sf, "events").select("event_id", tm.local_wall_time(raw).alias("local_time"))


@query("freshness_age", "SELECT event_id, greatest(0, floor(epoch(TIMESTAMP '2024-01-15 00:00:00'))::BIGINT - floor(epoch(ts))::BIGINT) AS age_seconds FROM events")
def freshness_age(spark, sf):
    at = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return dv.table(spark, sf, "events").select("event_id", tm.freshness_seconds(F.col("ts"), at).alias("age_seconds"))
