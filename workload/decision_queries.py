"""Risk, alerts, hotspots, graph, map and scenario queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import geo, numeric as nm, scoring as sc, times as tm
from panelforge.operators import graph as gr, panel as pn, timeseries as ts
from panelforge.plans import dashboards as db
from workload import derive as dv
from workload.registry import query, tidy
from workload.series_queries import BASELINE, LAGGED

C01 = lambda x: f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {x}))"
# Context columns of the newest rows, derived from the row itself.
CONTEXT = f"""{dv.PANEL}, ctx AS (SELECT *, (source_rows % 4)::DOUBLE * 9 AS weather_rain_1h, (source_rows % 3)::DOUBLE AS weather_severity, (source_rows % 2)::INTEGER AS has_rain,
  (hour(time_bucket) % 8)::DOUBLE AS max_event_severity_1h, (hour(time_bucket) % 2)::DOUBLE AS accident_count_1h, (hour(time_bucket) % 3)::DOUBLE AS news_event_count_1h, currentSpeed * (51.3::DOUBLE + hour(time_bucket)) / 103.7::DOUBLE AS predicted_speed FROM panel),
clatest AS (SELECT * FROM ctx QUALIFY row_number() OVER (PARTITION BY city, segment_id ORDER BY timestamp DESC) = 1)"""


def context(spark, sf):
    h, n = F.hour("time_bucket"), F.col("source_rows")
    return dv.panel(spark, sf).withColumns(
        {
            "weather_rain_1h": (n % 4).cast("double") * 9, "weather_severity": (n % 3).cast("double"), "has_rain": (n % 2).cast("int"),
            "max_event_severity_1h": (h % 8).cast("double"), "accident_count_1h": (h % 2).cast("double"), "news_event_count_1h": (h % 3).cast("double"),
            "predicted_speed": F.col("currentSpeed") * (h + 51.3) / 103.7,
        }
    )


LEVEL = lambda x: f"CASE WHEN {x} >= 80 THEN 'critical' WHEN {x} >= 60 THEN 'high' WHEN {x} >= 30 THEN 'medium' ELSE 'low' END"


def risk_parts(pred: str, rain: str = "weather_rain_1h", weather: str = "weather_severity", event: str = "max_event_severity_1h", news: str = "news_event_count_1h") -> dict[str, str]:
    return {
        "congestion_ratio": C01("1.0::DOUBLE - currentSpeed / freeFlowSpeed"),
        "prediction_drop_ratio": f"CASE WHEN currentSpeed > 0 THEN {C01(f'(currentSpeed - ({pred})) / currentSpeed')} ELSE 0 END",
        "rain_severity": C01(f"({rain}) / 30.0::DOUBLE + ({weather}) / 10.0::DOUBLE"),
        "event_severity": C01(f"({event}) / 10.0::DOUBLE + accident_count_1h * 0.25::DOUBLE + ({news}) * 0.08::DOUBLE"),
    }


WEIGHT = {"congestion_ratio": 0.35, "prediction_drop_ratio": 0.25, "rain_severity": 0.10, "event_severity": 0.10}


def risk_sql(pred: str, **kw: str) -> str:
    return "(" + " + ".join(f"({e}) * {WEIGHT[n]}::DOUBLE" for n, e in risk_parts(pred, **kw).items()) + ") * 100"


RULES = lambda pred: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN ({e}) >= 0.5 THEN '{n}' END" for n, e in risk_parts(pred).items()) + "], lambda r: r IS NOT NULL), ',')"


@query("segment_risk", f"""WITH {CONTEXT}, r AS (SELECT city, segment_id, time_bucket, round({risk_sql('currentSpeed')}, 3) AS risk_score, {RULES('currentSpeed')} AS rules, {', '.join(f'round({e}, 4) + 0.0 AS {n}' for n, e in risk_parts('currentSpeed').items())} FROM ctx)
    SELECT *, {LEVEL('risk_score')} AS risk_level FROM r""")
def segment_risk(spark, sf):
    """Risk of every panel row, not only of the newest one."""
    rows = context(spark, sf).withColumn("r", db._risk(context(spark, sf)))
    parts = [(F.col("r.components")[n] + F.lit(0.0)).alias(n) for n in WEIGHT]
    return rows.select("city", "segment_id", "time_bucket", "r.risk_score", F.array_join("r.triggered_rules", ",").alias("rules"), *parts, "r.risk_level")


HOT = f"""hot AS (SELECT *, CASE WHEN currentSpeed > 0 THEN (currentSpeed - predicted_speed) / currentSpeed * 100 ELSE 0 END AS d, predicted_speed / freeFlowSpeed AS q,
  greatest(least(1.0::DOUBLE, accident_count_1h * 0.45::DOUBLE + news_event_count_1h * 0.15::DOUBLE + max_event_severity_1h / 10.0::DOUBLE), least(1.0::DOUBLE, weather_severity / 10.0::DOUBLE + CASE WHEN has_rain > 0 AND (weather_rain_1h >= 10 OR weather_severity >= 2) THEN 0.35::DOUBLE ELSE 0 END)) AS c FROM {{src}}),
hs AS (SELECT *, round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN predicted_speed < 20 THEN 35 ELSE 0 END + CASE WHEN q < 0.5 THEN 25 ELSE 0 END + CASE WHEN d > 30 THEN 20 ELSE 0 END + {C01('jamFactor / 10')} * 10 + c * 10)), 2) AS risk_score FROM hot)"""
HOT_LEVEL = "CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high' WHEN risk_score >= 30 THEN 'medium' ELSE 'low' END"
HOT_RULES = "concat_ws(', ', CASE WHEN predicted_speed < 20 THEN 'predicted_speed_below_20' END, CASE WHEN q < 0.5 THEN 'predicted_speed_below_half_free_flow' END, CASE WHEN d > 30 THEN 'speed_drop_above_30pct' END, CASE WHEN jamFactor / 10 >= 0.6 THEN 'current_jam_factor_high' END, CASE WHEN c > 0 THEN 'context_risk_signal_present' END)"


# A factor on the jam keeps two-decimal scores away from rounding ties, where engines may differ.
SCALED = "(SELECT * REPLACE (jamFactor * 0.9973::DOUBLE AS jamFactor) FROM ctx)"


@query("hotspot_risk", f"WITH {CONTEXT}, {HOT.format(src=SCALED)} SELECT city, segment_id, time_bucket, round(d, 3) + 0.0 AS speed_drop_pct, round(q, 4) + 0.0 AS predicted_free_flow_ratio, risk_score + 0.0 AS risk_score, {HOT_LEVEL} AS risk_level, {HOT_RULES} AS reason FROM hs")
def hotspot_risk(spark, sf):
    rows = context(spark, sf).withColumn("jamFactor", F.col("jamFactor") * 0.9973)
    names = ("weather_rain_1h", "weather_severity", "has_rain", "news_event_count_1h", "accident_count_1h", "max_event_severity_1h")
    ctx = sc.context_risk(*[F.col(n) for n in names])
    risk = sc.hotspot_risk(F.col("currentSpeed"), F.col("predicted_speed"), F.col("freeFlowSpeed"), F.col("jamFactor"), ctx)
    out = rows.withColumn("r", risk).select("city", "segment_id", "time_bucket", "r.speed_drop_pct", "r.predicted_free_flow_ratio", "r.risk_score", "r.risk_level", "r.reason")
    return tidy(out)


@query("predicted_hotspots", f"""WITH {CONTEXT}, {HOT.format(src='clatest')} SELECT segment_id, city, round(currentSpeed, 3) AS current_speed, round(predicted_speed, 3) AS predicted_speed, risk_score + 0.0 AS risk_score, {HOT_LEVEL} AS risk_level, {HOT_RULES} AS reason,
    0.8 AS feature_coverage_ratio FROM hs WHERE risk_score >= 30""")
def predicted_hotspots(spark, sf):
    latest = pn.latest_by_segment(context(spark, sf))
    predictions = latest.select("segment_id", "predicted_speed", F.lit(10).alias("required_feature_count"), F.lit(8).alias("available_feature_count"), F.lit("carry").alias("model_name"))
    out = db.predicted_hotspots(latest.drop("predicted_speed"), predictions, "15m")
    return tidy(out.select("segment_id", "city", "current_speed", "predicted_speed", "risk_score", "risk_level", "reason", "feature_coverage_ratio"))


@query("reliability", """WITH p AS (SELECT event_id, 20 AS req, (event_id % 21)::INTEGER AS avail, ['15m', '60m', '240m', '999m'][event_id % 4 + 1] AS horizon, event_id % 11 = 0 AS fb, value,
      CASE WHEN event_id % 13 <> 0 THEN (epoch(TIMESTAMP '2024-01-30 23:59:59')::BIGINT - floor(epoch(ts))::BIGINT) // 500 END AS age FROM events),
    q AS (SELECT *, avail / req::DOUBLE AS cov, CASE horizon WHEN '15m' THEN 5.0::DOUBLE WHEN '60m' THEN 7.5::DOUBLE WHEN '240m' THEN 12.0::DOUBLE ELSE 8.0::DOUBLE END AS base FROM p)
    SELECT event_id, round(cov, 4) + 0.0 AS feature_coverage_ratio, CASE WHEN fb OR cov < 0.7::DOUBLE OR age > 3600 THEN 'low' WHEN cov < 0.9::DOUBLE OR age IS NULL OR age > 600 THEN 'medium' ELSE 'high' END AS reliability_level,
    round(greatest(0.0::DOUBLE, value - (base + (1 - cov) * base + CASE WHEN fb THEN base ELSE 0 END)), 3) + 0.0 AS band_low, round(value + base + (1 - cov) * base + CASE WHEN fb THEN base ELSE 0 END, 3) + 0.0 AS band_high FROM q""")
def reliability(spark, sf):
    e = F.col("event_id")
    age = F.when(e % 13 != 0, F.floor((tm.epoch(F.lit("2024-01-30 23:59:59").cast("timestamp_ntz")) - tm.epoch(F.col("ts"))) / 500))
    horizon = F.element_at(F.array(*[F.lit(h) for h in ("15m", "60m", "240m", "999m")]), (e % 4 + 1).cast("int"))
    r = sc.reliability(F.lit(20), (e % 21).cast("int"), age, horizon, F.col("value"), e % 11 == 0)
    return tidy(dv.table(spark, sf, "events").select("event_id", r.alias("r")).select("event_id", "r.*"), 4)


@query("prediction_table", f"""WITH {CONTEXT}, a AS (SELECT *, floor(epoch(TIMESTAMP '2024-01-31'))::BIGINT - floor(epoch(timestamp))::BIGINT AS age, (6 + hour(time_bucket) % 5) / 10.0::DOUBLE AS cov FROM ctx)
    SELECT city, segment_id, time_bucket, greatest(age, 0) AS data_freshness_seconds, round(cov, 4) + 0.0 AS feature_coverage_ratio, CASE WHEN cov < 0.7::DOUBLE OR age > 3600 THEN 'low' WHEN cov < 0.9::DOUBLE OR age > 600 THEN 'medium' ELSE 'high' END AS reliability_level,
    round(greatest(0.0::DOUBLE, predicted_speed - (7.5::DOUBLE + (1 - cov) * 7.5::DOUBLE)), 3) + 0.0 AS band_low, round(predicted_speed + 7.5::DOUBLE + (1 - cov) * 7.5::DOUBLE, 3) + 0.0 AS band_high FROM a""")
def prediction_table(spark, sf):
    rows = context(spark, sf).select(
        "city", "segment_id", "time_bucket", "predicted_speed", F.col("timestamp").alias("latest_timestamp"), F.lit(10).alias("required_feature_count"),
        (F.hour("time_bucket") % 5 + 6).alias("available_feature_count"), F.lit(False).alias("is_fallback"),
    )
    out = db.with_reliability(rows, "60m", F.lit("2024-01-31").cast("timestamp_ntz"))
    return tidy(out.select("city", "segment_id", "time_bucket", "data_freshness_seconds", "feature_coverage_ratio", "reliability_level", "band_low", "band_high"), 4)


ALERTS = f"""WITH {LAGGED}{BASELINE}, j AS (SELECT l.*, p15, p50, l.currentSpeed * 0.8::DOUBLE AS pred FROM lagged l JOIN baseline b USING (city, segment_id, hour_of_day, day_of_week)),
v AS (SELECT *, CASE WHEN speed_lag_1 > 0 AND speed_lag_1 - currentSpeed > 20 THEN 'MEDIUM' WHEN pred < p15 * 0.8::DOUBLE THEN 'CRITICAL' WHEN pred < p50 * 0.7::DOUBLE THEN 'HIGH' WHEN pred < p50 * 0.9::DOUBLE THEN 'MEDIUM' WHEN pred < p50 THEN 'LOW' END AS severity FROM j)"""


def _alerts(spark, sf):
    panel = ts.add_baseline(ts.exact_offsets(dv.based(spark, sf), {"speed_lag_1": ("currentSpeed", -60)}))
    return db.rule_alerts(panel.withColumn("predicted_speed_15m", F.col("currentSpeed") * 0.8), F.lit("2024-02-01").cast("timestamp_ntz"))


@query("alert_rules", ALERTS + " SELECT segment_id || '_' || strftime(time_bucket, '%Y%m%d%H%M%S') AS alert_id, city, severity, round(pred, 6) + 0.0 AS predicted_speed, round(p50, 6) + 0.0 AS baseline_p50 FROM v WHERE severity IS NOT NULL")
def alert_rules(spark, sf):
    return tidy(_alerts(spark, sf).select("alert_id", "city", "severity", "predicted_speed", "baseline_p50"))


@query("alert_counts", ALERTS + " SELECT severity, count(*) AS alerts FROM v WHERE severity IS NOT NULL GROUP BY severity")
def alert_counts(spark, sf):
    return _alerts(spark, sf).groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))


@query("active_alerts", f"""WITH {dv.PANEL} SELECT 'alert_' || city || '_' || segment_id AS alert_id, CASE WHEN jamFactor >= 8 THEN 'CRITICAL' WHEN jamFactor >= 6 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, round(currentSpeed, 2) AS predicted_speed,
    CASE WHEN jamFactor >= 6 THEN 'Prioritize monitoring this corridor and suggest an alternative route.' ELSE 'Monitor the segment and keep route alternatives ready.' END AS recommended_action,
    printf('Jam factor %.1f; speed %.1f km/h versus baseline %.1f km/h', jamFactor, currentSpeed, freeFlowSpeed) AS reason, timestamp AS created_at FROM latest WHERE jamFactor >= 3 ORDER BY jamFactor DESC, city, segment_id LIMIT 50""")
def active_alerts(spark, sf):
    return db.active_alerts(dv.panel(spark, sf), 50).select("alert_id", "severity", "predicted_speed", "recommended_action", "reason", "created_at")


@query("alert_by_id", f"WITH {dv.PANEL} SELECT 'alert_' || city || '_' || segment_id AS alert_id, timestamp AS created_at FROM latest WHERE segment_id = (SELECT min(segment_id) FROM latest WHERE jamFactor >= 3)")
def alert_by_id(spark, sf):
    panel = dv.panel(spark, sf)
    worst = db.active_alerts(panel).orderBy("segment_id").select("alert_id").first()[0]
    return db.alert_by_id(panel, worst).select("alert_id", "created_at")


@query("prefix_hotspots", f"""WITH {dv.PANEL}, g AS (SELECT city, substr(coalesce(segment_name, segment_id), 1, 6) AS x, * EXCLUDE (city) FROM latest WHERE jamFactor >= 3) SELECT city, coalesce(segment_name, segment_id) AS cluster, round(avg(lat), 6) AS center_lat, round(avg(lon), 6) AS center_lon,
    count(DISTINCT segment_id) AS num_segments, round(avg(greatest(0, freeFlowSpeed - currentSpeed)), 3) AS avg_congestion, round(avg(jamFactor), 2) AS avg_jam_factor, max(timestamp) AS detected_at,
    CASE WHEN avg(jamFactor) >= 8 THEN 'critical' WHEN avg(jamFactor) >= 6 THEN 'high' ELSE 'medium' END AS severity FROM g GROUP BY city, coalesce(segment_name, segment_id)""")
def prefix_hotspots(spark, sf):
    return db.current_hotspots(dv.panel(spark, sf)).drop("radius_km")


@query("corridor_rank", f"""WITH {CONTEXT}, r AS (SELECT city, segment_id, jamFactor, round({risk_sql('currentSpeed')}, 3) AS risk FROM clatest) SELECT city AS corridor_id, round(avg(risk), 3) AS risk_score, 'low' AS risk_level, round(max(jamFactor), 2) AS max_jam_factor, count(DISTINCT segment_id) AS segment_count
    FROM r GROUP BY city ORDER BY avg(risk) DESC, city LIMIT 10""")
def corridor_rank(spark, sf):
    return db.corridor_rank(context(spark, sf))


SCENARIOS = [("storm", 30.0, "none", False), ("crash", 0.0, "accident", True), ("flooding", 55.0, "flood", True), ("works", 0.0, "roadwork", False)]
WET, HIT = "rain > 0", "ev IN ('accident', 'flood', 'roadwork')"
CHANGED = dict(
    rain=f"CASE WHEN {WET} THEN rain ELSE weather_rain_1h END", weather=f"CASE WHEN {WET} THEN greatest(weather_severity, least(10.0::DOUBLE, rain / 3.0::DOUBLE)) ELSE weather_severity END",
    event=f"CASE WHEN {HIT} THEN greatest(max_event_severity_1h, 7) ELSE max_event_severity_1h END", news=f"CASE WHEN {HIT} THEN greatest(news_event_count_1h, 1) ELSE news_event_count_1h END",
)


@query("scenario_impact", f"""WITH {CONTEXT}, s(name, rain, ev, peak) AS (VALUES {', '.join(f"('{n}', {r}::DOUBLE, '{e}', {p})" for n, r, e, p in SCENARIOS)}),
    x AS (SELECT c.*, s.*, round(predicted_speed * CASE WHEN rain > 0 THEN greatest(0.65::DOUBLE, 1.0::DOUBLE - least(rain, 40) * 0.008::DOUBLE) ELSE 1 END * CASE ev WHEN 'accident' THEN 0.72::DOUBLE WHEN 'flood' THEN 0.78::DOUBLE WHEN 'roadwork' THEN 0.86::DOUBLE ELSE 1 END
      * CASE WHEN peak THEN 0.9::DOUBLE ELSE 1 END, 3) AS sim FROM clatest c, s)
    SELECT city, segment_id, name AS scenario, round(predicted_speed, 3) + 0.0 AS baseline_speed, sim + 0.0 AS simulated_speed, round(sim - predicted_speed, 3) + 0.0 AS speed_delta,
    round({risk_sql('predicted_speed')}, 3) + 0.0 AS baseline_risk, round({risk_sql('sim', **CHANGED)}, 3) + 0.0 AS simulated_risk, {LEVEL('round(' + risk_sql('sim', **CHANGED) + ', 3)')} AS simulated_level FROM x""")
def scenario_impact(spark, sf):
    scenarios = spark.createDataFrame(SCENARIOS, "name string, rain_1h_mm double, event_type string, is_peak_hour boolean")
    out = db.scenario_impact(pn.latest_by_segment(context(spark, sf)), scenarios)
    return tidy(out.select("city", "segment_id", "scenario", "baseline_speed", "simulated_speed", "speed_delta", "baseline_risk", "simulated_risk", "simulated_level"), 3)


@query("upstream_edges", f"""WITH {dv.PANEL}, w AS (SELECT * FROM latest), e AS (SELECT city, segment_id AS upstream, lead(segment_id) OVER (PARTITION BY city ORDER BY jamFactor DESC, segment_id) AS downstream FROM w)
    SELECT * FROM e WHERE downstream IS NOT NULL""")
def upstream_edges(spark, sf):
    return gr.upstream_edges(pn.latest_by_segment(dv.panel(spark, sf)))


@query("upstream_walk", f"""WITH RECURSIVE {dv.PANEL}, e AS (SELECT city, segment_id AS upstream, lead(segment_id) OVER (PARTITION BY city ORDER BY jamFactor DESC, segment_id) AS downstream FROM latest),
    walk(segment_id, hop) AS (SELECT segment_id, 0 FROM (SELECT segment_id FROM latest WHERE city = 'hanoi' ORDER BY jamFactor, segment_id DESC LIMIT 1) UNION ALL SELECT e.upstream, hop + 1 FROM walk JOIN e ON e.downstream = walk.segment_id WHERE hop < 3)
    SELECT segment_id, min(hop)::INTEGER AS hop FROM walk GROUP BY segment_id""")
def upstream_walk(spark, sf):
    latest = pn.latest_by_segment(dv.panel(spark, sf))
    start = latest.filter("city = 'hanoi'").orderBy("jamFactor", F.desc("segment_id")).limit(1).collect()[0]["segment_id"]
    return gr.upstream_walk(gr.upstream_edges(latest), start, 3)


@query("propagation", f"""WITH {CONTEXT}, w AS (SELECT *, row_number() OVER (ORDER BY jamFactor DESC, city, segment_id) AS rn FROM clatest), r AS (SELECT segment_id, ((rn - 1) * 500)::INTEGER AS distance_m, round(jamFactor, 2) AS jam_factor, round({risk_sql('currentSpeed')}, 3) AS risk_score FROM w WHERE rn <= 4)
    SELECT *, round((SELECT avg(risk_score) FROM r), 3) AS propagation_score FROM r""")
def propagation(spark, sf):
    return db.propagation(context(spark, sf), 3).select("segment_id", "distance_m", "jam_factor", "risk_score", "propagation_score")


@query("upstream_chain", f"""WITH {dv.PANEL}, w AS (SELECT *, row_number() OVER (ORDER BY jamFactor DESC, city, segment_id) AS rn FROM latest) SELECT segment_id, round(currentSpeed, 2) AS speed_kmh, CASE WHEN jamFactor >= 6 THEN 'congested' WHEN jamFactor >= 3 THEN 'slow' ELSE 'free' END AS status,
    (rn * 500)::INTEGER AS distance_m FROM w WHERE rn <= 4""")
def upstream_chain(spark, sf):
    return db.upstream_chain(dv.panel(spark, sf))


CYCLE = (1, 2, 2, 3, 4)


@query("interleave_priority", f"""WITH p AS (SELECT p_partkey, p_size % 4 + 1 AS priority, row_number() OVER (PARTITION BY p_size % 4 + 1 ORDER BY p_partkey) - 1 AS k FROM part),
    s AS (SELECT *, CASE priority WHEN 2 THEN k // 2 * 5 + 1 + k % 2 ELSE k * 5 + CASE priority WHEN 1 THEN 0 WHEN 3 THEN 3 ELSE 4 END END AS slot FROM p)
    SELECT p_partkey, priority::INTEGER AS priority, row_number() OVER (ORDER BY slot)::INTEGER AS position FROM s ORDER BY slot LIMIT 250""")
def interleave_priority(spark, sf):
    rows = dv.table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 4 + 1).cast("int").alias("priority"))
    return gr.interleave(rows, "priority", ["p_partkey"], CYCLE, 250)


@query("haversine_km", """SELECT a.s_suppkey AS s_suppkey, round(2 * 6371.0::DOUBLE * asin(sqrt(sin(radians(la2 - la1) / 2) ^ 2 + cos(radians(la1)) * cos(radians(la2)) * sin(radians(lo2 - lo1) / 2) ^ 2)), 6) + 0.0 AS km FROM (SELECT s_suppkey, (s_suppkey % 90)::DOUBLE AS la1, (s_suppkey % 180)::DOUBLE AS lo1,
    (s_nationkey * 3)::DOUBLE AS la2, s_acctbal / 100 AS lo2 FROM supplier) a""")
def haversine_km(spark, sf):
    s = F.col("s_suppkey")
    km = geo.haversine_km((s % 90).cast("double"), (s % 180).cast("double"), (F.col("s_nationkey") * 3).cast("double"), F.col("s_acctbal") / 100)
    return tidy(dv.table(spark, sf, "supplier").select("s_suppkey", km.alias("km")))


@query("road_priority", """SELECT p_partkey, CASE WHEN lower(p_type) = 'highway' OR contains(lower(p_name), 'bridge') OR contains(lower(p_name), 'highway') OR contains(lower(p_name), 'vanh dai') THEN 1 WHEN p_size % 3 = 0 THEN 2 WHEN p_size % 3 = 1 THEN 3 ELSE 4 END AS priority FROM part
    WHERE CASE WHEN contains(lower(p_name), 'bridge') THEN 1 WHEN p_size % 3 = 0 THEN 2 WHEN p_size % 3 = 1 THEN 3 ELSE 4 END <= 3""")
def road_priority(spark, sf):
    kind = F.when(F.col("p_size") % 3 == 0, "Arterial").when(F.col("p_size") % 3 == 1, "Collector").otherwise("Local")
    rows = dv.table(spark, sf, "part").select("p_partkey", nm.road_priority(kind, F.col("p_name")).alias("priority"))
    return rows.filter(F.col("priority") <= nm.allowed_priority(13, "medium"))


CHUNKS = """legs AS (SELECT s_suppkey, 10.0::DOUBLE AS la1, 106.0::DOUBLE AS lo1, 10.0::DOUBLE + (s_suppkey % 17)::DOUBLE / 500 AS la2, 106.0::DOUBLE + (s_suppkey % 23)::DOUBLE / 400 AS lo2, (['Highway', 'Arterial', 'Collector'])[s_suppkey % 3 + 1] AS kind FROM supplier),
n AS (SELECT *, greatest(1, least(6, ceil(2 * 6371.0::DOUBLE * asin(sqrt(sin(radians(la2 - la1) / 2) ^ 2 + cos(radians(la1)) * cos(radians(la2)) * sin(radians(lo2 - lo1) / 2) ^ 2)) / CASE kind WHEN 'Highway' THEN 0.85::DOUBLE * 1.25::DOUBLE WHEN 'Collector' THEN 0.85::DOUBLE * 0.85::DOUBLE ELSE 0.85::DOUBLE END)))::INTEGER AS cnt FROM legs),
pieces AS (SELECT *, unnest(range(cnt))::INTEGER AS i FROM n)"""


@query("polyline_chunks", f"WITH {CHUNKS} SELECT s_suppkey, i, round(la1 + (la2 - la1) * (i / cnt::DOUBLE), 6) + 0.0 AS lat_a, round(lo1 + (lo2 - lo1) * ((i + 1) / cnt::DOUBLE), 6) + 0.0 AS lon_b FROM pieces")
def polyline_chunks(spark, sf):
    s = F.col("s_suppkey")
    point = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    line = F.array(point(F.lit(106.0), F.lit(10.0)), point(106.0 + s % 23 / 400, 10.0 + s % 17 / 500))
    kind = F.element_at(F.array(F.lit("Highway"), F.lit("Arterial"), F.lit("Collector")), (s % 3 + 1).cast("int"))
    legs = dv.table(spark, sf, "supplier").select("s_suppkey", kind.alias("kind"), F.explode(geo.line_legs(line)).alias("leg"))
    pieces = geo.split_leg(F.col("leg"), geo.chunk_count(F.col("leg"), F.col("kind"), 14))
    out = legs.select("s_suppkey", F.posexplode(pieces).alias("i", "piece"))
    return tidy(out.select("s_suppkey", "i", F.col("piece.a.lat").alias("lat_a"), F.col("piece.b.lon").alias("lon_b")))


@query("point_line", f"WITH {dv.PANEL} SELECT city, segment_id, round(lon - 0.006, 6) + 0.0 AS first_lon, round(lat + 0.006, 6) + 0.0 AS last_lat FROM latest")
def point_line(spark, sf):
    rows = pn.latest_by_segment(dv.panel(spark, sf)).withColumn("p", geo.point_line(F.col("lat"), F.col("lon")))
    return tidy(rows.select("city", "segment_id", F.col("p")[0]["lon"].alias("first_lon"), F.col("p")[2]["lat"].alias("last_lat")))


GEOM_SQL = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 2 END AS n_points, CASE event_id % 5 WHEN 0 THEN round(105 + (event_id % 100)::DOUBLE / 100, 6) + 0.0 WHEN 1 THEN 106.0 END AS first_lon,
    CASE event_id % 5 WHEN 0 THEN (event_id % 100) >= 50 WHEN 1 THEN true END AS in_view FROM events"""


def _geometry():
    e = F.col("event_id")
    x = (105 + e % 100 / 100).cast("string")
    named = F.concat(F.lit('{"type":"LineString","coordinates":[{"latitude":21.0,"longitude":'), x, F.lit('},{"latitude":21.1,"longitude":'), x, F.lit("}]}"))
    pairs = F.lit('{"type":"LineString","coordinates":[[106.0,21.0],[106.1,21.1],[500.0,21.0]]}')
    short = F.lit('{"type":"LineString","coordinates":[[106.0,21.0]]}')
    return F.when(e % 5 == 0, named).when(e % 5 == 1, pairs).when(e % 5 == 2, short).when(e % 5 == 3, "not json")


@query("geometry_points", GEOM_SQL)
def geometry_points(spark, sf):
    rows = dv.table(spark, sf, "events").select("event_id", geo.line_points(_geometry()).alias("p"))
    view = geo.parse_viewport("105.495,20,107,22")
    return tidy(rows.select("event_id", F.when(F.col("p").isNotNull(), F.size("p")).alias("n_points"), F.col("p")[0]["lon"].alias("first_lon"), geo.any_vertex_in(F.col("p"), view).alias("in_view")))


@query("map_segments", f"""WITH {dv.PANEL} SELECT segment_id AS id, city, round(currentSpeed / freeFlowSpeed, 3) AS "speedRatio", CASE WHEN currentSpeed / freeFlowSpeed >= 0.75 THEN 'Free' WHEN currentSpeed / freeFlowSpeed >= 0.5 THEN 'Slow' WHEN currentSpeed / freeFlowSpeed >= 0.3 THEN 'Congested' ELSE 'Severe' END AS "congestionLevel",
    greatest(0, round_even((1 - {C01('currentSpeed / freeFlowSpeed')}) * 18 + jamFactor * 0.6::DOUBLE, 0))::INTEGER AS "travelTimeDelayMin" FROM latest WHERE lat BETWEEN 10 AND 22 ORDER BY city, segment_id LIMIT 120""")
def map_segments(spark, sf):
    line = F.to_json(F.struct(F.lit("LineString").alias("type"), F.transform(geo.point_line(F.col("lat"), F.col("lon")), lambda p: F.array(p["lon"], p["lat"])).alias("coordinates")))
    panel = dv.panel(spark, sf).withColumn("geometry", line)
    return db.map_segments(panel, geo.parse_viewport("100,10,110,22"), 120).select("id", "city", "speedRatio", "congestionLevel", "travelTimeDelayMin")


@query("segment_geojson", f"""WITH {dv.PANEL} SELECT city, segment_id, 'Feature' AS type, 3 AS vertices, round(jamFactor, 2) AS jam_factor, round(currentSpeed, 2) AS current_speed FROM latest""")
def segment_geojson(spark, sf):
    """Features as JSON text, read back to compare their content."""
    out = db.geojson_features(dv.panel(spark, sf))
    parsed = F.from_json("feature", "type string, geometry struct<coordinates:array<array<double>>>, properties struct<jam_factor:double,current_speed:double>")
    return out.select("city", "segment_id", parsed.alias("f")).select(
        "city", "segment_id", "f.type", F.size("f.geometry.coordinates").alias("vertices"), "f.properties.jam_factor", "f.properties.current_speed"
    )


@query("segment_detail", f"WITH {dv.PANEL} SELECT city, segment_id, time_bucket, round(jamFactor, 6) + 0.0 AS jamFactor FROM latest WHERE segment_id = 'S3'")
def segment_detail(spark, sf):
    return tidy(db.segment_detail(dv.panel(spark, sf), "S3").select("city", "segment_id", "time_bucket", "jamFactor"))


@query("dominant_source", f"WITH {dv.PANEL} SELECT source, count(*) AS segments FROM latest GROUP BY source ORDER BY segments DESC, source LIMIT 1")
def dominant_source(spark, sf):
    return db.dominant_source(dv.panel(spark, sf), "source")


@query("graph_nodes_edges", f"""WITH {dv.PANEL}, {dv.DIMENSION}, l AS (SELECT l.*, coalesce(d.district, 'unknown') AS district FROM latest l LEFT JOIN dimension d ON d.segment_id = l.segment_id)
    SELECT 'node' AS item, 'RoadSegment' AS kind, segment_id AS from_id, '' AS to_id, round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, jamFactor * 10)), 6) + 0.0 AS risk_score FROM l UNION ALL SELECT 'node', 'Intersection', segment_id || ':start', '', NULL FROM l UNION ALL SELECT 'node', 'Intersection', segment_id || ':end', '', NULL FROM l
    UNION ALL SELECT DISTINCT 'node', 'District', 'district:' || city || ':' || district, '', NULL::DOUBLE FROM l UNION ALL SELECT 'edge', 'LOCATED_IN', segment_id, 'district:' || city || ':' || district, NULL FROM l
    UNION ALL SELECT 'edge', 'STARTS_AT', segment_id, segment_id || ':start', NULL FROM l UNION ALL SELECT 'edge', 'ENDS_AT', segment_id, segment_id || ':end', NULL FROM l""")
def graph_nodes_edges(spark, sf):
    latest = pn.latest_by_segment(dv.panel(spark, sf)).join(dv.road_dimension(spark, sf).select("segment_id", "district"), "segment_id", "left")
    nodes, edges = gr.graph_export(latest)
    left = nodes.select(F.lit("node").alias("item"), "kind", F.col("node_id").alias("from_id"), F.lit("").alias("to_id"), "risk_score")
    return tidy(left.unionByName(edges.select(F.lit("edge").alias("item"), "kind", "from_id", "to_id", F.lit(None).cast("double").alias("risk_score"))))


@query("risk_explanations", f"""WITH {CONTEXT}, r AS (SELECT *, round({risk_sql('currentSpeed')}, 3) AS risk, {RULES('currentSpeed').replace("','", "', '")} AS rules FROM clatest)
    SELECT segment_id, concat_ws(' | ', printf('Jam factor is %.1f with speed %.1f km/h versus baseline %.1f km/h', jamFactor, currentSpeed, freeFlowSpeed), printf('Risk score is %.1f/100 (%s)', risk, {LEVEL('risk')}),
    CASE WHEN rules <> '' THEN 'Triggered risk signals: ' || rules END, 'Prediction reliability is low') AS why FROM r""")
def risk_explanations(spark, sf):
    rows = pn.latest_by_segment(context(spark, sf))
    why = sc.alert_explanation(F.col("jamFactor"), F.col("currentSpeed"), F.col("freeFlowSpeed"), db._risk(rows), F.lit("low"))
    return rows.select("segment_id", F.array_join(why, " | ").alias("why"))
