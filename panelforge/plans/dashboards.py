"""Decision tables over the newest row of every segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.functions import geo, numeric as nm, scoring as sc, times as tm
from panelforge.operators import graph as gr, learn as ln
from panelforge.operators.panel import latest_by_segment


METRICS = ["currentSpeed", "freeFlowSpeed", "jamFactor"]
RISK_CONTEXT = [
    "upstream_congestion_score", "weather_rain_1h", "weather_severity", "max_event_severity_1h", "accident_count_1h",
    "news_event_count_1h",
]


def _newest(panel: DataFrame, city: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """Newest rows with the metrics and those of the extra columns that exist."""
    wanted = [*METRICS, *[c for c in (extra or []) if c in panel.columns]]
    return latest_by_segment(panel, city, columns=wanted)


def _risk(df: DataFrame, predicted: Column | None = None, coverage: Column | None = None) -> Column:
    """Segment risk from whatever context columns the table carries."""
    have = set(df.columns)
    get = lambda n: F.col(n) if n in have else None
    return sc.segment_risk(
        F.col("currentSpeed"), F.col("freeFlowSpeed"), F.col("jamFactor"), predicted,
        get("upstream_congestion_score"), get("weather_rain_1h"), get("weather_severity"),
        get("max_event_severity_1h"), get("accident_count_1h"), get("news_event_count_1h"), coverage,
    )


def city_status(panel: DataFrame) -> DataFrame:
    """Segments, mean speed, congested share, worst jam and newest time per city."""
    jam = F.col("jamFactor")
    return _newest(panel).groupBy("city").agg(
        F.countDistinct("segment_id").alias("total_segments"),
        F.round(F.avg("currentSpeed"), 2).alias("avg_speed"),
        F.round(F.avg(F.when(jam >= 3, 1.0).otherwise(0.0)), 4).alias("congestion_ratio"),
        F.round(F.max(jam), 2).alias("max_jam_factor"),
        F.count_if(jam >= 6).alias("critical_segment_count"),
        F.max("timestamp").alias("latest"),
    )


def dashboard_summary(panel: DataFrame) -> DataFrame:
    """Segments by jam band per city."""
    jam = F.col("jamFactor")
    return _newest(panel).groupBy("city").agg(
        F.countDistinct("segment_id").alias("monitored_segments"),
        F.count_if(jam >= 3).alias("active_alerts"),
        F.count_if(jam < 3).alias("free_flow_segments"),
        F.count_if((jam >= 3) & (jam < 6)).alias("slow_segments"),
        F.count_if(jam >= 6).alias("congested_segments"),
        F.round(F.avg("currentSpeed"), 2).alias("avg_speed"),
        F.round(F.avg(jam), 2).alias("avg_jam_factor"),
        F.max("timestamp").alias("latest_timestamp"),
    )


def city_runtime(panel: DataFrame, cities: dict[str, bool]) -> DataFrame:
    """Online / offline and averages for a fixed list of cities and their switches."""
    spark = panel.sparkSession
    wanted = spark.createDataFrame(list(cities.items()), "city string, enabled boolean")
    stats = _newest(panel).groupBy("city").agg(
        F.countDistinct("segment_id").alias("segment_count"), F.max("timestamp").alias("latest_timestamp"),
        F.round(F.avg("currentSpeed"), 2).alias("avg_speed"), F.round(F.avg("jamFactor"), 2).alias("avg_jam_factor"),
    )
    joined = wanted.join(stats, "city", "left").withColumn("segment_count", F.coalesce("segment_count", F.lit(0)))
    online = F.col("enabled") & (F.col("segment_count") > 0)
    return joined.withColumn("status", F.when(online, "online").otherwise("offline"))


def segments_worst_first(panel: DataFrame, limit: int, city: str | None = None) -> DataFrame:
    rows = _newest(panel, city).orderBy(F.desc("jamFactor"), "city", "segment_id").limit(limit)
    return rows.select(
        "segment_id", "city", F.round("currentSpeed", 2).alias("current_speed"), F.round("freeFlowSpeed", 2).alias("free_flow_speed"),
        F.round("jamFactor", 2).alias("jam_factor"), "timestamp",
    )


def within_lookback(panel: DataFrame, hours: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last N hours before the newest row of the table (scalar subquery, no join)."""
    newest = panel.agg(F.max(ts).alias("m")).scalar()
    return panel.filter(F.col(ts) >= newest - F.expr(f"INTERVAL {hours} HOURS"))


def since(df: DataFrame, ts: str, as_of: Column, minutes: int) -> DataFrame:
    """Rows at most N minutes older than a given instant."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {minutes} MINUTES"))


def hourly_trend(panel: DataFrame, hours: int, digits: int = 2) -> DataFrame:
    """Mean speed and jam per clock hour; hours without rows do not appear."""
    return within_lookback(panel, hours).groupBy("city", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour")).agg(
        F.round(F.avg("currentSpeed"), digits).alias("avg_speed"), F.round(F.avg("jamFactor"), digits).alias("avg_jam_factor"),
    )


def active_alerts(panel: DataFrame, limit: int | None = None, severity: str | None = None, city: str | None = None) -> DataFrame:
    """Segments with jam ≥ 3, their severity, explanation and advice; ``limit`` keeps the worst."""
    rows = _newest(panel, city, ["p50", *RISK_CONTEXT]).filter(F.col("jamFactor") >= 3)
    level = nm.jam_severity(F.col("jamFactor"))
    if severity:
        rows = rows.filter(level == severity)
    baseline = F.col("p50") if "p50" in panel.columns else F.col("freeFlowSpeed")
    worst = rows.orderBy(F.desc("jamFactor"), "city", "segment_id").limit(limit) if limit else rows
    scored = worst.withColumns({"severity": level, "_risk": _risk(panel), "_base": baseline})
    return scored.select(
        F.concat_ws("_", F.lit("alert"), "city", "segment_id").alias("alert_id"), "segment_id", "city", "severity",
        sc.alert_reason(F.col("jamFactor"), F.col("currentSpeed"), F.col("_base")).alias("reason"),
        F.round("currentSpeed", 2).alias("predicted_speed"), F.round("_base", 2).alias("baseline_p50"),
        F.col("timestamp").alias("created_at"), F.lit(False).alias("acknowledged"),
        sc.alert_explanation(F.col("jamFactor"), F.col("currentSpeed"), F.col("_base"), F.col("_risk")).alias("why"),
        sc.recommended_action(F.col("severity")).alias("recommended_action"), F.lit("medium").alias("confidence_level"),
    )


def alert_by_id(panel: DataFrame, alert_id: str) -> DataFrame:
    """One alert. City and segment may hold the separator themselves, so the id is compared as composed."""
    return active_alerts(panel.filter(F.concat_ws("_", F.lit("alert"), "city", "segment_id") == alert_id), 1)


def rule_alerts(predictions: DataFrame, as_of: Column, drop_overrides: bool = True) -> DataFrame:
    """Alerts of the rule engine: predictions that carry p15, p50 and the previous speed."""
    verdict = sc.alert_rule(
        F.coalesce("predicted_speed_15m", "currentSpeed"), F.col("p15"), F.col("p50"), F.col("currentSpeed"),
        F.col("speed_lag_1"), drop_overrides,
    )
    hit = predictions.withColumn("_v", verdict).filter(F.col("_v").isNotNull())
    stamp = F.date_format("time_bucket", "yyyyMMddHHmmss")
    return hit.select(
        F.concat_ws("_", "segment_id", stamp).alias("alert_id"), "segment_id", "city", "time_bucket",
        F.col("_v.severity").alias("severity"), F.col("_v.reason").alias("reason"),
        F.coalesce("predicted_speed_15m", "currentSpeed").alias("predicted_speed"), F.col("currentSpeed").alias("current_speed"),
        F.col("p50").alias("baseline_p50"), F.col("p15").alias("baseline_p15"), as_of.alias("created_at"), F.lit(False).alias("acknowledged"),
    )


def current_hotspots(panel: DataFrame, severity: str | None = None, prefix: int | None = None) -> DataFrame:
    """Congested segments grouped by their name, or by its first ``prefix`` characters."""
    rows = _newest(panel, extra=["segment_name", "lat", "lon"]).filter(F.col("jamFactor") >= 3)
    name = F.coalesce("segment_name", "segment_id").cast("string")
    name = F.substring(name, 1, prefix) if prefix else name
    lost = F.greatest(F.lit(0.0), F.col("freeFlowSpeed") - F.col("currentSpeed"))
    grouped = rows.groupBy("city", name.alias("cluster")).agg(
        F.round(F.avg("lat"), 6).alias("center_lat"), F.round(F.avg("lon"), 6).alias("center_lon"),
        F.countDistinct("segment_id").alias("num_segments"), F.round(F.avg(lost), 3).alias("avg_congestion"),
        F.avg("jamFactor").alias("_jam"), F.max("timestamp").alias("detected_at"),
    )
    out = grouped.withColumns({"avg_jam_factor": F.round("_jam", 2), "severity": nm.jam_severity(F.col("_jam"), upper=False), "radius_km": F.lit(0.8)}).drop("_jam")
    out = out.filter(F.col("severity") == severity) if severity else out
    return out


def predicted_hotspots(latest: DataFrame, predictions: DataFrame, horizon: str, config: dict = sc.HOTSPOT_CONFIG) -> DataFrame:
    """Segments whose forecast scores above low risk, worst first.

    ``predictions`` has segment_id, predicted_speed, required/available feature counts and model name.
    """
    joined = latest.join(predictions, "segment_id").filter(F.col("predicted_speed").isNotNull())
    have = set(joined.columns)
    get = lambda n: F.col(n) if n in have else F.lit(0.0)
    context = sc.context_risk(
        get("weather_rain_1h"), get("weather_severity"), get("has_rain"), get("news_event_count_1h"), get("accident_count_1h"), get("max_event_severity_1h")
    )
    risk = sc.hotspot_risk(F.col("currentSpeed"), F.col("predicted_speed"), F.col("freeFlowSpeed"), F.col("jamFactor"), context, config)
    scored = joined.withColumns({"_r": risk, "context_component": F.round(context, 4)}).filter(F.col("_r.risk_level") != "low")
    coverage = F.when(F.col("required_feature_count") > 0, F.col("available_feature_count") / F.col("required_feature_count")).otherwise(0.0)
    return scored.select(
        "segment_id", F.coalesce("segment_name", "segment_id").alias("road_name") if "segment_name" in have else F.col("segment_id").alias("road_name"),
        "city", F.round("currentSpeed", 3).alias("current_speed"), F.round("predicted_speed", 3).alias("predicted_speed"),
        F.round("freeFlowSpeed", 3).alias("free_flow_speed"), "_r.speed_drop_pct", "_r.predicted_free_flow_ratio", "_r.risk_score",
        F.lit(horizon).alias("horizon"), "_r.risk_level", "_r.triggered_rules", "_r.reason", "context_component",
        F.round(coverage, 4).alias("feature_coverage_ratio"), "model_name",
    ).orderBy(F.desc("risk_score"), "predicted_speed", "segment_id")


def with_reliability(predictions: DataFrame, horizon: str, as_of: Column) -> DataFrame:
    """Predictions with coverage, level, confidence band and age."""
    age = tm.freshness_seconds(F.col("latest_timestamp"), as_of)
    verdict = sc.reliability(
        F.col("required_feature_count"), F.col("available_feature_count"), age, F.lit(horizon), F.col("predicted_speed"), F.col("is_fallback")
    )
    return predictions.withColumns({"data_freshness_seconds": age, "_v": verdict}).select(*predictions.columns, "data_freshness_seconds", "_v.*")


def score_segments(rows: DataFrame, bundle: ln.ModelBundle, horizons: list[str | int], as_of: Column) -> DataFrame:
    """One prediction per row and horizon: align to the model's schema, predict, measure coverage, judge reliability.

    A horizon without a model falls back to the current speed, marked as such and of low reliability.
    """
    keys = ["city", "segment_id", "latest_timestamp", "current_speed", "current_jam_factor"]
    base = rows.withColumns({"latest_timestamp": F.col("timestamp"), "current_speed": F.col("currentSpeed"), "current_jam_factor": F.col("jamFactor")})
    out = None
    for horizon in map(ln.normalize_horizon, horizons):
        wanted, model = bundle.features.get(horizon, []), bundle.models.get(horizon)
        if model is None:
            scored = base.select(
                *keys, F.col("current_speed").alias("prediction"), F.array().cast("array<string>").alias("missing_features"),
                *[F.lit(0).alias(f"{n}_feature_count") for n in ("required", "available", "filled")],
            )
        else:
            scored = model.transform(ln.align_features(base, wanted, keys))
        named = scored.select(
            *keys, F.round(F.col("prediction").cast("double"), 3).alias("predicted_speed"), F.lit(bundle.name if model else "current_speed").alias("model_name"),
            F.lit(horizon).alias("horizon"), F.lit(model is None).alias("is_fallback"), "missing_features",
            "required_feature_count", "available_feature_count", "filled_feature_count",
        )
        judged = with_reliability(named, horizon, as_of)
        out = judged if out is None else out.unionByName(judged)
    return out


def corridor_rank(panel: DataFrame, corridor: str = "district", limit: int = 10) -> DataFrame:
    """Corridors by mean segment risk."""
    column = corridor if corridor in panel.columns else "city"
    scored = _newest(panel, extra=[column, *RISK_CONTEXT]).withColumn("_risk", _risk(panel)["risk_score"])
    ranked = scored.groupBy(F.col(column).alias("corridor_id")).agg(
        F.avg("_risk").alias("_score"), F.max("jamFactor").alias("_jam"), F.countDistinct("segment_id").alias("segment_count"),
    )
    level = sc.segment_risk(F.lit(1.0), F.lit(1.0), F.col("_jam"))["risk_level"]
    best = ranked.orderBy(F.desc("_score"), "corridor_id").limit(limit)
    return best.select(
        "corridor_id", F.round("_score", 3).alias("risk_score"), level.alias("risk_level"), F.round("_jam", 2).alias("max_jam_factor"), "segment_count"
    )


def scenario_impact(latest: DataFrame, scenarios: DataFrame, baseline_on_changed_row: bool = False) -> DataFrame:
    """Every segment under every scenario (name, rain_1h_mm, event_type, is_peak_hour).

    The product is a join on a salt: every segment row has one, every scenario stands once under each, so both sides
    may be large. The baseline risk uses the unchanged row unless asked otherwise.
    """
    entry = F.struct(
        "name", F.coalesce(F.col("rain_1h_mm").cast("double"), F.lit(0.0)).alias("rain"),
        F.lower(F.coalesce("event_type", F.lit("none"))).alias("event"), F.coalesce("is_peak_hour", F.lit(False)).alias("peak"),
    )
    salts = int(latest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = scenarios.select(entry.alias("_s"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    have = set(latest.columns)
    get = lambda n: nm.zero_if_missing(F.col(n)) if n in have else F.lit(0.0)
    base = F.coalesce("predicted_speed", "currentSpeed") if "predicted_speed" in have else F.col("currentSpeed")
    salted = latest.withColumns({"_salt": F.pmod(F.xxhash64("city", "segment_id"), F.lit(salts)).cast("int"), "_base": F.coalesce(base, F.lit(0.0))})
    rows = salted.join(entries, "_salt")
    wet, hit = F.col("_s.rain") > 0, F.col("_s.event").isin(*sc.INCIDENT_FACTORS)
    changed = {
        "rain": F.when(wet, F.col("_s.rain")).otherwise(get("weather_rain_1h")),
        "weather": F.when(wet, F.greatest(get("weather_severity"), F.least(F.lit(10.0), F.col("_s.rain") / 3.0))).otherwise(get("weather_severity")),
        "event": F.when(hit, F.greatest(get("max_event_severity_1h"), F.lit(7.0))).otherwise(get("max_event_severity_1h")),
        "news": F.when(hit, F.greatest(get("news_event_count_1h"), F.lit(1.0))).otherwise(get("news_event_count_1h")),
    }
    plain = {"rain": get("weather_rain_1h"), "weather": get("weather_severity"), "event": get("max_event_severity_1h"), "news": get("news_event_count_1h")}
    speed = sc.scenario_speed(F.col("_base"), F.col("_s.rain"), F.col("_s.event"), F.col("_s.peak"))

    def risk(c: dict[str, Column], predicted: Column) -> Column:
        return sc.segment_risk(
            F.col("currentSpeed"), F.col("freeFlowSpeed"), F.col("jamFactor"), predicted, rain=c["rain"], weather_severity=c["weather"],
            event_severity=c["event"], accidents=get("accident_count_1h"), news=c["news"],
        )

    scored = rows.withColumn("simulated_speed", speed).withColumns(
        {"_b": risk(changed if baseline_on_changed_row else plain, F.col("_base")), "_n": risk(changed, F.col("simulated_speed"))}
    )
    delta = F.round(F.col("simulated_speed") - F.col("_base"), 3)
    return scored.select(
        "city", "segment_id", F.col("_s.name").alias("scenario"), F.round("_base", 3).alias("baseline_speed"), "simulated_speed",
        delta.alias("speed_delta"),
        F.when(F.col("_base") > 0, F.round(delta / F.col("_base") * 100.0, 3)).otherwise(0.0).alias("speed_delta_pct"),
        F.col("_b.risk_score").alias("baseline_risk"), F.col("_b.risk_level").alias("baseline_level"),
        F.col("_n.risk_score").alias("simulated_risk"), F.col("_n.risk_level").alias("simulated_level"),
    )


def map_segments(panel: DataFrame, viewport: tuple[float, float, float, float] | None, limit: int) -> DataFrame:
    """Live-map rows of the segments with a usable line inside the viewport."""
    rows = _newest(panel, extra=["geometry"]).withColumn("points", geo.line_points(F.col("geometry"))).filter(F.col("points").isNotNull())
    if viewport:
        rows = rows.filter(geo.any_vertex_in(F.col("points"), viewport))
    ratio = nm.speed_ratio(F.col("currentSpeed"), F.col("freeFlowSpeed"))
    return rows.orderBy("city", "segment_id").limit(limit).select(
        F.col("segment_id").alias("id"), "city", F.to_json(F.struct(F.lit("LineString").alias("type"), F.transform(
            "points", lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"))).alias("geometry"),
        F.round("currentSpeed", 2).alias("currentSpeed"), F.round("freeFlowSpeed", 2).alias("freeFlowSpeed"),
        F.round(ratio, 3).alias("speedRatio"), F.round("jamFactor", 2).alias("jamFactor"),
        nm.congestion_level(ratio).alias("congestionLevel"), nm.delay_minutes(ratio, F.col("jamFactor")).alias("travelTimeDelayMin"),
    )


def geojson_features(panel: DataFrame, limit: int | None = None) -> DataFrame:
    """One GeoJSON feature per segment; a short line through the coordinate where there is no geometry."""
    latest = _newest(panel, extra=["lat", "lon", "geometry"])
    real = geo.line_points(F.col("geometry")) if "geometry" in panel.columns else F.lit(None)
    points = F.coalesce(real, geo.point_line(F.col("lat"), F.col("lon")))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"), F.transform(points, lambda p: F.array(p["lon"], p["lat"])).alias("coordinates")).alias("geometry"),
        F.struct(
            "segment_id", F.round("jamFactor", 2).alias("jam_factor"), F.round("currentSpeed", 2).alias("current_speed"),
            F.round("freeFlowSpeed", 2).alias("free_flow_speed"), "city",
        ).alias("properties"),
    )
    shown = latest.orderBy("city", "segment_id").limit(limit) if limit else latest
    return shown.select("city", "segment_id", F.to_json(feature).alias("feature"))


def segment_detail(panel: DataFrame, segment_id: str) -> DataFrame:
    """Newest row of one segment; the filter reaches the scan."""
    return latest_by_segment(panel.filter(F.col("segment_id") == segment_id))


def upstream_chain(panel: DataFrame, size: int = 4) -> DataFrame:
    """Worst segments as a chain with status and synthetic distance."""
    chain = gr.ranked_chain(_newest(panel), size, first=1)
    return chain.select(
        "segment_id", F.round("currentSpeed", 2).alias("speed_kmh"), nm.corridor_status(F.col("jamFactor")).alias("status"), "distance_m"
    )


def propagation(panel: DataFrame, depth: int = 3) -> DataFrame:
    """Worst segments as a path with their risk and the mean risk of the path."""
    chain = gr.ranked_chain(_newest(panel, extra=RISK_CONTEXT), depth + 1).withColumn("_r", _risk(panel))
    path = chain.select(
        "segment_id", "distance_m", F.round("jamFactor", 2).alias("jam_factor"), F.round("currentSpeed", 2).alias("current_speed"),
        F.col("_r.risk_score").alias("risk_score"), F.col("_r.risk_level").alias("risk_level"),
    )
    return path.withColumn("propagation_score", F.round(path.agg(F.avg("risk_score")).scalar(), 3))


def segment_risks(panel: DataFrame) -> DataFrame:
    return _newest(panel, extra=RISK_CONTEXT).withColumn("_r", _risk(panel)).select("city", "segment_id", "_r.*")


def dominant_source(panel: DataFrame, column: str) -> DataFrame:
    """Most frequent value among the newest rows, smallest of equals."""
    counted = latest_by_segment(panel, columns=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("segments"))
    return counted.orderBy(F.desc("segments"), column).limit(1)
