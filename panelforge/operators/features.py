"""Feature groups that come from other tables: weather, road dimension, statistics, centrality, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.functions import numeric as nm
from panelforge.operators import joins as jn

WEATHER_NAMES = {
    "temp": "weather_temperature",
    "humidity": "weather_humidity",
    "rain_1h": "weather_rain_1h",
    "visibility": "weather_visibility",
    "wind_speed": "weather_wind_speed",
}


def weather_flags() -> dict[str, Column]:
    """Rain flag and severity 0–3; a visibility below 1000 m is the worst."""
    rain = F.coalesce(F.col("weather_rain_1h"), F.lit(0.0))
    low = F.coalesce(F.col("weather_visibility"), F.lit(10000.0)) < 1000
    return {
        "has_rain": nm.flag(rain > 0.1),
        "weather_severity": F.when(low, 3).when(rain > 10, 2).when(rain > 0.1, 1).otherwise(0),
    }


def add_weather(panel: DataFrame, weather: DataFrame, tolerance_minutes: int = 30) -> DataFrame:
    """Past weather of the row's cell (or of its city when the cell has none), then the flags."""
    joined = jn.asof_with_fallback(
        panel, weather, "city", "weather_cell_id", "time_bucket", list(WEATHER_NAMES), tolerance_minutes * 60
    )
    renamed = joined.withColumnsRenamed(WEATHER_NAMES)
    return renamed.withColumns(weather_flags())


def add_latest_weather(panel: DataFrame, weather: DataFrame, ts: str = "time_bucket") -> DataFrame:
    """Newest weather of the city for every row; a display join, it may look ahead."""
    joined = jn.latest_join(panel, weather, "city", ts, list(WEATHER_NAMES), "weather_cell_id")
    filled = joined.withColumnsRenamed(WEATHER_NAMES).fillna(0.0, subset=list(WEATHER_NAMES.values()))
    return filled.withColumns(weather_flags())


def add_segment_dimension(panel: DataFrame, dimension: DataFrame) -> DataFrame:
    """Road class, district, length and limit of the segment with defaults and ordinals."""
    defaults = {"road_class": "unknown", "district": "unknown", "length_m": 100.0, "speed_limit": 50.0}
    return jn.lookup(panel, dimension, ["segment_id"], defaults).withColumns(
        {
            "road_class_encoded": nm.road_class_ordinal(F.col("road_class")),
            "is_short_segment": nm.flag(F.col("length_m") < 50),
            "speed_limit_encoded": nm.speed_limit_ordinal(F.col("speed_limit")),
            "direction_quadrant": nm.direction_quadrant(F.col("lat"), F.col("lon")),
        }
    )


def add_district_density(panel: DataFrame) -> DataFrame:
    """Rows per (city, district) beside each row: aggregate and join back, so no district is one task."""
    density = panel.groupBy("city", "district").agg(F.count("segment_id").alias("district_segment_count"))
    return panel.join(density, ["city", "district"], "left")


def add_stats_lookup(panel: DataFrame, stats: DataFrame) -> DataFrame:
    """Baseline percentiles of (segment, hour, weekday) from a lookup table, lake-path comparison rules."""
    joined = jn.lookup(panel, stats, ["segment_id", "hour_of_day", "day_of_week"], {"p15": 20.0, "p50": 30.0, "p85": 40.0})
    speed, free = F.col("currentSpeed"), F.col("freeFlowSpeed")
    p15, p50, p85 = F.col("p15"), F.col("p50"), F.col("p85")
    return joined.withColumns(
        {
            "baseline_congestion_ratio": F.when(p50 > 0, 1.0 - free * 0.8 / p50).otherwise(0.5),
            "speed_vs_p15": speed - p15,
            "speed_vs_p50": speed - p50,
            "speed_vs_p85": speed - p85,
            "speed_percentile_position": F.when(speed <= p15, 0.0)
            .when(speed >= p85, 1.0)
            .otherwise((speed - p15) / (p85 - p15)),
            "is_below_p15": nm.flag(speed < p15),
            "is_above_p85": nm.flag(speed > p85),
            "is_between_p15_p50": nm.flag((speed >= p15) & (speed < p50)),
            "is_anomaly_vs_baseline": nm.flag(F.abs(speed - p50) > p50 * 2),
        }
    )


CENTRALITY = ("degree_centrality", "betweenness_centrality", "closeness_centrality")


def add_centrality(panel: DataFrame, centrality: DataFrame | None) -> DataFrame:
    """Network centrality of the segment, 0.5 when unknown or when there is no such table."""
    if centrality is None:
        joined = panel.withColumns({n: F.lit(0.5) for n in CENTRALITY})
    else:
        joined = jn.lookup(panel, centrality, ["segment_id"], {n: 0.5 for n in CENTRALITY})
    degree, between, close = (F.col(n) for n in CENTRALITY)
    return joined.withColumns(
        {
            "degree_centrality_encoded": nm.centrality_code(degree),
            "betweenness_centrality_encoded": nm.centrality_code(between),
            "network_importance_score": nm.network_importance(degree, between, close),
        }
    )


# Dashboard columns and what they hold before their source is joined.
PLACEHOLDERS = {
    "is_holiday_vn": 0,
    "road_class_encoded": 0,
    "length_m": 0.0,
    "is_short_segment": 0,
    "speed_limit_encoded": 0,
    "district_segment_count": 0,
    "direction_quadrant": 0,
    "has_accident": 0,
    "has_flood": 0,
    "has_roadwork": 0,
    "has_any_event": 0,
    "max_accident_severity_1h": 0,
    "max_flood_severity_1h": 0,
    "max_roadwork_severity_1h": 0,
    "max_event_severity_1h": 0,
    "degree_centrality": 0.0,
    "betweenness_centrality": 0.0,
    "closeness_centrality": 0.0,
    "degree_centrality_encoded": 0,
    "betweenness_centrality_encoded": 0,
    "network_importance_score": 0.0,
}


def add_placeholders(panel: DataFrame, values: dict[str, object] = PLACEHOLDERS) -> DataFrame:
    return panel.withColumns({n: F.lit(v) for n, v in values.items() if n not in panel.columns})


def tidy_numbers(panel: DataFrame, zero_fill: bool = False) -> DataFrame:
    """±inf and NaN → null in floating columns; optionally null → 0 in every numeric column."""
    floats = [n for n, t in panel.dtypes if t in ("double", "float")]
    out = panel.withColumns({n: nm.finite(F.col(n)) for n in floats})
    return out.fillna(0) if zero_fill else out


EVENT_KINDS = ("accident", "flood", "roadwork", "event")


def nearby_events(panel: DataFrame, events: DataFrame, bucket_seconds: int, reach_seconds: int = 3600) -> DataFrame:
    """Event flags within ± reach in the same city and worst severity of the past reach, per panel row.

    The answer depends on (city, bucket) only: it is computed once per such pair and joined back,
    so a busy city neither fans out nor gathers its panel in one task.
    """
    kind = lambda k: F.col("event_type") == k
    sums = {f"n_{k}": (F.when(kind(k), 1).otherwise(0).cast("long"), reach_seconds, reach_seconds) for k in EVENT_KINDS}
    maxes = {
        f"max_{k}_severity_1h": (F.when(kind(k), F.col("severity").cast("int")), reach_seconds, 0) for k in EVENT_KINDS
    }
    found = jn.window_aggregates(panel, events, ["city"], "time_bucket", "event_time", bucket_seconds, sums, maxes)
    flags = found.select(
        "city",
        "time_bucket",
        *[nm.flag(F.col(f"n_{k}") > 0).alias(f"has_{k}") for k in EVENT_KINDS],
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in maxes],
    )
    any_event = nm.flag(nm.any_of([F.col(f"has_{k}") == 1 for k in EVENT_KINDS]))
    return panel.join(flags.withColumn("has_any_event", any_event), ["city", "time_bucket"], "left")


HOUR = 3600


def event_windows(grid: DataFrame, events: DataFrame, bucket_seconds: int) -> DataFrame:
    """Trailing 1/3/6/24 h event features of every (city, segment, bucket) of the grid."""
    is_kind = lambda *kinds: F.col("event_category").isin(*kinds)
    count = lambda condition: F.when(condition, 1).otherwise(0).cast("long")
    every = F.lit(True)
    severity = F.col("severity_score").cast("int")
    sums = {
        "news_event_count_1h": (count(every), HOUR, 0),
        "news_event_count_3h": (count(every), 3 * HOUR, 0),
        "news_event_count_6h": (count(every), 6 * HOUR, 0),
        "accident_count_1h": (count(is_kind("accident")), HOUR, 0),
        "congestion_news_count_1h": (count(is_kind("congestion")), HOUR, 0),
        "roadwork_count_24h": (count(is_kind("roadwork_active", "roadwork_planned")), 24 * HOUR, 0),
        "weather_disruption_count_6h": (count(is_kind("weather_disruption", "flood")), 6 * HOUR, 0),
        "flood_count_6h": (count(is_kind("flood")), 6 * HOUR, 0),
        "_relevance_6h": (F.col("traffic_relevance_score"), 6 * HOUR, 0),
    }
    maxes = {"max_event_severity_1h": (severity, HOUR, 0), "max_event_severity_6h": (severity, 6 * HOUR, 0)}
    relevant = events.filter((F.col("is_relevant_for_traffic_model") == 1) & F.col("city").isNotNull())
    found = jn.window_aggregates(grid, relevant, ["city"], "time_bucket", "event_time_start", bucket_seconds, sums, maxes)
    out = found.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in maxes}).withColumns(
        {
            "avg_traffic_relevance_score_6h": F.when(
                F.col("news_event_count_6h") > 0, F.col("_relevance_6h") / F.col("news_event_count_6h")
            ).otherwise(0.0),
            "has_recent_accident": nm.flag(F.col("accident_count_1h") > 0),
            "has_recent_roadwork": nm.flag(F.col("roadwork_count_24h") > 0),
            "has_recent_flood": nm.flag(F.col("flood_count_6h") > 0),
            "has_major_event": nm.flag(F.col("max_event_severity_6h") >= 4),
            "has_weather_disruption": nm.flag(F.col("weather_disruption_count_6h") > 0),
        }
    )
    return grid.join(out.drop("_relevance_6h"), ["city", "time_bucket"], "left")


# Names of the event features.
EVENT_NUMBERS = (
    "news_event_count_1h", "news_event_count_3h", "news_event_count_6h", "accident_count_1h", "congestion_news_count_1h",
    "roadwork_count_24h", "weather_disruption_count_6h", "flood_count_6h", "max_event_severity_1h", "max_event_severity_6h",
    "avg_traffic_relevance_score_6h", "has_recent_accident", "has_recent_roadwork", "has_recent_flood", "has_major_event",
    "has_weather_disruption",
)


def merge_events(panel: DataFrame, event_features: DataFrame) -> DataFrame:
    """Event features replace same-named columns, misses read 0, flags take the larger of both sides."""
    keys = ["city", "segment_id", "time_bucket"]
    fresh = [c for c in event_features.columns if c not in keys]
    joined = panel.drop(*fresh).join(event_features, keys, "left")
    zero = lambda n: F.coalesce(F.col(n), F.lit(0)) if n in joined.columns else F.lit(0)
    out = joined.withColumns({n: zero(n) for n in EVENT_NUMBERS})
    larger = lambda a, b: F.greatest(F.coalesce(F.col(a), F.lit(0)), F.col(b)).cast("int")
    return out.withColumns(
        {
            "has_accident": larger("has_accident", "has_recent_accident"),
            "has_flood": larger("has_flood", "has_recent_flood"),
            "has_roadwork": larger("has_roadwork", "has_recent_roadwork"),
            "has_any_event": nm.flag(F.col("news_event_count_6h") > 0),
        }
    )
