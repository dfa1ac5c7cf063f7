"""Table builds from raw records to training data. Each returns a lazy DataFrame; write what feeds
more than one output, nothing else needs caching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge import catalog
from panelforge.operators import features as ft, joins as jn, news as nw, panel as pn, quality as ql, timeseries as ts
from panelforge.operators.event_groups import event_groups
from panelforge.session import cut_lineage, sorted_join


def panel_build(traffic: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    return pn.dedup_traffic(pn.clean_traffic(traffic, bucket_minutes))


def weather_build(weather: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    return pn.dedup_weather(pn.clean_weather(weather, bucket_minutes))


def matched_build(traffic: DataFrame, weather: DataFrame, columns: list[str], minutes: int = 30) -> DataFrame:
    """Silver traffic with the weather nearest in time of its city; unmatched traffic drops out."""
    one = jn.one_per_instant(weather, ["city"], "time_bucket", [*columns, "weather_cell_id"], "weather_cell_id")
    return ql.partition_columns(
        jn.asof_nearest(traffic.drop("weather_cell_id"), one, ["city"], "time_bucket", [*columns, "weather_cell_id"], minutes * 60)
    )


def gold_build(
    panel: DataFrame, weather: DataFrame, event_features: DataFrame | None = None, bucket_minutes: int = 5,
    horizons: tuple[int, ...] = ts.HORIZONS,
) -> DataFrame:
    """Panel → features and targets.

    The panel is stored once, since offsets, weather matching and the baseline all read it. Lags and
    targets share one chunked window: one shuffle and one sort for all of them.
    """
    base = cut_lineage(ts.add_base_features(ts.add_time_features(panel, bucket_minutes)))
    offsets = ts.exact_offsets(base, {**ts.lag_spec(bucket_minutes), **ts.target_spec(horizons)})
    lagged = ts.add_past_rolling(offsets.withColumns(ts.trend_columns())).withColumns(ts.target_flags(horizons))
    keys = [*pn.PANEL_KEYS, "weather_cell_id"]
    matched = ft.add_weather(base.select(keys), weather, max(bucket_minutes * 6, 30)).drop("weather_cell_id")
    with_weather = lagged.join(matched, pn.PANEL_KEYS)
    complete = ft.add_placeholders(ts.add_baseline(with_weather, ts.percentile_baseline(base)))
    merged = complete if event_features is None else ft.merge_events(complete, event_features)
    return ft.tidy_numbers(merged)


def training_build(features: DataFrame, horizon: int, city: str) -> DataFrame:
    """Rows of one city with an exact target and full history, split by time, inputs tidy."""
    history = "valid_history_15m" if horizon == 15 else "valid_history_60m"
    target = f"future_speed_{horizon}m"
    rows = features.filter((F.col("city") == city) & F.col(target).isNotNull() & (F.col(history) == 1))
    split = ts.time_split(rows.withColumn("target_speed", F.col(target)))
    dropped = [c for c in ql.LEAKY if c in split.columns] + [f"future_speed_{h}m" for h in ts.HORIZONS]
    return ft.tidy_numbers(split.drop(*dropped), zero_fill=True)


def news_build(raw: DataFrame, order: list[str], aliases=catalog.NEWS_CITY_ALIASES, hints=catalog.HINT_RULES) -> DataFrame:
    """Cleaned news with duplicates marked. The cleaned table is stored once: marking reads it four times."""
    return nw.mark_duplicates(cut_lineage(nw.news_table(raw, aliases, hints)), order)


def events_build(
    raw: DataFrame, as_of: Column, rules: dict = catalog.EVENT_RULES, aliases=catalog.EVENT_CITY_ALIASES
) -> tuple[DataFrame, DataFrame]:
    """(normalized events with their group, one best row per group). Events and groups are stored once, as both tables read them."""
    normalized = cut_lineage(nw.normalize_events(raw, as_of, rules, aliases))
    groups = cut_lineage(event_groups(normalized, "record_id").select("record_id", "dedup_group_id"))
    grouped = normalized.join(sorted_join(groups), "record_id")
    grouped = grouped.withColumn("event_id", F.col("dedup_group_id"))
    return grouped, nw.collapse_groups(grouped)


# Columns of the published feature table, in order.
GOLD_COLUMNS = [
    "segment_id", "city", "timestamp", "currentSpeed", "freeFlowSpeed", "jamFactor", "lat", "lon", "date",
    "hour_of_day", "day_of_week", "day_of_month", "month_of_year", "is_weekend", "is_peak_hour", "is_holiday_vn",
    "congestion_ratio", "speed_rolling_avg_5m", "speed_rolling_avg_15m", "speed_rolling_avg_30m",
    "congestion_rolling_avg_5m",
    "weather_temperature", "weather_humidity", "weather_rain_1h", "weather_visibility", "weather_wind_speed",
    "weather_severity",
    "road_class", "district", "road_class_encoded", "district_segment_count",
    "p15", "p50", "p85", "baseline_congestion_ratio", "speed_vs_p15", "speed_vs_p50", "speed_vs_p85",
    "speed_lag_1", "speed_lag_2", "speed_lag_3", "congestion_lag_1", "congestion_lag_2",
    "has_accident", "has_flood", "has_roadwork", "has_event",
    "degree_centrality", "betweenness_centrality", "network_importance_score",
]


def gold_projection(features: DataFrame) -> DataFrame:
    """The published columns; those the build did not produce are null."""
    have = set(features.columns)
    return features.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in GOLD_COLUMNS])
