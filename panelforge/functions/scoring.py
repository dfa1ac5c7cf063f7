"""Risk, reliability, alert and confidence scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelforge.functions import numeric as nm

# Weights of the six risk components (they sum to 1).
RISK_WEIGHTS = {
    "congestion_ratio": 0.35,
    "prediction_drop_ratio": 0.25,
    "upstream_congestion_score": 0.15,
    "rain_severity": 0.10,
    "event_severity": 0.10,
    "data_uncertainty": 0.05,
}
RISK_STEPS = [(80, "critical"), (60, "high"), (30, "medium")]

# Thresholds and weights of the predicted-hotspot score.
HOTSPOT_CONFIG = {
    "low_speed_kph": 20,
    "free_flow_ratio_threshold": 0.5,
    "speed_drop_pct_threshold": 30,
    "high_risk_threshold": 60,
    "critical_risk_threshold": 80,
    "weights": {"low_speed": 35, "free_flow_ratio": 25, "speed_drop": 20, "current_jam": 10, "context_multiplier": 10},
}

# Half width of the confidence band by horizon, km/h.
RESIDUAL_BAND = {"15m": 5.0, "60m": 7.5, "240m": 12.0}

# Speed factor of each incident type.
INCIDENT_FACTORS = {"accident": 0.72, "flood": 0.78, "roadwork": 0.86}


def _or_zero(value: Column | None) -> Column:
    return F.lit(0.0) if value is None else nm.zero_if_missing(value)


def segment_risk(
    speed: Column,
    free_flow: Column,
    jam: Column,
    predicted: Column | None = None,
    upstream: Column | None = None,
    rain: Column | None = None,
    weather_severity: Column | None = None,
    event_severity: Column | None = None,
    accidents: Column | None = None,
    news: Column | None = None,
    coverage: Column | None = None,
) -> Column:
    """struct<risk_score, risk_level, components: map, triggered_rules: array> on a 0–100 scale."""
    speed, free_flow, jam = _or_zero(speed), _or_zero(free_flow), _or_zero(jam)
    predicted = speed if predicted is None else F.coalesce(predicted.cast("double"), speed)
    coverage = F.lit(1.0) if coverage is None else coverage
    parts = {
        "congestion_ratio": F.when(free_flow > 0, nm.clip(1.0 - speed / free_flow, 0, 1)).otherwise(
            F.least(jam / 10.0, F.lit(1.0))
        ),
        "prediction_drop_ratio": F.when(speed > 0, nm.clip((speed - predicted) / speed, 0, 1)).otherwise(F.lit(0.0)),
        "upstream_congestion_score": nm.clip(_or_zero(upstream) / 10.0, 0, 1),
        "rain_severity": nm.clip(_or_zero(rain) / 30.0 + _or_zero(weather_severity) / 10.0, 0, 1),
        "event_severity": nm.clip(
            _or_zero(event_severity) / 10.0 + _or_zero(accidents) * 0.25 + _or_zero(news) * 0.08, 0, 1
        ),
        "data_uncertainty": nm.clip(1.0 - coverage, 0, 1),
    }
    total = F.lit(0.0)
    for name, weight in RISK_WEIGHTS.items():
        total = total + parts[name] * weight
    score = F.round(nm.clip(total * 100.0, 0, 100), 3)
    rules = F.array_compact(F.array(*[F.when(value >= 0.5, F.lit(name)) for name, value in parts.items()]))
    components = F.create_map(*[x for name, value in parts.items() for x in (F.lit(name), F.round(value, 4))])
    return F.struct(
        score.alias("risk_score"),
        nm.band(score, RISK_STEPS, "low").alias("risk_level"),
        components.alias("components"),
        rules.alias("triggered_rules"),
    )


def context_risk(
    rain: Column, weather_severity: Column, has_rain: Column, news: Column, accidents: Column, event_severity: Column
) -> Column:
    """Larger of the weather and the event signal, 0 to 1."""
    rain, weather_severity = _or_zero(rain), _or_zero(weather_severity)
    heavy = (_or_zero(has_rain) > 0) & ((rain >= 10) | (weather_severity >= 2))
    event = F.least(F.lit(1.0), _or_zero(accidents) * 0.45 + _or_zero(news) * 0.15 + _or_zero(event_severity) / 10.0)
    weather = F.least(F.lit(1.0), weather_severity / 10.0 + F.when(heavy, 0.35).otherwise(0.0))
    return F.greatest(event, weather)


def hotspot_risk(
    speed: Column, predicted: Column, free_flow: Column, jam: Column, context: Column, config: dict = HOTSPOT_CONFIG
) -> Column:
    """struct with drop, ratio, score, level and rules of a predicted hotspot."""
    weights = config["weights"]
    ratio = F.when(free_flow > 0, predicted / free_flow)
    drop = F.when(speed > 0, (speed - predicted) / speed * 100.0).otherwise(F.lit(0.0))
    slow = predicted < config["low_speed_kph"]
    below = F.coalesce(ratio < config["free_flow_ratio_threshold"], F.lit(False))
    falling = drop > config["speed_drop_pct_threshold"]
    jam_part = nm.clip(jam / 10.0, 0, 1)
    points = lambda condition, name: F.when(condition, float(weights[name])).otherwise(0.0)
    score = nm.clip(
        points(slow, "low_speed")
        + points(below, "free_flow_ratio")
        + points(falling, "speed_drop")
        + jam_part * float(weights["current_jam"])
        + context * float(weights["context_multiplier"]),
        0,
        100,
    )
    steps = [(config["critical_risk_threshold"], "critical"), (config["high_risk_threshold"], "high"), (30, "medium")]
    rules = F.array_compact(
        F.array(
            F.when(slow, F.lit("predicted_speed_below_20")),
            F.when(below, F.lit("predicted_speed_below_half_free_flow")),
            F.when(falling, F.lit("speed_drop_above_30pct")),
            F.when(jam_part >= 0.6, F.lit("current_jam_factor_high")),
            F.when(context > 0, F.lit("context_risk_signal_present")),
        )
    )
    return F.struct(
        F.round(drop, 3).alias("speed_drop_pct"),
        F.round(ratio, 4).alias("predicted_free_flow_ratio"),
        F.round(score, 2).alias("risk_score"),
        nm.band(score, steps, "low").alias("risk_level"),
        rules.alias("triggered_rules"),
        F.array_join(rules, ", ").alias("reason"),
    )


def reliability(
    required: Column, available: Column, freshness: Column, horizon: Column, predicted: Column, fallback: Column
) -> Column:
    """struct<coverage, level, band low, band high> of a prediction."""
    coverage = F.when(required > 0, available / required).otherwise(F.lit(0.0))
    level = (
        F.when(fallback | (coverage < 0.7) | (freshness > 3600), "low")
        .when((coverage < 0.9) | freshness.isNull() | (freshness > 600), "medium")
        .otherwise("high")
    )
    base = F.lit(8.0)
    for name, width in RESIDUAL_BAND.items():
        base = F.when(horizon == name, width).otherwise(base)
    half = base + (1.0 - nm.clip(coverage, 0, 1)) * base + F.when(fallback, base).otherwise(0.0)
    return F.struct(
        F.round(coverage, 4).alias("feature_coverage_ratio"),
        level.alias("reliability_level"),
        F.round(F.greatest(F.lit(0.0), predicted - half), 3).alias("band_low"),
        F.round(predicted + half, 3).alias("band_high"),
    )


def alert_rule(
    predicted: Column, p15: Column, p50: Column, speed: Column, previous: Column, drop_overrides: bool = True
) -> Column:
    """struct<severity, reason>; a sudden drop of over 20 km/h reads MEDIUM, over any other level when asked."""
    fmt = lambda template, *values: F.format_string(template, *values)
    cases = [
        (predicted < p15 * 0.8, "CRITICAL", fmt("Speed %.1f km/h is <80%% of baseline p15 (%.1f km/h)", predicted, p15)),
        (predicted < p50 * 0.7, "HIGH", fmt("Speed %.1f km/h is <70%% of baseline p50 (%.1f km/h)", predicted, p50)),
        (predicted < p50 * 0.9, "MEDIUM", fmt("Speed %.1f km/h is <90%% of baseline p50 (%.1f km/h)", predicted, p50)),
        (predicted < p50, "LOW", fmt("Speed %.1f km/h is below baseline p50 (%.1f km/h)", predicted, p50)),
    ]
    drop = (
        (previous > 0) & (previous - speed > 20),
        "MEDIUM",
        fmt("Rapid deceleration: %.1f km/h (was %.1f km/h)", speed, previous),
    )
    ordered = [drop, *cases] if drop_overrides else [*cases, drop]
    return F.coalesce(
        *[F.when(hit, F.struct(F.lit(name).alias("severity"), why.alias("reason"))) for hit, name, why in ordered]
    )


def snap_confidence(distance_m: Column) -> Column:
    """Confidence of a snap to the road by distance in metres."""
    return F.when(distance_m.isNull(), 0.3).when(distance_m < 50, 1.0).when(distance_m < 200, 0.7).otherwise(0.4)


def place_bonus(place: Column) -> Column:
    """Extra confidence for specific places."""
    lowered = F.lower(place)
    exact = nm.any_of([lowered.contains(w) for w in ("ngã tư", "ngã ba", "cầu ", "hầm ", "nút giao")])
    road = nm.any_of([lowered.contains(w) for w in ("đường ", "phố ", "đại lộ", "quốc lộ")])
    return F.when(exact, 0.15).when(road, 0.05).otherwise(0.0)


def geocode_confidence(place: Column, distance_m: Column, mirrors: Column) -> Column:
    total = snap_confidence(distance_m) + place_bonus(place) + F.least(mirrors * 0.05, F.lit(0.15))
    return F.round(F.least(total, F.lit(1.0)), 3)


def event_confidence(snapped: Column, distance_m: Column, sources: Column) -> Column:
    base = F.when(distance_m < 50, 1.0).when(distance_m < 200, 0.7).otherwise(0.4)
    scored = F.least(F.lit(1.0), base * (1 + sources * 0.1))
    return F.when(~snapped, 0.3).when(distance_m.isNull(), 0.5).otherwise(scored)


def geo_confidence(road: Column, district: Column, city: Column) -> Column:
    return F.when(road.isNotNull(), 0.75).when(district.isNotNull(), 0.55).when(city.isNotNull(), 0.4).otherwise(0.0)


def alert_reason(jam: Column, speed: Column, baseline: Column) -> Column:
    return F.format_string("Jam factor %.1f; speed %.1f km/h versus baseline %.1f km/h", jam, speed, baseline)


def alert_explanation(
    jam: Column, speed: Column, baseline: Column, risk: Column, reliability_level: Column | None = None
) -> Column:
    """Sentences that explain an alert, in reading order."""
    sentences = [
        F.format_string("Jam factor is %.1f with speed %.1f km/h versus baseline %.1f km/h", jam, speed, baseline),
        F.format_string("Risk score is %.1f/100 (%s)", risk["risk_score"], risk["risk_level"]),
        F.when(
            F.size(risk["triggered_rules"]) > 0,
            F.concat(F.lit("Triggered risk signals: "), F.array_join(F.slice(risk["triggered_rules"], 1, 3), ", ")),
        ),
    ]
    if reliability_level is not None:
        sentences.append(F.concat(F.lit("Prediction reliability is "), reliability_level))
    return F.array_compact(F.array(*sentences))


def recommended_action(severity: Column) -> Column:
    return (
        F.when(severity.isin("CRITICAL", "HIGH"), "Prioritize monitoring this corridor and suggest an alternative route.")
        .when(severity == "MEDIUM", "Monitor the segment and keep route alternatives ready.")
        .otherwise("Track the segment; no immediate intervention required.")
    )


def scenario_speed(baseline: Column, rain_mm: Column, incident: Column, peak: Column) -> Column:
    """Speed under a rain, incident and peak-hour scenario."""
    wet = F.when(rain_mm > 0, F.greatest(F.lit(0.65), 1.0 - F.least(rain_mm, F.lit(40.0)) * 0.008)).otherwise(1.0)
    factor = F.lit(1.0)
    for name, value in INCIDENT_FACTORS.items():
        factor = F.when(incident == name, value).otherwise(factor)
    busy = F.when(peak, 0.9).otherwise(1.0)
    return F.round(F.greatest(F.lit(0.0), baseline * wet * factor * busy), 3)
