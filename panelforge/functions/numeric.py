"""Numeric column rules: ratios, bands and ordinals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value)))


def finite(value: Column) -> Column:
    """±infinity and NaN become null."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def zero_if_missing(value: Column) -> Column:
    """Null and NaN become 0."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def to_double(value: Column) -> Column:
    """Numeric coercion where bad text becomes null."""
    return value.try_cast("double")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def band(value: Column, steps: list[tuple[float, object]], default: object) -> Column:
    """First step whose lower bound the value reaches; ``steps`` run from high to low."""
    out = None
    for bound, label in steps:
        out = F.when(value >= bound, F.lit(label)) if out is None else out.when(value >= bound, F.lit(label))
    return out.otherwise(F.lit(default))


def congestion_ratio(speed: Column, free_flow: Column) -> Column:
    """1 − speed / free flow inside [0, 1]; 0 where free flow is not positive."""
    return F.when(free_flow > 0, clip(1.0 - speed / free_flow, 0, 1)).otherwise(F.lit(0.0))


def jam_factor(speed: Column, free_flow: Column) -> Column:
    """0 to 10 by lost speed, two decimals; null where free flow is not positive."""
    return F.when(free_flow > 0, F.round(clip((1.0 - speed / free_flow) * 10.0, 0, 10), 2))


def speed_ratio(speed: Column, free_flow: Column) -> Column:
    return F.when(free_flow > 0, speed / free_flow).otherwise(F.lit(0.0))


def congestion_level(ratio: Column) -> Column:
    return band(ratio, [(0.75, "Free"), (0.5, "Slow"), (0.3, "Congested")], "Severe")


def delay_minutes(ratio: Column, jam: Column) -> Column:
    """Whole minutes, half to even, never negative."""
    raw = (1.0 - clip(ratio, 0, 1)) * 18 + jam * 0.6
    return F.greatest(F.lit(0), F.bround(raw, 0).cast("int"))


JAM_STEPS = [(8, "critical"), (6, "high"), (3, "medium")]


def jam_severity(jam: Column, upper: bool = True) -> Column:
    steps = [(b, s.upper()) for b, s in JAM_STEPS] if upper else JAM_STEPS
    return band(jam, steps, "LOW" if upper else "low")


def corridor_status(jam: Column) -> Column:
    return band(jam, [(6, "congested"), (3, "slow")], "free")


def road_priority(road_type: Column, name: Column) -> Column:
    kind, label = F.lower(road_type), F.lower(F.coalesce(name, F.lit("")))
    major = (kind == "highway") | any_of([label.contains(w) for w in ("bridge", "vanh dai", "highway")])
    return F.when(major, 1).when(kind == "arterial", 2).when(kind == "collector", 3).otherwise(4)


def allowed_priority(zoom: int, density: str = "medium") -> int:
    """Lowest road class shown at a zoom level and density."""
    limit = 2 if zoom <= 11 else 3 if zoom <= 13 else 4
    if density == "low":
        return min(limit, 2)
    return 4 if density == "high" and zoom >= 13 else limit


# Ordinal of each road class.
ROAD_CLASS_ORDINAL = {"motorway": 5, "trunk": 4, "primary": 3, "secondary": 2, "residential": 1}


def road_class_ordinal(road_class: Column) -> Column:
    out = F.lit(0)
    for name, rank in ROAD_CLASS_ORDINAL.items():
        out = F.when(road_class == name, rank).otherwise(out)
    return out


def speed_limit_ordinal(limit: Column) -> Column:
    return band(limit, [(80, 3), (50, 2), (30, 1)], 0)


def direction_quadrant(lat: Column, lon: Column, lat0: float = 20.8, lon0: float = 105.8) -> Column:
    """1 NE, 2 NW, 3 SE, 4 SW (and unknown) of the origin."""
    north, east = lat > lat0, lon > lon0
    return F.when(north & east, 1).when(north & (lon <= lon0), 2).when((lat <= lat0) & east, 3).otherwise(4)


def centrality_code(value: Column) -> Column:
    return F.when(value > 0.7, 2).when(value > 0.3, 1).otherwise(0)


def network_importance(degree: Column, betweenness: Column, closeness: Column) -> Column:
    return 0.4 * degree + 0.4 * betweenness + 0.2 * closeness


def age_status(hours: Column) -> Column:
    """Healthy up to a day, degraded up to a week."""
    hours = F.greatest(F.lit(0.0), hours)
    return F.when(hours <= 24, "healthy").when(hours <= 168, "degraded").otherwise("unhealthy")


def ratio_status(ratio: Column, warn: float, error: float, lower_is_better: bool = True) -> Column:
    bad, poor = (ratio >= error, ratio >= warn) if lower_is_better else (ratio <= error, ratio <= warn)
    return F.when(ratio.isNull() | bad, "unhealthy").when(poor, "degraded").otherwise("healthy")
