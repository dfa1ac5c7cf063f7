"""Panel building: standard columns, range checks, one row per bucket, newest row per series.

Everything that aggregates raw rows here is a ``groupBy`` with partial aggregation, so a key that
holds a third of the input still reaches the shuffle as one row per map task. After the dedup a
series holds at most one row per bucket: its length is bounded by calendar time, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.functions import geo, numeric as nm, times as tm

PANEL_KEYS = ["city", "segment_id", "time_bucket"]
WEATHER_KEYS = ["city", "weather_cell_id", "time_bucket"]
TRAFFIC_REQUIRED = ["city", "segment_id", "event_time", "currentSpeed", "freeFlowSpeed", "jamFactor"]
WEATHER_REQUIRED = ["city", "weather_cell_id", "event_time", "temp", "humidity", "visibility", "wind_speed"]

# Spellings of the two main cities.
CITY_SPELLINGS = {
    "hanoi": ("ha_noi", "hà nội", "hanoi"),
    "hcmc": ("tp.hcm", "tphcm", "hcm", "hcmc", "ho chi minh", "ho_chi_minh", "hochiminh"),
}

# Column aliases of the second table layout.
COLUMN_ALIASES = {
    "current_speed": "currentSpeed",
    "free_flow_speed": "freeFlowSpeed",
    "jam_factor": "jamFactor",
    "p15_speed": "p15",
    "p50_speed": "p50",
    "p85_speed": "p85",
    "corridor_name": "segment_name",
    "road_class": "road_class_encoded",
}


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail while planning, not after hours of reading, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def normalize_city(city: Column) -> Column:
    plain = F.lower(F.trim(city.cast("string")))
    out = plain
    for name, spellings in CITY_SPELLINGS.items():
        out = F.when(plain.isin(*spellings), name).otherwise(out)
    return out


def align_columns(df: DataFrame) -> DataFrame:
    """Bring either table layout to the standard names; fill name, time and coordinates where absent."""
    have = set(df.columns)
    new = {target: F.col(source) for source, target in COLUMN_ALIASES.items() if source in have and target not in have}
    if "timestamp" not in have and "time_bucket" in have:
        new["timestamp"] = F.col("time_bucket")
    if "segment_name" not in have | set(new):
        new["segment_name"] = F.col("segment_id").cast("string")
    if "city" in have:
        new["city"] = normalize_city(F.col("city"))
    out = df.withColumns(new)
    if not {"lat", "lon"} <= have:
        lat, lon = geo.pseudo_coordinates(F.col("city"), F.col("segment_id"))
        out = out.withColumns({n: c for n, c in (("lat", lat), ("lon", lon)) if n not in have})
    return out


def clean_traffic(df: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    """Raw traffic → typed rows inside the valid ranges, with their bucket."""
    require_columns(df, TRAFFIC_REQUIRED)
    numbers = [c for c in ("lat", "lon", "currentSpeed", "freeFlowSpeed", "jamFactor", "confidence") if c in df.columns]
    stamp = _wall_time(df, "event_time")
    out = df.withColumns({"city": normalize_city(F.col("city")), "timestamp": stamp}).withColumns(
        {
            "source_time_bucket": _wall_time(df, "time_bucket") if "time_bucket" in df.columns else F.col("timestamp"),
            **{c: nm.to_double(F.col(c)) for c in numbers},
        }
    )
    out = out.withColumn("time_bucket", tm.floor_bucket(F.col("timestamp"), bucket_minutes))
    out = out.filter(
        F.col("city").isNotNull()
        & F.col("segment_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("currentSpeed").between(0, 150)
        & F.col("freeFlowSpeed").between(1, 180)
        & F.col("jamFactor").between(0, 10)
    )
    return out.withColumn("date", F.date_format("time_bucket", "yyyy-MM-dd"))


def clean_weather(df: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    """Raw weather → typed rows inside the valid ranges, with their bucket."""
    require_columns(df, WEATHER_REQUIRED)
    measures = ("temp", "feels_like", "humidity", "pressure", "visibility", "rain_1h", "wind_speed", "wind_deg")
    numbers = [c for c in ("lat", "lon", *measures) if c in df.columns]
    out = df.withColumns({"city": normalize_city(F.col("city")), "timestamp": _wall_time(df, "event_time")})
    out = out.withColumns({c: nm.to_double(F.col(c)) for c in numbers})
    if "rain_1h" not in df.columns:
        out = out.withColumn("rain_1h", F.lit(0.0))
    out = out.withColumn("time_bucket", tm.floor_bucket(F.col("timestamp"), bucket_minutes))
    return out.filter(
        F.col("city").isNotNull()
        & F.col("weather_cell_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("temp").between(-50, 60)
        & F.col("humidity").between(0, 100)
        & F.col("visibility").between(0, 10000)
        & (F.col("wind_speed") >= 0)
    )


def _wall_time(df: DataFrame, name: str) -> Column:
    """Text is UTC-based and moves to the local zone; a zone-less column is local already."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return tm.local_wall_time(F.col(name))
    if kind == "timestamp":
        return F.from_utc_timestamp(F.col(name), tm.LOCAL_ZONE).cast("timestamp_ntz")
    return F.col(name).cast("timestamp_ntz")


def newest(value: str, ts: str) -> Column:
    """Newest non-null value; equal times are settled by the larger value."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(F.col(ts), F.col(value))))


def collapse(df: DataFrame, keys: list[str], ts: str, means: list[str], lasts: list[str]) -> DataFrame:
    """One row per key: newest time, means of the metrics, newest attributes."""
    have = set(df.columns)
    return df.groupBy(*keys).agg(
        F.max(ts).alias(ts),
        *[F.avg(c).alias(c) for c in means if c in have],
        *[newest(c, ts).alias(c) for c in lasts if c in have],
        F.count(F.lit(1)).alias("source_rows"),
    )


def dedup_traffic(df: DataFrame) -> DataFrame:
    """One row per (city, segment, bucket); ``source_rows`` tells how many it stands for."""
    return collapse(
        df,
        PANEL_KEYS,
        "timestamp",
        ["currentSpeed", "freeFlowSpeed", "jamFactor", "confidence"],
        ["lat", "lon", "source", "provider", "segment_name", "weather_cell_id", "geometry", "roadClosure", "date"],
    )


def dedup_weather(df: DataFrame) -> DataFrame:
    return collapse(
        df,
        WEATHER_KEYS,
        "timestamp",
        ["temp", "feels_like", "humidity", "pressure", "visibility", "rain_1h", "wind_speed", "wind_deg"],
        ["lat", "lon", "source", "provider", "weather_main", "weather_desc"],
    )


def collapse_counts(deduped: DataFrame) -> DataFrame:
    """How many rows the dedup merged, as one row."""
    return deduped.agg(
        F.sum("source_rows").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.sum(F.col("source_rows") - 1).alias("rows_collapsed"),
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Key dedup with a defined survivor: the row that sorts first (one aggregation, no window)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def latest_by_segment(
    df: DataFrame, city: str | None = None, ts: str = "timestamp", columns: list[str] | None = None
) -> DataFrame:
    """Newest row of every (city, segment) as a partial-aggregated ``max_by``; the bucket settles ties.

    ``columns`` names what is needed besides the keys: a packed row cannot be pruned afterwards, so
    naming few columns keeps the scan and the shuffle narrow.
    """
    if columns is not None:
        keep = ["city", "segment_id", ts, *[c for c in ("time_bucket",) if c in df.columns], *columns]
        df = df.select(*dict.fromkeys(keep))
    if city:
        df = df.filter(F.col("city") == city)
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(F.col(ts), F.col("time_bucket")) if "time_bucket" in df.columns else F.struct(F.col(ts))
    newest_row = F.max_by(row, order).alias("_row")
    return df.filter(F.col(ts).isNotNull()).groupBy("city", "segment_id").agg(newest_row).select("_row.*")


def bucket_grid(df: DataFrame) -> DataFrame:
    """Distinct (city, segment, bucket) cells."""
    return df.select(*PANEL_KEYS).dropna().distinct()
