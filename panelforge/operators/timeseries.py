"""Leakage-safe panel features: exact offsets, past-only rolling values, row lags, baselines, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.functions import numeric as nm, times as tm
from panelforge.operators.halo import chunk_window, chunked, only_home
from panelforge.operators.ordering import placed

HORIZONS = (15, 60, 240)
LAGS = range(1, 13)
SERIES = ["city", "segment_id"]
POSITION = "_at"


def exact_offsets(
    df: DataFrame, wanted: dict[str, tuple[str, int]], series: list[str] = SERIES, ts: str = "time_bucket"
) -> DataFrame:
    """Value of a column exactly N minutes away (negative = past), null when that bucket does not exist.

    ``wanted`` maps the new name to (column, minutes). All offsets share one shuffle and one sort:
    RANGE frames of a single instant, inside bounded chunks of the series.
    """
    back = max([-m for _, m in wanted.values() if m < 0], default=0) * 60
    ahead = max([m for _, m in wanted.values() if m > 0], default=0) * 60
    chunk = max(4 * (back + ahead), 7 * 86400)
    spread = chunked(df.withColumn(POSITION, tm.epoch(F.col(ts))), F.col(POSITION), chunk, before=back, after=ahead)
    window = chunk_window(series, POSITION)
    new = {
        name: F.max(source).over(window.rangeBetween(minutes * 60, minutes * 60))
        for name, (source, minutes) in wanted.items()
    }
    return only_home(spread.withColumns(new)).drop(POSITION)


def lag_spec(bucket_minutes: int, lags: range = LAGS) -> dict[str, tuple[str, int]]:
    return {
        f"{short}_lag_{k}": (source, -k * bucket_minutes)
        for short, source in (("speed", "currentSpeed"), ("congestion", "congestion_ratio"))
        for k in lags
    }


def target_spec(horizons: tuple[int, ...] = HORIZONS) -> dict[str, tuple[str, int]]:
    return {f"future_speed_{h}m": ("currentSpeed", h) for h in horizons}


def trend_columns() -> dict[str, Column]:
    first, second = F.col("speed_lag_1") - F.col("speed_lag_2"), F.col("speed_lag_2") - F.col("speed_lag_3")
    return {"speed_trend_1": first, "speed_trend_2": second, "speed_acceleration": first - second}


def add_exact_lags(df: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    return exact_offsets(df, lag_spec(bucket_minutes)).withColumns(trend_columns())


def target_flags(horizons: tuple[int, ...] = HORIZONS) -> dict[str, Column]:
    return {f"has_exact_target_{h}m": F.col(f"future_speed_{h}m").isNotNull().cast("int") for h in horizons}


def add_exact_targets(df: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    return exact_offsets(df, target_spec(horizons)).withColumns(target_flags(horizons))


def _mean(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / len(columns)


def _sample_std(columns: list[Column]) -> Column:
    mean = _mean(columns)
    return F.sqrt(reduce(lambda a, b: a + b, [(c - mean) * (c - mean) for c in columns]) / (len(columns) - 1))


def past_rolling_columns() -> dict[str, Column]:
    """Means and deviations over the exact lags only; one missing lag makes the value null."""
    lags = lambda short, n: [F.col(f"{short}_lag_{k}") for k in range(1, n + 1)]
    spans = {"15m": 3, "30m": 6, "60m": 12}
    out = {}
    for label, n in spans.items():
        out[f"speed_rolling_avg_{label}"] = _mean(lags("speed", n))
        out[f"congestion_rolling_avg_{label}"] = _mean(lags("congestion", n))
        out[f"valid_history_{label}"] = reduce(lambda a, b: a & b, [c.isNotNull() for c in lags("speed", n)]).cast("int")
    for label in ("15m", "30m"):
        out[f"speed_volatility_{label}"] = _sample_std(lags("speed", spans[label]))
    return out


def add_past_rolling(df: DataFrame) -> DataFrame:
    return df.withColumns(past_rolling_columns())


def add_range_rolling(
    df: DataFrame, spans: tuple[int, ...] = (5, 15, 30), ts: str = "time_bucket", series: list[str] = SERIES
) -> DataFrame:
    """Trailing means over the last N minutes including the current row; deviation over the middle span."""
    reach = max(spans) * 60
    spread = chunked(
        df.withColumn(POSITION, tm.epoch(F.col(ts))), F.col(POSITION), max(4 * reach, 7 * 86400), before=reach
    )
    window = chunk_window(series, POSITION)
    new = {}
    for minutes in spans:
        frame = window.rangeBetween(-minutes * 60, 0)
        new[f"speed_rolling_avg_{minutes}m"] = nm.zero_if_missing(F.avg("currentSpeed").over(frame))
        new[f"congestion_rolling_avg_{minutes}m"] = nm.zero_if_missing(F.avg("congestion_ratio").over(frame))
    middle = spans[len(spans) // 2]
    deviation = F.stddev("currentSpeed").over(window.rangeBetween(-middle * 60, 0))
    new[f"speed_volatility_{middle}m"] = nm.zero_if_missing(deviation)
    return only_home(spread.withColumns(new)).drop(POSITION)


def add_row_lags(df: DataFrame, ts: str = "time_bucket", series: list[str] = SERIES) -> DataFrame:
    """Previous rows whatever their distance in time, missing → 0. The input is a deduplicated panel,
    so a series is bounded by its number of buckets."""
    window = Window.partitionBy(*series).orderBy(ts)
    lagged = df.withColumns(
        {
            **{f"speed_lag_{k}": F.lag("currentSpeed", k).over(window) for k in range(1, 5)},
            **{f"congestion_lag_{k}": F.lag("congestion_ratio", k).over(window) for k in (1, 2)},
        }
    )
    first, second = F.col("currentSpeed") - F.col("speed_lag_1"), F.col("speed_lag_1") - F.col("speed_lag_2")
    filled = [f"speed_lag_{k}" for k in range(1, 5)] + ["congestion_lag_1", "congestion_lag_2"]
    trends = {"speed_trend_1": first, "speed_trend_2": second, "speed_acceleration": first - second}
    return lagged.withColumns({n: nm.zero_if_missing(c) for n, c in trends.items()}).withColumns(
        {n: nm.zero_if_missing(F.col(n)) for n in filled}
    )


def add_row_leads(
    df: DataFrame, steps: dict[int, int], ts: str = "time_bucket", series: list[str] = SERIES
) -> DataFrame:
    """Row-count targets {horizon: rows ahead}; rows without any target go. Exact targets are the safe form."""
    window = Window.partitionBy(*series).orderBy(ts)
    out = df.withColumns({f"future_speed_{h}m": F.lead("currentSpeed", n).over(window) for h, n in steps.items()})
    return out.filter(nm.any_of([F.col(f"future_speed_{h}m").isNotNull() for h in steps]))


def gap_columns(bucket_minutes: int, ts: str = "time_bucket", series: list[str] = SERIES) -> dict[str, Column]:
    """Minutes since the previous bucket of the series, with the two gap flags."""
    previous = F.lag(ts).over(Window.partitionBy(*series).orderBy(ts))
    gap = (tm.epoch(F.col(ts)) - tm.epoch(previous)) / 60.0
    return {
        "time_gap_minutes": gap,
        "has_previous_exact_bucket": nm.flag(gap == bucket_minutes),
        "has_large_gap_before": nm.flag(gap > bucket_minutes),
    }


def add_time_features(df: DataFrame, bucket_minutes: int = 5, ts: str = "time_bucket") -> DataFrame:
    names = ("date", "hour_of_day", "day_of_week", "day_of_month", "month_of_year", "is_weekend", "is_peak_hour")
    clock = tm.calendar(F.col(ts))
    return df.withColumns({n: clock[n] for n in names}).withColumns(gap_columns(bucket_minutes, ts))


def add_base_features(df: DataFrame) -> DataFrame:
    return df.withColumn("congestion_ratio", nm.congestion_ratio(F.col("currentSpeed"), F.col("freeFlowSpeed")))


BASELINE_KEYS = ["city", "segment_id", "hour_of_day", "day_of_week"]


def percentile_baseline(df: DataFrame, keys: list[str] = BASELINE_KEYS) -> DataFrame:
    """Exact p15/p50/p85 per key, linear interpolation.

    ``percentile`` keeps a count per distinct value; on a deduplicated panel a group holds one value
    per bucket of one weekly hour, so that map is bounded by calendar time.
    """
    found = df.groupBy(*keys).agg(F.percentile("currentSpeed", [0.15, 0.5, 0.85]).alias("_p"))
    return found.select(*keys, *[F.col("_p")[i].alias(n) for i, n in enumerate(("p15", "p50", "p85"))])


def baseline_columns() -> dict[str, Column]:
    speed, free = F.col("currentSpeed"), F.col("freeFlowSpeed")
    p15, p50, p85 = F.col("p15"), F.col("p50"), F.col("p85")
    width = p85 - p15
    below, above = speed < p15, speed > p85
    return {
        "baseline_congestion_ratio": nm.congestion_ratio(p50, free),
        "speed_vs_p15": speed - p15,
        "speed_vs_p50": speed - p50,
        "speed_vs_p85": speed - p85,
        "speed_percentile_position": F.when(F.abs(width) > 0, nm.clip((speed - p15) / width, 0, 1)).otherwise(0.5),
        "is_below_p15": nm.flag(below),
        "is_above_p85": nm.flag(above),
        "is_between_p15_p50": nm.flag((speed >= p15) & (speed <= p50)),
        "is_anomaly_vs_baseline": nm.flag(below | above),
    }


def add_baseline(df: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Join the baseline of the row's weekly hour and compare the speed with it."""
    baseline = percentile_baseline(df) if baseline is None else baseline
    joined = df.join(baseline, BASELINE_KEYS, "left")
    filled = joined.withColumns({n: F.coalesce(F.col(n), F.col("currentSpeed")) for n in ("p15", "p50", "p85")})
    return filled.withColumns(baseline_columns())


def time_split(df: DataFrame, ts: str = "time_bucket", cuts: tuple[float, float] = (0.7, 0.85)) -> DataFrame:
    """train / validation / test by time quantiles.

    The quantile state is a count per distinct bucket (bounded by calendar time); the cut-offs come
    back as a scalar subquery, so no row is moved.
    """
    marks = df.agg(F.percentile(tm.epoch(F.col(ts)).cast("double"), list(cuts)).alias("m")).select("m").scalar()
    at = tm.epoch(F.col(ts))
    return df.withColumn(
        "split", F.when(at <= marks[0], "train").when(at <= marks[1], "validation").otherwise("test")
    )


def ordered_holdout(df: DataFrame, share: float = 0.8, ts: str = "time_bucket") -> DataFrame:
    """First ``share`` of the rows in time order → train, the rest → test, without sorting the rows.

    Rows are counted per bucket, buckets are range-partitioned, and running counts are taken per partition from the
    counts of the earlier ones. A bucket the cut falls into goes to train as a whole, so no instant is on both sides.
    """
    per_time = placed(df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n")), ts)
    # One row per partition: as long as the shuffle is wide.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_time.groupBy("_part").agg(F.sum("_n").alias("_s")).select("_part", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_base"))
    running = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = per_time.join(bases, "_part").select(ts, (F.col("_base") + F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    last = counted.filter(F.col("_before") < F.floor(total * share)).agg(F.max(ts).alias("t")).scalar()
    return df.withColumn("split", F.when(F.col(ts) <= last, "train").otherwise("test"))


def walk_forward(df: DataFrame, folds: list[tuple[str, str, str]], ts: str = "time_bucket") -> DataFrame:
    """Expanding folds (name, train end, validation end): each row once per fold it belongs to."""

    def role(train_end: str, valid_end: str) -> Column:
        at = F.col(ts)
        return F.when(at <= F.lit(train_end).cast("timestamp_ntz"), "train").when(
            at <= F.lit(valid_end).cast("timestamp_ntz"), "validation"
        )

    parts = F.array(*[F.struct(F.lit(name).alias("fold"), role(a, b).alias("role")) for name, a, b in folds])
    return df.withColumn("_f", F.explode(parts)).select("*", "_f.*").drop("_f").filter(F.col("role").isNotNull())
