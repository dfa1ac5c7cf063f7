"""Filters with flags, continuity and quality reports, exact quantiles, column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F
from pyspark.sql import types as T

from panelforge.functions import geo, numeric as nm, text as tx, times as tm
from panelforge.session import cut_lineage

TRAFFIC_CRITICAL = {"has_null_speed": "currentSpeed", "has_null_timestamp": "event_time", "has_null_segment_id": "segment_id"}


def null_flags(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """One boolean per critical column."""
    return df.withColumns({name: F.col(source).isNull() for name, source in flags.items()})


def speed_outlier() -> Column:
    speed, jam = F.col("currentSpeed"), F.col("jamFactor")
    return (speed < 0) | (speed > 150) | (jam < 0) | (jam > 10)


def weather_out_of_range() -> Column:
    outside = lambda name, low, high: (F.col(name) < low) | (F.col(name) > high)
    return (
        outside("temp", -50, 60)
        | outside("humidity", 0, 100)
        | outside("pressure", 800, 1100)
        | outside("visibility", 0, 10000)
        | (F.col("wind_speed") < 0)
    )


def drop_flagged(df: DataFrame, condition: Column) -> DataFrame:
    """Keep rows where the condition is definitely false: unknown (null) goes as well."""
    return df.filter(~condition)


def counted(df: DataFrame, name: str, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach step counts that are filled by whatever action runs the plan - no extra pass."""
    watch = Observation(name)
    totals = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]]
    return df.observe(watch, *totals), watch


def retention_counts(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each successive filter and the share kept, from one aggregation."""
    passed, aggregates = F.lit(True), [F.count(F.lit(1)).alias("n0")]
    for i, (_, condition) in enumerate(steps, 1):
        passed = passed & F.coalesce(condition, F.lit(False))
        aggregates.append(F.count_if(passed).alias(f"n{i}"))
    names = ["input", *[name for name, _ in steps]]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"n{i}").alias("rows"),
                     F.when(F.col("n0") > 0, F.col(f"n{i}") / F.col("n0")).alias("share"))
            for i, n in enumerate(names)
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))


def clean_traffic_lake(df: DataFrame, boxes: dict = geo.CITY_BOXES) -> DataFrame:
    """Lake path of the traffic clean: critical nulls, +7 h, own-city box, outliers, partition columns."""
    flagged = null_flags(df, TRAFFIC_CRITICAL)
    kept = flagged.filter(~nm.any_of([F.col(n) for n in TRAFFIC_CRITICAL]))
    placed = kept.filter(geo.in_own_city(F.col("city"), F.col("lat"), F.col("lon"), boxes))
    sane = drop_flagged(placed, speed_outlier())
    return partition_columns(sane.withColumn("event_time", tm.shift_hours(F.col("event_time"))).drop(*TRAFFIC_CRITICAL))


def clean_weather_lake(df: DataFrame) -> DataFrame:
    kept = df.dropna(subset=["event_time", "city", "weather_cell_id"])
    sane = drop_flagged(kept, weather_out_of_range())
    return partition_columns(sane.withColumn("event_time", tm.shift_hours(F.col("event_time"))))


def partition_columns(df: DataFrame, ts: str = "time_bucket") -> DataFrame:
    return df.withColumns({"_year": F.year(ts), "_month": F.month(ts), "_day": F.dayofmonth(ts)})


def continuity_report(panel: DataFrame, bucket_minutes: int = 5) -> DataFrame:
    """Gaps of every series. The panel has one row per bucket, so a series is bounded by calendar time;
    ``median`` counts distinct gap lengths, again bounded."""
    gap = (tm.epoch(F.col("time_bucket")) - tm.epoch(F.lag("time_bucket").over(
        Window.partitionBy("city", "segment_id").orderBy("time_bucket")))) / 60.0
    gaps = panel.select("city", "segment_id", "time_bucket").distinct().withColumn("gap", gap)
    grouped = gaps.groupBy("city", "segment_id").agg(
        F.min("time_bucket").alias("min_time_bucket"),
        F.max("time_bucket").alias("max_time_bucket"),
        F.count(F.lit(1)).alias("record_count"),
        F.median("gap").alias("median_interval_minutes"),
        F.max("gap").alias("max_time_gap_minutes"),
        F.count_if(F.col("gap") == bucket_minutes).alias("_correct"),
        F.count("gap").alias("_gaps"),
    )
    span = tm.epoch(F.col("max_time_bucket")) - tm.epoch(F.col("min_time_bucket"))
    expected = F.floor(span / (bucket_minutes * 60)) + 1
    missing = F.greatest(expected - F.col("record_count"), F.lit(0))
    candidate = lambda rows: (F.col("record_count") >= rows) & (F.col("_correct") >= rows - 1)
    return grouped.select(
        "city", "segment_id", "min_time_bucket", "max_time_bucket", "record_count",
        expected.alias("expected_bucket_count"),
        missing.alias("missing_bucket_count"),
        (missing / expected).alias("missing_bucket_ratio"),
        "median_interval_minutes", "max_time_gap_minutes",
        F.when(F.col("_gaps") > 0, F.col("_correct") / F.col("_gaps")).alias("correct_interval_ratio"),
        candidate(4).alias("is_train_candidate_15m"),
        candidate(13).alias("is_train_candidate_60m"),
        candidate(49).alias("is_train_candidate_240m"),
    )


def city_continuity(report: DataFrame) -> DataFrame:
    """Totals per city; the median is exact and holds no map of a city's values."""
    totals = report.groupBy("city").agg(
        F.count(F.lit(1)).alias("segment_count"),
        F.sum("record_count").alias("total_records"),
        F.max("max_time_gap_minutes").alias("max_gap_minutes"),
    )
    median = exact_quantiles(report, ["city"], "correct_interval_ratio", [0.5])
    return totals.join(median.select("city", F.col("p50").alias("median_correct_interval_ratio")), "city", "left").select(
        "city", "segment_count", "total_records", "median_correct_interval_ratio", "max_gap_minutes"
    )


def worst_gaps(report: DataFrame, limit: int = 20) -> DataFrame:
    return report.orderBy(F.desc("missing_bucket_ratio"), "city", "segment_id").limit(limit)


def quality_rollup(report: DataFrame) -> DataFrame:
    """One-row health summary of the continuity report, with its two status bands."""
    rolled = report.agg(
        F.countDistinct("segment_id").alias("segments"),
        F.sum("record_count").alias("record_count"),
        F.round(F.avg("missing_bucket_ratio"), 4).alias("missing_bucket_ratio"),
        F.round(F.avg("correct_interval_ratio"), 4).alias("correct_interval_ratio"),
        F.count_if("is_train_candidate_15m").alias("train_candidate_15m"),
        F.count_if("is_train_candidate_60m").alias("train_candidate_60m"),
    )
    return rolled.withColumns(
        {
            "freshness_status": nm.ratio_status(F.col("missing_bucket_ratio"), 0.5, 0.8),
            "interval_status": nm.ratio_status(F.col("correct_interval_ratio"), 0.75, 0.5, lower_is_better=False),
        }
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; Parquet answers from footers."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(df: DataFrame, component: str, ts: str, as_of: str) -> DataFrame:
    """Age of the newest row against a given instant, with its status."""
    newest = df.agg(F.max(ts).alias("last_update"), F.count(F.lit(1)).alias("rows"))
    hours = F.greatest(F.lit(0.0), (tm.epoch(F.lit(as_of).cast("timestamp_ntz")) - tm.epoch(F.col("last_update"))) / 3600)
    aged = newest.withColumn("age_hours", F.round(hours, 2))
    return aged.select(
        F.lit(component).alias("component"), "last_update", "rows", "age_hours",
        nm.age_status(F.col("age_hours")).alias("status"),
        F.when(F.col("age_hours") <= 24, 0).otherwise(F.floor("age_hours")).cast("long").alias("lag_units"),
    )


def collection_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("segment_id").alias("unique_segments"),
        F.countDistinct("segment_name").alias("unique_names"),
        F.count_if(~tx.is_missing(F.col("geometry"))).alias("with_geometry"),
        F.count_if(F.col("currentSpeed").isNull() | F.col("jamFactor").isNull()).alias("missing_speed_or_jam"),
    )


#: Distinct values around a wanted rank that one task may sort.
FEW_VALUES = 4096


def exact_quantiles(df: DataFrame, keys: list[str], value: str, marks: list[float], bins: int = 4096) -> DataFrame:
    """Exact linear-interpolation quantiles per key for columns with unbounded distinct values.

    Histogram counts narrow every wanted rank down, round by round, until few distinct values lie around it; only these are
    ranked. The first round counts on a logarithmic scale, so outliers of any size share no bin with the rest; the next ones divide
    what is left of the range, as it really occurs, evenly. A round multiplies the resolution by ``bins``, so five are enough for all bits of
    a double. State per key is a histogram per rank, never the values themselves, so one key may hold most of the table.
    """
    base = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("x"))
    if not keys:
        base, keys = base.withColumn("_all", F.lit(0)), ["_all"]
        return exact_quantiles(base, keys, "x", marks, bins).drop("_all")
    # Stored once: three later steps read the counts, and the input may be expensive to derive.
    counts = cut_lineage(base.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c")))
    spread = counts.groupBy(*keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("c").alias("n"))
    positions = spread.select(
        *keys, "lo", "hi", "n",
        F.explode(F.array_distinct(F.flatten(F.array(*[
            F.array(F.floor((F.col("n") - 1) * m), F.ceil((F.col("n") - 1) * m)) for m in marks
        ])))).alias("rank"),
    )

    # Any scale that never falls will do: equal cells are told apart in the next round.
    size = F.floor((F.log(F.abs("x")) + 746) / 1456 * (bins // 2)) + 1
    by_size = F.when(F.col("x") == 0, F.lit(0).cast("long")).otherwise(F.when(F.col("x") < 0, -size).otherwise(size))
    width = (F.col("hi") - F.col("lo")) / bins
    evenly = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)

    def locate(wanted: DataFrame, cell: Column) -> DataFrame:
        """The bin of every wanted rank inside [lo, hi], the rank counted from its start, and how many distinct values it holds."""
        ranges = wanted.select(*keys, "lo", "hi").distinct()
        placed = counts.join(ranges, keys).filter(F.col("x").between(F.col("lo"), F.col("hi"))).withColumn("bin", cell)
        histogram = placed.groupBy(*keys, "lo", "hi", "bin").agg(
            F.sum("c").alias("bc"), F.count(F.lit(1)).alias("held"), F.min("x").alias("blo"), F.max("x").alias("bhi")
        )
        order = Window.partitionBy(*keys, "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        stacked = histogram.withColumn("start", F.coalesce(F.sum("bc").over(order), F.lit(0)))
        hit = stacked.join(wanted, [*keys, "lo", "hi"]).filter(
            (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("bc"))
        )
        return cut_lineage(hit.select(
            *keys, F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("rank") - F.col("start")).alias("rank"), "full", "n", "held"
        ))

    found = locate(positions.withColumn("full", F.col("rank")), by_size)
    while not found.filter(F.col("held") > FEW_VALUES).isEmpty():
        found = locate(found.drop("held"), evenly)
    slivers = counts.join(found.select(*keys, "lo", "hi").distinct(), keys).filter(F.col("x").between(F.col("lo"), F.col("hi")))
    order = Window.partitionBy(*keys, "lo", "hi").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    ranked = slivers.withColumn("start", F.coalesce(F.sum("c").over(order), F.lit(0)))
    at_rank = ranked.join(found, [*keys, "lo", "hi"]).filter(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("c"))
    )
    values = at_rank.groupBy(*keys).agg(
        F.map_from_entries(F.collect_set(F.struct("full", "x"))).alias("v"), F.max("n").alias("n")
    )

    def quantile(m: float) -> Column:
        spot = (F.col("n") - 1) * m
        low = F.try_element_at(F.col("v"), F.floor(spot))
        high = F.try_element_at(F.col("v"), F.ceil(spot))
        return low + (high - low) * (spot - F.floor(spot))

    return values.select(*keys, *[quantile(m).alias(f"p{round(m * 100):02d}") for m in marks])


# Columns that never enter a model, and those whose baseline looks at the whole history.
PROTECTED = (
    "city", "segment_id", "segment_name", "timestamp", "time_bucket", "event_time", "source_time_bucket", "date",
    "weather_cell_id", "source", "provider", "roadClosure", "future_speed_15m", "future_speed_60m", "future_speed_240m",
    "has_exact_target_15m", "has_exact_target_60m", "has_exact_target_240m", "target_speed", "split",
)
LEAKY = (
    "p15", "p50", "p85", "baseline_congestion_ratio", "speed_vs_p15", "speed_vs_p50", "speed_vs_p85",
    "speed_percentile_position", "is_below_p15", "is_above_p85", "is_between_p15_p50", "is_anomaly_vs_baseline",
)
LEAK_REASON = "global_baseline_potential_temporal_leakage"


def column_profile(df: DataFrame, target: str, dominance: float = 0.995) -> DataFrame:
    """(column, reason) of every column a model should not see.

    Columns are unpivoted to (column, value) and counted with partial aggregation, so a column with a
    distinct value per row costs a shuffle of counts, never a per-column map in one task.
    """
    checked = [f for f in df.schema.fields if f.name != target and f.name not in LEAKY and f.name not in PROTECTED]
    numeric = {f.name for f in checked if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    entries = [(n, LEAK_REASON) for n in LEAKY if n in df.columns] + [
        (n, "metadata_or_non_model_column") for n in PROTECTED if n in df.columns and n != target
    ]
    spark = df.sparkSession
    fixed = spark.createDataFrame(entries or [("", "")], "column string, reason string").filter("column <> ''")
    if not checked:
        return fixed
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("string").alias("value")) for f in checked])
    counts = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    present = F.when(F.col("value").isNotNull(), F.col("c"))
    stats = counts.groupBy("column").agg(
        F.count(present).alias("distinct"), F.coalesce(F.sum(present), F.lit(0)).alias("filled"), F.max(present).alias("top")
    )
    share = F.col("top") / F.col("filled")
    reason = (
        F.when(F.col("filled") == 0, "all_null")
        .when(F.col("distinct") <= 1, "constant")
        .when(share >= dominance, F.format_string("low_variance_top_ratio_%.4f", share))
        .when(~F.col("column").isin(*(numeric or {""})), "non_numeric_model_feature")
    )
    return fixed.unionByName(stats.select("column", reason.alias("reason")).filter(F.col("reason").isNotNull()))


def horizon_stats(features: DataFrame, city: str, horizons: tuple[int, ...] = (15, 60, 240), min_rows: int = 100) -> DataFrame:
    """Target and training rows per horizon; the longest horizon is never exported."""
    parts = []
    for h in horizons:
        has = F.col(f"future_speed_{h}m").isNotNull()
        history = F.col("valid_history_15m" if h == 15 else "valid_history_60m") == 1
        parts.append((h, F.count_if(has).alias(f"t{h}"), F.count_if(has & history & (F.col("city") == city)).alias(f"r{h}")))
    rows = F.array(*[F.struct(F.lit(h).alias("horizon_minutes"), F.col(f"t{h}").alias("exact_target_rows_all_cities"),
                              F.col(f"r{h}").alias("training_rows_primary_city")) for h, _, _ in parts])
    found = features.agg(*[c for _, t, r in parts for c in (t, r)]).select(F.inline(rows))
    enough = F.col("training_rows_primary_city") >= min_rows
    longest = F.col("horizon_minutes") == 240
    return found.withColumns(
        {
            "city": F.lit(city),
            "has_training_file": enough & ~longest,
            "note": F.when(longest, "240m intentionally not exported for baseline training")
            .when(enough, "enough_rows")
            .otherwise("insufficient_exact_horizon_rows"),
        }
    )


def leakage_checks(features: DataFrame, bucket_minutes: int, lags: range, horizons: tuple[int, ...]) -> DataFrame:
    """Recompute each lag and target by an equi join on the shifted instant and count disagreements.

    One self join answers all checks: every row offers its speed to the instants it should appear at.
    """
    shifts = {f"speed_lag_{k}": k * bucket_minutes for k in lags} | {f"future_speed_{h}m": -h for h in horizons}
    offers = F.array(*[F.struct(F.lit(n).alias("check"), F.lit(m).alias("shift")) for n, m in shifts.items()])
    offered = features.select(
        "city", "segment_id", F.col("time_bucket").alias("_from"), F.col("currentSpeed").alias("expected"), F.explode(offers).alias("_o")
    ).select(
        "city", "segment_id", F.col("_o.check").alias("check"), "expected",
        tm.from_epoch(tm.epoch(F.col("_from")) + F.col("_o.shift") * 60).alias("time_bucket"),
    )
    claims = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("double").alias("claimed")) for n in shifts])
    claimed = features.select("city", "segment_id", "time_bucket", F.inline(claims))
    joined = claimed.join(offered, ["city", "segment_id", "time_bucket", "check"], "left")
    wrong = ~F.col("claimed").eqNullSafe(F.col("expected"))
    return joined.groupBy("check").agg(
        F.count("claimed").alias("valid_rows"), F.count_if(wrong).alias("mismatches")
    ).withColumn("status", F.when(F.col("mismatches") == 0, "pass").otherwise("fail"))
