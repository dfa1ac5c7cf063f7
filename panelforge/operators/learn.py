"""Feature alignment, Spark ML training, batch prediction, metrics and attribution."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelforge.functions import numeric as nm, times as tm
from panelforge.operators import quality as ql
from panelforge.operators.sparse_forest import SparseForestRegressor

# Model inputs of the panel.
MODEL_FEATURES = [
    "hour_of_day", "day_of_week", "is_weekend", "is_peak_hour", "is_holiday_vn",
    "congestion_ratio", "speed_rolling_avg_5m", "speed_rolling_avg_15m", "speed_rolling_avg_30m",
    "congestion_rolling_avg_5m", "congestion_rolling_avg_15m", "speed_volatility_15m",
    "weather_temperature", "weather_humidity", "weather_rain_1h", "weather_visibility", "weather_wind_speed",
    "weather_severity", "has_rain",
    "road_class_encoded", "length_m", "is_short_segment", "speed_limit_encoded", "district_segment_count",
    "direction_quadrant",
    "p15", "p50", "p85", "baseline_congestion_ratio", "speed_vs_p15", "speed_vs_p50", "speed_vs_p85",
    "speed_percentile_position", "is_below_p15", "is_above_p85", "is_between_p15_p50", "is_anomaly_vs_baseline",
    "speed_lag_1", "speed_lag_2", "speed_lag_3", "speed_lag_4", "congestion_lag_1", "congestion_lag_2",
    "speed_trend_1", "speed_trend_2", "speed_acceleration",
    "has_accident", "has_flood", "has_roadwork", "has_any_event", "max_accident_severity_1h", "max_flood_severity_1h",
    "max_roadwork_severity_1h", "max_event_severity_1h",
    "degree_centrality", "betweenness_centrality", "closeness_centrality", "degree_centrality_encoded",
    "betweenness_centrality_encoded", "network_importance_score",
]

# Columns that must never be model inputs.
FORBIDDEN_FEATURES = {
    "target", "target_speed", "target_speed_15m", "target_speed_60m", "timestamp", "time_bucket", "time_bucket_local",
    "prediction", "predicted_speed_kph", "actual_target_speed_kph", "horizon", "task", "model",
    "future_speed_15m", "future_speed_60m", "future_speed_240m", "split",
}

# Other names under which a model may ask for a column.
FEATURE_ALIASES = {
    "current_speed_kph": "currentSpeed", "free_flow_speed_kph": "freeFlowSpeed", "current_jam_factor": "jamFactor",
    "jam_factor": "jamFactor", "latitude": "lat", "longitude": "lon", "city_key": "city", "road_name": "segment_name",
    "road": "segment_name", "road_class": "road_class_encoded", "is_vn_public_holiday": "is_holiday_vn",
    "weather_temperature_c": "weather_temperature", "weather_humidity_pct": "weather_humidity",
    "weather_wind_speed_mps": "weather_wind_speed", "weather_rain_1h_mm": "weather_rain_1h",
    "weather_visibility_m": "weather_visibility", "rain_flag": "has_rain", "weather_risk_score": "weather_severity",
    "eventctx_has_event_signal_v1": "has_any_event", "event_severity_score": "max_event_severity_1h",
    "district_name": "district",
    "speed_roll_mean_4": "speed_rolling_avg_15m", "speed_roll_mean_6": "speed_rolling_avg_30m",
    "speed_roll_mean_12": "speed_rolling_avg_60m", "speed_roll_std_4": "speed_volatility_15m",
    "speed_roll_std_6": "speed_volatility_30m", "speed_roll_std_12": "speed_volatility_30m",
    "congestion_roll_mean_4": "congestion_rolling_avg_15m", "congestion_roll_mean_6": "congestion_rolling_avg_30m",
    "congestion_roll_mean_12": "congestion_rolling_avg_60m", "jam_roll_mean_4": "congestion_rolling_avg_15m",
    "jam_roll_mean_12": "congestion_rolling_avg_60m",
}

# Name parts that mark a categorical input (its default is "unknown", not 0).
CATEGORICAL_MARKS = (
    "city", "district", "road", "segment", "weather_main", "weather_desc", "source", "peak_period", "corridor",
    "rain_intensity", "event_type",
)
RAIN_STAND_INS = {"heavy_rain_flag", "rain_roll_sum_4", "rain_roll_sum_12", "rain_lag_1", "rain_lag_4"}


def normalize_horizon(horizon: str | int) -> str:
    names = {"15m": ("15", "15m", "15min", "15mins"), "60m": ("60", "60m", "60min", "60mins"),
             "240m": ("240", "240m", "240min", "240mins", "4h")}
    text = str(horizon).strip().lower()
    for name, spellings in names.items():
        if text in spellings:
            return name
    raise ValueError("horizon must be 15m, 60m or 240m")


def check_features(names: list[str]) -> list[str]:
    """Refuse targets, ids and run metadata as inputs."""
    bad = sorted(set(names) & FORBIDDEN_FEATURES)
    if bad:
        raise ValueError(f"forbidden model features: {bad}")
    return names


def _clock(ts: Column) -> dict[str, Column]:
    hour, weekday = F.hour(ts), F.weekday(ts)
    hour_sin, hour_cos = tm.cyclic(hour, 24)
    day_sin, day_cos = tm.cyclic(weekday, 7)
    return {
        "local_hour": hour, "hour_of_day": hour, "local_minute": F.minute(ts), "day_of_week": weekday,
        "local_dow": weekday, "month_of_year": F.month(ts), "day_of_month": F.dayofmonth(ts),
        "is_weekend": weekday.isin(5, 6).cast("int"), "is_peak_hour": hour.isin(*tm.PEAK_HOURS).cast("int"),
        "hour_sin": hour_sin, "hour_cos": hour_cos, "day_of_week_sin": day_sin, "dow_sin": day_sin,
        "day_of_week_cos": day_cos, "dow_cos": day_cos,
    }


def _derived(name: str, have: set[str], ts: str) -> list[Column]:
    """Ways to obtain a feature that the row does not carry under its own name, best first."""
    out = []
    if FEATURE_ALIASES.get(name) in have:
        out.append(F.col(FEATURE_ALIASES[name]))
    if name.startswith("jam_lag_") and name.replace("jam_lag_", "congestion_lag_") in have:
        out.append(F.col(name.replace("jam_lag_", "congestion_lag_")))
    if name == "speed_ratio" and {"currentSpeed", "freeFlowSpeed"} <= have:
        out.append(F.when(F.col("freeFlowSpeed") > 0, F.col("currentSpeed") / F.col("freeFlowSpeed")))
    rain = F.col("weather_rain_1h") if "weather_rain_1h" in have else F.lit(0.0)
    true = lambda n: F.coalesce(F.col(n).cast("double") > 0, F.lit(False)) if n in have else F.lit(False)
    if name == "rain_intensity_level":
        out.append(F.when(rain >= 10, "heavy").when(rain > 0, "light").otherwise("none"))
    if name == "weather_main":
        out.append(F.when(true("has_rain"), "rain").otherwise("clear"))
    if name == "event_type":
        out.append(F.when(true("has_accident"), "accident").when(true("has_flood"), "flood")
                   .when(true("has_roadwork"), "roadwork").otherwise("none"))
    if name in RAIN_STAND_INS:
        out.append(rain.cast("double"))
    if name == "row_has_complete_lag_features":
        out.append(true("valid_history_60m" if "valid_history_60m" in have else "valid_history_30m").cast("int"))
    if ts in have and name in _clock(F.col(ts)):
        out.append(_clock(F.col(ts))[name])
    return out


def align_features(df: DataFrame, wanted: list[str], keep: list[str], ts: str = "time_bucket") -> DataFrame:
    """Rows in a model's schema: own value, else alias or derivation, else default - and what was filled.

    Adds required/available/filled counts, the names filled in, and the coverage ratio.
    """
    check_features(wanted)
    have = set(df.columns)
    values, absent = {}, []
    for name in wanted:
        options = ([F.col(name)] if name in have else []) + _derived(name, have, ts)
        categorical = any(mark in name.lower() for mark in CATEGORICAL_MARKS)
        kind = "string" if categorical or name in ("weather_main", "rain_intensity_level") else "double"
        known = F.coalesce(*[o.cast(kind) for o in options]) if options else F.lit(None).cast(kind)
        if kind == "double":
            known = F.nanvl(known, F.lit(None).cast("double"))
        values[name] = F.coalesce(known, F.lit("unknown") if kind == "string" else F.lit(0.0))
        absent.append(F.when(known.isNull(), F.lit(name)))
    missing = F.array_compact(F.array(*absent))
    aligned = df.select(*[F.col(k).alias(f"_k_{k}") for k in keep], missing.alias("missing_features"), *[c.alias(n) for n, c in values.items()])
    filled = F.size("missing_features")
    return aligned.select(
        *[F.col(f"_k_{k}").alias(k) for k in keep if k not in values], *wanted, "missing_features",
        F.lit(len(wanted)).alias("required_feature_count"),
        (F.lit(len(wanted)) - filled).alias("available_feature_count"),
        filled.alias("filled_feature_count"),
        (1 - filled / len(wanted)).alias("feature_coverage_ratio"),
    )


def training_rows(df: DataFrame, features: list[str], targets: list[str]) -> tuple[DataFrame, list[str]]:
    """Rows with at least one target, missing inputs as 0, and the inputs that exist."""
    usable = check_features([f for f in features if f in df.columns])
    kept = df.filter(nm.any_of([F.col(t).isNotNull() for t in targets]))
    return kept.withColumns({f: nm.zero_if_missing(F.col(f)) for f in usable}), usable


def hash_sample(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """About ``share`` of the rows, repeatable, chosen by key hash: for a fit that is to read fewer."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, 8), 16, 10)
    return df.filter(digits.cast("double") / 4294967296.0 < share)


def boosted_trees(
    features: list[str], target: str, rounds: int = 100, depth: int = 5, rate: float = 0.05, held: str | None = None, seed: int = 7
) -> Pipeline:
    """Up to ``rounds`` trees of some 31 leaves; ``held`` names a boolean column of rows that stop the rounds early."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    model = GBTRegressor(labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=0.7, seed=seed)
    if held:
        model = model.setValidationIndicatorCol(held)
    return Pipeline(stages=[assembler, model])


def forest(numeric: list[str], categorical: list[str], target: str, trees: int = 160, leaf: int = 2, seed: int = 7) -> Pipeline:
    """Median impute of numbers, mode impute of texts, index + one-hot with a slot for texts unseen in the fit, many trees."""
    stages = [Imputer(strategy="median", inputCols=numeric, outputCols=[f"{n}_f" for n in numeric])]
    if categorical:
        # The most frequent text has index 0, so that is what a missing text gets.
        stages.append(StringIndexer(inputCols=categorical, outputCols=[f"{n}_k" for n in categorical], handleInvalid="keep", stringOrderType="frequencyDesc"))
        mode = ", ".join(f"IF(`{n}` IS NULL, 0.0D, `{n}_k`) AS `{n}_i`" for n in categorical)
        stages.append(SQLTransformer(statement=f"SELECT *, {mode} FROM __THIS__"))
        stages.append(OneHotEncoder(inputCols=[f"{n}_i" for n in categorical], outputCols=[f"{n}_v" for n in categorical], handleInvalid="keep"))
    inputs = [f"{n}_f" for n in numeric] + [f"{n}_v" for n in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    # Spark's own forest holds a number per slot and row.
    stages.append(SparseForestRegressor(target, len(numeric), trees=trees, leaf=leaf, depth=8, seed=seed))
    return Pipeline(stages=stages)


def fit_horizons(train: DataFrame, features: list[str], horizons: tuple[int, ...], **options) -> dict[int, PipelineModel]:
    """One boosted model per horizon, each on the rows that have its target."""
    models = {}
    for h in horizons:
        target = f"future_speed_{h}m"
        rows = train.filter(F.col(target).isNotNull())
        if not rows.isEmpty():
            models[h] = boosted_trees(features, target, **options).fit(rows)
    return models


@dataclass(frozen=True)
class ModelBundle:
    """Fitted models by horizon name with the features each was fitted on, in order."""

    name: str
    models: dict[str, PipelineModel]
    features: dict[str, list[str]]


def predict_horizons(df: DataFrame, models: dict[int, PipelineModel], keep: list[str], prediction_time: Column) -> DataFrame:
    """One prediction column per horizon beside the keys."""
    out = df
    for h, model in models.items():
        scored = model.transform(out).drop("features").withColumnRenamed("prediction", f"predicted_speed_{h}m")
        out = scored
    return out.select(*keep, prediction_time.alias("prediction_timestamp"), *[f"predicted_speed_{h}m" for h in models])


def importances(model: PipelineModel, spark, features: list[str], top: int = 5) -> DataFrame:
    """Most important inputs of a fitted tree model (as many values as inputs)."""
    pairs = sorted(zip(features, model.stages[-1].featureImportances.toArray().tolist()), key=lambda p: -p[1])[:top]
    return spark.createDataFrame(pairs, "feature string, importance double")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: list[str]) -> DataFrame:
    """n, MAE, RMSE, R² and MAPE per group from one pass of moment sums."""
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    sums = df.filter(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("_sse"), (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.when(y != 0, F.abs(e / y))).alias("mape"),
    )
    r2 = F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst"))
    return sums.withColumn("r2", r2).drop("_sse", "_sst")


def error_quantiles(df: DataFrame, actual: str, predicted: str, by: list[str]) -> DataFrame:
    errors = df.select(*by, F.abs(F.col(actual) - F.col(predicted)).alias("abs_error"))
    return ql.exact_quantiles(errors, by, "abs_error", [0.5, 0.9, 0.95, 1.0])


def baseline_values(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(feature, baseline): exact median of numbers, mode of texts (smallest of equals)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), nm.finite(F.col(n)).alias("x")) for n in numeric])
    medians = ql.exact_quantiles(df.select(F.inline(pairs)), ["feature"], "x", [0.5])
    out = medians.select("feature", F.col("p50").cast("string").alias("baseline"))
    if categorical:
        texts = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("string").alias("v")) for n in categorical])
        counts = df.select(F.inline(texts)).filter(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c"))
        best = counts.groupBy("feature").agg(F.min_by("v", F.struct((-F.col("c")).alias("n"), F.col("v"))).alias("baseline"))
        out = out.unionByName(best)
    return out


def attribution(rows: DataFrame, model: PipelineModel, features: list[str], baseline: dict[str, float], keys: list[str],
                top: int = 8, floor: float = 0.001) -> DataFrame:
    """Top features per row by how far the prediction moves when one input takes its baseline.

    Every row becomes one row per feature plus one unchanged row and the model runs once over all.
    """
    estimator = model.stages[-1]
    values = F.array(*[nm.zero_if_missing(F.col(f)) for f in features])
    base = F.array(*[F.lit(float(baseline.get(f, 0.0))) for f in features])
    known = F.array(*[F.lit(f in baseline) for f in features])
    spread = rows.select(*keys, values.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("_j"))
    changed = F.transform("_x", lambda v, i: F.when(i + 1 == F.col("_j"), F.element_at(base, i + 1)).otherwise(v))
    scored = estimator.transform(spread.withColumn("features", array_to_vector(changed)))
    whole = F.max(F.when(F.col("_j") == 0, F.col("prediction"))).over(Window.partitionBy(*keys))
    effect = scored.withColumn("_whole", whole).filter((F.col("_j") > 0) & F.element_at(known, F.greatest(F.col("_j"), F.lit(1))))
    effect = effect.withColumn("contribution", F.round(F.col("_whole") - F.col("prediction"), 3))
    effect = effect.filter(F.abs(F.col("_whole") - F.col("prediction")) >= floor)
    names = F.array(*[F.lit(f) for f in features])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(F.abs("contribution")), "_j"))
    ranked = effect.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select(
        *keys, "rank", F.element_at(names, F.col("_j")).alias("feature"), F.element_at("_x", F.col("_j")).alias("value"),
        F.element_at(base, F.col("_j")).alias("baseline_value"), "contribution",
        F.when(F.col("contribution") > 0, "raises_speed").otherwise("lowers_speed").alias("direction"),
    )


def select_models(metrics: DataFrame, by: str, family: str, error: str, preferred: str, within: float) -> DataFrame:
    """Lowest error per group; the preferred family wins while it is within the given distance of the best."""
    best = F.min(error).over(Window.partitionBy(by))
    chosen = metrics.withColumn("_pref", (F.col(family) == preferred) & (F.col(error) <= best + within))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("_pref"), error, family))
    return chosen.withColumn("_r", rank).filter("_r = 1").drop("_r", "_pref")


def join_manifest(summary: DataFrame, manifest: DataFrame) -> DataFrame:
    """Model summary with artifact facts of its horizon, which the task name holds."""
    task = F.col("task")
    horizon = F.when(task.contains("15m"), "15m").when(task.contains("60m"), "60m").when(task.contains("240m"), "240m").otherwise("")
    return summary.withColumn("horizon", horizon).join(manifest, "horizon", "left")


def coverage_by_segment(aligned: DataFrame, horizon: str) -> DataFrame:
    """Mean filled features, coverage, rows and level per segment."""
    stats = aligned.groupBy("segment_id").agg(
        F.avg("filled_feature_count").alias("mean_filled"), F.avg("feature_coverage_ratio").alias("coverage_ratio"), F.count(F.lit(1)).alias("rows")
    )
    level = F.when(F.col("coverage_ratio") >= 0.9, "high").when(F.col("coverage_ratio") >= 0.7, "medium").otherwise("low")
    return stats.withColumns({"horizon": F.lit(horizon), "coverage_level": level})
