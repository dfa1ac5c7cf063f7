"""Splits, profiles, leakage checks, metrics, alignment and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import learn as ln, quality as ql, timeseries as ts
from panelforge.operators.panel import latest_by_segment
from panelforge.plans import builds, dashboards as db
from panelforge.session import cut_lineage
from workload import derive as dv
from workload.registry import pick, query, tidy
from workload.series_queries import BASELINE, HORIZONS, KEYS, LAGGED, ROLL_SQL, _shifted


@query("time_split", f"""WITH {dv.PANEL}, q AS (SELECT quantile_cont(epoch(time_bucket), 0.7) AS a, quantile_cont(epoch(time_bucket), 0.85) AS b FROM panel)
    SELECT city, segment_id, time_bucket, CASE WHEN epoch(time_bucket) <= a THEN 'train' WHEN epoch(time_bucket) <= b THEN 'validation' ELSE 'test' END AS split FROM panel, q""")
def time_split(spark, sf):
    return ts.time_split(dv.panel(spark, sf)).select(*KEYS.split(), "split")


@query("ordered_holdout", f"""WITH {dv.PANEL}, c AS (SELECT time_bucket, sum(count(*)) OVER (ORDER BY time_bucket) - count(*) AS before FROM panel GROUP BY time_bucket), m AS (SELECT max(time_bucket) AS t FROM c WHERE before < floor((SELECT count(*) FROM panel) * 0.8))
    SELECT city, segment_id, time_bucket, CASE WHEN time_bucket <= t THEN 'train' ELSE 'test' END AS split FROM panel, m""")
def ordered_holdout(spark, sf):
    return ts.ordered_holdout(dv.panel(spark, sf)).select(*KEYS.split(), "split")


FOLDS = [("f1", "2024-01-10 00:00:00", "2024-01-15 00:00:00"), ("f2", "2024-01-15 00:00:00", "2024-01-20 00:00:00"), ("f3", "2024-01-20 00:00:00", "2024-01-25 00:00:00")]


@query("walk_forward_folds", f"""WITH {dv.PANEL}, f(fold, a, b) AS (VALUES {', '.join(f"('{n}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for n, a, b in FOLDS)}), r AS (SELECT fold, CASE WHEN time_bucket <= a THEN 'train' WHEN time_bucket <= b THEN 'validation' END AS role, currentSpeed FROM panel, f)
    SELECT fold, role, count(*) AS n, round(avg(currentSpeed), 6) + 0.0 AS mean_speed FROM r WHERE role IS NOT NULL GROUP BY fold, role""")
def walk_forward_folds(spark, sf):
    rows = ts.walk_forward(dv.panel(spark, sf), FOLDS)
    return tidy(rows.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.avg("currentSpeed").alias("mean_speed")))


PROFILED = ["event_type", "user_id", "flat", "mostly", "empty", "p50", "value"]


@query("column_profile", """WITH s AS (SELECT event_type, user_id, 1 AS flat, CASE WHEN event_id % 400 = 7 THEN 2 ELSE 1 END AS mostly, NULL::DOUBLE AS empty, value FROM events)
    SELECT 'event_type' AS column, 'non_numeric_model_feature' AS reason UNION ALL SELECT 'flat', 'constant' FROM (SELECT count(DISTINCT flat) AS d FROM s) WHERE d = 1
    UNION ALL SELECT 'mostly', 'low_variance_top_ratio_' || printf('%.4f', max(c) / sum(c)) FROM (SELECT count(*) AS c FROM s GROUP BY mostly) HAVING max(c) / sum(c) >= 0.995 UNION ALL SELECT 'empty', 'all_null' FROM (SELECT count(empty) AS n FROM s) WHERE n = 0
    UNION ALL SELECT 'p50', 'global_baseline_potential_temporal_leakage' UNION ALL SELECT 'city', 'metadata_or_non_model_column'""")
def column_profile(spark, sf):
    e = F.col("event_id")
    rows = dv.table(spark, sf, "events").select(
        "event_type", "user_id", F.lit(1).alias("flat"), F.when(e % 400 == 7, 2).otherwise(1).alias("mostly"), F.lit(None).cast("double").alias("empty"), "value",
        F.col("value").alias("p50"), F.lit("x").alias("city"), F.col("value").alias("goal"),
    )
    return ql.column_profile(rows, "goal")


TARGET_SQL = ", ".join(_shifted(h // 60, f"future_speed_{h}m", "currentSpeed") for h in HORIZONS)


def _features(spark, sf):
    base = dv.based(spark, sf)
    return ts.exact_offsets(base, {**ts.lag_spec(dv.BUCKET), **ts.target_spec(HORIZONS)})


@query("leakage_checks", f"""WITH {LAGGED}, t AS (SELECT a.*, {TARGET_SQL} FROM lagged a) {' UNION ALL '.join(f"SELECT '{c}' AS check, count({c}) AS valid_rows, 0 AS mismatches, 'pass' AS status FROM t" for c in [f'speed_lag_{k}' for k in range(1, 13)] + [f'future_speed_{h}m' for h in HORIZONS])}""")
def leakage_checks(spark, sf):
    return ql.leakage_checks(cut_lineage(_features(spark, sf)), dv.BUCKET, ts.LAGS, HORIZONS)


@query("horizon_stats", f"""WITH {LAGGED}, t AS (SELECT a.*, {ROLL_SQL}, {', '.join(_shifted(k, f'future_speed_{h}m', 'currentSpeed') for k, h in ((1, 15), (2, 60), (4, 240)))} FROM lagged a),
    s AS ({' UNION ALL '.join(f"SELECT {h} AS horizon_minutes, count(future_speed_{h}m) AS exact_target_rows_all_cities, count(*) FILTER (future_speed_{h}m IS NOT NULL AND city = 'hanoi' AND valid_history_{'15m' if h == 15 else '60m'} = 1) AS training_rows_primary_city FROM t" for h in (15, 60, 240))})
    SELECT *, 'hanoi' AS city, training_rows_primary_city >= 100 AND horizon_minutes <> 240 AS has_training_file, CASE WHEN horizon_minutes = 240 THEN '240m intentionally not exported for baseline training' WHEN training_rows_primary_city >= 100 THEN 'enough_rows' ELSE 'insufficient_exact_horizon_rows' END AS note FROM s""")
def horizon_stats(spark, sf):
    wanted = {**ts.lag_spec(dv.BUCKET), "future_speed_15m": ("currentSpeed", 60), "future_speed_60m": ("currentSpeed", 120), "future_speed_240m": ("currentSpeed", 240)}
    rows = ts.add_past_rolling(ts.exact_offsets(dv.based(spark, sf), wanted))
    return ql.horizon_stats(rows, "hanoi")


PRED = f"{dv.BASED}, pr AS (SELECT a.city, a.segment_id, a.currentSpeed AS y, {_shifted(-1, 'p', 'currentSpeed')} FROM based a)"


def carried(spark, sf):
    """Speed of the previous exact bucket as a forecast."""
    return ts.exact_offsets(dv.based(spark, sf), {"p": ("currentSpeed", -60)}).withColumn("y", F.col("currentSpeed"))


@query("regression_metrics", f"""WITH {PRED}, k AS (SELECT * FROM pr WHERE p IS NOT NULL) SELECT city, count(*) AS n, round(avg(abs(y - p)), 6) + 0.0 AS mae, round(sqrt(avg((y - p) ^ 2)), 6) + 0.0 AS rmse,
    round(1 - sum((y - p) ^ 2) / (var_pop(y) * count(*)), 6) + 0.0 AS r2, round(avg(abs((y - p) / nullif(y, 0))), 4) + 0.0 AS mape FROM k GROUP BY city""")
def regression_metrics(spark, sf):
    return tidy(ln.regression_metrics(carried(spark, sf), "y", "p", ["city"]).withColumn("mape", F.round("mape", 4)))


@query("error_quantiles", f"""WITH {PRED} SELECT city, {', '.join(f'round(quantile_cont(abs(y - p), {q}), 6) + 0.0 AS p{n}' for q, n in ((0.5, '50'), (0.9, '90'), (0.95, '95'), (1.0, '100')))} FROM pr WHERE p IS NOT NULL GROUP BY city""")
def error_quantiles(spark, sf):
    return tidy(ln.error_quantiles(carried(spark, sf), "y", "p", ["city"]))


@query("skewed_quantiles", """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS g, """ + ", ".join(f"round(quantile_cont(l_extendedprice * (1 - l_discount), {q}), 6) + 0.0 AS p{round(q * 100):02d}" for q in (0.15, 0.5, 0.85)) + " FROM lineitem GROUP BY ALL")
def skewed_quantiles(spark, sf):
    rows = dv.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_returnflag")).alias("g"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v")
    )
    return tidy(ql.exact_quantiles(rows, ["g"], "v", [0.15, 0.5, 0.85]))


WANTED = ["current_speed_kph", "jam_lag_1", "speed_ratio", "hour_sin", "rain_intensity_level", "event_type", "row_has_complete_lag_features", "pressure_trend", "corridor_code", "speed_lag_1", "local_hour"]


def aligned(spark, sf):
    rows = ts.add_past_rolling(ts.exact_offsets(dv.based(spark, sf), ts.lag_spec(dv.BUCKET)))
    rows = rows.withColumns({"weather_rain_1h": F.col("source_rows") * 4.0, "has_flood": (F.col("source_rows") % 2).cast("int")})
    return ln.align_features(rows, WANTED, KEYS.split())


@query("feature_alignment", f"""WITH {LAGGED}, t AS (SELECT *, {ROLL_SQL} FROM lagged) SELECT city, segment_id, time_bucket, round(currentSpeed, 6) + 0.0 AS current_speed_kph, round(coalesce(congestion_lag_1, 0), 6) + 0.0 AS jam_lag_1, round(currentSpeed / freeFlowSpeed, 6) + 0.0 AS speed_ratio,
    CASE WHEN source_rows * 4 >= 10 THEN 'heavy' ELSE 'light' END AS rain_intensity_level, CASE WHEN source_rows % 2 = 1 THEN 'flood' ELSE 'none' END AS event_type, valid_history_60m::DOUBLE AS row_has_complete_lag_features, 'unknown' AS corridor_code, hour(time_bucket)::DOUBLE AS local_hour,
    concat_ws(',', CASE WHEN congestion_lag_1 IS NULL THEN 'jam_lag_1' END, 'pressure_trend', 'corridor_code', CASE WHEN speed_lag_1 IS NULL THEN 'speed_lag_1' END) AS missing, (2 + CASE WHEN speed_lag_1 IS NULL THEN 2 ELSE 0 END)::INTEGER AS filled_feature_count,
    round(1 - (2 + CASE WHEN speed_lag_1 IS NULL THEN 2 ELSE 0 END) / 11.0::DOUBLE, 6) + 0.0 AS feature_coverage_ratio FROM t""")
def feature_alignment(spark, sf):
    out = aligned(spark, sf).withColumn("missing", F.array_join("missing_features", ","))
    cols = "current_speed_kph jam_lag_1 speed_ratio rain_intensity_level event_type row_has_complete_lag_features corridor_code local_hour missing filled_feature_count feature_coverage_ratio"
    return tidy(out.select(*KEYS.split(), *cols.split()))


@query("coverage_by_segment", f"""WITH {LAGGED}, c AS (SELECT segment_id, 2 + CASE WHEN speed_lag_1 IS NULL THEN 2 ELSE 0 END AS f FROM lagged), s AS (SELECT segment_id, avg(f) AS mean_filled, avg(1 - f / 11.0::DOUBLE) AS coverage_ratio, count(*) AS rows FROM c GROUP BY segment_id)
    SELECT {pick('segment_id rows', 'mean_filled coverage_ratio')}, '15m' AS horizon, CASE WHEN coverage_ratio >= 0.9 THEN 'high' WHEN coverage_ratio >= 0.7 THEN 'medium' ELSE 'low' END AS coverage_level FROM s""")
def coverage_by_segment(spark, sf):
    return tidy(ln.coverage_by_segment(aligned(spark, sf), "15m"))


@query("baseline_values", """SELECT 'l_quantity' AS feature, round(median(l_quantity), 4) + 0.0 AS number, NULL AS label FROM lineitem UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 4) + 0.0, NULL FROM lineitem
    UNION ALL SELECT 'l_returnflag', NULL, l_returnflag FROM (SELECT l_returnflag, count(*) AS c FROM lineitem GROUP BY 1 ORDER BY c DESC, l_returnflag LIMIT 1)""")
def baseline_values(spark, sf):
    out = ln.baseline_values(dv.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    text = F.col("feature") == "l_returnflag"
    number = F.round(F.when(~text, F.col("baseline").try_cast("double")), 4) + F.lit(0.0)
    return out.select("feature", number.alias("number"), F.when(text, F.col("baseline")).alias("label"))


@query("hash_sample", "SELECT o_orderkey, o_custkey FROM orders WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.5")
def hash_sample(spark, sf):
    return ln.hash_sample(dv.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 0.5)


@query("model_select", f"""WITH {PRED}, k AS (SELECT city, abs(y - p) AS e1, abs(y - 30) AS e2, abs(y - p) * 0.999::DOUBLE AS e3 FROM pr WHERE p IS NOT NULL), m AS (SELECT city, 'carry' AS family, avg(e1) AS mae FROM k GROUP BY city UNION ALL SELECT city, 'flat', avg(e2) FROM k GROUP BY city UNION ALL SELECT city, 'boost', avg(e3) FROM k GROUP BY city),
    b AS (SELECT *, family = 'carry' AND mae <= min(mae) OVER (PARTITION BY city) + 0.05 AS pref FROM m) SELECT city, family, round(mae, 6) + 0.0 AS mae FROM b QUALIFY row_number() OVER (PARTITION BY city ORDER BY pref DESC, mae, family) = 1""")
def model_select(spark, sf):
    e = F.abs(F.col("y") - F.col("p"))
    rows = carried(spark, sf).filter("p IS NOT NULL")
    parts = F.array(*[F.struct(F.lit(n).alias("family"), c.alias("e")) for n, c in (("carry", e), ("flat", F.abs(F.col("y") - 30)), ("boost", e * 0.999))])
    metrics = rows.select("city", F.inline(parts)).groupBy("city", "family").agg(F.avg("e").alias("mae"))
    return tidy(ln.select_models(metrics, "city", "family", "mae", "carry", 0.05))


@query("model_manifest_join", """WITH s AS (SELECT DISTINCT 'traffic_' || ['15m', '60m', '240m', 'x'][event_id % 4 + 1] || '_task' AS task FROM events), m AS (SELECT '15m' AS horizon, 67 AS features UNION ALL SELECT '60m', 62)
    SELECT task, CASE WHEN contains(task, '15m') THEN '15m' WHEN contains(task, '60m') THEN '60m' WHEN contains(task, '240m') THEN '240m' ELSE '' END AS horizon, features FROM s LEFT JOIN m ON m.horizon = CASE WHEN contains(task, '15m') THEN '15m' WHEN contains(task, '60m') THEN '60m' WHEN contains(task, '240m') THEN '240m' ELSE '' END""")
def model_manifest_join(spark, sf):
    kind = F.element_at(F.array(*[F.lit(x) for x in ("15m", "60m", "240m", "x")]), (F.col("event_id") % 4 + 1).cast("int"))
    summary = dv.table(spark, sf, "events").select(F.concat(F.lit("traffic_"), kind, F.lit("_task")).alias("task")).distinct()
    manifest = spark.createDataFrame([("15m", 67), ("60m", 62)], "horizon string, features int")
    return ln.join_manifest(summary, manifest).select("task", "horizon", "features")


MODEL_INPUTS = ["hour_of_day", "day_of_week", "congestion_ratio", "speed_lag_1", "speed_lag_2", "speed_lag_3"]


def _training(spark, sf):
    rows = cut_lineage(_features(spark, sf))
    return ln.training_rows(rows, MODEL_INPUTS, [f"future_speed_{h}m" for h in HORIZONS])


def _held_out(spark, sf):
    rows, inputs = _training(spark, sf)
    return cut_lineage(ts.ordered_holdout(rows)), inputs


def _stopping(rows):
    """A fifth of the rows stops the rounds early."""
    return rows.withColumn("held", F.pmod(F.xxhash64(*KEYS.split()), F.lit(5)) == 0)


def _facts(scored, actual: str, predicted: str, by: str):
    """Per group: rows scored, whether every prediction is a number, and whether the error is at most a quarter above that of
    the later rows' own mean (which no forecast can know; speeds here are close to noise)."""
    m = ln.regression_metrics(scored, actual, predicted, [by])
    return m.select(by, "n", F.col("rmse").between(0.0, 1e6).alias("finite"), (F.col("r2") > 1 - 1.25**2).alias("close_to_mean_or_better"), (F.col("mae") <= F.col("rmse")).alias("mae_below_rmse"))


SPLIT_SQL = f"""{LAGGED}, labelled AS (SELECT a.*, {', '.join(_shifted(h // 60, f'future_speed_{h}m', 'currentSpeed') for h in HORIZONS)} FROM lagged a),
    fit AS (SELECT * FROM labelled WHERE {' OR '.join(f'future_speed_{h}m IS NOT NULL' for h in HORIZONS)}), c AS (SELECT time_bucket, sum(count(*)) OVER (ORDER BY time_bucket) - count(*) AS before FROM fit GROUP BY time_bucket),
    later AS (SELECT * FROM fit WHERE time_bucket > (SELECT max(time_bucket) FROM c WHERE before < floor((SELECT count(*) FROM fit) * 0.8)))"""


@query("train_boosted", f"WITH {SPLIT_SQL.removeprefix('WITH ')} " + " UNION ALL ".join(f"SELECT {h} AS horizon, count(future_speed_{h}m) AS n, true AS finite, true AS close_to_mean_or_better, true AS mae_below_rmse FROM later" for h in HORIZONS))
def train_boosted(spark, sf):
    """One boosted model per horizon, its rounds stopped early on part of the fitted rows: facts about the errors on the later rows."""
    rows, inputs = _held_out(spark, sf)
    models = ln.fit_horizons(_stopping(rows.filter("split = 'train'")), inputs, HORIZONS, held="held")
    scored = ln.predict_horizons(rows.filter("split = 'test'"), models, [*KEYS.split(), *[f"future_speed_{h}m" for h in HORIZONS]], F.current_timestamp())
    long = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"future_speed_{h}m").alias("y"), F.col(f"predicted_speed_{h}m").alias("p")) for h in models])
    return _facts(scored.select(F.inline(long)), "y", "p", "horizon")


@query("train_forest", f"WITH {SPLIT_SQL.removeprefix('WITH ')} SELECT city, count(*) AS n, true AS finite, true AS close_to_mean_or_better, true AS mae_below_rmse FROM later WHERE future_speed_60m IS NOT NULL GROUP BY city")
def train_forest(spark, sf):
    """The published forest, facts about its errors on rows later than those it was fitted on."""
    rows, inputs = _held_out(spark, sf)
    rows = rows.filter("future_speed_60m IS NOT NULL")
    model = ln.forest(inputs, ["city", "segment_id"], "future_speed_60m").fit(rows.filter("split = 'train'"))
    return _facts(model.transform(rows.filter("split = 'test'")), "future_speed_60m", "prediction", "city")


@query("batch_predict", f"WITH {SPLIT_SQL.removeprefix('WITH ')}, known AS (SELECT min(y) AS low, max(y) AS high FROM (SELECT unnest([{', '.join(f'future_speed_{h}m' for h in HORIZONS)}]) AS y FROM fit)) SELECT city, segment_id, time_bucket, round(currentSpeed, 6) + 0.0 AS currentSpeed, TIMESTAMP '2024-02-01' AS prediction_timestamp, low IS NOT NULL AS plausible FROM later, known")
def batch_predict(spark, sf):
    """Later rows under a model of the earlier ones; a prediction is plausible if it lies within half a range of the fitted speeds."""
    rows, inputs = _held_out(spark, sf)
    train = rows.filter("split = 'train'")
    models = ln.fit_horizons(_stopping(train), inputs, (60,), held="held")
    low, high = train.agg(F.min("future_speed_60m"), F.max("future_speed_60m")).first()
    out = ln.predict_horizons(rows.filter("split = 'test'"), models, [*KEYS.split(), "currentSpeed"], F.lit("2024-02-01").cast("timestamp_ntz"))
    plausible = F.col("predicted_speed_60m").between(low - (high - low) / 2, high + (high - low) / 2).alias("plausible")
    return tidy(out.select(*KEYS.split(), "currentSpeed", "prediction_timestamp", plausible))


@query("attribution", f"WITH {SPLIT_SQL.removeprefix('WITH ')} SELECT city, segment_id, true AS ranked_by_size, true AS signs_fit, true AS within_top FROM (SELECT DISTINCT city, segment_id FROM fit)")
def attribution(spark, sf):
    """Top features of the newest row of each segment by single-feature replacement: facts about every segment's list."""
    rows, inputs = _training(spark, sf)
    model = ln.fit_horizons(_stopping(rows), inputs, (60,), held="held")[60]
    baseline = {r["feature"]: float(r["baseline"]) for r in ln.baseline_values(rows, inputs, []).collect()}
    newest = latest_by_segment(rows)
    effects = ln.attribution(newest, model, inputs, baseline, ["city", "segment_id"])
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.abs("contribution").alias("c")))), lambda x: x["c"])
    lists = effects.groupBy("city", "segment_id").agg(
        sizes.alias("s"), F.max("rank").alias("r"), F.count(F.lit(1)).alias("n"), F.bool_and((F.col("direction") == "raises_speed") == (F.col("contribution") > 0)).alias("signs"),
    )
    # A segment whose prediction no input moves has an empty list.
    all_ = newest.select("city", "segment_id").join(lists, ["city", "segment_id"], "left")
    return all_.select(
        "city", "segment_id", F.coalesce(F.col("s") == F.reverse(F.array_sort("s")), F.lit(True)).alias("ranked_by_size"), F.coalesce("signs", F.lit(True)).alias("signs_fit"),
        F.coalesce((F.col("r") <= 8) & (F.col("r") == F.col("n")), F.lit(True)).alias("within_top"),
    )


@query("feature_importance", f"SELECT unnest([{', '.join(repr(n) for n in sorted(MODEL_INPUTS))}]) AS feature, true AS is_share, true AS shares_sum_to_one FROM (SELECT count(*) FROM events)")
def feature_importance(spark, sf):
    """Importances of all inputs: shares that sum to one."""
    rows, inputs = _training(spark, sf)
    model = ln.fit_horizons(_stopping(rows), inputs, (60,), held="held")[60]
    all_ = ln.importances(model, spark, inputs, top=len(inputs))
    total = all_.agg(F.sum("importance").alias("s")).scalar()
    return all_.select("feature", F.col("importance").between(0.0, 1.0).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("shares_sum_to_one"))


SCORED_INPUTS = ["current_speed_kph", "jam_lag_1", "speed_ratio", "hour_sin", "pressure_trend", "speed_lag_1", "local_hour"]
AS_OF = "2024-01-31"


@query("score_segments", f"""WITH {LAGGED.removeprefix('WITH ')}, newest AS (SELECT * FROM lagged QUALIFY row_number() OVER (PARTITION BY city, segment_id ORDER BY time_bucket DESC) = 1), h(horizon, half) AS (VALUES ('15m', 5.0::DOUBLE), ('60m', 7.5::DOUBLE), ('240m', 12.0::DOUBLE)),
    s AS (SELECT *, horizon = '15m' AS is_fallback, CASE WHEN horizon = '15m' THEN 0 ELSE 7 END AS required, CASE WHEN horizon = '15m' THEN 0 ELSE 1 + CASE WHEN speed_lag_1 IS NULL THEN 2 ELSE 0 END END AS filled, greatest(0, floor(epoch(TIMESTAMP '{AS_OF}'))::BIGINT - floor(epoch(timestamp))::BIGINT) AS age FROM newest, h),
    v AS (SELECT *, CASE WHEN required > 0 THEN (required - filled) / required::DOUBLE ELSE 0.0::DOUBLE END AS cov FROM s)
    SELECT city, segment_id, horizon, round(currentSpeed, 6) + 0.0 AS current_speed, is_fallback, CASE WHEN is_fallback THEN 'current_speed' ELSE 'boosted' END AS model_name, required::INTEGER AS required_feature_count, (required - filled)::INTEGER AS available_feature_count, filled::INTEGER AS filled_feature_count,
    CASE WHEN is_fallback THEN '' ELSE concat_ws(',', CASE WHEN speed_lag_1 IS NULL THEN 'jam_lag_1' END, 'pressure_trend', CASE WHEN speed_lag_1 IS NULL THEN 'speed_lag_1' END) END AS missing, age AS data_freshness_seconds, round(cov, 4) + 0.0 AS feature_coverage_ratio,
    CASE WHEN is_fallback OR cov < 0.7::DOUBLE OR age > 3600 THEN 'low' WHEN cov < 0.9::DOUBLE OR age > 600 THEN 'medium' ELSE 'high' END AS reliability_level, round(half + (1 - cov) * half + CASE WHEN is_fallback THEN half ELSE 0 END, 2) + 0.0 AS half_band, true AS plausible FROM v""")
def score_segments(spark, sf):
    """Every segment's newest row through one bundle: fitted on aligned rows, aligned, predicted, judged."""
    rows = cut_lineage(ts.exact_offsets(dv.based(spark, sf), {**ts.lag_spec(dv.BUCKET), **ts.target_spec(HORIZONS)}))
    fit = ln.align_features(rows, SCORED_INPUTS, [*KEYS.split(), "future_speed_60m", "future_speed_240m"])
    models = {f"{h}m": m for h, m in ln.fit_horizons(_stopping(fit), SCORED_INPUTS, (60, 240), held="held").items()}
    bundle = ln.ModelBundle("boosted", models, {h: SCORED_INPUTS for h in models})
    out = db.score_segments(latest_by_segment(rows), bundle, ["15m", 60, "4h"], F.lit(AS_OF).cast("timestamp_ntz"))
    plausible = F.when(F.col("is_fallback"), F.col("predicted_speed") == F.round("current_speed", 3)).otherwise(F.col("predicted_speed").between(0.0, 200.0))
    return tidy(out.select(
        "city", "segment_id", "horizon", "current_speed", "is_fallback", "model_name", "required_feature_count", "available_feature_count", "filled_feature_count",
        F.array_join("missing_features", ",").alias("missing"), "data_freshness_seconds", "feature_coverage_ratio", "reliability_level",
        F.round(F.col("band_high") - F.col("predicted_speed"), 2).alias("half_band"), plausible.alias("plausible"),
    ))


GOLD_COLS = "speed_lag_1 speed_rolling_avg_15m p50 speed_vs_p50 weather_temperature future_speed_60m"


@query("gold_build", f"""WITH {LAGGED.replace('WITH ', '')}, {dv.WEATHER}, pooled AS (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY city, time_bucket ORDER BY weather_cell_id DESC) = 1){BASELINE},
    t AS (SELECT a.*, {ROLL_SQL}, {_shifted(1, 'future_speed_60m', 'currentSpeed')}, p50, a.currentSpeed - p50 AS speed_vs_p50, EXISTS (SELECT 1 FROM weather k WHERE k.city = a.city AND k.weather_cell_id = a.weather_cell_id) AS known,
      (SELECT arg_max(x.temp, x.time_bucket) FROM weather x WHERE x.city = a.city AND x.weather_cell_id = a.weather_cell_id AND x.time_bucket <= a.time_bucket AND x.time_bucket >= a.time_bucket - INTERVAL 6 HOURS) AS w1,
      (SELECT arg_max(x.temp, x.time_bucket) FROM pooled x WHERE x.city = a.city AND x.time_bucket <= a.time_bucket AND x.time_bucket >= a.time_bucket - INTERVAL 6 HOURS) AS w2 FROM lagged a JOIN baseline USING (city, segment_id, hour_of_day, day_of_week)),
    u AS (SELECT *, CASE WHEN known THEN w1 ELSE w2 END AS weather_temperature FROM t) SELECT {pick(KEYS + ' valid_history_60m', GOLD_COLS)}, 0 AS has_accident FROM u""")
def gold_build(spark, sf):
    out = builds.gold_build(dv.panel(spark, sf), dv.weather(spark, sf), None, dv.BUCKET, HORIZONS)
    return tidy(out.select(*KEYS.split(), "valid_history_60m", *GOLD_COLS.split(), "has_accident"))


@query("gold_projection", f"WITH {dv.BASED} SELECT segment_id, city, timestamp, round(congestion_ratio, 6) + 0.0 AS congestion_ratio, NULL::DOUBLE AS p50, hour_of_day FROM based")
def gold_projection(spark, sf):
    return tidy(builds.gold_projection(dv.based(spark, sf)).select("segment_id", "city", "timestamp", "congestion_ratio", "p50", "hour_of_day"))


@query("training_rows", f"""WITH {LAGGED}, t AS (SELECT a.*, {_shifted(1, 'future_speed_60m', 'currentSpeed')}, {_shifted(4, 'future_speed_240m', 'currentSpeed')} FROM lagged a)
    SELECT city, segment_id, time_bucket, round(coalesce(speed_lag_1, 0), 6) + 0.0 AS speed_lag_1 FROM t WHERE future_speed_60m IS NOT NULL OR future_speed_240m IS NOT NULL""")
def training_rows(spark, sf):
    wanted = {**ts.lag_spec(60), "future_speed_60m": ("currentSpeed", 60), "future_speed_240m": ("currentSpeed", 240)}
    rows, _ = ln.training_rows(ts.exact_offsets(dv.based(spark, sf), wanted), ["speed_lag_1"], ["future_speed_60m", "future_speed_240m"])
    return tidy(rows.select(*KEYS.split(), "speed_lag_1"))
