"""Horizons, guards, models and sinks."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import learn as ln
from panelforge.sources import readers as rd, schemas, sinks as sk


def test_horizon_names():
    assert [ln.normalize_horizon(h) for h in (15, "60min", "4h")] == ["15m", "60m", "240m"]
    with pytest.raises(ValueError):
        ln.normalize_horizon("999m")


def test_forbidden_inputs():
    with pytest.raises(ValueError):
        ln.check_features(["hour_of_day", "target_speed"])


def test_filled_equals_required_minus_available(spark):
    df = spark.createDataFrame([(1, 30.0, None)], "id int, currentSpeed double, speed_lag_1 double")
    got = ln.align_features(df, ["current_speed_kph", "speed_lag_1", "district"], ["id"]).collect()[0]
    assert (got["current_speed_kph"], got["speed_lag_1"], got["district"]) == (30.0, 0.0, "unknown")
    assert got["filled_feature_count"] == got["required_feature_count"] - got["available_feature_count"] == 2
    assert got["missing_features"] == ["speed_lag_1", "district"]


def test_boosted_model_beats_the_mean_and_attributes(spark):
    df = spark.range(600).select(F.col("id"), (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")).withColumn(
        "future_speed_15m", F.col("a") * 3 + 1
    )
    models = ln.fit_horizons(df, ["a", "b"], (15,), rounds=10, depth=4)
    scored = ln.predict_horizons(df, models, ["id", "future_speed_15m"], F.lit("2024-01-01").cast("timestamp"))
    metrics = ln.regression_metrics(scored, "future_speed_15m", "predicted_speed_15m", []).collect()[0]
    assert metrics["r2"] > 0.9
    top = ln.attribution(df.limit(20), models[15], ["a", "b"], {"a": 4.5, "b": 3.0}, ["id"]).filter("rank = 1").select("feature").distinct().collect()
    assert [r["feature"] for r in top] == ["a"]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    m = ln.regression_metrics(df, "y", "p", []).collect()[0]
    assert (m["n"], m["mae"], round(m["rmse"], 6), round(m["r2"], 6)) == (3, 1.0, round((5 / 3) ** 0.5, 6), 0.375)


def test_raw_layouts(spark, tmp_path):
    folder = tmp_path / "traffic"
    folder.mkdir()
    (folder / "a.jsonl").write_text(
        '{"segment_id":"S1","city":"hanoi","timestamp":"2026-05-14T03:37:00Z","currentSpeed":20,"freeFlowSpeed":40}\n'
        '{"segment_id":"S2","city":"hanoi","event_time":"2026-05-14T03:37:00Z","time_bucket":"2026-05-14T03:35:00Z","currentSpeed":10,"freeFlowSpeed":40,"jamFactor":9.0,'
        '"raw":{"flowSegmentData":{"coordinates":{"coordinate":[{"latitude":21.0,"longitude":105.8},{"latitude":21.1,"longitude":105.9}]}}}}\n'
        "not json\n\n"
    )
    rows = {r["segment_id"]: r for r in rd.read_traffic(spark, str(folder)).collect()}
    assert rows["S1"]["jamFactor"] == 5.0 and rows["S1"]["event_time"] == "2026-05-14T03:37:00Z"
    assert rows["S2"]["jamFactor"] == 9.0 and "105.9" in rows["S2"]["geometry"]
    _, wrong = rd.read_jsonl(spark, str(folder), schemas.TRAFFIC_RAW)
    letters = sk.dead_letters(wrong, "traffic").collect()
    assert [r["original_value"] for r in letters] == ["not json"]


def test_weather_layouts(spark, tmp_path):
    folder = tmp_path / "weather"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"point_id":"W1","city":"hanoi","timestamp":"2026-05-14T03:37:00Z","temp":30}\n{"weather_cell_id":"W2","event_time":"2026-05-14T03:00:00Z","temp":28.5,"rain_1h":1.5}\n')
    got = {r["weather_cell_id"]: (r["event_time"][:13], r["rain_1h"]) for r in rd.read_weather(spark, str(folder)).collect()}
    assert got == {"W1": ("2026-05-14T03", 0.0), "W2": ("2026-05-14T03", 1.5)}


def test_unknown_topic():
    assert schemas.topic_table("a.b") == "bronze_a_b_raw"
    with pytest.raises(ValueError):
        schemas.topic_schema("a.b")
    assert "segment_id" in schemas.topic_schema("traffic.realtime.tomtom")


def test_missing_table_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        rd.read_first(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("name", ["attribution", "feature_importance", "batch_predict"])
def test_queries_fit_the_published_rounds(spark, monkeypatch, name):
    from workload import learning_queries as lq

    asked = []

    def fit(train, features, horizons, **options):
        asked.append((options, "held" in train.columns))
        raise InterruptedError

    monkeypatch.setattr(lq.ln, "fit_horizons", fit)
    with pytest.raises(InterruptedError):
        getattr(lq, name)(spark, "/root/testdata/sf0.001")
    assert asked == [({"held": "held"}, True)]


def _noisy(spark, rows, texts):
    """A number, a text of few and one of many values; the target follows the first two."""
    i = F.col("id")
    df = spark.range(rows).select(((i * 37) % 100).cast("double").alias("a"), F.concat(F.lit("c"), i % 5).alias("city"), F.concat(F.lit("s"), i % texts).alias("road"), (i % 10 == 3).alias("later"))
    return df.withColumn("y", F.col("a") + F.when(F.col("city") == "c1", 60.0).otherwise(0.0) + F.pmod(F.xxhash64("a", "city"), F.lit(7)))


def _fit_and_score(stages, df):
    from pyspark.ml import Pipeline

    model = Pipeline(stages=stages).fit(df.filter("NOT later"))
    return model, ln.regression_metrics(model.transform(df.filter("later")), "y", "prediction", []).first()


def test_forest_works_in_rows_not_rows_times_texts(spark):
    import signal

    def late(*_):
        raise TimeoutError("a number per text and row")

    df = _noisy(spark, 60_000, 30_000).cache()
    df.count()
    old = signal.signal(signal.SIGALRM, late)
    signal.alarm(120)
    try:
        model, m = _fit_and_score(ln.forest(["a"], ["city", "road"], "y", trees=20).getStages(), df)
    except Exception:
        spark.sparkContext.cancelAllJobs()
        raise
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, old)
    assert m["n"] == 6000 and m["r2"] > 0.8
    odd = spark.createDataFrame([(None, "c1", "s1"), (5.0, "new", None), (5.0, None, "new")], "a double, city string, road string")
    assert all(0 <= r["prediction"] <= 170 for r in model.transform(odd).collect())


def test_forest_errs_no_more_than_sparks_own(spark):
    from pyspark.ml.regression import RandomForestRegressor

    df = _noisy(spark, 4000, 40).cache()
    stages = ln.forest(["a"], ["city", "road"], "y", trees=40).getStages()
    spark_forest = RandomForestRegressor(labelCol="y", numTrees=40, minInstancesPerNode=2, maxDepth=8, featureSubsetStrategy="onethird", seed=7)
    (own, m), (theirs, n) = _fit_and_score(stages, df), _fit_and_score([*stages[:-1], spark_forest], df)
    assert m["n"] == n["n"] == 400 and m["rmse"] < 1.1 * n["rmse"]
    weights = [x.stages[-1].featureImportances.toArray() for x in (own, theirs)]
    assert len(weights[0]) == len(weights[1]) and abs(weights[0] - weights[1]).max() < 0.1
    with pytest.raises(ValueError):
        stages[-1].fit(own.transform(df.withColumn("y", F.lit(None).cast("double"))).drop("prediction"))


def test_forest_splits_where_the_sums_say(spark):
    """Each tree's root has the split of most gain in its own sample, of the feature it drew."""
    import numpy as np
    from panelforge.operators import sparse_forest as sf
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 6, 300), *(np.arange(300) % 3 == k for k in range(2))], 1).astype(float)
    y = x[:, 0] ** 2 + 9 * x[:, 1] + rng.random(300)
    df = spark.createDataFrame([(a.tolist(), b) for a, b in zip(x, y.tolist())], "x array<double>, y double").select(array_to_vector("x").alias("features"), "y")
    est = sf.SparseForestRegressor("y", 1, trees=30, depth=1)
    kept = []
    rows = est._rows
    est._rows = lambda *a: kept.append(rows(*a)) or kept[0]
    model = est.fit(df)
    got = kept[0].collect()
    keys = sf.draw_keys(30 * 4, 7)
    for t in range(30):
        w = np.array([r["bag"][t] for r in got], float)
        gains = {}
        for f, c in [*((0, c) for c in range(5)), (1, -1), (2, -1)]:
            if not sf.drawn(keys, np.array([t * 4 + 1]), np.array([f]), 3, 1)[0]:
                continue
            side = np.array([r["bins"][0] <= c if f == 0 else f in r["slots"] for r in got])
            ys = np.array([r["y"] for r in got])
            if min((w * side).sum(), (w * ~side).sum()) >= 2:
                sse = lambda k: (w[k] * (ys[k] - np.average(ys[k], weights=w[k])) ** 2).sum()
                gains[f, c] = sse(slice(None)) - sse(side) - sse(~side)
        best = max(gains, key=gains.get)
        assert (model.feature[t, 1], model.cut[t, 1]) == best and abs(model.gain[t, 1] - gains[best]) < 1e-6


def test_every_node_draws_exactly_its_share():
    import numpy as np
    from panelforge.operators import sparse_forest as sf

    for size in (3, 8, 100):
        share, nodes = -(-size // 3), 3000
        node, f = (x.ravel() for x in np.indices((nodes, size)))
        got = sf.drawn(sf.draw_keys(nodes, 7), node, f, size, share).reshape(nodes, size)
        assert (got.sum(1) == share).all()
        assert abs(got.mean(0) - share / size).max() < 0.05
        pairs = got.T.astype(float) @ got / nodes
        assert abs(pairs[~np.eye(size, dtype=bool)] - share * (share - 1) / (size * (size - 1))).max() < 0.06
