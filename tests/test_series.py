"""Offsets, as-of joins, windows, quantiles and scores on small frames with brute-force checks."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions import geo, numeric as nm, scoring as sc
from panelforge.operators import joins as jn, panel as pn, quality as ql, timeseries as ts

T0 = datetime(2024, 1, 1)


def panel(spark, minutes, city="hanoi", segment="S1"):
    rows = [(city, segment, T0 + timedelta(minutes=m), float(m)) for m in minutes]
    return spark.createDataFrame(rows, "city string, segment_id string, time_bucket timestamp_ntz, currentSpeed double").withColumns(
        {"freeFlowSpeed": F.lit(100.0), "congestion_ratio": F.col("currentSpeed") / 100}
    )


def test_exact_lags_ignore_gaps(spark):
    got = {r["time_bucket"]: r for r in ts.add_exact_lags(panel(spark, [0, 5, 15, 20]), 5).collect()}
    assert got[T0 + timedelta(minutes=5)]["speed_lag_1"] == 0.0
    assert got[T0 + timedelta(minutes=15)]["speed_lag_1"] is None
    assert got[T0 + timedelta(minutes=15)]["speed_lag_2"] == 5.0
    assert got[T0 + timedelta(minutes=20)]["speed_trend_1"] is None


def test_offsets_cross_chunk_borders(spark):
    minutes = list(range(0, 60 * 24 * 20, 60))
    rows = ts.exact_offsets(panel(spark, minutes), {"back": ("currentSpeed", -120), "ahead": ("currentSpeed", 240)}).collect()
    assert len(rows) == len(minutes)
    last = minutes[-1]
    for r in rows:
        m = int(r["currentSpeed"])
        assert r["back"] == (m - 120 if m >= 120 else None)
        assert r["ahead"] == (m + 240 if m + 240 <= last else None)


def test_as_of_joins_match_brute_force(spark):
    rng = random.Random(3)
    left = sorted(rng.sample(range(0, 20000), 120))
    right = sorted(rng.sample(range(0, 20000), 60))
    stamp = lambda m: T0 + timedelta(minutes=m)
    lf = spark.createDataFrame([("a", stamp(m)) for m in left], "k string, t timestamp_ntz")
    rf = spark.createDataFrame([("a", stamp(m), m) for m in right], "k string, t timestamp_ntz, v int")
    back = {r["t"]: r["v"] for r in jn.asof_backward(lf, rf, ["k"], "t", ["v"], 200 * 60).collect()}
    near = {r["t"]: r["v"] for r in jn.asof_nearest(lf, rf, ["k"], "t", ["v"], 200 * 60).collect()}
    for m in left:
        older = [x for x in right if m - 200 <= x <= m]
        around = sorted((abs(x - m), x) for x in right if abs(x - m) <= 200)
        assert back[stamp(m)] == (max(older) if older else None)
        assert near.get(stamp(m)) == (around[0][1] if around else None)


def test_fallback_is_per_cell(spark):
    stamp = lambda h: T0 + timedelta(hours=h)
    left = spark.createDataFrame([("c", "w1", stamp(1)), ("c", "w1", stamp(9)), ("c", "w9", stamp(9)), ("c", None, stamp(9))], "g string, cell string, t timestamp_ntz")
    right = spark.createDataFrame([("c", "w1", stamp(0), 1), ("c", "w2", stamp(8), 2)], "g string, cell string, t timestamp_ntz, v int")
    got = sorted(((r["cell"] or "-", r["t"], r["v"]) for r in jn.asof_with_fallback(left, right, "g", "cell", "t", ["v"], 2 * 3600).collect()))
    assert got == sorted([("w1", stamp(1), 1), ("w1", stamp(9), None), ("w9", stamp(9), 2), ("-", stamp(9), 2)])


def test_window_bounds_are_inclusive(spark):
    grid = spark.createDataFrame([("c", T0 + timedelta(hours=h)) for h in range(6)], "city string, t timestamp_ntz")
    at = [0, 3600, 3601, 7199, 7200]
    events = spark.createDataFrame([("c", T0 + timedelta(seconds=s), s) for s in at], "city string, e timestamp_ntz, s int")
    out = jn.window_aggregates(grid, events, ["city"], "t", "e", 3600, {"n": (F.lit(1), 3600, 0)}, {"top": (F.col("s"), 7200, 0)}).collect()
    for r in out:
        now = int((r["t"] - T0).total_seconds())
        assert r["n"] == sum(now - 3600 <= s <= now for s in at)
        assert r["top"] == max([s for s in at if now - 7200 <= s <= now], default=None)
    with pytest.raises(ValueError):
        jn.window_aggregates(grid, events, ["city"], "t", "e", 3600, {"n": (F.lit(1), 1800, 0)})


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(5)
    values = {"hot": np.concatenate([np.full(500, 7.0), rng.lognormal(3, 2, 1500)]), "one": np.array([4.2]), "two": np.array([1.0, 9.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs]
    out = ql.exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", [0.15, 0.5, 0.95], bins=16).collect()
    for r in out:
        want = np.quantile(values[r["k"]], [0.15, 0.5, 0.95])
        assert np.allclose([r["p15"], r["p50"], r["p95"]], want)


def test_dedup_keeps_newest_non_null(spark):
    rows = [("hanoi", "S1", T0, 1.0, "a"), ("hanoi", "S1", T0 + timedelta(minutes=2), 3.0, None)]
    df = spark.createDataFrame(rows, "city string, segment_id string, timestamp timestamp_ntz, currentSpeed double, source string").withColumn("time_bucket", F.lit(T0))
    got = pn.dedup_traffic(df).collect()[0]
    assert (got["currentSpeed"], got["source"], got["source_rows"]) == (2.0, "a", 2)


def test_required_columns_fail_early(spark):
    with pytest.raises(ValueError):
        pn.clean_traffic(spark.createDataFrame([("x",)], "city string"))


def test_column_profile_reasons(spark):
    df = spark.range(1000).select(F.lit(1).alias("flat"), F.col("id").alias("good"), F.lit(None).cast("int").alias("empty"), F.lit("t").alias("city"))
    got = {r["column"]: r["reason"] for r in ql.column_profile(df, "y").collect()}
    assert got == {"flat": "constant", "empty": "all_null", "city": "metadata_or_non_model_column"}


def test_holdout_is_in_time_order(spark):
    rows = ts.ordered_holdout(panel(spark, range(0, 500, 5))).groupBy("split").agg(F.count("*").alias("n"), F.min("time_bucket").alias("a"), F.max("time_bucket").alias("b")).collect()
    got = {r["split"]: r for r in rows}
    assert got["train"]["n"] == 80 and got["train"]["b"] < got["test"]["a"]


def scalar(spark, column):
    return spark.range(1).select(column.alias("r")).collect()[0]["r"]


def test_confidences(spark):
    for metres, want in ((20.0, 1.0), (100.0, 0.7), (300.0, 0.4), (None, 0.3)):
        assert scalar(spark, sc.snap_confidence(F.lit(metres).cast("double"))) == want
    for place, want in (("Ngã tư Sở", 0.15), ("Cầu Giấy", 0.15), ("Đường Láng", 0.05), ("Ba Đình", 0.0)):
        assert scalar(spark, sc.place_bonus(F.lit(place))) == want
    assert scalar(spark, sc.geocode_confidence(F.lit("Cầu Giấy"), F.lit(10.0), F.lit(9))) == 1.0


def test_alert_override_can_be_switched_off(spark):
    rule = lambda flag: scalar(spark, sc.alert_rule(F.lit(5.0), F.lit(20.0), F.lit(40.0), F.lit(5.0), F.lit(60.0), flag))["severity"]
    assert rule(True) == "MEDIUM" and rule(False) == "CRITICAL"


def test_risk_stays_in_range(spark):
    worst = scalar(spark, sc.segment_risk(F.lit(0.0), F.lit(60.0), F.lit(10.0), rain=F.lit(500.0), event_severity=F.lit(99.0)))
    assert 0 <= worst["risk_score"] <= 100
    assert "congestion_ratio" in worst["triggered_rules"]


def test_geometry_and_delay(spark):
    points = scalar(spark, geo.line_points(F.lit('{"coordinates":[[105.8,21.0],[105.9,21.1]]}')))
    assert [(p["lon"], p["lat"]) for p in points] == [(105.8, 21.0), (105.9, 21.1)]
    assert scalar(spark, geo.line_points(F.lit('{"coordinates":[[105.8,21.0]]}'))) is None
    assert scalar(spark, nm.delay_minutes(F.lit(0.75), F.lit(0.0))) == 4
    with pytest.raises(ValueError):
        geo.parse_viewport("3,1,2,4")
