"""Global order without one big window, partitioned writes, scenario product, late rows, scoring by a bundle."""

import json
import math
import random
from collections import Counter
from glob import glob

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelforge.operators import graph, learn, ordering, quality, timeseries as ts
from panelforge.plans import dashboards
from panelforge.session import scratch_path
from panelforge.sources import readers, sinks
from panelforge.streaming import jobs


def test_numbered_equals_a_window_with_a_hot_value(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", None, "b"]), 7 if i % 3 == 0 else rng.randint(0, 40), i) for i in range(900)] + [("a", 7, 3)] * 50
    df = spark.createDataFrame(rows, "g string, v int, i long").repartition(6)
    got = ordering.numbered(df, "v", "i", by=["g"], partitions=7).collect()
    for g in ("a", None, "b"):
        mine = sorted((r["position"], r["v"], r["i"]) for r in got if r["g"] == g)
        assert [p for p, _, _ in mine] == list(range(len(mine)))
        assert [(v, i) for _, v, i in mine] == sorted((v, i) for h, v, i in rows if h == g)


def test_upstream_edges_with_null_and_equal_jam(spark):
    rng = random.Random(2)
    rows = [("x", f"S{i:03d}", None if i % 5 == 0 else 0.0 if i % 3 == 0 else round(rng.uniform(0, 10), 2)) for i in range(200)]
    rows += [(None, f"N{i}", None if i else 2.0) for i in range(4)] + [("one", "only", 1.0)]
    latest = spark.createDataFrame(rows, "city string, segment_id string, jamFactor double").repartition(5)
    got = Counter((r["city"], r["upstream"], r["downstream"]) for r in graph.upstream_edges(latest).collect())
    want = Counter()
    for city in {c for c, _, _ in rows}:
        line = sorted((r for r in rows if r[0] == city), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        want.update((city, a[1], b[1]) for a, b in zip(line, line[1:]))
    assert got == want


def test_upstream_edges_sort_no_whole_city(spark):
    latest = spark.range(4000).select(F.lit("x").alias("city"), F.format_string("S%05d", "id").alias("segment_id"), F.lit(0.0).alias("jamFactor"))
    placed = ordering.placed(latest.withColumn("c", -F.col("jamFactor")), "city", "c", "segment_id", partitions=8)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_holdout_keeps_instants_whole(spark):
    rows = spark.range(500).select((F.lit(1704067200) + F.floor(F.col("id") / 7) * 60).cast("timestamp").alias("time_bucket"), "id")
    split = ts.ordered_holdout(rows, 0.8)
    got = split.groupBy("time_bucket").agg(F.countDistinct("split").alias("n"), F.min("split").alias("s"), F.count(F.lit(1)).alias("c")).orderBy("time_bucket").collect()
    assert all(r["n"] == 1 for r in got)
    train = sum(r["c"] for r in got if r["s"] == "train")
    assert 400 <= train < 407 and [r["s"] for r in got] == sorted([r["s"] for r in got], reverse=True)


def test_hot_partition_value_has_several_writers(spark, tmp_path):
    df = spark.range(6000).select("id", F.when(F.col("id") < 4000, "hot").when(F.col("id") < 5998, F.concat(F.lit("v"), (F.col("id") % 20).cast("string"))).alias("city"))
    sinks.write_partitioned(df, f"{tmp_path}/t", ["city"], rows_per_file=1000)
    files = Counter(f.split("city=")[1].split("/")[0] for f in glob(f"{tmp_path}/t/city=*/*.parquet"))
    assert files.pop("hot") > 1 and set(files.values()) == {1}
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 6000 and back.filter("city IS NULL").count() == 2 and back.columns == ["id", "city"]


def test_two_thousand_scenarios_without_a_gathered_array(spark):
    latest = spark.range(3).select(
        F.lit("hanoi").alias("city"), F.format_string("S%03d", "id").alias("segment_id"), F.lit(2.0).alias("jamFactor"), F.lit(20.0).alias("currentSpeed"), F.lit(50.0).alias("freeFlowSpeed"),
    )
    scenarios = spark.range(2000).select(F.col("id").cast("string").alias("name"), (F.col("id") % 5).cast("double").alias("rain_1h_mm"), F.lit("none").alias("event_type"), F.lit(False).alias("is_peak_hour"))
    out = dashboards.scenario_impact(latest, scenarios)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Subquery" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.select("segment_id", "scenario").distinct().count() == 6000


def test_rows_after_their_bucket_are_counted(spark, tmp_path):
    def put(*rows):
        spark.createDataFrame(rows, "at string, k string").select(F.to_timestamp("at").alias("ts"), "k").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema("ts timestamp, k string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        counted = jobs.tumbling(stream, "ts", 60, ["k"], [F.count(F.lit(1)).alias("n")], "30 minutes")
        query = jobs.to_bronze(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint", once=True)
        query.awaitTermination()
        return jobs.late_rows(query), counted.schema

    put(("2024-01-01 00:10:00", "a"), ("2024-01-01 03:00:00", "a"))
    assert run()[0] == 0
    put(("2024-01-01 00:20:00", "a"), ("2024-01-01 02:50:00", "a"), ("2024-01-01 05:00:00", "a"))
    late, schema = run()
    rows = {(r["time_bucket"].hour, r["n"]) for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()}
    assert late == 1 and rows == {(0, 1), (2, 1), (3, 1)}


def test_bundle_scores_every_horizon(spark):
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    rows = spark.range(40).select(
        F.lit("x").alias("city"), F.format_string("S%02d", "id").alias("segment_id"), at.alias("time_bucket"), at.alias("timestamp"),
        (F.col("id") + 10.0).alias("currentSpeed"), F.lit(50.0).alias("freeFlowSpeed"), F.lit(1.0).alias("jamFactor"),
        F.when(F.col("id") % 4 != 0, F.col("id") * 1.0).alias("speed_lag_1"),
    )
    wanted = ["current_speed_kph", "speed_lag_1", "hour_sin"]
    fit = learn.align_features(rows.withColumn("future_speed_60m", F.col("currentSpeed") * 0.9), wanted, ["city", "segment_id", "future_speed_60m"])
    models = {"60m": learn.fit_horizons(fit, wanted, (60,), rounds=5)[60]}
    bundle = learn.ModelBundle("m", models, {"60m": wanted})
    out = dashboards.score_segments(rows, bundle, ["60", "15min"], at).collect()
    assert len(out) == 80
    for r in out:
        if r["horizon"] == "15m":
            assert r["is_fallback"] and r["predicted_speed"] == r["current_speed"] and r["reliability_level"] == "low"
        else:
            missing = int(r["segment_id"][1:]) % 4 == 0
            assert r["missing_features"] == (["speed_lag_1"] if missing else []) and r["feature_coverage_ratio"] == (0.6667 if missing else 1.0)
            assert r["reliability_level"] == ("low" if missing else "high") and 5 < r["predicted_speed"] < 50 and r["band_low"] < r["predicted_speed"] < r["band_high"]


def test_small_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.create_table(df, f"{tmp_path}/t", ["v"])
    sinks.create_table(df.limit(1), f"{tmp_path}/t", ["v"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1
    assert StructType.fromJson(json.loads(sinks.schema_json(df))) == df.schema
    df.createOrReplaceTempView("known_rows")
    assert readers.optional_table(spark, "absent_rows") is None and readers.optional_table(spark, "known_rows").count() == 2
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_quantiles_beside_far_outliers(spark, monkeypatch):
    """Outliers of 1e300 on both sides, values packed within a billionth, zeros and a constant group."""
    rng = random.Random(9)
    groups = {
        "far": [rng.gauss(50, 5) for _ in range(3000)] + [1e300, -1e300, 5e-324, 0.0],
        "packed": [1e6 + rng.random() * 1e-3 for _ in range(3000)] + [1.4e6, 1e-9],
        "signs": [rng.choice([-1, 1]) * 10 ** rng.uniform(-200, 200) for _ in range(2000)] + [0.0] * 200,
        "same": [3.5] * 500, "one": [7.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    marks = [0.0, 0.15, 0.5, 0.85, 1.0]
    largest = []
    monkeypatch.setattr(quality, "FEW_VALUES", 64)
    real = quality.cut_lineage

    def watched(df):
        out = real(df)
        if "held" in out.columns:
            largest.append(out.agg(F.max("held")).first()[0])
        return out

    monkeypatch.setattr(quality, "cut_lineage", watched)
    got = {r["g"]: r for r in quality.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", marks).collect()}
    for g, values in groups.items():
        values.sort()
        for m in marks:
            spot = (len(values) - 1) * m
            low, high = values[math.floor(spot)], values[math.ceil(spot)]
            assert got[g][f"p{round(m * 100):02d}"] == low + (high - low) * (spot - math.floor(spot)), (g, m)
    assert largest[-1] <= 64 and len(largest) <= 6


def test_counts_ride_along_with_an_action(spark):
    df, watch = quality.counted(spark.range(100), "steps", {"even": F.col("id") % 2 == 0, "small": F.col("id") < 7})
    assert df.count() == 100 and watch.get == {"rows": 100, "even": 50, "small": 7}


def test_news_ids_survive_a_move_and_count_equal_lines(spark, tmp_path):
    lines = ['{"title": "x"}\n'] * 500 + ['{"title": "y"}\n', "\n", "broken\n"]
    for place in ("one", "two"):
        (tmp_path / place / "day").mkdir(parents=True)
        (tmp_path / place / "day" / "a.jsonl").write_text("".join(lines))
    ids = [{r["record_id"] for r in readers.read_news(spark, f"{tmp_path}/{place}/day").collect()} for place in ("one", "two")]
    assert ids[0] == ids[1] and len(ids[0]) == 501
