"""Panel, cleaning, continuity and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import geo, numeric as nm, times as tm
from panelforge.operators import panel as pn, quality as ql
from panelforge.plans import dashboards as db
from panelforge.sources import readers as rd
from workload import derive as dv
from workload.registry import pick, query, tidy


@query(
    "panel_dedup",
    f"WITH {dv.PANEL} SELECT {pick('city segment_id time_bucket timestamp source segment_name weather_cell_id source_rows', 'currentSpeed freeFlowSpeed jamFactor lat lon')} FROM panel",
)
def panel_dedup(spark, sf):
    cols = "city segment_id time_bucket timestamp source segment_name weather_cell_id source_rows currentSpeed freeFlowSpeed jamFactor lat lon"
    return tidy(dv.panel(spark, sf).select(*cols.split()))


@query(
    "dedup_collapse_counts",
    f"WITH {dv.PANEL} SELECT sum(source_rows)::BIGINT AS rows_before, count(*) AS rows_after, sum(source_rows - 1)::BIGINT AS rows_collapsed FROM panel",
)
def dedup_collapse_counts(spark, sf):
    return pn.collapse_counts(dv.panel(spark, sf))


@query(
    "weather_dedup",
    f"WITH {dv.WEATHER} SELECT {pick('city weather_cell_id time_bucket timestamp source_rows', 'temp humidity visibility rain_1h wind_speed')} FROM weather",
)
def weather_dedup(spark, sf):
    cols = "city weather_cell_id time_bucket timestamp source_rows temp humidity visibility rain_1h wind_speed"
    return tidy(dv.weather(spark, sf).select(*cols.split()))


@query(
    "key_dedup_first",
    "SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
def key_dedup_first(spark, sf):
    df = dv.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return pn.keep_first(df, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@query(
    "latest_by_segment",
    f"WITH {dv.PANEL} SELECT {pick('city segment_id time_bucket timestamp', 'currentSpeed jamFactor')} FROM latest",
)
def latest_by_segment(spark, sf):
    out = pn.latest_by_segment(dv.panel(spark, sf))
    return tidy(out.select("city", "segment_id", "time_bucket", "timestamp", "currentSpeed", "jamFactor"))


@query(
    "city_status",
    f"""WITH {dv.PANEL} SELECT city, count(DISTINCT segment_id) AS total_segments, round(avg(currentSpeed), 2) AS avg_speed,
    round(avg(CASE WHEN jamFactor >= 3 THEN 1.0 ELSE 0.0 END), 4) AS congestion_ratio, round(max(jamFactor), 2) AS max_jam_factor,
    count(*) FILTER (jamFactor >= 6) AS critical_segment_count, max(timestamp) AS latest FROM latest GROUP BY city""",
)
def city_status(spark, sf):
    return db.city_status(dv.panel(spark, sf))


@query(
    "dashboard_summary",
    f"""WITH {dv.PANEL} SELECT city, count(DISTINCT segment_id) AS monitored_segments, count(*) FILTER (jamFactor >= 3) AS active_alerts,
    count(*) FILTER (jamFactor < 3) AS free_flow_segments, count(*) FILTER (jamFactor >= 3 AND jamFactor < 6) AS slow_segments,
    count(*) FILTER (jamFactor >= 6) AS congested_segments, round(avg(currentSpeed), 2) AS avg_speed,
    round(avg(jamFactor), 2) AS avg_jam_factor, max(timestamp) AS latest_timestamp FROM latest GROUP BY city""",
)
def dashboard_summary(spark, sf):
    return db.dashboard_summary(dv.panel(spark, sf))


@query(
    "segments_worst_first",
    f"""WITH {dv.PANEL} SELECT segment_id, city, round(currentSpeed, 2) AS current_speed, round(freeFlowSpeed, 2) AS free_flow_speed,
    round(jamFactor, 2) AS jam_factor, timestamp FROM latest ORDER BY jamFactor DESC, city, segment_id LIMIT 50""",
)
def segments_worst_first(spark, sf):
    return db.segments_worst_first(dv.panel(spark, sf), 50)


@query(
    "hourly_trend",
    f"""WITH {dv.PANEL} SELECT city, date_trunc('hour', timestamp) AS hour, round(avg(currentSpeed), 6) AS avg_speed,
    round(avg(jamFactor), 6) AS avg_jam_factor FROM panel
    WHERE timestamp >= (SELECT max(timestamp) FROM panel) - INTERVAL 168 HOURS GROUP BY ALL""",
)
def hourly_trend(spark, sf):
    return db.hourly_trend(dv.panel(spark, sf), 168, digits=6)


@query(
    "lookback_window",
    f"""WITH {dv.PANEL} SELECT {pick('city segment_id time_bucket', 'currentSpeed')} FROM panel
    WHERE timestamp >= (SELECT max(timestamp) FROM panel) - INTERVAL 24 HOURS""",
)
def lookback_window(spark, sf):
    return tidy(db.within_lookback(dv.panel(spark, sf), 24).select("city", "segment_id", "time_bucket", "currentSpeed"))


@query(
    "recent_window",
    f"""WITH {dv.OBS} SELECT event_id, segment_id, event_time FROM obs WHERE event_time >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 30 MINUTES""",
)
def recent_window(spark, sf):
    at = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return db.since(dv.observations(spark, sf), "event_time", at, 30).select("event_id", "segment_id", "event_time")


@query(
    "clean_panel",
    f"""WITH {dv.PANEL} SELECT {pick('event_id city segment_id timestamp time_bucket', 'currentSpeed jamFactor')}, strftime(time_bucket, '%Y-%m-%d') AS date FROM cleaned""",
)
def clean_panel(spark, sf):
    out = pn.clean_traffic(dv.observations(spark, sf), dv.BUCKET)
    return tidy(out.select("event_id", "city", "segment_id", "timestamp", "time_bucket", "currentSpeed", "jamFactor", "date"))


BOXED = "((city = 'hanoi' AND lat BETWEEN 20.9 AND 21.1 AND lon BETWEEN 105.7 AND 106.0) OR (city = 'hcmc' AND lat BETWEEN 10.5 AND 10.9 AND lon BETWEEN 106.5 AND 107.0))"


@query(
    "silver_traffic_clean",
    f"""WITH {dv.OBS}, b AS (SELECT *, date_trunc('hour', event_time) AS time_bucket FROM obs)
    SELECT event_id, city, segment_id, date_trunc('second', event_time + INTERVAL 7 HOURS) AS event_time, year(time_bucket) AS _year,
    month(time_bucket) AS _month, day(time_bucket) AS _day FROM b WHERE {BOXED} AND NOT (currentSpeed < 0 OR currentSpeed > 150 OR jamFactor < 0 OR jamFactor > 10)""",
)
def silver_traffic_clean(spark, sf):
    rows = dv.observations(spark, sf).withColumn("time_bucket", tm.floor_bucket(F.col("event_time"), 60))
    out = ql.clean_traffic_lake(rows)
    return out.select("event_id", "city", "segment_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "_year", "_month", "_day")


@query(
    "silver_weather_clean",
    f"""WITH {dv.RAW_WEATHER} SELECT event_id, weather_cell_id, date_trunc('second', event_time + INTERVAL 7 HOURS) AS event_time, year(event_time) AS _year,
    month(event_time) AS _month, day(event_time) AS _day FROM raw_weather WHERE NOT (temp < -50 OR temp > 60 OR humidity < 0 OR humidity > 100
    OR pressure < 800 OR pressure > 1100 OR visibility < 0 OR visibility > 10000 OR wind_speed < 0)""",
)
def silver_weather_clean(spark, sf):
    rows = dv.raw_weather(spark, sf).withColumn("time_bucket", F.col("event_time"))
    out = ql.clean_weather_lake(rows)
    return out.select("event_id", "weather_cell_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "_year", "_month", "_day")


@query(
    "range_outliers",
    f"""WITH {dv.RAW_WEATHER}, s AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS currentSpeed, value / 40 AS jamFactor FROM events)
    SELECT event_id, (currentSpeed < 0 OR currentSpeed > 150 OR jamFactor < 0 OR jamFactor > 10) AS is_outlier FROM s
    WHERE NOT coalesce(currentSpeed < 0 OR currentSpeed > 150 OR jamFactor < 0 OR jamFactor > 10, true)""",
)
def range_outliers(spark, sf):
    speed = F.when(F.col("event_id") % 9 == 0, None).otherwise(F.col("value"))
    rows = dv.table(spark, sf, "events").select("event_id", speed.alias("currentSpeed"), (F.col("value") / 40).alias("jamFactor"))
    flagged = rows.withColumn("is_outlier", ql.speed_outlier())
    return ql.drop_flagged(flagged, F.col("is_outlier")).select("event_id", "is_outlier")


@query(
    "null_flags",
    """WITH s AS (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN value END AS currentSpeed, CASE WHEN event_id % 7 <> 0 THEN ts END AS event_time,
    CASE WHEN event_id % 5 <> 0 THEN user_id END AS segment_id FROM events)
    SELECT event_id, currentSpeed IS NULL AS has_null_speed, event_time IS NULL AS has_null_timestamp, segment_id IS NULL AS has_null_segment_id FROM s""",
)
def null_flags(spark, sf):
    n = F.col("event_id")
    rows = dv.table(spark, sf, "events").select(
        "event_id", F.when(n % 9 != 0, F.col("value")).alias("currentSpeed"), F.when(n % 7 != 0, F.col("ts")).alias("event_time"),
        F.when(n % 5 != 0, F.col("user_id")).alias("segment_id"),
    )
    return ql.null_flags(rows, ql.TRAFFIC_CRITICAL).select("event_id", *ql.TRAFFIC_CRITICAL)


@query(
    "bbox_city",
    f"""WITH {dv.OBS} SELECT event_id, CASE WHEN lat BETWEEN 20.9 AND 21.1 AND lon BETWEEN 105.7 AND 106.0 THEN 'hanoi'
    WHEN lat BETWEEN 10.5 AND 10.9 AND lon BETWEEN 106.5 AND 107.0 THEN 'hcmc' END AS box_city, {BOXED} AS in_own_city FROM obs""",
)
def bbox_city(spark, sf):
    lat, lon = F.col("lat"), F.col("lon")
    return dv.observations(spark, sf).select(
        "event_id", geo.city_of_point(lat, lon).alias("box_city"), geo.in_own_city(F.col("city"), lat, lon).alias("in_own_city")
    )


@query(
    "retention_counts",
    f"""WITH {dv.OBS}, c AS (SELECT count(*) AS a, count(*) FILTER (currentSpeed IS NOT NULL) AS b,
      count(*) FILTER (currentSpeed IS NOT NULL AND {BOXED}) AS c, count(*) FILTER (currentSpeed IS NOT NULL AND {BOXED} AND currentSpeed <= 100) AS d FROM obs)
    SELECT * REPLACE (round(share, 6) + 0.0 AS share) FROM (
    SELECT 0 AS step_no, 'input' AS step, a AS rows, a / a AS share FROM c UNION ALL SELECT 1, 'not_null', b, b / a FROM c
    UNION ALL SELECT 2, 'in_city', c, c / a FROM c UNION ALL SELECT 3, 'plausible', d, d / a FROM c)""",
)
def retention_counts(spark, sf):
    steps = [
        ("not_null", F.col("currentSpeed").isNotNull()),
        ("in_city", geo.in_own_city(F.col("city"), F.col("lat"), F.col("lon"))),
        ("plausible", F.col("currentSpeed") <= 100),
    ]
    return tidy(ql.retention_counts(dv.observations(spark, sf), steps))


@query("partition_columns", f"WITH {dv.PANEL} SELECT segment_id, time_bucket, year(time_bucket) AS _year, month(time_bucket) AS _month, day(time_bucket) AS _day FROM panel")
def partition_columns(spark, sf):
    return ql.partition_columns(dv.panel(spark, sf)).select("segment_id", "time_bucket", "_year", "_month", "_day")


@query(
    "standard_columns",
    """SELECT 'S' || user_id AS segment_id, 'S' || user_id AS segment_name, value AS currentSpeed, ts AS timestamp,
    CASE WHEN user_id % 3 = 0 THEN 'hanoi' WHEN user_id % 3 = 1 THEN 'hcmc' ELSE 'hue' END AS city FROM events""",
)
def standard_columns(spark, sf):
    spelling = F.when(F.col("user_id") % 3 == 0, " Ha_Noi").when(F.col("user_id") % 3 == 1, "TP.HCM").otherwise("Hue")
    other = dv.table(spark, sf, "events").select(
        F.concat(F.lit("S"), "user_id").alias("segment_id"), F.col("value").alias("current_speed"), F.col("ts").alias("time_bucket"), spelling.alias("city")
    )
    return pn.align_columns(other).select("segment_id", "segment_name", "currentSpeed", "timestamp", "city")


@query(
    "pseudo_coordinates",
    """WITH s AS (SELECT DISTINCT 'S' || user_id AS segment_id, CASE WHEN user_id % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city FROM events)
    SELECT segment_id, city,
      round(CASE city WHEN 'hanoi' THEN 21.0278::DOUBLE ELSE 10.7769::DOUBLE END + (('0x' || substr(sha1(segment_id), 1, 8))::BIGINT / 4294967295.0::DOUBLE - 0.5::DOUBLE) * 0.08::DOUBLE, 6) + 0.0 AS lat,
      round(CASE city WHEN 'hanoi' THEN 105.8342::DOUBLE ELSE 106.7009::DOUBLE END + (('0x' || substr(sha1(segment_id), 9, 8))::BIGINT / 4294967295.0::DOUBLE - 0.5::DOUBLE) * 0.08::DOUBLE, 6) + 0.0 AS lon
    FROM s""",
)
def pseudo_coordinates(spark, sf):
    ids = dv.table(spark, sf, "events").select(
        F.concat(F.lit("S"), "user_id").alias("segment_id"), F.when(F.col("user_id") % 2 == 0, "hanoi").otherwise("hcmc").alias("city")
    ).distinct()
    return tidy(pn.align_columns(ids).select("segment_id", "city", "lat", "lon"))


@query(
    "numeric_coercion",
    """WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE value::VARCHAR END AS raw, CASE event_id % 5 WHEN 0 THEN 'inf'::DOUBLE
      WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN NULL ELSE value END AS x FROM events)
    SELECT event_id, TRY_CAST(raw AS DOUBLE) AS number, CASE WHEN isfinite(x) THEN x END AS finite, CASE WHEN x IS NULL OR isnan(x) THEN 0 ELSE x END = 0 AS is_zero FROM s""",
)
def numeric_coercion(spark, sf):
    n = F.col("event_id")
    x = F.when(n % 5 == 0, float("inf")).when(n % 5 == 1, float("nan")).when(n % 5 == 2, None).otherwise(F.col("value"))
    raw = F.when(n % 4 == 0, "n/a").when(n % 4 == 1, "").otherwise(F.col("value").cast("string"))
    rows = dv.table(spark, sf, "events").select("event_id", raw.alias("raw"), x.alias("x"))
    return rows.select(
        "event_id", nm.to_double(F.col("raw")).alias("number"), nm.finite(F.col("x")).alias("finite"), (nm.zero_if_missing(F.col("x")) == 0).alias("is_zero")
    )


GAPS = """, gaps AS (SELECT city, segment_id, time_bucket, epoch(time_bucket - lag(time_bucket) OVER (PARTITION BY city, segment_id ORDER BY time_bucket)) / 60.0 AS gap FROM panel),
report AS (SELECT city, segment_id, min(time_bucket) AS min_time_bucket, max(time_bucket) AS max_time_bucket, count(*) AS record_count,
  (epoch(max(time_bucket)) - epoch(min(time_bucket)))::BIGINT // 3600 + 1 AS expected_bucket_count,
  greatest((epoch(max(time_bucket)) - epoch(min(time_bucket)))::BIGINT // 3600 + 1 - count(*), 0) AS missing_bucket_count,
  greatest((epoch(max(time_bucket)) - epoch(min(time_bucket)))::BIGINT // 3600 + 1 - count(*), 0) / ((epoch(max(time_bucket)) - epoch(min(time_bucket)))::BIGINT // 3600 + 1)::DOUBLE AS missing_bucket_ratio,
  median(gap) AS median_interval_minutes, max(gap) AS max_time_gap_minutes, count(*) FILTER (gap = 60) / nullif(count(gap), 0)::DOUBLE AS correct_interval_ratio,
  count(*) >= 4 AND count(*) FILTER (gap = 60) >= 3 AS is_train_candidate_15m, count(*) >= 13 AND count(*) FILTER (gap = 60) >= 12 AS is_train_candidate_60m,
  count(*) >= 49 AND count(*) FILTER (gap = 60) >= 48 AS is_train_candidate_240m FROM gaps GROUP BY city, segment_id)"""
REPORT = dv.PANEL + GAPS
REPORT_EXACT = "city segment_id min_time_bucket max_time_bucket record_count expected_bucket_count missing_bucket_count is_train_candidate_15m is_train_candidate_60m is_train_candidate_240m"
REPORT_ROUND = "missing_bucket_ratio median_interval_minutes max_time_gap_minutes correct_interval_ratio"


@query("continuity_report", f"WITH {REPORT} SELECT {pick(REPORT_EXACT, REPORT_ROUND)} FROM report")
def continuity_report(spark, sf):
    return tidy(ql.continuity_report(dv.panel(spark, sf), 60))


@query(
    "city_continuity",
    f"""WITH {REPORT} SELECT city, count(*) AS segment_count, sum(record_count)::BIGINT AS total_records,
    round(median(correct_interval_ratio), 6) + 0.0 AS median_correct_interval_ratio, max(max_time_gap_minutes) AS max_gap_minutes FROM report GROUP BY city""",
)
def city_continuity(spark, sf):
    return tidy(ql.city_continuity(ql.continuity_report(dv.panel(spark, sf), 60)))


@query("worst_gaps", f"WITH {REPORT} SELECT {pick('city segment_id missing_bucket_count', 'missing_bucket_ratio')} FROM report ORDER BY report.missing_bucket_ratio DESC, city, segment_id LIMIT 20")
def worst_gaps(spark, sf):
    out = ql.worst_gaps(ql.continuity_report(dv.panel(spark, sf), 60))
    return tidy(out.select("city", "segment_id", "missing_bucket_count", "missing_bucket_ratio"))


@query(
    "quality_rollup",
    f"""WITH {REPORT}, r AS (SELECT count(DISTINCT segment_id) AS segments, sum(record_count)::BIGINT AS record_count, round(avg(missing_bucket_ratio), 4) AS missing_bucket_ratio,
    round(avg(correct_interval_ratio), 4) AS correct_interval_ratio, count(*) FILTER (is_train_candidate_15m) AS train_candidate_15m,
    count(*) FILTER (is_train_candidate_60m) AS train_candidate_60m FROM report)
    SELECT *, CASE WHEN missing_bucket_ratio >= 0.8 THEN 'unhealthy' WHEN missing_bucket_ratio >= 0.5 THEN 'degraded' ELSE 'healthy' END AS freshness_status,
    CASE WHEN correct_interval_ratio <= 0.5 THEN 'unhealthy' WHEN correct_interval_ratio <= 0.75 THEN 'degraded' ELSE 'healthy' END AS interval_status FROM r""",
)
def quality_rollup(spark, sf):
    return ql.quality_rollup(ql.continuity_report(dv.panel(spark, sf), 60))


@query(
    "collection_summary",
    f"""WITH {dv.OBS}, g AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN '{{}}' END AS geom, CASE WHEN event_id % 10 = 0 THEN NULL ELSE currentSpeed END AS sp FROM obs)
    SELECT count(*) AS records, count(DISTINCT segment_id) AS unique_segments, count(DISTINCT segment_name) AS unique_names, count(geom) AS with_geometry,
    count(*) FILTER (sp IS NULL OR jamFactor IS NULL) AS missing_speed_or_jam FROM g""",
)
def collection_summary(spark, sf):
    n = F.col("event_id")
    rows = dv.observations(spark, sf).withColumns(
        {"geometry": F.when(n % 3 == 0, "{}"), "currentSpeed": F.when(n % 10 != 0, F.col("currentSpeed"))}
    )
    return ql.collection_summary(rows)


@query(
    "freshness",
    """WITH f AS (SELECT max(ts) AS last_update, count(*) AS rows FROM events), a AS (SELECT *, round((epoch(TIMESTAMP '2024-02-05') - epoch(date_trunc('second', last_update))) / 3600, 2) AS age_hours FROM f)
    SELECT 'events' AS component, last_update, rows, age_hours, CASE WHEN age_hours <= 24 THEN 'healthy' WHEN age_hours <= 168 THEN 'degraded' ELSE 'unhealthy' END AS status,
    CASE WHEN age_hours <= 24 THEN 0 ELSE floor(age_hours)::BIGINT END AS lag_units FROM a""",
)
def freshness(spark, sf):
    return ql.freshness(dv.table(spark, sf, "events"), "events", "ts", "2024-02-05 00:00:00")


COUNTED = ("events", "documents", "pages", "lineitem", "orders")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in COUNTED))
def table_counts(spark, sf):
    return ql.table_counts({t: dv.table(spark, sf, t) for t in COUNTED})


@query("distinct_grid", f"WITH {dv.PANEL} SELECT DISTINCT city, segment_id, time_bucket FROM cleaned")
def distinct_grid(spark, sf):
    return pn.bucket_grid(pn.clean_traffic(dv.observations(spark, sf), 60))


@query("union_cities", f"WITH {dv.PANEL} SELECT {pick('city segment_id', 'currentSpeed')} FROM latest")
def union_cities(spark, sf):
    panel = dv.panel(spark, sf)
    parts = [pn.latest_by_segment(panel, c) for c in ("hanoi", "hcmc")]
    return tidy(parts[0].unionByName(parts[1]).select("city", "segment_id", "currentSpeed"))


@query(
    "city_runtime",
    f"""WITH {dv.PANEL}, s AS (SELECT city, count(DISTINCT segment_id) AS segment_count, max(timestamp) AS latest_timestamp, round(avg(currentSpeed), 2) AS avg_speed,
    round(avg(jamFactor), 2) AS avg_jam_factor FROM latest GROUP BY city), w AS (SELECT * FROM (VALUES ('hanoi', true), ('hcmc', false), ('hue', true)) v(city, enabled))
    SELECT w.city, enabled, coalesce(segment_count, 0) AS segment_count, latest_timestamp, avg_speed, avg_jam_factor,
    CASE WHEN enabled AND coalesce(segment_count, 0) > 0 THEN 'online' ELSE 'offline' END AS status FROM w LEFT JOIN s ON w.city = s.city""",
)
def city_runtime(spark, sf):
    return db.city_runtime(dv.panel(spark, sf), {"hanoi": True, "hcmc": False, "hue": True})


@query("paged_points", "SELECT s_suppkey AS segment_id, CASE WHEN s_suppkey % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city FROM supplier WHERE s_suppkey % 2 = 0 ORDER BY s_suppkey OFFSET 5 LIMIT 20")
def paged_points(spark, sf):
    points = dv.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("segment_id"), F.when(F.col("s_suppkey") % 2 == 0, "hanoi").otherwise("hcmc").alias("city")
    )
    return rd.monitoring_points(points, "Hanoi", 5, 20)
