"""Views of the given tables in the shapes the operators expect, in Spark and in SQL.

``events`` become traffic observations and weather readings, ``pages`` become news records,
``supplier``/``nation`` the road dimension. Every view keeps all rows of its table that qualify.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelforge.functions import numeric as nm
from panelforge.operators import panel as pn, timeseries as ts

BUCKET = 60
FREE_FLOW = 59.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    road = F.floor(F.col("user_id") / 20)
    spot = F.col("event_id") % 200
    north = road % 2 == 0
    speed = F.col("value") % 120
    return events.select(
        "event_id",
        F.concat(F.lit("S"), road.cast("string")).alias("segment_id"),
        F.concat(F.lit("Road "), road.cast("string")).alias("segment_name"),
        F.when(north, "hanoi").otherwise("hcmc").alias("city"),
        F.concat(F.lit("W"), (road % 4).cast("string")).alias("weather_cell_id"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("event_time"),
        F.when(north, 20.85 + spot / 1000).otherwise(10.45 + spot / 400).alias("lat"),
        F.when(north, 105.65 + spot / 500).otherwise(106.45 + spot / 350).alias("lon"),
        speed.alias("currentSpeed"),
        F.lit(FREE_FLOW).alias("freeFlowSpeed"),
        nm.jam_factor(speed, F.lit(FREE_FLOW)).alias("jamFactor"),
        F.lit(None).cast("string").alias("geometry"),
    )


OBS = """obs AS (
  SELECT event_id, 'S' || (user_id // 20) AS segment_id, 'Road ' || (user_id // 20) AS segment_name,
    CASE WHEN (user_id // 20) % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city,
    'W' || ((user_id // 20) % 4) AS weather_cell_id, event_type AS source, ts AS event_time,
    CASE WHEN (user_id // 20) % 2 = 0 THEN 20.85::DOUBLE + (event_id % 200)::DOUBLE / 1000 ELSE 10.45::DOUBLE + (event_id % 200)::DOUBLE / 400 END AS lat,
    CASE WHEN (user_id // 20) % 2 = 0 THEN 105.65::DOUBLE + (event_id % 200)::DOUBLE / 500 ELSE 106.45::DOUBLE + (event_id % 200)::DOUBLE / 350 END AS lon,
    value % 120 AS currentSpeed, 59.0::DOUBLE AS freeFlowSpeed,
    round(greatest(0.0::DOUBLE, least(10.0::DOUBLE, (1.0::DOUBLE - (value % 120) / 59.0::DOUBLE) * 10.0::DOUBLE)), 2) AS jamFactor,
    CAST(NULL AS VARCHAR) AS geometry
  FROM events)"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, deduplicated observations: one row per (city, segment, hour)."""
    return pn.dedup_traffic(pn.clean_traffic(observations(spark, sf_dir), BUCKET))


PANEL = OBS + """, cleaned AS (
  SELECT *, event_time AS timestamp, date_trunc('hour', event_time) AS time_bucket FROM obs
  WHERE currentSpeed BETWEEN 0 AND 150 AND freeFlowSpeed BETWEEN 1 AND 180 AND jamFactor BETWEEN 0 AND 10),
panel AS (
  SELECT city, segment_id, time_bucket, max(timestamp) AS timestamp, avg(currentSpeed) AS currentSpeed,
    avg(freeFlowSpeed) AS freeFlowSpeed, avg(jamFactor) AS jamFactor,
    arg_max(lat, row(timestamp, lat)) AS lat, arg_max(lon, row(timestamp, lon)) AS lon,
    arg_max(source, row(timestamp, source)) AS source, arg_max(segment_name, row(timestamp, segment_name)) AS segment_name,
    arg_max(weather_cell_id, row(timestamp, weather_cell_id)) AS weather_cell_id, count(*) AS source_rows
  FROM cleaned GROUP BY city, segment_id, time_bucket),
latest AS (
  SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY city, segment_id ORDER BY timestamp DESC, time_bucket DESC) = 1)"""


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as weather readings; cell W3 gets none and has to fall back to its city."""
    events = table(spark, sf_dir, "events")
    road = F.floor(F.col("user_id") / 20)
    v = F.col("value")
    return events.filter(road % 4 != 3).select(
        "event_id", F.when(road % 2 == 0, "hanoi").otherwise("hcmc").alias("city"),
        F.concat(F.lit("W"), (road % 4).cast("string")).alias("weather_cell_id"), F.col("ts").alias("event_time"),
        (15 + v % 20).alias("temp"), (15 + v % 18).alias("feels_like"), (40 + v % 70).alias("humidity"),
        (990 + v % 40).alias("pressure"), (v * 21).alias("visibility"), (v / 50).alias("rain_1h"), (v % 12).alias("wind_speed"),
    )


RAW_WEATHER = """raw_weather AS (
  SELECT event_id, CASE WHEN (user_id // 20) % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city, 'W' || ((user_id // 20) % 4) AS weather_cell_id,
    ts AS event_time, 15 + value % 20 AS temp, 15 + value % 18 AS feels_like, 40 + value % 70 AS humidity, 990 + value % 40 AS pressure,
    value * 21 AS visibility, value / 50 AS rain_1h, value % 12 AS wind_speed
  FROM events WHERE (user_id // 20) % 4 <> 3)"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pn.dedup_weather(pn.clean_weather(raw_weather(spark, sf_dir), BUCKET))


WEATHER = RAW_WEATHER + """, weather AS (
  SELECT city, weather_cell_id, date_trunc('hour', event_time) AS time_bucket, max(event_time) AS timestamp, avg(temp) AS temp,
    avg(feels_like) AS feels_like, avg(humidity) AS humidity, avg(pressure) AS pressure, avg(visibility) AS visibility,
    avg(rain_1h) AS rain_1h, avg(wind_speed) AS wind_speed, count(*) AS source_rows
  FROM raw_weather WHERE temp BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 AND visibility BETWEEN 0 AND 10000 AND wind_speed >= 0
  GROUP BY city, weather_cell_id, date_trunc('hour', event_time))"""


def based(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with clock features and the congestion ratio."""
    return ts.add_base_features(ts.add_time_features(panel(spark, sf_dir), BUCKET))


BASED = PANEL + """, based AS (
  SELECT *, hour(time_bucket) AS hour_of_day, isodow(time_bucket) - 1 AS day_of_week,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - currentSpeed / freeFlowSpeed)) AS congestion_ratio
  FROM panel)"""


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as news records: some without publish time, some with it hidden in the URL."""
    pages = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    at = F.timestamp_seconds(F.lit(1704067200) + n * 1020)
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamped = F.concat(F.regexp_extract("url", "^[^?#]*", 0), F.lit("/tin-20240105"), F.lpad((n % 24).cast("string"), 2, "0"), F.lit("1530.htm"))
    return pages.select(
        F.col("page_id").alias("record_id"),
        F.concat(F.lit("x"), (n % 200).cast("string")).alias("external_id"),
        F.when(n % 3 == 0, "tuoitre_giaothong").when(n % 3 == 1, "site_thoisux").otherwise("vov").alias("source"),
        F.when(n % 2 == 0, "rss").otherwise("html_listing").alias("provider"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.when(n % 7 == 0, None).when(n % 4 == 0, F.concat(F.lit('<img src="'), "url", F.lit('">'), "html")).otherwise(F.col("html")).alias("summary"),
        F.when(n % 10 == 1, stamped).otherwise(F.col("url")).alias("source_url"),
        F.when((n % 5 == 0) | (n % 10 == 1), None).otherwise(iso(at)).alias("published_at"),
        F.when(n % 6 == 0, "Hà Nội").when(n % 6 == 1, "none").alias("city_hint"),
        F.when(n % 25 == 0, None).otherwise(iso(at + F.expr("INTERVAL 1 HOUR"))).alias("ingestion_time"),
    )


RAW_NEWS = """raw_news AS (
  SELECT page_id AS record_id, 'x' || (page_id % 200) AS external_id,
    CASE page_id % 3 WHEN 0 THEN 'tuoitre_giaothong' WHEN 1 THEN 'site_thoisux' ELSE 'vov' END AS source,
    CASE WHEN page_id % 2 = 0 THEN 'rss' ELSE 'html_listing' END AS provider,
    regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 4 = 0 THEN '<img src="' || url || '">' || html ELSE html END AS summary,
    CASE WHEN page_id % 10 = 1 THEN regexp_extract(url, '^[^?#]*') || '/tin-20240105' || lpad((page_id % 24)::VARCHAR, 2, '0') || '1530.htm' ELSE url END AS source_url,
    CASE WHEN page_id % 5 = 0 OR page_id % 10 = 1 THEN NULL
      ELSE TIMESTAMP '2024-01-01' + to_seconds(page_id * 1020) END AS published_at,
    CASE page_id % 6 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'none' END AS city_hint,
    CASE WHEN page_id % 25 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_seconds(page_id * 1020 + 3600) END AS ingestion_time
  FROM pages)"""

# Rule tables made of words and fragments that occur in the fixture texts.
FIXTURE_RULES = {
    "categories": {
        "accident": ["sterou", "etrela"],
        "congestion": ["gasich", "thened"],
        "flood": ["hewh", "oicheau"],
        "weather_disruption": ["thand", "ciónde"],
        "roadwork_active": ["ndsh", "eauvi"],
        "airport": ["erhe", "osde"],
        "public_transport": ["inat", "lichge"],
        "enforcement": ["outh", "querai"],
        "planned_event": ["arese", "ungein"],
        "roadwork_planned": ["thst"],
        "infrastructure_planning": ["qwerty"],
    },
    "planning": ["retion", "queai", "ereein"],
    "active_roadwork": ["shthe", "aileau"],
    "infrastructure": ["the", "der", "les"],
    "planned_roadwork": ["onof", "thti"],
    "fatal": ["nthen", "oiré"],
    "severe": ["anst", "eaual"],
    "moderate": ["inth", "ment"],
    "early_plan": ["edin", "vipa"],
    "off_topic": ["hean", "dade"],
}
FIXTURE_CITIES = {"hanoi": ["hà nội", "thinan", "ouaux"], "hcmc": ["ernd", "réeau"], "danang": ["hein", "der"]}
FIXTURE_HINTS = {"accident": ["tion", "ción"], "roadwork": ["ndsh", "éeau"], "possible_unrelated": ["bleon", "keit"]}


def road_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of three quarters of the keys as road segments."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    classes = F.array(*[F.lit(x) for x in ("motorway", "trunk", "primary", "secondary", "residential", "track")])
    return s.filter(key % 4 != 0).join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), key.cast("string")).alias("segment_id"),
        F.element_at(classes, (key % 6 + 1).cast("int")).alias("road_class"), F.col("n_name").alias("district"),
        F.when(key % 5 != 0, F.abs("s_acctbal") / 10).alias("length_m"), F.when(key % 3 != 0, (key % 100).cast("double")).alias("speed_limit"),
    )


DIMENSION = """dimension AS (
  SELECT 'S' || s_suppkey AS segment_id,
    (['motorway', 'trunk', 'primary', 'secondary', 'residential', 'track'])[s_suppkey % 6 + 1] AS road_class, n_name AS district,
    CASE WHEN s_suppkey % 5 <> 0 THEN abs(s_acctbal) / 10 END AS length_m, CASE WHEN s_suppkey % 3 <> 0 THEN (s_suppkey % 100)::DOUBLE END AS speed_limit
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 <> 0)"""


def road_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed road events of a city."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    kinds = F.array(*[F.lit(x) for x in ("accident", "flood", "roadwork", "event", "other")])
    return e.select(
        n.alias("record_id"), F.when(n % 2 == 0, "hanoi").otherwise("hcmc").alias("city"),
        # Some events sit exactly on the bucket grid, to exercise inclusive bounds.
        F.when(n % 11 == 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("event_time"),
        F.element_at(kinds, (n % 5 + 1).cast("int")).alias("event_type"), (n % 6).cast("int").alias("severity"),
        (n % 10 / 10).alias("traffic_relevance_score"), (n % 3 != 0).cast("int").alias("is_relevant_for_traffic_model"),
    )


ROAD_EVENTS = """road_events AS (
  SELECT event_id AS record_id, CASE WHEN event_id % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city,
    CASE WHEN event_id % 11 = 0 THEN date_trunc('hour', ts) ELSE ts END AS event_time,
    (['accident', 'flood', 'roadwork', 'event', 'other'])[event_id % 5 + 1] AS event_type, (event_id % 6)::INTEGER AS severity,
    (event_id % 10)::DOUBLE / 10 AS traffic_relevance_score, CASE WHEN event_id % 3 <> 0 THEN 1 ELSE 0 END AS is_relevant_for_traffic_model
  FROM events)"""
