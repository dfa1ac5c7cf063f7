"""Readers, sinks and streams: tables derived from the given ones are written, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import times as tm
from panelforge.operators import news as nw
from panelforge.session import scratch_path
from panelforge.sources import readers as rd, sinks as sk
from panelforge.streaming import jobs as st
from workload import derive as dv
from workload.registry import pick, query, tidy

MESSAGE = "event_id long, segment_id string, currentSpeed double, ts timestamp"


def message_lines(spark, sf):
    """Every event as a JSON line; each 50th line is cut short and cannot be parsed."""
    body = F.to_json(F.struct("event_id", F.concat(F.lit("S"), "user_id").alias("segment_id"), F.col("value").alias("currentSpeed"), F.col("ts").cast("timestamp").alias("ts")))
    broken = F.col("event_id") % 50 == 13
    return dv.table(spark, sf, "events").select(F.when(broken, F.substring(body, 1, 20)).otherwise(body).alias("value"))


def message_folder(spark, sf) -> str:
    path = scratch_path(spark, "messages")
    message_lines(spark, sf).repartition(4).write.text(path)
    return path


GOOD = "SELECT event_id, 'S' || user_id AS segment_id, value AS \"currentSpeed\" FROM events WHERE event_id % 50 <> 13"


@query("jsonl_scan", GOOD)
def jsonl_scan(spark, sf):
    good, _ = rd.read_jsonl(spark, message_folder(spark, sf), MESSAGE, glob="*.txt")
    return good.select("event_id", "segment_id", "currentSpeed")


@query("dead_letter_split", "SELECT 'traffic' AS original_topic, 'malformed JSON' AS error, count(*) AS letters, 20 AS longest FROM events WHERE event_id % 50 = 13")
def dead_letter_split(spark, sf):
    _, wrong = rd.read_jsonl(spark, message_folder(spark, sf), MESSAGE, glob="*.txt")
    letters = sk.dead_letters(wrong, "traffic")
    return letters.groupBy("original_topic", "error").agg(F.count(F.lit(1)).alias("letters"), F.max(F.length("original_value")).alias("longest"))


@query("jsonl_append", "SELECT o_orderkey, o_orderpriority FROM orders")
def jsonl_append(spark, sf):
    path = scratch_path(spark, "orders-json")
    rows = dv.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    sk.append_jsonl(rows.filter("o_orderkey % 2 = 0"), path)
    sk.append_jsonl(rows.filter("o_orderkey % 2 = 1"), path)
    return rd.read_jsonl(spark, path, "o_orderkey long, o_orderpriority string", glob="*.json")[0]


@query("traffic_layouts", """SELECT event_id, 'S' || user_id AS segment_id, date_trunc('second', ts) AS event_time, value % 120 AS "currentSpeed", CASE WHEN event_id % 2 = 0 THEN 3.5 ELSE round(greatest(0.0::DOUBLE, least(10.0::DOUBLE, (1.0::DOUBLE - (value % 120) / 59.0::DOUBLE) * 10.0::DOUBLE)), 2) END AS "jamFactor" FROM events""")
def traffic_layouts(spark, sf):
    """Both layouts in one folder: with event_time and jam, or with timestamp only."""
    path = scratch_path(spark, "traffic")
    e, iso = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shared = [e.cast("string").alias("segment_name"), F.concat(F.lit("S"), "user_id").alias("segment_id"), (F.col("value") % 120).alias("currentSpeed"), F.lit(59.0).alias("freeFlowSpeed")]
    events = dv.table(spark, sf, "events")
    new = events.filter(e % 2 == 0).select(*shared, iso.alias("event_time"), F.lit(3.5).alias("jamFactor"))
    old = events.filter(e % 2 == 1).select(*shared, iso.alias("timestamp"))
    for part, name in ((new, "new"), (old, "old")):
        part.write.json(f"{path}/{name}")
    rows = rd.read_traffic(spark, f"{path}/*", "*.json")
    at = tm.parse_utc(F.col("event_time")).cast("timestamp_ntz")
    return rows.select(F.col("segment_name").cast("long").alias("event_id"), "segment_id", at.alias("event_time"), "currentSpeed", "jamFactor")


@query("csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "supplier-csv")
    dv.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option("header", True).csv(path)
    return rd.read_csv(spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query("csv_tagged_glob", "SELECT s_suppkey::INTEGER AS s_suppkey, s_nationkey, 'mets' AS _source FROM supplier")
def csv_tagged_glob(spark, sf):
    path = scratch_path(spark, "tagged")
    dv.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").repartition(3).write.option("header", True).csv(path)
    return rd.read_tagged(spark, f"{path}/*.csv", "mets")


@query("first_existing_table", "SELECT n_nationkey, n_name, 'csv' AS found FROM nation UNION ALL SELECT r_regionkey, r_name, 'parquet' FROM region")
def first_existing_table(spark, sf):
    base = scratch_path(spark, "either")
    sk.write_both(dv.table(spark, sf, "nation").select("n_nationkey", "n_name"), base + "-n")
    dv.table(spark, sf, "region").select("r_regionkey", "r_name").write.parquet(base + "-r.parquet")
    first = rd.read_first(spark, base + "-n").select("n_nationkey", "n_name", F.lit("csv").alias("found"))
    return first.unionAll(rd.read_first(spark, base + "-r").select("r_regionkey", "r_name", F.lit("parquet").alias("found")))


@query("partitioned_roundtrip", f"WITH {dv.PANEL} SELECT {pick('city segment_id time_bucket', 'currentSpeed')}, strftime(time_bucket, '%Y-%m-%d') AS date FROM panel WHERE strftime(time_bucket, '%Y-%m-%d') >= '2024-01-15'")
def partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "panel")
    rows = dv.panel(spark, sf).select("city", "segment_id", "time_bucket", "currentSpeed").withColumn("date", F.date_format("time_bucket", "yyyy-MM-dd"))
    sk.write_partitioned(rows, path, ["city", "date"])
    back = rd.read_table(spark, path).filter(F.col("date") >= "2024-01-15")
    return tidy(back.select("city", "segment_id", "time_bucket", "currentSpeed", F.date_format("date", "yyyy-MM-dd").alias("date")))


@query("upsert", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'N' FROM orders WHERE o_orderkey % 10 = 1")
def upsert(spark, sf):
    orders = dv.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    changed = orders.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X"))
    added = orders.filter("o_orderkey % 10 = 1").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return sk.upserted(orders, changed.unionByName(added), ["o_orderkey"])


@query("merged_schema", "SELECT s_suppkey, s_name, NULL AS note FROM supplier UNION ALL SELECT s_suppkey + 1000000, NULL, 'new' FROM supplier WHERE s_suppkey % 2 = 0")
def merged_schema(spark, sf):
    path = scratch_path(spark, "merged")
    s = dv.table(spark, sf, "supplier")
    new = s.filter("s_suppkey % 2 = 0").select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), F.lit("new").alias("note"))
    sk.write_merged_schema(new, s.select("s_suppkey", "s_name"), path)
    return rd.read_table(spark, path).select("s_suppkey", "s_name", "note")


@query("empty_table_create", "SELECT r_regionkey, r_name FROM region")
def empty_table_create(spark, sf):
    """Creating an existing table again must leave it alone."""
    path = scratch_path(spark, "ensure")
    sk.create_empty(spark, path, "r_regionkey int, r_name string")
    dv.table(spark, sf, "region").select("r_regionkey", "r_name").write.mode("append").parquet(path)
    sk.create_empty(spark, path, "r_regionkey int, r_name string")
    return rd.read_table(spark, path)


@query("standard_types", "SELECT 'S' || user_id AS segment_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'x' ELSE value::VARCHAR END AS DOUBLE) AS \"currentSpeed\", event_id % 2 = 0 AS \"roadClosure\", NULL AS provider FROM events")
def standard_types(spark, sf):
    e = F.col("event_id")
    raw = dv.table(spark, sf, "events").select(
        F.concat(F.lit("S"), "user_id").alias("segment_id"), F.when(e % 4 == 0, "x").otherwise(F.col("value").cast("string")).alias("currentSpeed"), F.when(e % 2 == 0, "true").otherwise("false").alias("roadClosure")
    )
    return rd.to_standard(raw, rd.TRAFFIC_TYPES).select("segment_id", "currentSpeed", "roadClosure", "provider")


@query("lineage_columns", "SELECT event_id, 'bronze' AS _source, 2024 AS _year, 3 AS _month, 9 AS _day FROM events")
def lineage_columns(spark, sf):
    now = F.lit("2024-03-09 10:00:00").cast("timestamp_ntz")
    return rd.with_lineage(dv.table(spark, sf, "events"), "bronze", now).select("event_id", "_source", "_year", "_month", "_day")


@query("prefixed_columns", "SELECT n.n_name AS left_n_name, n_regionkey, r_name AS right_r_name FROM nation n JOIN region r ON n_regionkey = r_regionkey")
def prefixed_columns(spark, sf):
    left = rd.with_prefix(dv.table(spark, sf, "nation").select("n_name", "n_regionkey"), "left_", ["n_regionkey"])
    right = rd.with_prefix(dv.table(spark, sf, "region").select("r_name", F.col("r_regionkey").alias("n_regionkey")), "right_", ["n_regionkey"])
    return left.join(right, "n_regionkey")


@query("percentile_stats_table", "SELECT 'S' || s_suppkey AS segment_id, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal ELSE 0 END AS p15_percentile, 0.0 AS p50_percentile, s_acctbal AS p85_percentile, 'tomtom-stats' AS source FROM supplier")
def percentile_stats_table(spark, sf):
    s = F.col("s_suppkey")
    stats = dv.table(spark, sf, "supplier").select(F.concat(F.lit("S"), s).alias("segment_id"), F.when(s % 2 == 0, F.col("s_acctbal")).alias("p15"), F.lit(None).cast("double").alias("p50"), F.col("s_acctbal").alias("p85"))
    return rd.percentile_stats(stats, F.current_timestamp()).drop("fetched_at")


@query("road_segment_dimension", "SELECT 'hanoi_' || sha1(s_suppkey || '|' || s_name) AS segment_id, 'primary' AS highway, 'LINESTRING (105.0 ' || (20 + s_suppkey % 3) || '.0, 106.0 21.0)' AS geometry_wkt FROM supplier")
def road_segment_dimension(spark, sf):
    point = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    edges = dv.table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit("primary").alias("highway"), F.array(
        point(F.lit(105.0), (20 + F.col("s_suppkey") % 3).cast("double")), point(F.lit(106.0), F.lit(21.0))).alias("points"))
    return rd.road_segments(edges, "hanoi", ["s_suppkey", "s_name"]).select("segment_id", "highway", "geometry_wkt")


@query("news_line_identity", "SELECT 2 * count(*) AS records, 2 * count(DISTINCT page_id) AS identities, 40 AS id_length FROM pages")
def news_line_identity(spark, sf):
    path = scratch_path(spark, "news")
    rows = dv.raw_news(spark, sf).drop("record_id")
    # Every line twice in one file: the occurrences get ids of their own.
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    lines.unionByName(lines).repartition(3, "value").write.text(f"{path}/lines")
    ids = rd.read_news(spark, f"{path}/lines", "*.txt").select(F.col("record_id").alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("id").alias("identities"), F.max(F.length("id")).alias("id_length"))


@query("raw_event_shape", f"""WITH {dv.RAW_NEWS} SELECT record_id, CASE WHEN published_at IS NOT NULL THEN strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') WHEN record_id % 10 = 1 THEN strftime(TIMESTAMP '2024-01-05 00:15:30' + to_hours(record_id % 24) - INTERVAL 7 HOURS, '%Y-%m-%dT%H:%M:%SZ') END AS published_at,
    'traffic_news' AS event_type FROM raw_news""")
def raw_event_shape(spark, sf):
    news = nw.news_table(dv.raw_news(spark, sf), dv.FIXTURE_CITIES, dv.FIXTURE_HINTS)
    return nw.raw_shape(news).select("record_id", "published_at", "event_type")


# ---------------------------------------------------------------- streams


def stream_lines(spark, sf):
    return st.file_lines(spark, message_folder(spark, sf), "traffic")


@query("stream_bronze", "SELECT event_id, 'S' || user_id AS segment_id, value AS \"currentSpeed\", 'traffic' AS _source FROM events WHERE event_id % 50 <> 13")
def stream_bronze(spark, sf):
    rows = st.bronze_rows(stream_lines(spark, sf), "traffic", MESSAGE)
    return st.run_to_table(spark, rows, "bronze").select("event_id", "segment_id", "currentSpeed", "_source")


@query("stream_dead_letter", "SELECT count(*) FILTER (event_id % 50 <> 13) AS stored, count(*) FILTER (event_id % 50 = 13) AS letters FROM events")
def stream_dead_letter(spark, sf):
    root = scratch_path(spark, "split")
    st.split_stream(stream_lines(spark, sf), MESSAGE, f"{root}/good", f"{root}/bad", f"{root}/checkpoint", once=True).awaitTermination()
    good = spark.read.parquet(f"{root}/good").select(F.lit(1).alias("s"), F.lit(0).alias("l"))
    bad = spark.read.parquet(f"{root}/bad").select(F.lit(0).alias("s"), F.lit(1).alias("l"))
    return good.unionAll(bad).agg(F.sum("s").alias("stored"), F.sum("l").alias("letters"))


# Four arrivals: a row comes with the quarter of the time range it lies in, every 7th one quarter later. Rows of the first two
# quarters arrive before a restart, the others after it. What a batch drops as late is what the batch before has closed.
ARRIVALS = """span AS (SELECT min(epoch(ts)) AS a, max(epoch(ts)) AS z FROM events), timed AS (SELECT *, least(3, floor((epoch(ts) - a) / (z - a) * 4)::INTEGER) AS q FROM events, span),
arrived AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN least(3, q + 1) ELSE q END AS arrival, date_trunc('day', ts) AS day FROM timed),
marks AS (SELECT max(ts) FILTER (arrival < 2) - INTERVAL 2 DAYS AS late_mark, max(ts) - INTERVAL 2 DAYS AS last_mark FROM arrived),
taken AS (SELECT * FROM arrived, marks WHERE arrival < 2 OR day + INTERVAL 1 DAY > late_mark)"""


@query("stream_tumbling", f"""WITH {ARRIVALS} SELECT day AS time_bucket, event_type, count(*) AS n, round(avg(value), 6) + 0.0 AS mean_value FROM taken WHERE day + INTERVAL 1 DAY <= last_mark GROUP BY ALL""")
def stream_tumbling(spark, sf):
    """Daily buckets over four micro-batches with rows out of order and one restart; buckets that are still open do not appear."""
    path = scratch_path(spark, "ticks")
    events = dv.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    quarter = F.least(F.lit(3), F.floor((F.unix_micros("ts") - low) / (high - low) * 4).cast("int"))
    arrivals = events.withColumn("arrival", F.when(F.col("event_id") % 7 == 0, F.least(F.lit(3), quarter + 1)).otherwise(quarter)).cache()
    for first in (0, 2):
        for i in (first, first + 1):
            arrivals.filter(F.col("arrival") == i).select("ts", "event_type", "value").coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        daily = st.tumbling(stream, "ts", 1440, ["event_type"], [F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")], lateness="2 days")
        # The second run goes on from the first one's state.
        st.to_bronze(daily, f"{path}/out", f"{path}/checkpoint", once=True).awaitTermination()
    arrivals.unpersist()
    out = spark.read.schema(daily.schema).parquet(f"{path}/out")
    return tidy(out.select(F.col("time_bucket").cast("timestamp_ntz").alias("time_bucket"), "event_type", "n", "mean_value"))


@query("stream_dedup", "SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT user_id, event_type FROM events)")
def stream_dedup(spark, sf):
    path = scratch_path(spark, "keys")
    events = dv.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("key"))
    events.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
    out = st.run_to_table(spark, st.first_within(stream, "key", "ts", "40 days"), "first")
    return out.agg(F.count(F.lit(1)).alias("distinct_keys"))


@query("stream_union", "SELECT 'traffic.raw' AS topic, count(*) AS messages FROM events UNION ALL SELECT 'weather.raw', count(*) FROM orders UNION ALL SELECT 'events.news', count(*) FROM pages")
def stream_union(spark, sf):
    root = scratch_path(spark, "topics")
    tables = {"traffic.raw": "events", "weather.raw": "orders", "events.news": "pages"}
    streams = {}
    for topic, name in tables.items():
        dv.table(spark, sf, name).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/{topic}")
        streams[topic] = st.file_lines(spark, f"{root}/{topic}", topic)
    out = st.run_to_table(spark, st.union_topics(streams), "union")
    return out.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query("stream_counts", "SELECT count(*) AS sent, count(*) FILTER (event_id % 50 = 13) AS failed FROM events")
def stream_counts(spark, sf):
    """Totals over all micro-batches of a finished stream."""
    root = scratch_path(spark, "counts")
    st.count_batches(stream_lines(spark, sf), MESSAGE, f"{root}/batches", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/batches").agg(F.sum("sent").alias("sent"), F.sum("failed").alias("failed"))
