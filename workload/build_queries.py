"""Whole table builds: matched silver, events, their report, training data."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge import catalog
from panelforge.operators import features as ft, news as nw, panel as pn, timeseries as ts
from panelforge.plans import builds
from panelforge.session import cut_lineage
from workload import derive as dv
from workload.registry import pick, query, tidy
from workload.cluster_queries import COMPARABLE, GREEDY
from workload.series_queries import KEYS, NEAREST, WIN_EXACT, WINDOWS
from workload.text_queries import CITY_CASE, FOLD, PUBLISH, SUBTYPED, SUMMARY, decode, squeeze, strip_tags

AS_OF = "2024-03-01 00:00:00"
# The classification SQL over any (doc_id, text) source.
TEXTS = f"""{dv.RAW_NEWS}, {PUBLISH}, shaped AS (SELECT *, {squeeze(strip_tags(decode('title')))} AS ttl, coalesce({SUMMARY('summary')}, '') AS body FROM timed),
documents_text AS (SELECT record_id AS doc_id, trim(concat_ws(' ', ttl, nullif(body, ''))) AS text FROM shaped), {SUBTYPED.replace('FROM documents)', 'FROM documents_text)', 1)},
normal AS (SELECT s.record_id, s.ttl AS title, r.category AS event_category, r.subtype AS event_subtype, r.severity AS severity_score, r.relevance AS traffic_relevance_score, r.duration_hours,
  coalesce(s.published_at, s.from_url, s.ingestion_time, TIMESTAMP '{AS_OF}') AS event_time_start,
  coalesce({CITY_CASE(FOLD("CASE WHEN city_hint <> 'none' THEN city_hint END"), 0)}, {CITY_CASE(FOLD('d.text'), 0)}) AS city FROM shaped s JOIN documents_text d ON d.doc_id = s.record_id JOIN rel r ON r.doc_id = s.record_id)"""


def normalized(spark, sf):
    # No publish time is read from free text here: the fixture's words carry no dates.
    return nw.normalize_events(dv.raw_news(spark, sf), F.lit(AS_OF).cast("timestamp"), dv.FIXTURE_RULES, dv.FIXTURE_CITIES)


@query("events_normalized", f"WITH {TEXTS} SELECT record_id, title, city, event_category, event_subtype, severity_score, event_time_start, event_time_start + to_hours(duration_hours) AS event_time_end, round(traffic_relevance_score, 6) + 0.0 AS traffic_relevance_score FROM normal")
def events_normalized(spark, sf):
    cols = "record_id title city event_category event_subtype severity_score event_time_start event_time_end traffic_relevance_score"
    return tidy(normalized(spark, sf).select(*cols.split()))


HINT = "CASE WHEN s.city_hint <> 'none' THEN s.city_hint END"
ACTIVE = ", ".join(f"'{c}'" for c in catalog.ACTIVE_CATEGORIES)
# Events in order of time and id (k), matched like ``event_groups``; one best row per leader.
EVENTS = f"""{TEXTS}, placed AS (SELECT n.*, CASE WHEN {CITY_CASE(FOLD(HINT), 0)} IS NOT NULL THEN s.city_hint ELSE {CITY_CASE(FOLD('d.text'), 1)} END AS place,
  CASE WHEN s.published_at IS NOT NULL THEN 'high' WHEN s.from_url IS NOT NULL THEN 'medium' ELSE 'low' END AS event_time_confidence,
  (n.city IS NOT NULL AND n.event_category IN ({ACTIVE}) AND n.traffic_relevance_score >= {catalog.MODEL_RELEVANCE}::DOUBLE)::INTEGER AS eligible FROM normal n JOIN shaped s USING (record_id) JOIN documents_text d ON d.doc_id = n.record_id),
ord AS (SELECT *, row_number() OVER (ORDER BY event_time_start, record_id) AS k, coalesce(city, '') AS cc, {COMPARABLE} AS t FROM placed),
near AS (SELECT x.k AS a, y.k AS b FROM ord x JOIN ord y ON x.cc = y.cc AND x.event_category = y.event_category AND x.k < y.k AND y.event_time_start - x.event_time_start <= INTERVAL 24 HOURS
  WHERE CASE WHEN x.t = y.t THEN 1.0::DOUBLE ELSE 1 - levenshtein(x.t, y.t) / greatest(length(x.t), length(y.t))::DOUBLE END >= CASE WHEN x.place = y.place AND x.place <> '' THEN 0.68 ELSE 0.82 END - 1e-9),
{GREEDY}, led AS (SELECT o.*, coalesce(w.original, o.k) AS leader FROM ord o LEFT JOIN walk w ON w.id = o.k),
best AS (SELECT * FROM led QUALIFY row_number() OVER (PARTITION BY leader ORDER BY traffic_relevance_score DESC, severity_score DESC, record_id) = 1)"""
EVENT_WINDOWS = "cat AS (SELECT city, event_time_start AS event_time, event_category AS c, severity_score AS severity, traffic_relevance_score FROM best WHERE eligible = 1 AND city IS NOT NULL)," + WINDOWS.split(",", 1)[1].split("= 1),", 1)[1]


def _events(spark, sf):
    return builds.events_build(dv.raw_news(spark, sf), F.lit(AS_OF).cast("timestamp"), dv.FIXTURE_RULES, dv.FIXTURE_CITIES)


@query("events_build", f"WITH RECURSIVE {EVENTS}, {dv.PANEL}, {EVENT_WINDOWS} SELECT p.city, p.segment_id, p.time_bucket, {pick(' '.join(WIN_EXACT), 'avg_traffic_relevance_score_6h')} FROM panel p JOIN winf w ON w.city = p.city AND w.time_bucket = p.time_bucket")
def events_build(spark, sf):
    """Grouped and collapsed events, then their windows on the traffic grid."""
    _, best = _events(spark, sf)
    grid = pn.bucket_grid(dv.panel(spark, sf))
    return tidy(ft.event_windows(grid, best, 3600).select(*KEYS.split(), *WIN_EXACT, "avg_traffic_relevance_score_6h"))


SCALAR = lambda name, value, source: f"SELECT '{name}' AS metric, ({value})::VARCHAR AS value FROM {source}"
COUNTED = lambda name: f"SELECT '{name}.' || coalesce({name}::VARCHAR, 'missing') AS metric, count(*)::VARCHAR AS value FROM placed GROUP BY {name}"
MISSING = lambda c: f"count(*) FILTER ({c} IS NULL OR lower(trim({c}::VARCHAR)) IN ('', 'none'))"
REPORT = [
    SCALAR("raw_records", "count(*)", "raw_news"), SCALAR("raw_missing_published_at", MISSING("published_at"), "raw_news"), SCALAR("raw_missing_summary", MISSING("summary"), "raw_news"),
    SCALAR("raw_city_hint_null_before_detect", MISSING("city_hint"), "raw_news"), SCALAR("normalized_missing_city_after_detect", "count(*) FILTER (city IS NULL)", "placed"), SCALAR("city_detected_or_retained", "count(city)", "placed"),
    SCALAR("unrelated_records", "count(*) FILTER (event_category = 'unrelated')", "placed"), SCALAR("model_eligible_records_before_dedup", "coalesce(sum(eligible), 0)", "placed"),
    SCALAR("events_after_semantic_dedup", "count(*)", "best"), SCALAR("model_eligible_events_after_dedup", "coalesce(sum(eligible), 0)", "best"),
    SCALAR("events_removed_by_semantic_dedup", "(SELECT count(*) FROM placed) - count(*)", "best"), *map(COUNTED, ("event_category", "city", "severity_score", "event_time_confidence")),
]


@query("event_quality_report", f"WITH RECURSIVE {EVENTS} " + " UNION ALL ".join(REPORT))
def event_quality_report(spark, sf):
    grouped, best = _events(spark, sf)
    # Stored without the texts, which no figure of the report reads.
    facts = cut_lineage(grouped.select("event_category", "city", "severity_score", "event_time_confidence", "is_relevant_for_traffic_model"))
    return nw.event_report(dv.raw_news(spark, sf), facts, cut_lineage(best.select("is_relevant_for_traffic_model")))


@query("silver_matched", f"WITH {dv.PANEL}, {dv.WEATHER}{NEAREST.replace('180 MINUTES', '60 MINUTES')} SELECT {pick(KEYS + ' matched_cell', 'temp')}, year(time_bucket) AS _year, month(time_bucket) AS _month, day(time_bucket) AS _day FROM near")
def silver_matched(spark, sf):
    out = builds.matched_build(dv.panel(spark, sf), dv.weather(spark, sf), ["temp"], 60)
    return tidy(out.select(*KEYS.split(), F.col("weather_cell_id").alias("matched_cell"), "temp", "_year", "_month", "_day"))


@query("training_build", f"""WITH {dv.BASED}, h AS (SELECT a.*, {', '.join(f"(SELECT count(*) FROM based b WHERE b.city = a.city AND b.segment_id = a.segment_id AND b.time_bucket = a.time_bucket - to_hours({k})) AS h{k}" for k in range(1, 4))},
    (SELECT b.currentSpeed FROM based b WHERE b.city = a.city AND b.segment_id = a.segment_id AND b.time_bucket = a.time_bucket + INTERVAL 1 HOUR) AS target_speed FROM based a WHERE city = 'hanoi'),
    k AS (SELECT * FROM h WHERE h1 + h2 + h3 = 3 AND target_speed IS NOT NULL), q AS (SELECT quantile_cont(epoch(time_bucket), 0.7) AS a, quantile_cont(epoch(time_bucket), 0.85) AS b FROM k)
    SELECT segment_id, time_bucket, round(target_speed, 6) + 0.0 AS target_speed, CASE WHEN epoch(time_bucket) <= a THEN 'train' WHEN epoch(time_bucket) <= b THEN 'validation' ELSE 'test' END AS split FROM k, q""")
def training_build(spark, sf):
    wanted = {**ts.lag_spec(60), "future_speed_15m": ("currentSpeed", 60), "future_speed_60m": ("currentSpeed", 120), "future_speed_240m": ("currentSpeed", 240)}
    features = ts.add_past_rolling(ts.exact_offsets(dv.based(spark, sf), wanted))
    return tidy(builds.training_build(features, 15, "hanoi").select("segment_id", "time_bucket", "target_speed", "split"))
