"""Duplicate, event-group and density-cluster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import cluster as cl, dedup as dd
from panelforge.operators.event_groups import event_groups
from panelforge.operators import panel as pn, timeseries as ts
from panelforge.session import cut_lineage
from workload import derive as dv
from workload.registry import pick, query, tidy
from workload.text_queries import STOPWORDS, TOKENS, docs, title


@query("url_dedup", """WITH u AS (SELECT doc_id, 'https://n.example.com/a/' || (doc_id % 700) AS link FROM documents) SELECT sha1(link) AS key, min(doc_id) AS original, count(*) AS copies FROM u GROUP BY link""")
def url_dedup(spark, sf):
    link = F.concat(F.lit("https://n.example.com/a/"), (F.col("doc_id") % 700).cast("string"), F.lit("/?utm_source=feed&ref="), F.col("doc_id").cast("string"))
    return dd.first_by_key(docs(spark, sf), dd.url_key(link), "doc_id")


# Greedy election in SQL: walk the ids in order and keep the list of originals. Only records with a
# possible match take part.
GREEDY = """involved AS (SELECT b AS id FROM near UNION SELECT a FROM near),
ordered AS (SELECT id, row_number() OVER (ORDER BY id) AS rn, coalesce((SELECT list(a) FROM near WHERE b = id), []) AS e FROM involved),
walk(rn, leaders, id, original) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT
  UNION ALL SELECT o.rn, CASE WHEN list_has_any(o.e, w.leaders) THEN w.leaders ELSE list_append(w.leaders, o.id) END, o.id, list_min(list_intersect(o.e, w.leaders)) FROM walk w JOIN ordered o ON o.rn = w.rn + 1)"""

TITLES = f"""tok AS (SELECT doc_id, list_sort(list_distinct({TOKENS})) AS t FROM documents), sets AS (SELECT t, min(doc_id) AS rep, list(doc_id) AS ids FROM tok WHERE len(t) > 0 GROUP BY t),
simsets AS (SELECT x.ids AS xi, y.ids AS yi FROM sets x JOIN sets y ON len(x.t) >= 0.8 * len(y.t) AND len(y.t) >= 0.8 * len(x.t)
  WHERE len(list_intersect(x.t, y.t)) >= 0.8 * (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t)))),
titlenear AS (SELECT DISTINCT a, b FROM (SELECT unnest(xi) AS a, yi FROM simsets), LATERAL (SELECT unnest(yi) AS b) WHERE a < b)"""


@query("title_originals", f"WITH RECURSIVE {TITLES}, near AS (SELECT * FROM titlenear), {GREEDY} SELECT t.doc_id, w.original, w.original IS NOT NULL AS is_duplicate FROM tok t LEFT JOIN walk w ON w.id = t.doc_id WHERE len(t.t) > 0")
def title_originals(spark, sf):
    rows = docs(spark, sf).select("doc_id", title().alias("title"))
    return dd.title_originals(rows, "doc_id", "title", stopwords=STOPWORDS)


VOTE = lambda half, b: f"sum(CASE WHEN ({half} >> {b}) & 1 = 1 THEN 1 ELSE -1 END) > 0"
HALF = lambda half: " + ".join(f"CASE WHEN {VOTE(half, b)} THEN {1 << b} ELSE 0 END" for b in range(32))
SIMHASH = f"""words AS (SELECT doc_id, md5(unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> ''))) AS h FROM documents),
halves AS (SELECT doc_id, ('0x' || substr(h, 17, 8))::BIGINT AS hi, ('0x' || substr(h, 25, 8))::BIGINT AS lo FROM words),
sig AS (SELECT doc_id, ({HALF('hi')})::BIGINT AS hi, ({HALF('lo')})::BIGINT AS lo FROM halves GROUP BY doc_id),
contentnear AS (SELECT x.doc_id AS a, y.doc_id AS b FROM sig x JOIN sig y ON x.doc_id < y.doc_id WHERE bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 4)"""


@query("simhash_signatures", f"WITH {SIMHASH} SELECT doc_id, printf('%08X%08X', hi, lo) AS signature FROM sig")
def simhash_signatures(spark, sf):
    out = dd.simhash(docs(spark, sf), "doc_id", "text", window=None)
    return out.select("doc_id", F.lpad(F.hex("simhash"), 16, "0").alias("signature"))


@query("content_originals", f"WITH RECURSIVE {SIMHASH}, near AS (SELECT * FROM contentnear), {GREEDY} SELECT s.doc_id, w.original, w.original IS NOT NULL AS is_duplicate FROM sig s LEFT JOIN walk w ON w.id = s.doc_id")
def content_originals(spark, sf):
    return dd.content_originals(docs(spark, sf), "doc_id", "text", window=None)


LAYERS = f"""{TITLES}, {SIMHASH}, links AS (SELECT doc_id, doc_id % 900 AS u FROM documents),
layered AS (SELECT x.doc_id AS a, y.doc_id AS b, 0 AS layer FROM links x JOIN links y ON x.u = y.u AND x.doc_id < y.doc_id UNION ALL SELECT a, b, 1 FROM titlenear UNION ALL SELECT a, b, 2 FROM contentnear),
near AS (SELECT a, b, min(layer) AS layer FROM layered GROUP BY a, b)"""


@query("layered_originals", f"""WITH RECURSIVE {LAYERS}, {GREEDY}, lead AS (SELECT id FROM walk WHERE id IS NOT NULL AND original IS NULL),
    best AS (SELECT b, min(layer) AS layer, arg_min(a, row(layer, a)) AS a FROM near WHERE a IN (SELECT id FROM lead) AND b NOT IN (SELECT id FROM lead) GROUP BY b)
    SELECT d.doc_id, b.b IS NOT NULL AS is_duplicate, CASE b.layer WHEN 0 THEN 'url' WHEN 1 THEN 'title' WHEN 2 THEN 'content' END AS layer, CASE WHEN b.layer > 0 THEN b.a END AS original FROM documents d LEFT JOIN best b ON b.b = d.doc_id""")
def layered_originals(spark, sf):
    link = F.concat(F.lit("https://n.example.com/a/"), (F.col("doc_id") % 900).cast("string"))
    rows = docs(spark, sf).select("doc_id", link.alias("url"), title().alias("title"), "text")
    return dd.layered_originals(rows, "doc_id", "url", "title", "text", window=None, stopwords=STOPWORDS)


def page_events(spark, sf):
    n = F.col("page_id")
    return dv.table(spark, sf, "pages").select(
        n.alias("record_id"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.when(n % 2 == 0, "hanoi").otherwise("hcmc").alias("city"),
        F.when(n % 5 < 4, "accident").otherwise("flood").alias("event_category"), F.when(n % 3 != 0, "đường Láng").alias("location_text"),
        F.timestamp_seconds(F.lit(1704067200) + n * 1020).alias("event_time_start"),
    )


COMPARABLE = "trim(regexp_replace(regexp_replace(replace(strip_accents(lower(title)), 'đ', 'd'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
GROUPS = f"""ev AS (SELECT page_id AS id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, CASE WHEN page_id % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city, CASE WHEN page_id % 5 < 4 THEN 'accident' ELSE 'flood' END AS cat,
  CASE WHEN page_id % 3 <> 0 THEN 'đường Láng' END AS loc, TIMESTAMP '2024-01-01' + to_seconds(page_id * 1020) AS t FROM pages), norm AS (SELECT *, {COMPARABLE} AS n FROM ev),
near AS (SELECT x.id AS a, y.id AS b FROM norm x JOIN norm y ON x.id < y.id AND x.city = y.city AND x.cat = y.cat AND y.t - x.t <= INTERVAL 24 HOURS
  WHERE 1 - levenshtein(x.n, y.n) / greatest(length(x.n), length(y.n))::DOUBLE >= CASE WHEN x.loc = y.loc THEN 0.68 ELSE 0.82 END - 1e-9)"""


@query("event_groups", f"""WITH RECURSIVE {GROUPS}, {GREEDY}, led AS (SELECT n.id, coalesce(w.original, n.id) AS leader FROM norm n LEFT JOIN walk w ON w.id = n.id)
    SELECT led.id AS record_id, led.leader, sha1(l.city || '|' || l.cat || '|' || l.n || '|' || strftime(l.t, '%Y-%m-%d') || '|' || led.leader) AS dedup_group_id FROM led JOIN norm l ON l.id = led.leader""")
def event_group_ids(spark, sf):
    return event_groups(page_events(spark, sf), "record_id")


EPS = {"a": (2.2, 4), "b": (3.1, 6)}
POINTS = """pts AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 2 = 0 THEN 'a' ELSE 'b' END AS g, c_acctbal / 100 AS x, ((c_custkey * 37) % 1000)::DOUBLE / 10 AS y FROM customer),
near AS (SELECT p.g, p.id AS a, q.id AS b FROM pts p JOIN pts q ON p.g = q.g AND (p.x - q.x) ^ 2 + (p.y - q.y) ^ 2 <= CASE p.g WHEN 'a' THEN 2.2::DOUBLE ^ 2 ELSE 3.1::DOUBLE ^ 2 END),
cores AS (SELECT a AS id, g FROM near GROUP BY a, g HAVING count(*) >= CASE g WHEN 'a' THEN 4 ELSE 6 END),
links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM cores) AND b IN (SELECT id FROM cores)),
reach(src, dst) AS (SELECT id, id FROM cores UNION SELECT r.src, l.b FROM reach r JOIN links l ON l.a = r.dst),
root AS (SELECT dst AS id, min(src) AS cluster FROM reach GROUP BY dst),
border AS (SELECT n.a AS id, min(r.cluster) AS cluster FROM near n JOIN root r ON r.id = n.b WHERE n.a NOT IN (SELECT id FROM cores) GROUP BY n.a)"""


def customer_points(spark, sf):
    c = F.col("c_custkey")
    return dv.table(spark, sf, "customer").select(
        c.alias("id"), F.when(F.col("c_nationkey") % 2 == 0, "a").otherwise("b").alias("g"), (F.col("c_acctbal") / 100).alias("x"), ((c * 37) % 1000 / 10).alias("y")
    )


@query("dbscan_labels", f"WITH RECURSIVE {POINTS} SELECT p.id, p.g, r.id IS NOT NULL AS is_core, coalesce(r.cluster, b.cluster) AS cluster FROM pts p LEFT JOIN root r ON r.id = p.id LEFT JOIN border b ON b.id = p.id")
def dbscan_labels(spark, sf):
    return cl.dbscan(customer_points(spark, sf), "id", "x", "y", "g", EPS)


@query("standardized_coordinates", f"WITH {dv.OBS} SELECT event_id, round((lat - avg(lat) OVER (PARTITION BY city)) / stddev_pop(lat) OVER (PARTITION BY city), 6) + 0.0 AS lat_z, round((lon - avg(lon) OVER (PARTITION BY city)) / stddev_pop(lon) OVER (PARTITION BY city), 6) + 0.0 AS lon_z FROM obs")
def standardized_coordinates(spark, sf):
    return tidy(cl.standardize(dv.observations(spark, sf), ["lat", "lon"], ["city"]).select("event_id", "lat_z", "lon_z"))


@query("cluster_stats", f"""WITH {dv.BASED}, m AS (SELECT *, CASE WHEN hour_of_day < 20 THEN hour_of_day END AS cluster FROM based), s AS (SELECT city, cluster, avg(lat) AS center_lat, avg(lon) AS center_lon, count(*) AS num_segments, avg(currentSpeed) AS avg_speed, min(currentSpeed) AS min_speed,
    max(currentSpeed) AS max_speed, avg(congestion_ratio) AS avg_congestion, avg(jamFactor) AS avg_jam_factor FROM m WHERE cluster IS NOT NULL GROUP BY city, cluster),
    t AS (SELECT s.*, (SELECT max(sqrt((m.lat - s.center_lat) ^ 2 + (m.lon - s.center_lon) ^ 2)) * 111 FROM m WHERE m.city = s.city AND m.cluster = s.cluster) AS radius_km FROM s)
    SELECT {pick('city cluster num_segments', 'center_lat center_lon avg_speed min_speed max_speed avg_congestion avg_jam_factor radius_km')}, CASE WHEN avg_congestion <= 0.3 THEN 'low' WHEN avg_congestion <= 0.6 THEN 'medium' ELSE 'high' END AS severity FROM t""")
def cluster_stats(spark, sf):
    rows = dv.based(spark, sf).withColumn("cluster", F.when(F.col("hour_of_day") < 20, F.col("hour_of_day")))
    return tidy(cl.cluster_stats(rows, "city"))


Z = lambda c: f"(n.{c} - avg(n.{c}) OVER (PARTITION BY n.city)) / CASE WHEN stddev_pop(n.{c}) OVER (PARTITION BY n.city) > 0 THEN stddev_pop(n.{c}) OVER (PARTITION BY n.city) ELSE 1 END"
HOTSPOTS = f"""{dv.BASED.removeprefix('WITH ')}, newest AS (SELECT * FROM based QUALIFY row_number() OVER (PARTITION BY city, segment_id ORDER BY time_bucket DESC) = 1),
pts AS (SELECT n.segment_id AS id, n.city AS g, {Z('lat')} AS x, {Z('lon')} AS y FROM newest n),
near AS (SELECT p.g, p.id AS a, q.id AS b FROM pts p JOIN pts q ON p.g = q.g AND (p.x - q.x) ^ 2 + (p.y - q.y) ^ 2 <= 1.0::DOUBLE), cores AS (SELECT g, a AS id FROM near GROUP BY g, a HAVING count(*) >= 2),
links AS (SELECT n.g, a, b FROM near n JOIN cores c ON c.g = n.g AND c.id = a JOIN cores d ON d.g = n.g AND d.id = b), reach(g, src, dst) AS (SELECT g, id, id FROM cores UNION SELECT r.g, r.src, l.b FROM reach r JOIN links l ON l.g = r.g AND l.a = r.dst),
root AS (SELECT g, dst AS id, min(src) AS cluster FROM reach GROUP BY g, dst), border AS (SELECT n.g, n.a AS id, min(r.cluster) AS cluster FROM near n JOIN root r ON r.g = n.g AND r.id = n.b GROUP BY n.g, n.a),
m AS (SELECT n.*, coalesce(r.cluster, b.cluster) AS cluster FROM newest n LEFT JOIN root r ON r.g = n.city AND r.id = n.segment_id LEFT JOIN border b ON b.g = n.city AND b.id = n.segment_id),
s AS (SELECT city, cluster, avg(lat) AS center_lat, avg(lon) AS center_lon, count(*) AS num_segments, avg(currentSpeed) AS avg_speed, min(currentSpeed) AS min_speed, max(currentSpeed) AS max_speed, avg(congestion_ratio) AS avg_congestion, avg(jamFactor) AS avg_jam_factor FROM m WHERE cluster IS NOT NULL GROUP BY city, cluster),
t AS (SELECT s.*, (SELECT max(sqrt((m.lat - s.center_lat) ^ 2 + (m.lon - s.center_lon) ^ 2)) * 111 FROM m WHERE m.city = s.city AND m.cluster = s.cluster) AS radius_km FROM s)"""


@query("segment_hotspots", f"WITH RECURSIVE {HOTSPOTS} SELECT {pick('city cluster num_segments', 'center_lat center_lon avg_speed min_speed max_speed avg_congestion avg_jam_factor radius_km')}, CASE WHEN avg_congestion <= 0.3 THEN 'low' WHEN avg_congestion <= 0.6 THEN 'medium' ELSE 'high' END AS severity FROM t")
def segment_hotspots(spark, sf):
    """Density clusters of the newest row of each segment in standardized coordinates, with their statistics."""
    latest = ts.add_base_features(pn.latest_by_segment(dv.panel(spark, sf)))
    placed = cut_lineage(cl.standardize(cut_lineage(latest), ["lat", "lon"], ["city"]))
    labels = cl.dbscan(placed, "segment_id", "lat_z", "lon_z", "city", {"hanoi": (1.0, 2), "hcmc": (1.0, 2)})
    return tidy(cl.cluster_stats(placed.join(labels.select("segment_id", "city", "cluster"), ["segment_id", "city"]), "city"))
