"""Text, URL, time-in-text, rule and news-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions import scoring as sc, text as tx, times as tm, urls
from panelforge.operators import cluster as cl, news as nw, ordering, panel as pn
from panelforge.plans import builds
from panelforge.session import cut_lineage
from panelforge.sources import readers as rd
from workload import derive as dv
from workload.registry import query, tidy


def pages(spark, sf):
    return dv.table(spark, sf, "pages")


def docs(spark, sf):
    return dv.table(spark, sf, "documents")


def decode(x: str) -> str:
    """Entities of the fixture, ampersand last so that nothing is decoded twice."""
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


CLEAN = lambda x: squeeze("regexp_replace(" + strip_tags(decode(strip_tags(x))) + ", '&[a-zA-Z0-9#]+;', ' ', 'g')")
SUMMARY = lambda x: squeeze(strip_tags(f"regexp_replace({decode(x)}, '<script.*?</script>|<style.*?</style>', ' ', 'gis')"))


@query("html_to_text", f"SELECT page_id, {CLEAN('html')} AS body FROM pages")
def html_to_text(spark, sf):
    return pages(spark, sf).select("page_id", tx.clean_html(F.col("html")).alias("body"))


@query("summary_text", f"WITH {dv.RAW_NEWS} SELECT record_id, nullif({SUMMARY('summary')}, '') AS summary_text FROM raw_news")
def summary_text(spark, sf):
    return dv.raw_news(spark, sf).select("record_id", tx.clean_summary(F.col("summary")).alias("summary_text"))


@query("image_url", f"WITH {dv.RAW_NEWS} SELECT record_id, nullif(regexp_extract(summary, '<img[^>]+src=\"([^\"]+)\"', 1), '') AS image_url FROM raw_news")
def image_url(spark, sf):
    return dv.raw_news(spark, sf).select("record_id", tx.image_url(F.col("summary")).alias("image_url"))


@query("unicode_nfc", "SELECT doc_id, nfc_normalize(text) = text AS was_nfc, md5(nfc_normalize(text)) AS digest FROM documents")
def unicode_nfc(spark, sf):
    normal = tx.nfc(F.col("text"))
    return docs(spark, sf).select("doc_id", (normal == F.col("text")).alias("was_nfc"), F.md5(normal).alias("digest"))


@query("accent_fold", "SELECT doc_id, replace(strip_accents(lower(text)), 'đ', 'd') AS folded FROM documents")
def accent_fold(spark, sf):
    return docs(spark, sf).select("doc_id", tx.fold_accents(F.col("text")).alias("folded"))


@query("missing_text", "SELECT conv_id, turn, (CASE turn % 4 WHEN 0 THEN 'None ' WHEN 1 THEN NULL ELSE text END IS NULL OR turn % 4 = 0 OR lower(trim(text)) IN ('', 'none', 'null', 'nan')) AS is_missing FROM conversations")
def missing_text(spark, sf):
    value = F.when(F.col("turn") % 4 == 0, "None ").when(F.col("turn") % 4 == 1, None).otherwise(F.col("text"))
    return dv.table(spark, sf, "conversations").select("conv_id", "turn", tx.is_missing(value).alias("is_missing"))


URL_RE = r"'^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?'"
PART = lambda i: f"regexp_extract(url, {URL_RE}, {i})"
KEPT = lambda cond: f"list_filter(string_split({PART(4)}, '&'), lambda p: p <> '' AND {cond})"
JOINED = lambda l: f"CASE WHEN len({l}) > 0 THEN '?' || array_to_string({l}, '&') ELSE '' END"


@query("url_canonical", f"SELECT page_id, lower({PART(1)}) || '://' || lower({PART(2)}) || regexp_replace(regexp_replace({PART(3)}, '/{{2,}}', '/', 'g'), '/+$', '') || {JOINED('list_sort(' + KEPT('NOT starts_with(lower(p), ' + chr(39) + 'utm_' + chr(39) + ')') + ')')} AS canonical FROM pages")
def url_canonical(spark, sf):
    return pages(spark, sf).select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query("url_dedup_form", f"""SELECT page_id, regexp_replace({PART(1)} || '://' || {PART(2)} || {PART(3)} || {JOINED(KEPT("NOT regexp_matches(p, '^(utm_|fbclid|gclid|ref|source)')"))}, '/+$', '') AS dedup_form,
    {PART(1)} || '://' || {PART(2)} || regexp_replace({PART(3)}, '/+$', '') || {JOINED(KEPT("NOT starts_with(lower(p), 'utm_')"))} AS feed_form FROM pages""")
def url_dedup_form(spark, sf):
    return pages(spark, sf).select("page_id", urls.dedup_url(F.col("url")).alias("dedup_form"), urls.feed_url(F.col("url")).alias("feed_form"))


@query("url_domain", f"""WITH {dv.RAW_NEWS}, u AS (SELECT record_id, source, source_url AS url FROM raw_news) SELECT record_id, regexp_replace(lower({PART(2)}), '^www\\.', '') AS domain,
    CASE source WHEN 'tuoitre_giaothong' THEN 'giao_thong' WHEN 'site_thoisux' THEN 'thoi_su' END AS section FROM u""")
def url_domain(spark, sf):
    return dv.raw_news(spark, sf).select("record_id", urls.domain(F.col("source_url")).alias("domain"), urls.section(F.col("source")).alias("section"))


@query("hash_ids", """SELECT doc_id, sha1(text) AS text_sha1, sha256(lang || '|' || text) AS text_sha256, 'ev_' || strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y%m%d%H') || '_' || substr(sha1(text), 1, 6) AS event_id FROM documents""")
def hash_ids(spark, sf):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    return docs(spark, sf).select(
        "doc_id", F.sha1("text").alias("text_sha1"), F.sha2(F.concat_ws("|", "lang", "text"), 256).alias("text_sha256"), tx.event_identity(at, F.col("text")).alias("event_id")
    )


STOPS = "['the', 'of', 'and', 'de', 'la', 'der']"
TOKENS = f"list_filter(regexp_extract_all(strip_accents(lower(string_split(text, chr(10))[1])), '([a-z0-9]+)', 1), lambda t: length(t) > 1 AND NOT list_contains({STOPS}, t))"
STOPWORDS = ["the", "of", "and", "de", "la", "der"]


def title(text: str = "text"):
    """First line of a document."""
    return F.get(F.split(F.col(text), "\n"), 0)


@query("title_tokens", f"SELECT doc_id, array_to_string({TOKENS}, ' ') AS tokens, trim(regexp_replace(regexp_replace(replace(strip_accents(lower(string_split(text, chr(10))[1])), 'đ', 'd'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS comparable FROM documents")
def title_tokens(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(tx.title_tokens(title(), STOPWORDS), " ").alias("tokens"), tx.comparable_title(title()).alias("comparable"))


@query("word_tokens", "SELECT conv_id, turn, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS n_words, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')[1] AS first_word FROM conversations")
def word_tokens(spark, sf):
    w = tx.words(F.col("text"))
    return dv.table(spark, sf, "conversations").select("conv_id", "turn", F.size(w).cast("long").alias("n_words"), F.get(w, 0).alias("first_word"))


@query("poly_hash", "SELECT page_id, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(url, ''), lambda c: ord(c)::BIGINT)), lambda a, c: (a * 31 + c) % 1000003) AS road_hash FROM pages")
def poly_hash(spark, sf):
    return pages(spark, sf).select("page_id", tx.poly_hash(F.col("url")).alias("road_hash"))


@query("redact_key", "SELECT page_id, 'failed: ' || url || '?key=<redacted> after 3 tries' AS message FROM pages")
def redact_key(spark, sf):
    text = F.concat(F.lit("failed: "), "url", F.lit("?key=abc"), F.col("page_id").cast("string"), F.lit(" after 3 tries"))
    return pages(spark, sf).select("page_id", tx.redact_key(text).alias("message"))


@query("canonical_payload", """SELECT o_orderkey, '{"custkey":"' || o_custkey || '","priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}' AS payload FROM orders""")
def canonical_payload(spark, sf):
    flat = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in (("status", "o_orderstatus"), ("custkey", "o_custkey"), ("priority", "o_orderpriority"))])
    return dv.table(spark, sf, "orders").select("o_orderkey", F.to_json(F.map_from_entries(F.array_sort(flat))).alias("payload"))


BODY = "regexp_replace(html, '<script.*?</script>|<style.*?</style>|<nav.*?</nav>|<header.*?</header>|<footer.*?</footer>|<aside.*?</aside>|<!--.*?-->', ' ', 'gis')"
# RE2 has no look-ahead: paragraph openings are marked and the text cut at them.
PARAS = f"""array_to_string(list_transform(string_split(regexp_replace({BODY}, '<p[ ]*[^>]*>', chr(1), 'gi'), chr(1))[2:], lambda s: regexp_replace(s, '(</p>|</article>|</body>).*$', '', 'is')), ' ')"""


@query("main_text", f"WITH t AS (SELECT page_id, {CLEAN(PARAS)} AS x FROM pages) SELECT page_id, CASE WHEN length(x) > 100 THEN x END AS main_text FROM t")
def main_text(spark, sf):
    return pages(spark, sf).select("page_id", tx.main_text(F.col("html")).alias("main_text"))


@query("link_extract", f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]+)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]+)"[^>]*>(.*?)</a>', 2)) AS label FROM pages)
    SELECT page_id, {PART(1)} || '://' || {PART(2)} || href AS link, label FROM a""")
def link_extract(spark, sf):
    found = pages(spark, sf).select("page_id", "url", F.explode(tx.links(F.col("html"))).alias("a"))
    return found.select("page_id", urls.resolve(F.col("url"), F.col("a.href")).alias("link"), F.col("a.label").alias("label"))


@query("url_timestamp", f"""WITH {dv.RAW_NEWS} SELECT record_id, CASE WHEN record_id % 10 = 1 THEN TIMESTAMP '2024-01-05 00:15:30' + to_hours(record_id % 24) - INTERVAL 7 HOURS END AS from_path,
    CASE WHEN record_id % 10 = 1 THEN TIMESTAMP '2024-01-05 00:15:30' + to_hours(record_id % 24) - INTERVAL 7 HOURS END AS from_page FROM raw_news""")
def url_timestamp(spark, sf):
    u = F.col("source_url")
    return dv.raw_news(spark, sf).select("record_id", tm.local_to_utc(urls.path_time(u)).alias("from_path"), tm.local_to_utc(urls.page_name_time(u)).alias("from_page"))


@query("url_timestamp_sliding", """SELECT o_orderkey, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 500000) AS from_path FROM orders""")
def url_timestamp_sliding(spark, sf):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey") % 500000 * 60)
    # A digit that cannot start a valid stamp, a 12-digit stamp, then trailing digits.
    link = F.concat(F.lit("https://news.example.com/a-9"), F.date_format(at, "yyMMddHHmmss"), F.lit("777.vov"))
    return dv.table(spark, sf, "orders").select("o_orderkey", urls.path_time(link).alias("from_path"))


@query("text_date", """WITH s AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Ngày ' || strftime(o_orderdate, '%-d/%-m/%Y') || ' xe' WHEN 1 THEN 'sáng ' || strftime(o_orderdate, '%d-%m') || ' tắc' ELSE 'không rõ' END AS t, o_orderdate FROM orders)
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN year(o_orderdate) >= 2000 THEN date_trunc('day', o_orderdate) ELSE CASE WHEN month(o_orderdate) <= 12 THEN make_timestamp(2024, month(o_orderdate), day(o_orderdate), 0, 0, 0.0) END END
      WHEN 1 THEN make_timestamp(2024, month(o_orderdate), day(o_orderdate), 0, 0, 0.0) END AS found FROM s""")
def text_date(spark, sf):
    n = F.col("o_orderkey")
    t = F.when(n % 3 == 0, F.concat(F.lit("Ngày "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit(" xe"))).when(
        n % 3 == 1, F.concat(F.lit("sáng "), F.date_format("o_orderdate", "dd-MM"), F.lit(" tắc"))
    ).otherwise("không rõ")
    return dv.table(spark, sf, "orders").select("o_orderkey", tm.text_date(t, F.lit(2024)).alias("found"))


PUBLISH = """pub AS (SELECT *, CASE WHEN record_id % 10 = 1 THEN TIMESTAMP '2024-01-05 00:15:30' + to_hours(record_id % 24) - INTERVAL 7 HOURS END AS from_url FROM raw_news),
timed AS (SELECT *, coalesce(published_at, from_url, ingestion_time) AS published_at_utc,
  CASE WHEN published_at IS NOT NULL THEN CASE WHEN provider = 'rss' THEN 'rss' ELSE 'html_meta' END WHEN from_url IS NOT NULL THEN 'url_timestamp' WHEN ingestion_time IS NOT NULL THEN 'ingestion_time_fallback' END AS published_at_source,
  CASE WHEN published_at IS NOT NULL THEN 'ok' WHEN from_url IS NOT NULL THEN 'parsed_from_url' WHEN ingestion_time IS NOT NULL THEN 'fallback_low_confidence' ELSE 'missing' END AS published_at_parse_status FROM pub)"""


@query("publish_time_chain", f"WITH {dv.RAW_NEWS}, {PUBLISH} SELECT record_id, published_at_utc, published_at_source, published_at_parse_status FROM timed")
def publish_time_chain(spark, sf):
    return nw.published_time(dv.raw_news(spark, sf)).select("record_id", "published_at_utc", "published_at_source", "published_at_parse_status")


@query("event_time_choice", f"""WITH {dv.RAW_NEWS}, {PUBLISH} SELECT record_id, coalesce(published_at, from_url, ingestion_time, TIMESTAMP '2024-03-01') AS event_time_start,
    CASE WHEN published_at IS NOT NULL THEN 'published_at' WHEN from_url IS NOT NULL THEN 'source_url' WHEN ingestion_time IS NOT NULL THEN 'ingestion_time' ELSE 'fallback_now' END AS event_time_source,
    CASE WHEN published_at IS NOT NULL THEN 'high' WHEN from_url IS NOT NULL THEN 'medium' ELSE 'low' END AS event_time_confidence FROM timed""")
def event_time_choice(spark, sf):
    raw = dv.raw_news(spark, sf).withColumn("summary_text", F.lit(""))
    return nw.event_time(raw, F.lit("2024-03-01").cast("timestamp")).select("record_id", "event_time_start", "event_time_source", "event_time_confidence")


# ---------------------------------------------------------------- rules

TYPE_RULES = {"accident": ["sterou", "etrela"], "flood": ["hewh", "oicheau"], "event": ["arese", "ungein"], "road_work": ["ndsh", "eauvi"], "weather": ["thand"]}
LEVELS = {3: ["sterou", "hewh"], 2: ["inth", "oiche"], 1: ["ndsh", "ment"]}


def like_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def first_hit(x: str, words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({x}, '{w}') THEN '{w}'" for w in words) + " END"


@query("classify_priority", "SELECT doc_id, CASE " + " ".join(f"WHEN {like_any('lower(text)', w)} THEN '{k}'" for k, w in TYPE_RULES.items()) + " ELSE 'other' END AS event_type FROM documents")
def classify_priority(spark, sf):
    return docs(spark, sf).select("doc_id", nw.event_type(F.col("text"), TYPE_RULES).alias("event_type"))


@query("severity_levels", "SELECT doc_id, CASE " + " ".join(f"WHEN {like_any('lower(text)', w)} THEN {k}" for k, w in LEVELS.items()) + " ELSE 0 END AS severity FROM documents")
def severity_levels(spark, sf):
    return docs(spark, sf).select("doc_id", nw.keyword_severity(F.col("text"), LEVELS).alias("severity"))


R = dv.FIXTURE_RULES
SUBTYPED = f"""low AS (SELECT doc_id, lower(text) AS t FROM documents), hit AS (SELECT *, {first_hit('t', R['active_roadwork'])} AS active, {first_hit('t', R['planning'])} AS plan FROM low),
classed AS (SELECT *, CASE WHEN plan IS NOT NULL AND active IS NULL AND {like_any('t', R['infrastructure'])} THEN CASE WHEN {like_any('t', R['planned_roadwork'])} THEN 'roadwork_planned' ELSE 'infrastructure_planning' END
  WHEN active IS NOT NULL THEN 'roadwork_active' {' '.join(f"WHEN {like_any('t', w)} THEN '{k}'" for k, w in R['categories'].items())} ELSE 'unrelated' END AS category,
  CASE WHEN plan IS NOT NULL AND active IS NULL AND {like_any('t', R['infrastructure'])} THEN plan WHEN active IS NOT NULL THEN active
  {' '.join(f"WHEN {like_any('t', w)} THEN {first_hit('t', w)}" for k, w in R['categories'].items())} ELSE 'unrelated' END AS subtype FROM hit),
scored AS (SELECT *, CASE WHEN category = 'unrelated' THEN 0 WHEN {like_any('t', R['fatal'])} THEN 5 WHEN {like_any('t', R['severe'])} THEN 4 WHEN {like_any('t', R['moderate'])} THEN 3
  WHEN category IN ('infrastructure_planning', 'roadwork_planned') AND {like_any('t', R['early_plan'])} THEN 1 ELSE 2 END AS severity FROM classed),
rel AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE category WHEN 'accident' THEN 0.95::DOUBLE WHEN 'congestion' THEN 0.95::DOUBLE WHEN 'flood' THEN 0.9::DOUBLE WHEN 'weather_disruption' THEN 0.85::DOUBLE
  WHEN 'roadwork_active' THEN 0.85::DOUBLE WHEN 'airport' THEN 0.65::DOUBLE WHEN 'public_transport' THEN 0.6::DOUBLE WHEN 'enforcement' THEN 0.55::DOUBLE WHEN 'planned_event' THEN 0.55::DOUBLE WHEN 'roadwork_planned' THEN 0.35::DOUBLE
  WHEN 'infrastructure_planning' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN severity >= 4 THEN 0.05::DOUBLE ELSE 0 END - CASE WHEN {like_any('t', R['off_topic'])} THEN 0.1::DOUBLE ELSE 0 END)) AS relevance,
  CASE WHEN category IN ('roadwork_active', 'roadwork_planned', 'infrastructure_planning') THEN 24 WHEN category IN ('flood', 'weather_disruption', 'planned_event') THEN 6 ELSE 3 END AS duration_hours FROM scored)"""


@query("classify_subtype", f"WITH {SUBTYPED} SELECT doc_id, category, subtype, severity FROM rel")
def classify_subtype(spark, sf):
    c = nw.category_and_subtype(F.col("text"), R)
    out = docs(spark, sf).select("doc_id", "text", c.alias("c")).select("doc_id", "text", "c.*")
    return out.select("doc_id", "category", "subtype", nw.event_severity(F.col("category"), F.col("text"), R).alias("severity"))


@query("relevance_score", f"WITH {SUBTYPED} SELECT doc_id, round(relevance, 6) + 0.0 AS relevance, duration_hours, (category IN ('accident', 'congestion', 'flood', 'weather_disruption', 'roadwork_active', 'airport', 'public_transport', 'enforcement', 'planned_event') AND relevance >= 0.55::DOUBLE)::INTEGER AS eligible FROM rel")
def relevance_score(spark, sf):
    rows = classify_subtype(spark, sf).join(docs(spark, sf).select("doc_id", "text"), "doc_id")
    rows = rows.withColumn("relevance", nw.relevance(F.col("category"), F.col("severity"), F.col("text"), R))
    return tidy(rows.select("doc_id", "relevance", nw.duration_hours(F.col("category")).alias("duration_hours"), nw.model_relevant(F.lit("x"), F.col("category"), F.col("relevance")).alias("eligible")))


FOLDED = "replace(strip_accents(lower(text)), 'đ', 'd')"


@query("multi_label", "SELECT doc_id, nullif(concat_ws(';', " + ", ".join(f"CASE WHEN {like_any(FOLDED, [tx.fold_word(x) for x in w])} THEN '{k}' END" for k, w in dv.FIXTURE_HINTS.items()) + "), '') AS labels FROM documents")
def multi_label(spark, sf):
    folded = {k: [tx.fold_word(w) for w in words] for k, words in dv.FIXTURE_HINTS.items()}
    labels = tx.let(tx.fold_accents(F.col("text")), lambda low: tx.all_labels(low, folded))
    return docs(spark, sf).select("doc_id", F.when(F.size(labels) > 0, F.array_join(labels, ";")).alias("labels"))


ALIAS = [(c, a, tx.fold_word(a)) for c, words in dv.FIXTURE_CITIES.items() for a in words]
CITY_CASE = lambda hay, what: "CASE " + " ".join(f"WHEN contains({hay}, '{k}') THEN '{(c, a)[what]}'" for c, a, k in ALIAS) + " END"
FOLD = lambda x: f"replace(strip_accents(lower({x})), 'đ', 'd')"


@query("city_alias", f"""WITH h AS (SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN 'Thành phố HÀ NỘI' WHEN doc_id % 7 = 1 THEN 'none' END AS hint FROM documents), g AS (SELECT doc_id, {FOLD('text')} AS t, CASE WHEN hint <> 'none' THEN {FOLD('hint')} END AS h FROM h)
    SELECT doc_id, coalesce({CITY_CASE('h', 0)}, {CITY_CASE('t', 0)}) AS city, coalesce({CITY_CASE('h', 1)}, {CITY_CASE('t', 1)}) AS alias FROM g""")
def city_alias(spark, sf):
    hint = F.when(F.col("doc_id") % 7 == 0, "Thành phố HÀ NỘI").when(F.col("doc_id") % 7 == 1, "none")
    found = nw.city_by_alias(F.col("text"), hint, dv.FIXTURE_CITIES)
    return docs(spark, sf).select("doc_id", found.alias("f")).select("doc_id", "f.city", "f.alias")


PLACES = ["Thered", "Sterouan", "Eauonna", "Ndwhst", "Inat", "Lichge"]
PLACE_CITIES = {"Hanoi": ["thened", "oiche"], "Saigon": ["hewh", "gasich"]}
BY_LENGTH = sorted(PLACES, key=len, reverse=True)
CITY_OF = "CASE " + " ".join(f"WHEN {like_any('lower(text)', w)} THEN '{k}'" for k, w in PLACE_CITIES.items()) + " ELSE CASE WHEN doc_id % 2 = 0 THEN 'Hue' END END"


@query("gazetteer_match", f"""WITH p AS (SELECT doc_id, {CITY_OF} AS city, list_filter([{', '.join(f"CASE WHEN contains(lower(text), '{n.lower()}') THEN '{n}' END" for n in BY_LENGTH)}], lambda x: x IS NOT NULL) AS names FROM documents)
    SELECT doc_id, array_to_string(list_transform(names, lambda n: CASE WHEN city IS NULL THEN n ELSE n || ', ' || city END), '; ') AS places, coalesce(CASE WHEN city IS NULL THEN names[1] ELSE names[1] || ', ' || city END, '') AS primary_place FROM p""")
def gazetteer_match(spark, sf):
    rows = docs(spark, sf).select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "Hue").alias("hint"))
    out = nw.located_places(rows, "doc_id", "text", "hint", nw.gazetteer_table(spark, PLACES), PLACE_CITIES)
    return out.select("doc_id", F.array_join("places", "; ").alias("places"), "primary_place")


@query("district_and_road", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'quận ' || (user_id % 12) END AS district, CASE event_id % 3 WHEN 1 THEN 'đường Láng ' || user_id END AS road FROM events")
def district_and_road(spark, sf):
    n, u = F.col("event_id"), F.col("user_id").cast("string")
    text = F.when(n % 3 == 0, F.concat(F.lit("Ùn tắc ở Quận "), (F.col("user_id") % 12).cast("string"), F.lit(". Xe dừng"))).when(
        n % 3 == 1, F.concat(F.lit("tai nạn trên đường Láng "), u)
    ).otherwise("không có tin")
    return dv.table(spark, sf, "events").select("event_id", nw.district_in(text).alias("district"), nw.road_in(text).alias("road"))


@query("geocode_lookup", """WITH g AS (SELECT lower(n_name) AS key, (n_nationkey * 1.5)::DOUBLE AS lat, (n_nationkey * 2.5)::DOUBLE AS lon FROM nation WHERE n_nationkey % 3 <> 0 UNION ALL SELECT 'hanoi', 21, 105.8),
    q AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN ' ' ELSE n_name END AS place, CASE WHEN s_suppkey % 4 = 0 THEN 'Hanoi' WHEN s_suppkey % 4 = 1 THEN 'Nowhere' END AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    k AS (SELECT *, CASE WHEN city IS NULL THEN lower(trim(place)) ELSE lower(trim(place || ', ' || city)) END AS k1, lower(city) AS k2 FROM q)
    SELECT s_suppkey, CASE WHEN trim(place) <> '' THEN coalesce(a.lat, b.lat) END AS geo_lat, CASE WHEN trim(place) <> '' THEN coalesce(a.lon, b.lon) END AS geo_lon,
    CASE WHEN trim(place) <> '' THEN CASE WHEN coalesce(a.lat, b.lat) IS NULL THEN 'failed' ELSE 'ok' END END AS geocode_status FROM k LEFT JOIN g a ON a.key = k1 LEFT JOIN g b ON b.key = k2""")
def geocode_lookup(spark, sf):
    n = dv.table(spark, sf, "nation")
    k = F.col("n_nationkey")
    gazetteer = n.filter(k % 3 != 0).select(F.lower("n_name").alias("key"), (k * 1.5).alias("lat"), (k * 2.5).alias("lon")).unionAll(
        spark.sql("SELECT 'hanoi', 21.0D, 105.8D")
    )
    s = F.col("s_suppkey")
    rows = dv.table(spark, sf, "supplier").join(n, F.col("s_nationkey") == k).select(
        "s_suppkey", F.when(s % 10 == 0, " ").otherwise(F.col("n_name")).alias("place"), F.when(s % 4 == 0, "Hanoi").when(s % 4 == 1, "Nowhere").alias("city")
    )
    return nw.geocode(rows, gazetteer, "place", "city").select("s_suppkey", "geo_lat", "geo_lon", "geocode_status")


@query("event_confidence", """WITH s AS (SELECT event_id, event_id % 4 <> 0 AS snapped, CASE WHEN event_id % 5 <> 0 THEN value END AS d, (event_id % 4)::INTEGER AS n, (['Ngã tư Sở', 'Đường Láng', 'Ba Đình'])[event_id % 3 + 1] AS place FROM events)
    SELECT event_id, round(CASE WHEN NOT snapped THEN 0.3 WHEN d IS NULL THEN 0.5 ELSE least(1.0::DOUBLE, CASE WHEN d < 50 THEN 1.0::DOUBLE WHEN d < 200 THEN 0.7::DOUBLE ELSE 0.4::DOUBLE END * (1 + 0.1::DOUBLE * n)) END, 6) + 0.0 AS confidence,
    round(least(1.0::DOUBLE, CASE WHEN d IS NULL THEN 0.3::DOUBLE WHEN d < 50 THEN 1.0::DOUBLE WHEN d < 200 THEN 0.7::DOUBLE ELSE 0.4::DOUBLE END + CASE event_id % 3 WHEN 0 THEN 0.15::DOUBLE WHEN 1 THEN 0.05::DOUBLE ELSE 0 END + least(n * 0.05::DOUBLE, 0.15::DOUBLE)), 3) + 0.0 AS geocode_confidence,
    CASE event_id % 4 WHEN 0 THEN 0.75::DOUBLE WHEN 1 THEN 0.55::DOUBLE WHEN 2 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS geo_confidence FROM s""")
def event_confidence(spark, sf):
    e = F.col("event_id")
    rows = dv.table(spark, sf, "events").select(
        "event_id", (e % 4 != 0).alias("snapped"), F.when(e % 5 != 0, F.col("value")).alias("d"), (e % 4).cast("int").alias("n"),
        F.element_at(F.array(F.lit("Ngã tư Sở"), F.lit("Đường Láng"), F.lit("Ba Đình")), (e % 3 + 1).cast("int")).alias("place"),
    )
    some = lambda k: F.when(e % 4 == k, "x")
    return tidy(rows.select(
        "event_id", sc.event_confidence(F.col("snapped"), F.col("d"), F.col("n")).alias("confidence"), sc.geocode_confidence(F.col("place"), F.col("d"), F.col("n")).alias("geocode_confidence"),
        sc.geo_confidence(some(0), some(1), some(2)).alias("geo_confidence"),
    ))


@query("keyword_filter", "SELECT doc_id, lang FROM documents WHERE " + like_any("lower(lang || ' ' || text)", ["sterou", "gasich", "thened"]))
def keyword_filter(spark, sf):
    return docs(spark, sf).filter(nw.keyword_relevant(F.col("lang"), F.col("text"), ["sterou", "gasich", "thened"])).select("doc_id", "lang")


@query("link_relevance", f"""SELECT page_id FROM pages WHERE length(trim(regexp_extract(html, '<title>(.*?)</title>', 1))) >= 8 AND lower(trim(regexp_extract(html, '<title>(.*?)</title>', 1))) NOT IN ('giao thông')
    AND length(regexp_replace(url, '/+$', '')) - length(replace(regexp_replace(url, '/+$', ''), '/', '')) > 2 AND regexp_matches(url, '/\\d{{3,}}(\\.html)?$') AND contains(lower(regexp_extract(html, '<title>(.*?)</title>', 1) || ' ' || url), 'th')""")
def link_relevance(spark, sf):
    t = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    keep = nw.link_relevant(t, F.col("url"), words=["th"], blocked=["giao thông"], article_patterns=(r"/\d{3,}(\.html)?$",))
    return pages(spark, sf).filter(keep).select("page_id")


# ---------------------------------------------------------------- news table and reports

HINT_SQL = "concat_ws(';', " + ", ".join(f"CASE WHEN {like_any('folded', [tx.fold_word(x) for x in w])} THEN '{k}' END" for k, w in dv.FIXTURE_HINTS.items()) + ")"
NEWS = f"""{dv.RAW_NEWS}, {PUBLISH}, cleaned AS (SELECT *, {squeeze(decode('title'))} AS title_raw, nullif({SUMMARY('summary')}, '') AS summary_text, source_url AS url FROM timed),
texts AS (SELECT *, {FOLD("trim(concat_ws(' ', title_raw, summary_text))")} AS folded, lower({PART(1)}) || '://' || lower({PART(2)}) || regexp_replace(regexp_replace({PART(3)}, '/{{2,}}', '/', 'g'), '/+$', '')
    || {JOINED("list_sort(" + KEPT("NOT starts_with(lower(p), 'utm_')") + ")")} AS canonical_url FROM cleaned),
hinted AS (SELECT *, sha256(canonical_url) AS url_hash, sha256(lower(title_raw) || '|' || lower(coalesce(summary_text, ''))) AS content_hash, coalesce({CITY_CASE(FOLD("CASE WHEN city_hint <> 'none' THEN city_hint END"), 0)}, {CITY_CASE('folded', 0)}) AS city_hint_raw,
    nullif({HINT_SQL}, '') AS category_hint_raw FROM texts),
flagged AS (SELECT *, list_sort(list_filter([CASE WHEN summary IS NULL THEN 'missing_summary' END, CASE WHEN regexp_matches(summary, '<[^>]+>') THEN 'summary_contains_html' END, CASE WHEN summary_text IS NULL THEN 'summary_text_empty' END,
    CASE WHEN contains(summary, '<img') THEN 'image_extracted' END, CASE WHEN city_hint_raw IS NULL THEN 'city_hint_missing' END, CASE WHEN category_hint_raw IS NULL THEN 'category_hint_missing' END,
    CASE WHEN contains(category_hint_raw, 'possible_unrelated') THEN 'possible_unrelated' END, CASE WHEN provider = 'html_listing' AND (summary IS NULL OR published_at IS NULL) THEN 'html_listing_partial' END,
    CASE WHEN published_at IS NULL THEN 'missing_published_at' END, CASE WHEN published_at_source = 'url_timestamp' THEN 'published_at_from_url' END,
    CASE WHEN published_at_source = 'ingestion_time_fallback' THEN 'published_at_fallback_ingestion_time' END, CASE WHEN published_at_source IS NULL THEN 'parse_error' END], lambda f: f IS NOT NULL)) AS flags FROM hinted),
firsts AS (SELECT *, min(record_id) OVER (PARTITION BY external_id) AS f1, min(record_id) OVER (PARTITION BY url_hash) AS f2, min(record_id) OVER (PARTITION BY content_hash) AS f3 FROM flagged),
news AS (SELECT *, coalesce(CASE WHEN f1 <> record_id THEN f1 END, CASE WHEN f2 <> record_id THEN f2 END, CASE WHEN f3 <> record_id THEN f3 END) AS duplicate_of_record_id FROM firsts)"""


def news(spark, sf):
    return builds.news_build(dv.raw_news(spark, sf), [], dv.FIXTURE_CITIES, dv.FIXTURE_HINTS)


ALL_FLAGS = "list_sort(CASE WHEN duplicate_of_record_id IS NOT NULL THEN list_append(flags, 'exact_duplicate') ELSE flags END)"
BRONZE = {
    "external_id": "external_id", "source": "source", "source_domain": f"regexp_replace(lower({PART(2)}), '^www\\.', '')",
    "source_section": "CASE source WHEN 'tuoitre_giaothong' THEN 'giao_thong' WHEN 'site_thoisux' THEN 'thoi_su' END", "provider": "provider", **{n: f"'{v}'" for n, v in nw.BRONZE_VERSIONS.items()},
    "source_url": "source_url", "canonical_url": "canonical_url", "url_hash": "url_hash", "content_hash": "content_hash", "title_raw": "title_raw", "summary_raw": "summary", "summary_text": "summary_text",
    "content_raw_optional": "NULL", "html_raw_optional": "NULL", "image_url": "nullif(regexp_extract(summary, '<img[^>]+src=\"([^\"]+)\"', 1), '')",
    "published_at_raw": "strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')", "published_at_utc": "published_at_utc", "published_at_local": "published_at_utc + INTERVAL 7 HOURS",
    "published_at_source": "published_at_source", "published_at_parse_status": "published_at_parse_status", "ingestion_time_utc": "ingestion_time", "crawl_date": "strftime(ingestion_time, '%Y-%m-%d')",
    "fetch_status": "CASE WHEN list_contains(flags, 'html_listing_partial') THEN 'partial' ELSE 'ok' END", "http_status": "NULL", "language": "CASE WHEN record_id % 3 = 0 THEN 'en' ELSE 'vi' END", "encoding": "'utf-8'",
    "city_hint_raw": "city_hint_raw", "location_hint_raw": f"coalesce({CITY_CASE(FOLD("CASE WHEN city_hint <> 'none' THEN city_hint END"), 1)}, {CITY_CASE('folded', 1)})", "category_hint_raw": "category_hint_raw",
    "author_raw": "'author ' || (record_id % 9)", "tags_raw": "'[\"t' || (record_id % 5) || '\",\"news\"]'", "raw_payload_json": "NULL", "data_quality_flags": f"array_to_string({ALL_FLAGS}, ';')",
    "is_exact_duplicate": "duplicate_of_record_id IS NOT NULL", "duplicate_of_record_id": "duplicate_of_record_id",
}


@query("news_build", f"WITH {NEWS} SELECT record_id, {', '.join(f'{e} AS {n}' for n, e in BRONZE.items())} FROM news")
def news_build(spark, sf):
    """All columns of the table; the records carry an author, tags and a language."""
    n = F.col("record_id")
    raw = dv.raw_news(spark, sf).withColumns({
        "author": F.concat(F.lit("author "), (n % 9).cast("string")), "tags": F.concat(F.lit('["t'), (n % 5).cast("string"), F.lit('","news"]')), "language": F.when(n % 3 == 0, "en").otherwise(""),
    })
    out = builds.news_build(raw, [], dv.FIXTURE_CITIES, dv.FIXTURE_HINTS)
    times = [c for c in ("published_at_utc", "published_at_local", "ingestion_time_utc")]
    return out.withColumns({**{c: F.col(c).cast("timestamp_ntz") for c in times}, "data_quality_flags": F.array_join("data_quality_flags", ";")})


@query("news_published_order", f"WITH {NEWS} SELECT record_id, row_number() OVER (ORDER BY ingestion_time NULLS LAST, source NULLS LAST, title_raw NULLS LAST, record_id) AS place FROM news")
def news_published_order(spark, sf):
    """Places in the published order, from range partitions instead of one sorted task."""
    placed = ordering.numbered(news(spark, sf), *nw.published_order(), "record_id")
    return placed.select("record_id", (F.col("position") + 1).alias("place"))


@query("flag_arrays", f"WITH {NEWS} SELECT record_id, array_to_string(list_sort(CASE WHEN duplicate_of_record_id IS NOT NULL THEN list_append(flags, 'exact_duplicate') ELSE flags END), ';') AS flags, list_contains(flags, 'parse_error') AS unparsed FROM news")
def flag_arrays(spark, sf):
    return news(spark, sf).select("record_id", F.array_join("data_quality_flags", ";").alias("flags"), F.array_contains("data_quality_flags", "parse_error").alias("unparsed"))


@query("first_seen_duplicates", f"WITH {NEWS} SELECT record_id, duplicate_of_record_id IS NOT NULL AS is_exact_duplicate, duplicate_of_record_id FROM news")
def first_seen_duplicates(spark, sf):
    return news(spark, sf).select("record_id", "is_exact_duplicate", "duplicate_of_record_id")


RATE = lambda c: f"printf('%.4f', avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END))"
METRIC = lambda n, e: f"SELECT '{n}' AS metric, ({e})::VARCHAR AS value FROM news"
COUNTS = lambda p, c, t="news": f"SELECT '{p}.' || coalesce({c}, 'missing'), count(*)::VARCHAR FROM {t} GROUP BY {c}"


@query("news_quality_report", f"""WITH {NEWS}, dom AS (SELECT *, regexp_replace(lower({PART(2)}), '^www\\.', '') AS source_domain FROM news),
    fl AS (SELECT unnest(CASE WHEN duplicate_of_record_id IS NOT NULL THEN list_append(flags, 'exact_duplicate') ELSE flags END) AS f FROM news), src AS (SELECT source, count(*) AS c FROM news GROUP BY source)
    {METRIC('total_records', 'count(*)')} UNION ALL {METRIC('missing_title_rate', RATE("trim(title_raw) = ''"))} UNION ALL {METRIC('missing_summary_rate', RATE('summary IS NULL'))} UNION ALL {METRIC('missing_summary_text_rate', RATE('summary_text IS NULL'))}
    UNION ALL {METRIC('missing_published_at_rate_before_fallback', RATE('published_at IS NULL'))} UNION ALL {METRIC('missing_published_at_rate_after_fallback', RATE('published_at_utc IS NULL'))}
    UNION ALL {METRIC('city_hint_raw_coverage', RATE('city_hint_raw IS NOT NULL'))} UNION ALL {METRIC('category_hint_raw_coverage', RATE('category_hint_raw IS NOT NULL'))}
    UNION ALL {METRIC('duplicate_external_id_count', 'count(external_id) - count(DISTINCT external_id)')} UNION ALL {METRIC('duplicate_canonical_url_count', 'count(canonical_url) - count(DISTINCT canonical_url)')}
    UNION ALL {METRIC('duplicate_content_hash_count', 'count(content_hash) - count(DISTINCT content_hash)')} UNION ALL {METRIC('summary_html_rate', RATE("list_contains(flags, 'summary_contains_html')"))}
    UNION ALL {METRIC('image_extraction_rate', RATE("list_contains(flags, 'image_extracted')"))} UNION ALL {METRIC('url_hash_coverage', RATE('url_hash IS NOT NULL'))} UNION ALL {METRIC('content_hash_coverage', RATE('content_hash IS NOT NULL'))}
    UNION ALL {METRIC('exact_duplicate_records', 'count(duplicate_of_record_id)')} UNION ALL {COUNTS('records_by_source', 'source')} UNION ALL {COUNTS('records_by_provider', 'provider')} UNION ALL {COUNTS('records_by_source_domain', 'source_domain', 'dom')}
    UNION ALL {COUNTS('data_quality_flags_distribution', 'f', 'fl')} UNION ALL {COUNTS('published_at_source_distribution', 'published_at_source')} UNION ALL {COUNTS('published_at_parse_status_distribution', 'published_at_parse_status')}
    UNION ALL SELECT 'top_sources_by_record_count.' || row_number() OVER (ORDER BY c DESC, source) || '.' || source, c::VARCHAR FROM src
    UNION ALL SELECT 'source_imbalance_notes', CASE WHEN max(c) / sum(c) >= 0.5 THEN 'dominant_source=' || arg_max(source, c) || ';share=' || printf('%.4f', max(c) / sum(c)) || ';review_source_mix_before_modeling' ELSE 'no_single_source_exceeds_50pct' END FROM src""")
def news_quality_report(spark, sf):
    return nw.news_report(cut_lineage(news(spark, sf)))


@query("top_sources", "SELECT 'top.' || row_number() OVER (ORDER BY c DESC, source) || '.' || source AS metric, c::VARCHAR AS value FROM (SELECT source, count(*) AS c FROM documents GROUP BY source ORDER BY c DESC, source LIMIT 10)")
def top_sources(spark, sf):
    return nw.top_values(docs(spark, sf), "top", "source")


@query("mirror_sources", "SELECT md5(text) AS content, array_to_string(list_sort(list(DISTINCT source)), ';') AS mirrored_sources FROM documents GROUP BY md5(text)")
def mirror_sources(spark, sf):
    rows = docs(spark, sf).select(F.md5("text").alias("content"), "source")
    return nw.mirror_sources(rows, "content").select("content", F.array_join("mirrored_sources", ";").alias("mirrored_sources"))


@query("collapse_groups", """SELECT record_id, city, severity, round(traffic_relevance_score, 6) + 0.0 AS relevance FROM (SELECT event_id AS record_id, 'g' || (event_id % 300) AS g, CASE WHEN event_id % 2 = 0 THEN 'hanoi' ELSE 'hcmc' END AS city, (event_id % 6)::INTEGER AS severity,
    (event_id % 10)::DOUBLE / 10 AS traffic_relevance_score FROM events) QUALIFY row_number() OVER (PARTITION BY g ORDER BY traffic_relevance_score DESC, severity DESC, record_id) = 1""")
def collapse_groups(spark, sf):
    rows = dv.road_events(spark, sf).withColumns({"g": F.concat(F.lit("g"), (F.col("record_id") % 300).cast("string")), "severity_score": F.col("severity")})
    return tidy(nw.collapse_groups(rows, "g").select("record_id", "city", "severity", F.col("traffic_relevance_score").alias("relevance")))


@query("nearest_segment", f"""WITH {dv.PANEL}, seg AS (SELECT DISTINCT segment_id, lat, lon FROM latest), p AS (SELECT event_id, lat + 0.0013::DOUBLE AS lat, lon - 0.0007::DOUBLE AS lon FROM obs),
    d AS (SELECT event_id, segment_id, 2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, sin(radians(s.lat - p.lat) / 2) ^ 2 + cos(radians(p.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - p.lon) / 2) ^ 2))) * 1000 AS m FROM p JOIN seg s ON abs(s.lat - p.lat) < 0.01 AND abs(s.lon - p.lon) < 0.01),
    b AS (SELECT * FROM d WHERE m <= 500 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY m, segment_id) = 1)
    SELECT p.event_id, b.segment_id AS snapped_segment_id, round(b.m, 3) + 0.0 AS snap_distance_m FROM p LEFT JOIN b ON b.event_id = p.event_id""")
def nearest_segment(spark, sf):
    segments = pn.latest_by_segment(dv.panel(spark, sf)).select("segment_id", "lat", "lon")
    points = dv.observations(spark, sf).select("event_id", (F.col("lat") + 0.0013).alias("lat"), (F.col("lon") - 0.0007).alias("lon"))
    return tidy(cl.nearest_segment(points, segments, "event_id"), 3)


@query("payload_flatten", """SELECT o_orderkey, o_totalprice / 10 AS "currentSpeed", (o_orderkey % 7 + 50)::DOUBLE AS "freeFlowSpeed", 10 + (o_orderkey % 90)::DOUBLE / 10 AS lat, 106.5::DOUBLE AS lon, o_orderstatus = 'F' AS "roadClosure" FROM orders""")
def payload_flatten(spark, sf):
    k = F.col("o_orderkey")
    vertex = lambda lat, lon: F.struct(lat.alias("latitude"), lon.alias("longitude"))
    flow = F.struct(
        (F.col("o_totalprice") / 10).alias("currentSpeed"), (k % 7 + 50).alias("freeFlowSpeed"), (F.col("o_orderstatus") == "F").alias("roadClosure"),
        F.struct(F.array(vertex(F.lit(1.0), F.lit(2.0)), vertex(10 + k % 90 / 10, F.lit(106.5))).alias("coordinate")).alias("coordinates"),
    )
    rows = dv.table(spark, sf, "orders").select("o_orderkey", F.to_json(F.struct(flow.alias("flowSegmentData"))).alias("raw"), F.lit(0.0).alias("la"), F.lit(0.0).alias("lo"))
    return rd.flatten_flow(rows, "raw", "la", "lo", ["o_orderkey"]).select("o_orderkey", "currentSpeed", "freeFlowSpeed", "lat", "lon", "roadClosure")


@query("payload_weather", """SELECT event_id, date_trunc('second', ts) AS event_time, value AS temp, CASE WHEN event_id % 2 = 0 THEN value / 10 ELSE 0 END AS rain_1h, event_type AS weather_main FROM events""")
def payload_weather(spark, sf):
    body = F.struct(
        tm.epoch(F.col("ts")).alias("dt"), F.struct(F.col("value").alias("temp"), F.lit(50).alias("humidity")).alias("main"), F.struct(F.lit(2.5).alias("speed")).alias("wind"),
        F.when(F.col("event_id") % 2 == 0, F.struct((F.col("value") / 10).alias("1h"))).alias("rain"), F.array(F.struct(F.lit(800).alias("id"), F.col("event_type").alias("main"))).alias("weather"),
    )
    rows = dv.table(spark, sf, "events").select("event_id", F.to_json(body).alias("raw"))
    out = rd.flatten_weather(rows, "raw", ["event_id"])
    return out.select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "temp", "rain_1h", "weather_main")
