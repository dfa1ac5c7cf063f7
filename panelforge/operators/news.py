"""News records: raw table, event normalization, duplicate marking and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelforge import catalog
from panelforge.functions import numeric as nm, scoring as sc, text as tx, times as tm, urls

# Version columns of the news table.
BRONZE_VERSIONS = {"crawler_name": "news_reader", "crawler_version": "1", "schema_version": "1"}


# ---------------------------------------------------------------- places


def city_by_alias(text: Column, hint: Column, aliases: dict[str, list[str]]) -> Column:
    """struct<city, alias>: the hint is searched before the text, cities and aliases in table order."""
    table = F.array(
        *[
            F.struct(F.lit(city).alias("city"), F.lit(alias).alias("alias"), F.lit(tx.fold_word(alias)).alias("key"))
            for city, words in aliases.items()
            for alias in words
        ]
    )
    search = lambda hay: tx.let(
        tx.fold_accents(hay), lambda folded: F.get(F.filter(table, lambda a: F.contains(folded, a["key"])), 0)
    )
    found = F.coalesce(search(tx.present(hint)), search(text))
    return F.when(found.isNotNull(), F.struct(found["city"].alias("city"), found["alias"].alias("alias")))


#: Characters of the fragment by which a gazetteer name is looked up, and of the stretches in which a text is cut into them.
FRAGMENT, STRETCH = 4, 512
#: Characters of a stretch that are cut at once, as every cut counts from the start; size of the filter of fragments that are looked up.
CUT, FILTER = 32, 1 << 18


def _fragments(text: Column, width: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - width + 1), lambda i: F.substr(text, i, width))


def _fragment_filter(index: DataFrame, fragment: str) -> DataFrame:
    """One row (_known): a flag for every hash value, set where a fragment has it. Of fixed size, however many there are."""
    at = index.select(F.pmod(F.xxhash64(fragment), F.lit(FILTER)).alias("id")).distinct().withColumn("_set", F.lit(True))
    flags = index.sparkSession.range(FILTER).join(at, "id", "left").select(F.struct("id", F.coalesce("_set", F.lit(False)).alias("_set")).alias("_f"))
    return flags.agg(F.array_sort(F.collect_list("_f")).alias("_all")).select(F.col("_all._set").alias("_known"))


def place_names(df: DataFrame, key: str, text: str, gazetteer: DataFrame) -> DataFrame:
    """(key, places): names of the gazetteer that the text contains, whatever their case, longest first.

    ``gazetteer`` is a table (name, rank); of equally long names the smaller rank comes first, of names that differ in
    case only the smallest rank stays. ``key`` is unique. Each name is indexed by its rarest fragment among the names, and the
    distinct fragments of a text meet that index, so a text looks at the few names that may be in it, however long the table is.
    """
    low = F.lower("name")
    names = gazetteer.filter(F.trim("name") != "").groupBy(low.alias("_low")).agg(F.min_by("name", F.struct("rank", "name")).alias("name"), F.min("rank").alias("rank"))
    names = names.withColumn("_w", F.least(F.length("_low"), F.lit(FRAGMENT)))
    fragments = names.select("_low", "name", "rank", F.explode(F.array_distinct(_fragments(F.col("_low"), F.col("_w")))).alias("_f"))
    counts = fragments.groupBy("_f").agg(F.count(F.lit(1)).alias("_c"))
    index = fragments.join(counts, "_f").groupBy("_low", "name", "rank").agg(F.min_by("_f", F.struct("_c", "_f")).alias("_f"))

    texts = df.select(key, F.lower(text).alias("_text"))
    widths = sorted(r["_w"] for r in names.select("_w").distinct().collect())  # at most FRAGMENT numbers
    # Places inside a long text are found from its start, so it is cut into stretches first; they overlap by a fragment.
    stretch = F.transform(F.sequence(F.lit(0), F.floor(F.length("_text") / STRETCH)), lambda i: F.substr(F.col("_text"), (i * STRETCH + 1).cast("int"), F.lit(STRETCH + FRAGMENT - 1)))
    pieces = texts.filter("_text <> ''").select(key, F.explode(stretch).alias("_s"))
    none = F.array().cast("array<string>")

    def fragments_of(w: int) -> Column:
        cuts = F.transform(F.sequence(F.lit(0), F.floor((F.length("_s") - w) / CUT)), lambda i: F.substr(F.col("_s"), (i * CUT + 1).cast("int"), F.lit(CUT + w - 1)))
        return F.when(F.length("_s") >= w, F.flatten(F.transform(cuts, lambda c: F.filter(_fragments(c, F.lit(w)), lambda f: F.get("_known", F.pmod(F.xxhash64(f), F.lit(FILTER)).cast("int")))))).otherwise(none)

    # Nearly all fragments are in no name; the filter drops most of them before they become rows.
    filtered = pieces.crossJoin(_fragment_filter(index, "_f"))
    held = filtered.select(key, F.explode(F.array_distinct(F.concat(*map(fragments_of, widths)) if widths else none)).alias("_f"))
    maybe = held.join(index, "_f").select(key, "_low", "name", "rank").distinct().groupBy(key).agg(F.collect_list(F.struct((-F.length("_low")).alias("n"), "rank", "_low", "name")).alias("_maybe"))
    joined = texts.join(maybe, key, "left")
    inside = F.filter(F.array_sort("_maybe"), lambda p: F.contains(F.col("_text"), p["_low"]))
    return joined.select(key, F.coalesce(F.transform(inside, lambda p: p["name"]), F.array().cast("array<string>")).alias("places"))


def named_city(text: Column, cities: dict[str, list[str]] = catalog.PLACE_CITIES) -> Column:
    return tx.let(F.lower(text), lambda low: tx.first_label(low, cities))


def with_city(places: Column, text: Column, hint: Column, cities: dict[str, list[str]]) -> Column:
    """Places with the city of the text (else the hint) appended where the name lacks one."""
    city = F.coalesce(named_city(text, cities), hint)
    every = [w for words in cities.values() for w in words]
    has_city = lambda p: tx.contains_any(F.lower(p), every)
    return tx.let(
        city, lambda c: F.transform(places, lambda p: F.when(has_city(p) | c.isNull(), p).otherwise(F.concat_ws(", ", p, c)))
    )


def located_places(
    df: DataFrame, key: str, text: str, hint: str, gazetteer: DataFrame, cities: dict[str, list[str]] = catalog.PLACE_CITIES, found: str | None = None
) -> DataFrame:
    """Adds ``places`` (with their city) and ``primary_place`` ('' for none); names of the array column ``found`` go first, once."""
    joined = df.join(place_names(df, key, text, gazetteer).withColumnRenamed("places", "_names"), key)
    names = F.array_distinct(F.concat(F.coalesce(F.col(found), F.array().cast("array<string>")), F.col("_names"))) if found else F.col("_names")
    out = joined.withColumn("places", with_city(names, F.col(text), F.col(hint), cities)).drop("_names")
    return out.withColumn("primary_place", F.coalesce(F.get("places", 0), F.lit("")))


def gazetteer_table(spark: SparkSession, names: list[str] = catalog.GAZETTEER) -> DataFrame:
    """The built-in names as a table, ranked in their order."""
    return spark.createDataFrame(list(zip(names, range(len(names)))), "name string, rank int")


def district_in(text: Column, patterns: list[str] = catalog.DISTRICT_PATTERNS) -> Column:
    lowered = F.lower(text)
    found = [F.regexp_extract(lowered, p, 0) for p in patterns]
    return F.coalesce(*[F.when(f != "", tx.collapse_spaces(f)) for f in found])


def road_in(text: Column, pattern: str = catalog.ROAD_PATTERN) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", tx.collapse_spaces(found))


def geocode(df: DataFrame, gazetteer: DataFrame, place: str, city: str) -> DataFrame:
    """Coordinates by exact lookup of the place (with its city), else of the city; adds status.

    ``gazetteer`` is (key, lat, lon) with lower-case keys; of a key that it holds twice the smallest point counts.
    """
    full = F.when(F.contains(F.lower(F.col(place)), F.lower(F.col(city))) | F.col(city).isNull(), F.col(place)).otherwise(
        F.concat_ws(", ", F.col(place), F.col(city))
    )
    keyed = df.withColumns({"_k1": F.lower(F.trim(full)), "_k2": F.lower(F.trim(F.col(city)))})
    names = gazetteer.groupBy("key").agg(F.min(F.struct("lat", "lon")).alias("_p"))
    joined = keyed.join(names.withColumnsRenamed({"key": "_k1", "_p": "_p1"}), "_k1", "left").join(
        names.withColumnsRenamed({"key": "_k2", "_p": "_p2"}), "_k2", "left"
    )
    point = F.coalesce(F.col("_p1"), F.col("_p2"))
    blank = tx.is_missing(F.col(place))
    status = F.when(blank, F.lit(None)).when(point.isNull(), "failed").otherwise("ok")
    return joined.select(
        *df.columns,
        F.when(~blank, point["lat"]).alias("geo_lat"),
        F.when(~blank, point["lon"]).alias("geo_lon"),
        status.alias("geocode_status"),
    )


# ---------------------------------------------------------------- rules


def event_type(text: Column, rules: dict[str, list[str]] = catalog.EVENT_TYPE_RULES) -> Column:
    return tx.let(F.lower(text), lambda low: F.coalesce(tx.first_label(low, rules), F.lit("other")))


def keyword_severity(text: Column, levels: dict[int, list[str]] = catalog.SEVERITY_WORDS) -> Column:
    level_of = lambda low: [F.when(tx.contains_any(low, words), F.lit(level)) for level, words in levels.items()]
    return tx.let(F.lower(text), lambda low: F.coalesce(*level_of(low), F.lit(0)))


def category_and_subtype(text: Column, rules: dict = catalog.EVENT_RULES) -> Column:
    """struct<category, subtype>: planning about infrastructure wins over everything unless works are active;
    active works come before the other categories."""
    return tx.let(F.lower(text), lambda low: _classify(low, rules))


def _classify(low: Column, rules: dict) -> Column:
    active = tx.first_contained(low, rules["active_roadwork"])
    planning = tx.first_contained(low, rules["planning"])
    pair = lambda category, subtype: F.struct(F.lit(category).alias("category"), subtype.alias("subtype"))
    is_plan = planning.isNotNull() & active.isNull() & tx.contains_any(low, rules["infrastructure"])
    roadworks_ahead = tx.contains_any(low, rules["planned_roadwork"])
    out = F.when(is_plan & roadworks_ahead, pair("roadwork_planned", planning)).when(
        is_plan, pair("infrastructure_planning", planning)
    )
    out = out.when(active.isNotNull(), pair("roadwork_active", active))
    for category, words in rules["categories"].items():
        first = tx.first_contained(low, words)
        out = out.when(first.isNotNull(), pair(category, first))
    return out.otherwise(pair("unrelated", F.lit("unrelated")))


def event_severity(category: Column, text: Column, rules: dict = catalog.EVENT_RULES) -> Column:
    planned = category.isin("infrastructure_planning", "roadwork_planned")

    def score(low: Column) -> Column:
        return (
            F.when(category == "unrelated", 0)
            .when(tx.contains_any(low, rules["fatal"]), 5)
            .when(tx.contains_any(low, rules["severe"]), 4)
            .when(tx.contains_any(low, rules["moderate"]), 3)
            .when(planned & tx.contains_any(low, rules["early_plan"]), 1)
            .otherwise(2)
        )

    return tx.let(F.lower(text), score)


def _by_category(category: Column, table: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(category == name, value).otherwise(out)
    return out


def relevance(category: Column, severity: Column, text: Column, rules: dict = catalog.EVENT_RULES) -> Column:
    base = _by_category(category, catalog.RELEVANCE_BASE, 0.0)
    off_topic = tx.let(F.lower(text), lambda low: tx.contains_any(low, rules["off_topic"]))
    total = base + F.when(severity >= 4, 0.05).otherwise(0.0) - F.when(off_topic, 0.1).otherwise(0.0)
    return nm.clip(total, 0, 1)


def duration_hours(category: Column) -> Column:
    return _by_category(category, catalog.DURATION_HOURS, catalog.DEFAULT_DURATION_HOURS)


def model_relevant(city: Column, category: Column, score: Column) -> Column:
    hit = city.isNotNull() & category.isin(*catalog.ACTIVE_CATEGORIES) & (score >= catalog.MODEL_RELEVANCE)
    return nm.flag(hit)


def keyword_relevant(title: Column, summary: Column, words: list[str] = catalog.TRAFFIC_WORDS) -> Column:
    body = F.lower(F.concat_ws(" ", title, F.coalesce(summary, F.lit(""))))
    return tx.let(body, lambda low: tx.contains_any(low, words))


ARTICLE_LINKS = (r"-\d{5,}\.html?$", r"-\d{5,}\.vov$", r"-\d{9,}\.htm$")


def link_relevant(
    title: Column,
    link: Column,
    words: list[str] = catalog.LINK_WORDS,
    blocked: list[str] = catalog.BLOCKED_TITLES,
    article_patterns: tuple[str, ...] = ARTICLE_LINKS,
    min_title: int = 8,
) -> Column:
    """Listing link that looks like a traffic article."""
    plain = F.trim(F.regexp_replace(F.lower(F.trim(title)), "^#+", ""))
    depth = F.regexp_count(F.regexp_replace(link, "/+$", ""), F.lit("/"))
    article = nm.any_of([link.rlike(p) for p in article_patterns])
    return (
        (F.length(F.trim(title)) >= min_title)
        & ~plain.isin(*blocked)
        & (depth > 2)
        & article
        & tx.contains_any(F.lower(F.concat_ws(" ", title, link)), words)
    )


# ---------------------------------------------------------------- times


def published_time(df: DataFrame) -> DataFrame:
    """UTC publish time by the chain given → URL → ingestion, with source, status and flags."""
    given = tm.parse_utc(tx.present(F.col("published_at")))
    from_url = tm.local_to_utc(urls.path_time(tx.present(F.col("source_url"))))
    ingested = tm.parse_utc(tx.present(F.col("ingestion_time")))
    case = lambda a, b, c, d: F.when(given.isNotNull(), a).when(from_url.isNotNull(), b).when(ingested.isNotNull(), c).otherwise(d)
    names = lambda *flags: F.array(*[F.lit(f) for f in flags]) if flags else F.array().cast("array<string>")
    return df.withColumns(
        {
            "published_at_utc": F.coalesce(given, from_url, ingested),
            "published_at_source": case(
                F.when(F.col("provider") == "rss", "rss").otherwise("html_meta"),
                F.lit("url_timestamp"), F.lit("ingestion_time_fallback"), F.lit(None),
            ),
            "published_at_parse_status": case(
                F.lit("ok"), F.lit("parsed_from_url"), F.lit("fallback_low_confidence"), F.lit("missing")
            ),
            "_time_flags": case(
                names(),
                names("missing_published_at", "published_at_from_url"),
                names("missing_published_at", "published_at_fallback_ingestion_time"),
                names("missing_published_at", "parse_error"),
            ),
        }
    )


def event_time(df: DataFrame, as_of: Column) -> DataFrame:
    """Event start with its source and confidence; ``as_of`` is the last resort and gives year-less dates their year."""
    given = tm.parse_utc(tx.present(F.col("published_at")))
    from_url = tm.local_to_utc(urls.page_name_time(tx.present(F.col("source_url"))))
    ingested = tm.parse_utc(tx.present(F.col("ingestion_time")))
    body = F.concat_ws(" ", F.col("title"), F.col("summary_text"))
    from_text = tm.local_to_utc(tm.text_date(body, F.year(F.coalesce(ingested, as_of))))
    options = [
        (given, "published_at", "high"),
        (from_url, "source_url", "medium"),
        (from_text, "title_or_summary", "medium"),
        (ingested, "ingestion_time", "low"),
        (as_of, "fallback_now", "low"),
    ]
    choice = F.coalesce(
        *[
            F.when(t.isNotNull(), F.struct(t.alias("t"), F.lit(source).alias("source"), F.lit(trust).alias("confidence")))
            for t, source, trust in options
        ]
    )
    return df.withColumn("_when", choice).select(
        *df.columns,
        F.col("_when.t").alias("event_time_start"),
        F.col("_when.source").alias("event_time_source"),
        F.col("_when.confidence").alias("event_time_confidence"),
    )


# ---------------------------------------------------------------- raw table


def news_table(
    raw: DataFrame,
    aliases: dict[str, list[str]] = catalog.NEWS_CITY_ALIASES,
    hints: dict[str, list[str]] = catalog.HINT_RULES,
) -> DataFrame:
    """Audited news table: cleaned text, canonical URL and hashes, publish time, hints and quality flags.

    Needs source, provider, external_id, title, summary, source_url, published_at, city_hint,
    ingestion_time and record_id; content, html, author, tags, language, encoding, http_status and
    raw_payload_json where there are any.
    """
    base = raw.withColumns(
        {
            "title_raw": tx.collapse_spaces(tx.decode_entities(tx.nfc(tx.present(F.col("title"))))),
            "summary_raw": tx.present(F.col("summary")),
        }
    ).withColumns(
        {
            "summary_text": tx.clean_summary(F.col("summary_raw")),
            "image_url": tx.image_url(F.col("summary_raw")),
            "canonical_url": urls.canonical_url(F.col("source_url")),
        }
    )
    lower_or_empty = lambda name: F.lower(F.coalesce(F.col(name), F.lit("")))
    full_text = F.trim(F.concat_ws(" ", F.col("title_raw"), F.col("summary_text")))
    folded_hints = {k: [tx.fold_word(w) for w in words] for k, words in hints.items()}
    base = published_time(base).withColumn("_folded", tx.fold_accents(full_text)).withColumns(
        {
            "url_hash": F.sha2(F.col("canonical_url"), 256),
            "content_hash": F.sha2(F.concat_ws("|", lower_or_empty("title_raw"), lower_or_empty("summary_text")), 256),
            "source_domain": urls.domain(F.col("source_url")),
            "source_section": urls.section(F.col("source")),
            "_place": city_by_alias(full_text, F.col("city_hint"), aliases),
            "_labels": tx.all_labels(F.col("_folded"), folded_hints),
            "ingestion_time_utc": tm.parse_utc(F.col("ingestion_time")),
        }
    )
    partial = (F.col("provider") == "html_listing") & (F.col("summary_raw").isNull() | tx.is_missing(F.col("published_at")))
    # Names of the quality flags.
    flags = {
        "missing_title": F.col("title_raw").isNull(),
        "missing_summary": F.col("summary_raw").isNull(),
        "summary_contains_html": F.col("summary_raw").rlike(tx.TAG),
        "summary_text_empty": F.col("summary_text").isNull(),
        "image_extracted": F.col("image_url").isNotNull(),
        "city_hint_missing": F.col("_place").isNull(),
        "category_hint_missing": F.size("_labels") == 0,
        "possible_unrelated": F.array_contains("_labels", "possible_unrelated"),
        "html_listing_partial": partial,
    }
    optional = lambda name: F.col(name) if name in raw.columns else F.lit(None).cast("string")
    own = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))
    return base.select(
        "record_id",
        tx.present(F.col("external_id")).alias("external_id"),
        tx.present(F.col("source")).alias("source"),
        "source_domain", "source_section",
        tx.present(F.col("provider")).alias("provider"),
        *[F.lit(v).alias(n) for n, v in BRONZE_VERSIONS.items()],
        tx.present(F.col("source_url")).alias("source_url"),
        "canonical_url", "url_hash", "content_hash", "title_raw", "summary_raw", "summary_text",
        optional("content").alias("content_raw_optional"), optional("html").alias("html_raw_optional"), "image_url",
        tx.present(F.col("published_at")).alias("published_at_raw"),
        "published_at_utc",
        F.from_utc_timestamp("published_at_utc", tm.LOCAL_ZONE).alias("published_at_local"),
        "published_at_source", "published_at_parse_status", "ingestion_time_utc",
        F.date_format("ingestion_time_utc", "yyyy-MM-dd").alias("crawl_date"),
        F.when(partial, "partial").otherwise("ok").alias("fetch_status"),
        optional("http_status").alias("http_status"),
        F.coalesce(F.nullif(optional("language"), F.lit("")), F.lit("vi")).alias("language"),
        F.coalesce(F.nullif(optional("encoding"), F.lit("")), F.lit("utf-8")).alias("encoding"),
        F.col("_place.city").alias("city_hint_raw"),
        F.col("_place.alias").alias("location_hint_raw"),
        F.when(F.size("_labels") > 0, F.array_join("_labels", ";")).alias("category_hint_raw"),
        # The reader keeps lists and objects as JSON text.
        optional("author").alias("author_raw"), optional("tags").alias("tags_raw"), optional("raw_payload_json").alias("raw_payload_json"),
        F.array_sort(F.array_distinct(F.concat(own, F.col("_time_flags")))).alias("data_quality_flags"),
    )


def published_order() -> list[Column]:
    """Ingestion time, source, title, nulls last."""
    return [F.asc_nulls_last(c) for c in ("ingestion_time_utc", "source", "title_raw")]


def by_ingestion(news: DataFrame) -> DataFrame:
    """The table in its published order."""
    return news.orderBy(*published_order())


def mark_duplicates(news: DataFrame, order: list[str]) -> DataFrame:
    """Flag rows whose id, URL or content was seen before and name the first record that had it.

    Each key needs only its first record: one aggregation per key and a join back. A key shared by a
    third of the rows is one aggregated row, and AQE splits the skewed side of the join.
    """
    out = news
    for key in ("external_id", "url_hash", "content_hash"):
        first = news.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.min_by("record_id", F.struct(*order, "record_id")).alias(f"_first_{key}")
        )
        # Rows without the key get one of their own, so that they don't meet in one task.
        own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\x00"), F.col("record_id").cast("string")))
        out = out.withColumn("_own", own).join(first.withColumnRenamed(key, "_own"), "_own", "left").drop("_own")
    seen = lambda key: F.when(F.col(f"_first_{key}") != F.col("record_id"), F.col(f"_first_{key}"))
    original = F.coalesce(seen("external_id"), seen("url_hash"), seen("content_hash"))
    flags = F.col("data_quality_flags")
    marked = out.withColumn("duplicate_of_record_id", original).withColumns(
        {
            "is_exact_duplicate": F.col("duplicate_of_record_id").isNotNull(),
            "data_quality_flags": F.when(
                F.col("duplicate_of_record_id").isNotNull(),
                F.array_sort(F.array_distinct(F.array_append(flags, "exact_duplicate"))),
            ).otherwise(flags),
        }
    )
    return marked.select(*news.columns, "is_exact_duplicate", "duplicate_of_record_id")


# ---------------------------------------------------------------- events


def raw_shape(news: DataFrame) -> DataFrame:
    """News table → raw event shape; publish times that were only an ingestion fallback go back to raw."""
    fallback = F.col("published_at_source") == "ingestion_time_fallback"
    published = F.when(F.coalesce(fallback, F.lit(False)), F.col("published_at_raw")).otherwise(
        F.date_format("published_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return news.select(
        "record_id", "source", "provider", F.lit("traffic_news").alias("event_type"), "external_id",
        F.col("title_raw").alias("title"), F.col("summary_raw").alias("summary"), "source_url",
        published.alias("published_at"), F.col("city_hint_raw").alias("city_hint"),
        F.date_format("ingestion_time_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingestion_time"),
    )


# Flag columns of an event and the categories that set them.
FLAG_CATEGORIES = {
    "has_accident": ["accident"],
    "has_congestion": ["congestion"],
    "has_roadwork": ["roadwork_active", "roadwork_planned"],
    "has_flood": ["flood"],
    "has_heavy_rain": ["weather_disruption"],
    "has_public_transport_issue": ["public_transport"],
    "has_airport_issue": ["airport"],
    "has_enforcement": ["enforcement"],
    "has_planned_event": ["planned_event"],
}


def normalize_events(
    raw: DataFrame,
    as_of: Column,
    rules: dict = catalog.EVENT_RULES,
    aliases: dict[str, list[str]] = catalog.EVENT_CITY_ALIASES,
) -> DataFrame:
    """Raw news → one typed event per record: time, place, category, severity, relevance and flags."""
    strip = lambda c: tx.collapse_spaces(
        F.regexp_replace(F.regexp_replace(tx.decode_entities(tx.nfc(c)), tx.SCRIPT_OR_STYLE, " "), tx.TAG, " ")
    )
    blank = F.lit("")
    texts = raw.withColumns(
        {
            "title": strip(F.coalesce("title", blank)),
            "summary_text": strip(F.coalesce("summary", blank)),
            "image_url": tx.image_url(F.col("summary")),
        }
    )
    timed = event_time(texts, as_of).withColumns(
        {
            "full_text": F.trim(F.concat_ws(" ", "title", "summary_text")),
            "published_at_utc": tm.parse_utc(F.col("published_at")),
            "ingestion_time_utc": tm.parse_utc(F.col("ingestion_time")),
        }
    )
    placed = timed.withColumns(
        {
            "_place": city_by_alias(F.col("full_text"), F.col("city_hint"), aliases),
            "district": district_in(F.col("full_text")),
            "road_name": road_in(F.col("full_text")),
            "_class": category_and_subtype(F.col("full_text"), rules),
        }
    ).withColumns({"city": F.col("_place.city"), "event_category": F.col("_class.category"), "event_subtype": F.col("_class.subtype")})
    hinted = tx.present(F.col("city_hint"))
    by_hint = city_by_alias(hinted, F.lit(None).cast("string"), aliases)
    scored = placed.withColumns(
        {
            "location_text": F.coalesce(
                "road_name", "district", F.when(by_hint.isNotNull(), hinted).otherwise(F.col("_place.alias"))
            ),
            "geo_confidence": sc.geo_confidence(F.col("road_name"), F.col("district"), F.col("city")),
            "severity_score": event_severity(F.col("event_category"), F.col("full_text"), rules),
        }
    ).withColumn(
        "traffic_relevance_score",
        relevance(F.col("event_category"), F.col("severity_score"), F.col("full_text"), rules),
    )
    end = F.timestamp_seconds(tm.epoch(F.col("event_time_start")) + duration_hours(F.col("event_category")) * 3600)
    return scored.select(
        "record_id", "external_id", "source", "provider", "source_url", "title", "summary_text", "image_url",
        "published_at_utc",
        F.from_utc_timestamp("published_at_utc", tm.LOCAL_ZONE).alias("published_at_local"),
        "ingestion_time_utc", "event_time_start", end.alias("event_time_end"), "event_time_source",
        "event_time_confidence", "city", "district", "road_name", "location_text",
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
        "geo_confidence", "event_category", "event_subtype", "severity_score", "traffic_relevance_score",
        *[nm.flag(F.col("event_category").isin(*kinds)).alias(n) for n, kinds in FLAG_CATEGORIES.items()],
        model_relevant(F.col("city"), F.col("event_category"), F.col("traffic_relevance_score")).alias(
            "is_relevant_for_traffic_model"
        ),
    )


def collapse_groups(events: DataFrame, group: str = "dedup_group_id", tie: str = "record_id") -> DataFrame:
    """Best row of every group: relevance, then severity, then the smallest id. Only the columns that are used are sorted and kept."""
    best = Window.partitionBy(group).orderBy(-F.col("traffic_relevance_score"), -F.col("severity_score"), tie)
    return events.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def mirror_sources(events: DataFrame, group: str, source: str = "source") -> DataFrame:
    """Distinct sources per original. Distinct pairs are reduced first: the list holds names, not records."""
    pairs = events.select(group, source).distinct()
    return pairs.groupBy(group).agg(F.array_sort(F.collect_set(source)).alias("mirrored_sources"))


# ---------------------------------------------------------------- reports


def value_counts(df: DataFrame, prefix: str, column: Column) -> DataFrame:
    """metric/value rows ``prefix.value`` → count."""
    label = F.coalesce(column.cast("string"), F.lit("missing"))
    counted = df.groupBy(label.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    return counted.select(F.concat(F.lit(prefix + "."), F.col("v")).alias("metric"), F.col("c").cast("string").alias("value"))


def scalars(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """metric/value rows from one global aggregation."""
    row = df.agg(*[c.cast("string").alias(f"m{i}") for i, c in enumerate(metrics.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate(metrics)])
    return row.select(F.inline(pairs))


def top_values(df: DataFrame, prefix: str, column: str, limit: int = 10) -> DataFrame:
    """Most frequent values with their rank in the metric name."""
    counted = df.groupBy(F.coalesce(column, F.lit("missing")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    best = counted.orderBy(F.desc("c"), "v").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("c"), "v"))
    metric = F.concat_ws(".", F.lit(prefix), rank.cast("string"), F.col("v"))
    return best.select(metric.alias("metric"), F.col("c").cast("string").alias("value"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def news_report(news: DataFrame) -> DataFrame:
    """Quality report of the raw news table in long form."""
    rate = lambda c: F.format_string("%.4f", F.avg(F.when(c, 1.0).otherwise(0.0)))
    missing = lambda n: tx.is_missing(F.col(n))
    repeated = lambda n: F.count(n) - F.countDistinct(n)
    coverage = lambda n: rate(~missing(n))
    metrics = {
        "total_records": F.count(F.lit(1)),
        "missing_title_rate": rate(missing("title_raw")),
        "missing_summary_rate": rate(missing("summary_raw")),
        "missing_summary_text_rate": rate(missing("summary_text")),
        "missing_published_at_rate_before_fallback": rate(missing("published_at_raw")),
        "missing_published_at_rate_after_fallback": rate(F.col("published_at_utc").isNull()),
        "city_hint_raw_coverage": coverage("city_hint_raw"),
        "category_hint_raw_coverage": coverage("category_hint_raw"),
        "duplicate_external_id_count": repeated("external_id"),
        "duplicate_canonical_url_count": repeated("canonical_url"),
        "duplicate_content_hash_count": repeated("content_hash"),
        "summary_html_rate": rate(F.array_contains("data_quality_flags", "summary_contains_html")),
        "image_extraction_rate": coverage("image_url"),
        "url_hash_coverage": coverage("url_hash"),
        "content_hash_coverage": coverage("content_hash"),
        "exact_duplicate_records": F.count_if("is_exact_duplicate"),
    }
    share = F.max("c") / F.sum("c")
    by_source = news.groupBy(F.coalesce("source", F.lit("missing")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    leader = F.min_by("v", F.struct((-F.col("c")).alias("n"), F.col("v")))
    note = F.when(
        share >= 0.5, F.format_string("dominant_source=%s;share=%.4f;review_source_mix_before_modeling", leader, share)
    ).otherwise("no_single_source_exceeds_50pct")
    flags = news.select(F.explode("data_quality_flags").alias("f"))
    return _union(
        [
            scalars(news, metrics),
            value_counts(news, "records_by_source", F.col("source")),
            value_counts(news, "records_by_provider", F.col("provider")),
            value_counts(news, "records_by_source_domain", F.col("source_domain")),
            value_counts(flags, "data_quality_flags_distribution", F.col("f")),
            value_counts(news, "published_at_source_distribution", F.col("published_at_source")),
            value_counts(news, "published_at_parse_status_distribution", F.col("published_at_parse_status")),
            top_values(news, "top_sources_by_record_count", "source"),
            by_source.agg(note.alias("value")).select(F.lit("source_imbalance_notes").alias("metric"), "value"),
        ]
    )


def event_report(raw: DataFrame, normalized: DataFrame, deduped: DataFrame) -> DataFrame:
    """Quality report of the event build in long form."""
    count = F.count(F.lit(1))
    before = scalars(
        raw,
        {
            "raw_records": count,
            "raw_missing_published_at": F.count_if(tx.is_missing(F.col("published_at"))),
            "raw_missing_summary": F.count_if(tx.is_missing(F.col("summary"))),
            "raw_city_hint_null_before_detect": F.count_if(tx.is_missing(F.col("city_hint"))),
        },
    )
    middle = scalars(
        normalized,
        {
            "normalized_missing_city_after_detect": F.count_if(F.col("city").isNull()),
            "city_detected_or_retained": F.count("city"),
            "unrelated_records": F.count_if(F.col("event_category") == "unrelated"),
            "model_eligible_records_before_dedup": F.coalesce(F.sum("is_relevant_for_traffic_model"), F.lit(0)),
        },
    )
    after = scalars(
        deduped,
        {
            "events_after_semantic_dedup": count,
            "model_eligible_events_after_dedup": F.coalesce(F.sum("is_relevant_for_traffic_model"), F.lit(0)),
        },
    )
    both = normalized.select(F.lit(1).alias("d")).unionAll(deduped.select(F.lit(-1).alias("d")))
    removed = scalars(both, {"events_removed_by_semantic_dedup": F.coalesce(F.sum("d"), F.lit(0))})
    names = ("event_category", "city", "severity_score", "event_time_confidence")
    return _union([before, middle, after, removed, *[value_counts(normalized, n, F.col(n)) for n in names]])
