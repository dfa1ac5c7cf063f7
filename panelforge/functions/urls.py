"""URL parts, canonical forms and timestamps hidden in paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelforge.functions import text as tx

PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"

# Click identifiers that never tell two articles apart.
CLICK_IDS = ("fbclid", "gclid", "yclid")
FEED_CLICK_IDS = ("fbclid", "gclid")
DEDUP_PREFIXES = ("utm_", "fbclid", "gclid", "ref", "source")


def part(url: Column, index: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query."""
    return F.regexp_extract(F.trim(url), PARTS, index)


def _decode(value: Column) -> Column:
    return F.coalesce(F.try_url_decode(value), value)


def _encode(value: Column) -> Column:
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_items(url: Column) -> Column:
    """Decoded array<struct<k,v>> of the query string, in order."""
    pieces = F.filter(F.split(part(url, 4), "&"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("v"),
        ),
    )


def _assemble(scheme: Column, host: Column, path: Column, items: Column) -> Column:
    query = F.array_join(F.transform(items, lambda i: F.concat(_encode(i["k"]), F.lit("="), _encode(i["v"]))), "&")
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit("://"))).otherwise(""),
        host,
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, single slashes, no tracking, sorted query, no fragment."""
    scheme = F.when(part(url, 1) == "", "https").otherwise(F.lower(part(url, 1)))
    path = F.regexp_replace(F.regexp_replace(part(url, 3), "/{2,}", "/"), "/+$", "")
    kept = F.filter(
        query_items(url), lambda i: ~F.lower(i["k"]).startswith("utm_") & ~F.lower(i["k"]).isin(*CLICK_IDS)
    )
    return F.when(~tx.is_missing(url), _assemble(scheme, F.lower(part(url, 2)), path, F.array_sort(kept)))


def dedup_url(url: Column) -> Column:
    """Form used for duplicate checks: drops tracking, referral and source keys and a trailing slash."""
    kept = F.filter(
        query_items(url), lambda i: (i["v"] != "") & ~tx.any_prefix(i["k"], DEDUP_PREFIXES)
    )
    return F.regexp_replace(_assemble(part(url, 1), part(url, 2), part(url, 3), kept), "/+$", "")


def feed_url(url: Column) -> Column:
    """Feed form: drops tracking keys, keeps the order of the rest."""
    kept = F.filter(
        query_items(url), lambda i: ~F.lower(i["k"]).startswith("utm_") & ~F.lower(i["k"]).isin(*FEED_CLICK_IDS)
    )
    return _assemble(part(url, 1), part(url, 2), F.regexp_replace(part(url, 3), "/+$", ""), kept)


def domain(url: Column) -> Column:
    host = F.regexp_replace(F.lower(part(url, 2)), r"^www\.", "")
    return F.when(~tx.is_missing(url) & (host != ""), host)


# Site section by source name, then by the suffix after the first underscore.
SECTION_BY_SOURCE = {
    "vnexpress_giaothong": "giao_thong",
    "tuoitre_giaothong": "giao_thong",
    "baoxaydung_giaothong": "giaothong",
    "baoxaydung_atgt": "atgt",
    "baoxaydung_gt24h": "gt24h",
    "dantri_thoisux": "thoi_su",
    "thanhnien_thoisux": "thoi_su",
    "vietnamnet_thoisux": "thoi_su",
}
SECTION_BY_SUFFIX = {"thoisux": "thoi_su"}


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def section(source: Column) -> Column:
    name = F.lower(F.trim(source))
    suffix = F.trim(F.regexp_extract(name, "^[^_]*_(.*)$", 1))
    named = F.coalesce(_lookup(name, SECTION_BY_SOURCE), _lookup(suffix, SECTION_BY_SUFFIX))
    return F.when(~tx.is_missing(source), F.coalesce(named, F.when(suffix != "", suffix)))


def resolve(page: Column, href: Column) -> Column:
    """Absolute address of a link found on a page."""
    root = F.concat(part(page, 1), F.lit("://"), part(page, 2))
    folder = F.regexp_replace(part(page, 3), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(part(page, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#") | href.startswith("?"), F.concat(root, part(page, 3), href))
        .otherwise(F.concat(root, folder, href))
    )


def _timestamp(parts: list[Column]) -> Column:
    """Valid local wall time or null."""
    year, month, day, hour, minute, second = parts
    stamp = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", year, month, day, hour, minute, second)
    return stamp.try_cast("timestamp_ntz")


def _digits(run: Column, spans: list[tuple[int, int]]) -> list[Column]:
    return [F.substring(run, start, width).cast("int") for start, width in spans]


FULL_SPANS = [(1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2)]
SHORT_SPANS = [(1, 2), (3, 2), (5, 2), (7, 2), (9, 2), (11, 2)]


def path_time(url: Column) -> Column:
    """Local time in the URL path: first valid 14-digit run, else first valid 12-digit window (20yy, 2020–2039)."""
    path = part(url, 3)
    full = F.transform(
        F.regexp_extract_all(path, F.lit(r"(20\d{12})"), F.lit(1)), lambda run: _timestamp(_digits(run, FULL_SPANS))
    )
    windows = F.flatten(
        F.transform(
            F.regexp_extract_all(path, F.lit(r"(\d{12,})"), F.lit(1)),
            lambda run: F.transform(F.sequence(F.lit(1), F.length(run) - 11), lambda i: F.substring(run, i, F.lit(12))),
        )
    )

    def short(run: Column) -> Column:
        year, *rest = _digits(run, SHORT_SPANS)
        return F.when(year.between(20, 39), _timestamp([year + 2000, *rest]))

    first = lambda stamps: F.get(F.filter(stamps, lambda t: t.isNotNull()), 0)
    return F.coalesce(first(full), first(F.transform(windows, short)))


def page_name_time(url: Column) -> Column:
    """Local time before ``.htm`` by the two site patterns: 192yymmddhhmmss… and yyyymmddhhmmss…."""
    short = F.regexp_extract(url, r"192(\d{12})\d*\.htm", 1)
    full = F.regexp_extract(url, r"(\d{14})\d*\.htm", 1)
    year, *rest = _digits(short, SHORT_SPANS)
    return F.when(short != "", _timestamp([year + 2000, *rest])).when(full != "", _timestamp(_digits(full, FULL_SPANS)))
