"""URL rules with redirect equivalence, in DataFrame operations only.

A rule names a host and a path prefix and holds for the host and its subdomains; the longest rule that fits decides.
URLs that redirects or canonical links tie together are aliases: a block reaches aliases that no rule decides, unless
an explicit allow lies among them.
"""

from __future__ import annotations

import json
import string
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelforge.functions.text import let
from panelforge.llm.common import components, stored

# Tags of a page that name another URL of the same content. The patterns mean the same to Java and RE2.
LINK_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
LINK_TARGET = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
REFRESH_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; path: from there to ``?`` or ``#``. Else both empty."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, rule_host, rule_path, action) of (action, ``host/path``) pairs."""
    rows = [(r, r.split("/", 1)[0].lower(), "/" + r.split("/", 1)[1], action) for action, r in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, action string")


def decided(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, action) of distinct ``urls`` that a rule fits: the longest; among equally long ones an allow.

    Hosts meet rules by their suffixes, once per distinct host; paths are compared afterwards, so rules may be as many as they like.
    """
    host, path = host_and_path(F.col("url"))
    parsed = urls.select("url", host.alias("host"), path.alias("path")).filter("host <> ''")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    hosts = parsed.select("host").distinct().select("host", F.explode(suffixes).alias("rule_host"))
    fitting = hosts.join(rules, "rule_host").select("host", "rule", "rule_path", "action")
    found = parsed.join(fitting, "host").filter(F.startswith("path", "rule_path"))
    best = F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), F.col("action") == "allow", F.hash("rule")))
    return found.groupBy("url").agg(best.alias("_b")).select("url", "_b.rule", "_b.action")


def decoded(text: Column) -> Column:
    """Character references of an attribute's value as HTML reads them: by number, by name, and by the old names that need no semicolon."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def piece(p: Column) -> Column:
        return let(F.regexp_extract(p, r"^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", 0), lambda found: sign_and_rest(p, found))

    def sign_and_rest(p: Column, found: Column) -> Column:
        digits = F.regexp_extract(found, r"^#[xX]?([0-9a-fA-F]+)", 1)
        code = F.when(F.rlike(found, F.lit("^#[xX]")), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        rest = F.substring(p, F.length(found) + 1, F.length(p))
        named = F.when(F.endswith(found, F.lit(";")) | ~F.startswith(rest, F.lit("=")), F.try_element_at(names, found))
        sign = F.when(F.startswith(found, F.lit("#")), numbered).otherwise(named)
        return F.coalesce(F.concat(sign, rest), F.concat(F.lit("&"), p))

    return let(F.split(text, "&"), lambda pieces: F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), piece), "")))


def without_dots(url: Column) -> Column:
    """``.`` and ``..`` segments of the path worked out; a path without any stays as it is."""
    origin = F.regexp_extract(url, r"^[^/?#]*://[^/?#]*", 0)
    rest = F.substring(url, F.length(origin) + 1, F.length(url))
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    tail = F.substring(rest, F.length(path) + 1, F.length(rest))
    segments = F.split(F.substring(path, 2, F.length(path)), "/")
    step = lambda kept, s: F.when(s == ".", kept).when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(s)))
    left = F.aggregate(segments, F.array().cast("array<string>"), step)
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(F.rlike(path, F.lit(r"/\.\.?(/|$)")), F.concat(origin, F.lit("/"), F.array_join(F.concat(left, closing), "/"), tail)).otherwise(url)


def resolved(base: Column, t: Column) -> Column:
    """The URL that a target names on the page ``base``, dot segments as they stand; null if its scheme has no ``://``."""
    origin = F.regexp_extract(base, r"^[^/?#]*://[^/?#]*", 0)
    path = F.regexp_extract(F.substring(base, F.length(origin) + 1, F.length(base)), r"^[^?#]*", 0)
    folder = F.concat(origin, F.coalesce(F.nullif(F.regexp_extract(path, r"^.*/", 0), F.lit("")), F.lit("/")))
    own_scheme = F.rlike(t, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:"))
    whole = (
        F.when(own_scheme, F.when(F.rlike(t, F.lit(r"^[^/?#]*://")), t))
        .when(F.startswith(t, F.lit("//")), F.concat(F.substring_index(base, "://", 1), F.lit(":"), t))
        .when(F.startswith(t, F.lit("/")), F.concat(origin, t))
        .when(F.startswith(t, F.lit("?")), F.concat(origin, path, t))
        .when(F.startswith(t, F.lit("#")), F.concat(without_fragment(base), t))
        .when(t != "", F.concat(folder, t))
    )
    return whole


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b) from canonical links and refresh redirects, their targets decoded and resolved against the page's URL."""
    tags = lambda tag, target: F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, target, 1))
    targets = F.explode(F.concat(tags(LINK_TAG, LINK_TARGET), tags(REFRESH_TAG, REFRESH_TARGET)))
    rows = pages.filter(F.col(url).contains("://")).select(F.col(url).alias("a"), targets.alias("t"))
    # Each step is bound by let: merged projections would repeat its whole expression wherever the next one names it.
    whole = let(decoded(F.col("t")), lambda t: let(resolved(F.col("a"), t), without_dots))
    return rows.select("a", whole.alias("b")).filter("b is not null").distinct()


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of every row.

    A rule's verdict stands. Otherwise aliases decide: allow if a rule allows one of them, block if a rule blocks one,
    else ``default``. ``links`` are (a, b) pairs of URLs, from the pages' own tags if unset; fragments do not tell URLs
    apart. Null URLs and those without ``://`` have empty host and path and get ``default``. Rows repeat as given.
    Everything is worked out once per distinct URL, so a URL that many rows share is one row until the last join, which can be split.
    """
    links = page_links(pages, url) if links is None else links
    ends = stored(links.select(without_fragment(F.col("a")).alias("a"), without_fragment(F.col("b")).alias("b")).filter("a <> b").distinct(), "url-links")
    own = pages.select(F.col(url).alias("url")).filter("url is not null").distinct()
    linked = ends.select(F.col("a").alias("url")).unionByName(ends.select(F.col("b").alias("url")))
    of_rule = stored(decided(own.unionByName(linked).distinct(), rules), "url-rules")
    roots = components(ends)
    said = roots.join(of_rule.select(without_fragment(F.col("url")).alias("node"), "action").distinct(), "node")
    spread = said.groupBy("root").agg(F.min("action").alias("alias_action"))  # "allow" sorts before "block"
    aliases = roots.join(spread, "root").select(F.col("node").alias("_plain"), "alias_action")
    judged = (
        own.join(of_rule, "url", "left").withColumn("_plain", without_fragment(F.col("url"))).join(aliases, "_plain", "left")
        .select("url", "rule", F.coalesce("action", "alias_action").alias("_verdict"))
        .filter("_verdict is not null")
    )
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(F.col(key), F.col(url).alias("_url"))
    out = rows.join(judged, rows["_url"] == judged["url"], "left")
    return out.select(key, host.alias("host"), path.alias("path"), "rule", F.coalesce("_verdict", F.lit(default)).alias("verdict"))
