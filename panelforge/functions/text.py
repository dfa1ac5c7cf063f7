"""Text cleaning, folding, tokens and keyword rules, all as JVM-side column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

SPACES = r"(?U)\s+"
TAG = r"<[^>]+>"
SCRIPT_OR_STYLE = r"(?is)<script.*?</script>|<style.*?</style>"
IMAGE = r"""(?i)<img[^>]+src=["']([^"']+)["']"""
MISSING_WORDS = ("", "none", "null", "nan")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body`` (lambdas would recompute it)."""
    return F.get(F.transform(F.array(value), body), 0)


def is_missing(value: Column) -> Column:
    """Null, or text that only says so."""
    return value.isNull() | F.lower(F.trim(value.cast("string"))).isin(*MISSING_WORDS)


def present(value: Column) -> Column:
    """The text, with missing markers as null."""
    return F.when(~is_missing(value), value.cast("string"))


def collapse_spaces(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, SPACES, " "))


def nfc(text: Column) -> Column:
    """Unicode NFC; Spark has no builtin, so the ICU library it ships is called, row by row in the JVM."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(text.isNotNull(), composed)


def decode_entities(value: Column) -> Column:
    """Named (Latin-1, symbols, Greek) and numeric HTML entities; unknown names stay as written."""
    common = ("amp", "quot", "nbsp", "lt", "gt")
    ordered = {name: name2codepoint[name] for name in (*common, *name2codepoint)}
    names = F.create_map(*[F.lit(x) for name, code in ordered.items() for x in (name, chr(code))])
    pieces = F.split(value, r"(?=&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});)")

    def decode(piece: Column) -> Column:
        # Splitting leaves the entity at the start of its piece, closed by the first semicolon.
        body = F.substring_index(F.substring_index(piece, ";", 1), "&", -1)
        rest = F.substring(piece, F.length(body) + 3, F.length(piece))
        digits = F.when(F.lower(F.substring(body, 2, 1)) == "x", F.conv(F.substring(body, 3, 6), 16, 10)).otherwise(
            F.substring(body, 2, 7)
        )
        number = digits.try_cast("long")
        usable = number.between(1, 1114111) & ~number.between(55296, 57343)
        numeric = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        char = F.when(body.startswith("#"), numeric).otherwise(F.try_element_at(names, body))
        starts = piece.startswith("&") & piece.contains(";")
        return F.when(starts, F.coalesce(F.concat(char, rest), piece)).otherwise(piece)

    return F.when(value.contains("&"), F.concat_ws("", F.transform(pieces, decode))).otherwise(value)


def clean_html(value: Column) -> Column:
    """Tags out, entities decoded, tags out again (encoded ones), leftovers out, one space between words."""
    text = decode_entities(F.regexp_replace(value, TAG, " "))
    text = F.regexp_replace(F.regexp_replace(text, TAG, " "), "&[a-zA-Z0-9#]+;", " ")
    return collapse_spaces(text)


def clean_summary(value: Column) -> Column:
    """Summary text without scripts, styles and tags; null when nothing is left."""
    text = decode_entities(present(value))
    text = F.regexp_replace(F.regexp_replace(text, SCRIPT_OR_STYLE, " "), TAG, " ")
    text = collapse_spaces(text)
    return F.when(text != "", text)


def image_url(value: Column) -> Column:
    """Address of the first image in an HTML fragment."""
    found = F.regexp_extract(value, IMAGE, 1)
    return F.when(found != "", decode_entities(found))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Lowercase accented Latin letters and their base letter, from Unicode decomposition."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code).lower()
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn")
        if len(letter) == 1 and len(base) == 1 and base != letter and letter not in source:
            source.append(letter)
            target.append(base)
    return "".join(source), "".join(target)


def fold_accents(value: Column, fold_d: bool = True) -> Column:
    """Lower case without accents; đ becomes d unless ``fold_d`` is off."""
    source, target = _fold_table()
    if fold_d:
        source, target = source + "đ", target + "d"
    return F.regexp_replace(F.translate(F.lower(value), source, target), r"\p{Mn}+", "")


def fold_word(word: str) -> str:
    """The same folding for a word of a rule table, done once at plan time."""
    plain = unicodedata.normalize("NFD", word.lower())
    return "".join(c for c in plain if unicodedata.category(c) != "Mn").replace("đ", "d")


def contains_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | text.contains(word)
    return out


def first_contained(text: Column, words: list[str]) -> Column:
    """First word of the list, in list order, that the text contains."""
    return F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in words], F.lit(None))


def first_label(text: Column, rules: dict[str, list[str]], order: list[str] | None = None) -> Column:
    """First label, in priority order, one of whose words the text contains; null if none."""
    return F.coalesce(
        *[F.when(contains_any(text, rules[name]), F.lit(name)) for name in (order or list(rules))], F.lit(None)
    )


def all_labels(text: Column, rules: dict[str, list[str]]) -> Column:
    """Every label that matches, in table order."""
    return F.array_compact(F.array(*[F.when(contains_any(text, words), F.lit(name)) for name, words in rules.items()]))


def title_tokens(title: Column, stopwords: list[str]) -> Column:
    """Folded alphanumeric tokens of two or more characters that are no stopwords."""
    tokens = F.regexp_extract_all(fold_accents(title, fold_d=False), F.lit("([a-z0-9]+)"), F.lit(1))
    stops = F.array(*[F.lit(w) for w in stopwords])
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~F.array_contains(stops, t))


def comparable_title(title: Column) -> Column:
    return collapse_spaces(F.regexp_replace(fold_accents(title), r"[^a-z0-9\s]", " "))


def words(text: Column) -> Column:
    """Whitespace tokens, empty text → empty array."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def poly_hash(value: Column, base: int = 31, modulus: int = 1_000_003) -> Column:
    """Polynomial hash over code points."""
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0).cast("long"), lambda acc, c: (acc * base + F.ascii(c)) % modulus)


def redact_key(value: Column) -> Column:
    return F.regexp_replace(value, r"([?&]key=)[^&\s)]+", "$1<redacted>")


def event_identity(ts: Column, text: Column) -> Column:
    """``ev_<yyyymmddhh>_<6 hex>``."""
    return F.concat(F.lit("ev_"), F.date_format(ts, "yyyyMMddHH"), F.lit("_"), F.substring(F.sha1(text), 1, 6))


def main_text(html: Column, floor: int = 100) -> Column:
    """Paragraph text of a page without scripts, styles and navigation; null up to ``floor`` characters."""
    body = F.regexp_replace(html, r"(?is)<(script|style|nav|header|footer|aside)\b.*?</\1>|<!--.*?-->", " ")
    blocks = F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</p>|<p\b|</article>|</body>|\z)"), F.lit(1))
    text = clean_html(F.array_join(blocks, " "))
    return F.when(F.length(text) > floor, text)


def links(html: Column) -> Column:
    """array<struct<href,label>> of the anchors of a page, in page order."""
    anchor = r"""(?is)<a\b[^>]*href=["']([^"']+)["'][^>]*>(.*?)</a>"""
    hrefs = F.regexp_extract_all(html, F.lit(anchor), F.lit(1))
    labels = F.regexp_extract_all(html, F.lit(anchor), F.lit(2))
    return F.zip_with(hrefs, labels, lambda h, t: F.struct(h.alias("href"), clean_html(t).alias("label")))


def any_prefix(value: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | value.startswith(prefix)
    return out
