"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelforge.llm import (
    embed_dedup, fill_middle, hash_tree, mixing_lm, packing, quality_rules, quality_sampling, simhash, token_files, toxicity, url_rules, whitening, word_bpe,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> Column:
    """crc32 of the document id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2, capacity=4096)
    return packing.pack(pieces, capacity=4096).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op3_quality_rules"] = f"""
WITH w AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), chars AS (
  SELECT id, pos, length(ws[pos])::BIGINT AS n FROM (SELECT id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w)
), totals AS (SELECT id, sum(n)::BIGINT AS word_chars FROM chars GROUP BY id
), limits(n, most) AS (VALUES {", ".join(f"({n}, {share}::DOUBLE)" for n, share in quality_rules.DUPLICATE_SHARE.items())}
), grams AS (
  SELECT id, n, pos, row_number() OVER same AS nth, count(*) OVER (PARTITION BY id, n, gram) AS times
  FROM (SELECT id, n, pos, array_to_string(ws[pos : pos + n - 1], ' ') AS gram FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM w, limits))
  WINDOW same AS (PARTITION BY id, n, gram ORDER BY pos)
), repeats AS (
  SELECT id, count(DISTINCT place) AS n_repeat_words FROM (SELECT id, unnest(range(pos, pos + 8)) AS place FROM grams WHERE n = 8 AND times > 1) GROUP BY id
), covered AS (
  SELECT DISTINCT id, n, unnest(range(pos, pos + n)) AS place FROM grams WHERE nth > 1
), over_n AS (
  SELECT DISTINCT v.id FROM (SELECT c.id, c.n, sum(k.n) AS covered FROM covered c JOIN chars k ON k.id = c.id AND k.pos = c.place GROUP BY c.id, c.n) v
  JOIN limits USING (n) JOIN totals t ON t.id = v.id WHERE v.covered / t.word_chars > most
), lines AS (
  SELECT id, line, row_number() OVER (PARTITION BY id, line) AS nth, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS n
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), dup_lines AS (SELECT id, count(*) AS n_dup_lines, sum(n) AS n FROM lines WHERE nth > 1 GROUP BY id
), measured AS (
  SELECT w.id, doc_id, len(ws)::BIGINT AS n_words, coalesce(word_chars, 0) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(d.n, 0) AS dup_chars, o.id IS NOT NULL AS over_n
  FROM w LEFT JOIN totals t USING (id) LEFT JOIN repeats r USING (id) LEFT JOIN dup_lines d USING (id) LEFT JOIN over_n o USING (id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT over_n AND NOT (dup_chars / word_chars > {quality_rules.DUPLICATE_LINE_SHARE}::DOUBLE)
    AND NOT (n_symbols > {quality_rules.SYMBOLS_PER_WORD}::DOUBLE * n_words) AS kept
FROM measured
"""


@query
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), radius=4)


@query
def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op7_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = mixing_lm.score_texts(table(spark, sf_dir, "documents"), fold(5) != 1, group=F.col("lang"))
    return scored.select("doc_id", (fold(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op8_quality_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = quality_sampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return sampled.select("doc_id", "log_weight", "n_grams", "gumbel_key", "kept")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(3) != 1, threshold=0.7)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, RULES))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLES["op10_url_rules"] = f"""
WITH RECURSIVE tags AS (
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, {_quoted(url_rules.LINK_TAG)})), {_quoted(url_rules.LINK_TARGET)}, 1) AS t FROM pages WHERE contains(url, '://')
  UNION ALL
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, {_quoted(url_rules.REFRESH_TAG)})), {_quoted(url_rules.REFRESH_TARGET)}, 1) FROM pages WHERE contains(url, '://')
), ends AS (
  SELECT DISTINCT split_part(url, '#', 1) AS a, split_part(CASE
    WHEN starts_with(t, '//') THEN split_part(url, '://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '^[^/?#]*://[^/?#]*') || t
    WHEN contains(t, '://') THEN t END, '#', 1) AS b FROM tags
), edges AS (
  SELECT a, b FROM ends WHERE a <> b UNION SELECT b, a FROM ends WHERE a <> b
), reach AS (
  SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
), urls AS (
  SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM edges
), rest AS (
  SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls
), parsed AS (
  SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest
), rules(rule, rule_host, rule_path, action) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), decided AS (
  SELECT url, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM parsed, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY url
), aliases AS (
  SELECT r.node, min(d.action) AS action FROM reach r JOIN decided d ON split_part(d.url, '#', 1) = r.other GROUP BY r.node
)
SELECT p.page_id, coalesce(x.host, '') AS host, coalesce(x.path, '') AS path, d.rule, coalesce(d.action, a.action, 'allow') AS verdict
FROM pages p LEFT JOIN parsed x ON x.url = p.url LEFT JOIN decided d ON d.url = p.url LEFT JOIN aliases a ON a.node = split_part(p.url, '#', 1)
"""


@query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLES["op11_fill_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), drawn AS (
  SELECT *, len(units)::BIGINT AS n, list_transform(range(4), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS draws FROM d
), cut AS (
  SELECT *, least(draws[1] % (n + 1), draws[2] % (n + 1)) AS low, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR draws[3] % 100 >= 50 THEN 'plain'
      WHEN draws[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


TREE = hash_tree.even_tree(regions=4, racks=2, per_rack=2)


@query
def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shards(table(spark, sf_dir, "documents"), TREE)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=32)


def _tree_sql(tree: hash_tree.Tree, source: str, into: str) -> str:
    """The tree as a table of nodes, descended level by level: of a node's children the one that draws the most."""
    nodes = sorted({(path, name, weight) for path in {(), *((x.region,) for x in tree.leaves), *((x.region, x.rack) for x in tree.leaves)} for name, weight in tree.children(*path)})
    values = ", ".join(f"('{'.'.join(map(str, path))}', '{'.'.join(map(str, (*path, name)))}', {name}, {weight}::DOUBLE)" for path, name, weight in nodes)
    level = lambda of: f"""
  SELECT doc_id, arg_max(node, drawn) AS node, arg_max(name, drawn) AS name FROM (
    SELECT p.doc_id, t.node, t.name, row(ln((('0x' || substr(md5(p.key || '/' || t.node), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / t.weight, t.name) AS drawn
    FROM {of} p JOIN {into}_nodes t ON t.parent = p.node) GROUP BY doc_id"""
    again = lambda name: f"(SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, node FROM {name})"
    return f"""{into}_nodes(parent, node, name, weight) AS (VALUES {values}),
{into}_root AS (SELECT DISTINCT doc_id, '' AS node FROM {source}), {into}_regions AS ({level(again(into + '_root'))}),
{into}_racks AS ({level(again(into + '_regions'))}), {into}_shards AS ({level(again(into + '_racks'))})"""


ORACLES["op12_hash_tree"] = f"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crcs AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, text IS NULL AS missing, t,
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)) AS b FROM documents, crcs
), measured AS (
  SELECT doc_id, size, missing, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM bytes
), {_tree_sql(TREE, "documents", "own")}, {_tree_sql(TREE.grown(), "documents", "more")}
SELECT m.doc_id, size, text_crc32, 'key' AS law, o.name::INTEGER AS shard,
  row_number() OVER (PARTITION BY o.name ORDER BY m.doc_id NULLS FIRST, missing DESC, text_crc32, size) - 1 AS slot, g.name::INTEGER AS grown_shard
FROM measured m JOIN own_shards o ON o.doc_id IS NOT DISTINCT FROM m.doc_id JOIN more_shards g ON g.doc_id IS NOT DISTINCT FROM m.doc_id
"""
