"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (alignment, chat, classifier, decontam, licenses, mixing, neardup, pii, quality, secrets, sharding, urls,
               vectors)
from .common import LOWER, UPPER, read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(read_table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_digest(read_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(read_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_digest(read_table(spark, sf_dir, "pages"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(read_table(spark, sf_dir, "documents"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.neardup_digest(read_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontam_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.code_digest(read_table(spark, sf_dir, "embeddings"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(read_table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mixing": op2_source_mixing,
    "op3_sharding": op3_sharding,
    "op4_license_scan": op4_license_scan,
    "op5_url_filter": op5_url_filter,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secret_scan": op7_secret_scan,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_chat_format": op12_chat_format,
    "op13_token_alignment": op13_token_alignment,
}

UPPER_LOWER = f"'{UPPER}', '{LOWER}'"
BLANK_WORDS = r"regexp_extract_all({x}, '[^\x20\x09-\x0D]+')"
ALNUM_WORDS = r"regexp_extract_all(translate(coalesce({x}, ''), " + UPPER_LOWER + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_PHRASES = " OR ".join(f"contains(lower(l), '{p}')" for p in quality.BOILERPLATE)



#: Levels of the SQL's tree, which cannot go on until no path does: more than any path of the tables has.
_URL_LEVELS = 10


def _url_sql() -> str:
    """The URL filter: rules, generalised segments, one pair of steps a level of the tree, purity."""
    rules = sorted(urls.RULES, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), reverse=True)
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, rules, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, rules, strict=True))
    ext = r"regexp_extract(s, '(\.[A-Za-z][A-Za-z0-9]{0,4})$', 1)"
    stem = r"regexp_replace(s, '\.[A-Za-z][A-Za-z0-9]{0,4}$', '')"
    general = rf"""CASE WHEN regexp_matches({stem}, '^[0-9]+$') THEN '{{n}}' || {ext}
      WHEN regexp_matches({stem}, '^[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?$') THEN '{{date}}' || {ext}
      WHEN regexp_matches({stem}, '[0-9]') AND regexp_matches({stem}, '^[0-9a-fA-F-]{{8,}}$') THEN '{{hex}}' || {ext}
      WHEN regexp_matches({stem}, '[0-9]') AND regexp_matches({stem}, '^[A-Za-z0-9_-]{{16,}}$') THEN '{{id}}' || {ext}
      WHEN regexp_matches({stem}, '^[A-Za-z_-]+[0-9]+$') THEN regexp_extract({stem}, '^([A-Za-z_-]+)', 1) || '{{n}}' || {ext}
      ELSE s END"""
    url = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)'"
    levels = ""
    for k in range(_URL_LEVELS):
        levels += f""",
c{k} AS (SELECT host, template, segs[{k + 1}] AS child, sum(n) AS n, sum(a) AS a, sum(b) AS b FROM t{k}
  WHERE len(segs) > {k} GROUP BY ALL),
q{k} AS (SELECT *, count(*) OVER p AS children, sum(n) OVER p AS pages, sum(a) OVER p AS aa, sum(b) OVER p AS bb FROM c{k}
  WINDOW p AS (PARTITION BY host, template)),
z{k} AS (SELECT *, (b + 1) / (a + b + 2) AS s1, (bb - b + 1) / (aa + bb - a - b + 2) AS s2, (bb + 2) / (aa + bb + 4) AS s FROM q{k}),
n{k} AS (SELECT host, template, child, CASE
    WHEN children >= {urls.VARIABLE_CHILDREN} AND pages < children * {urls.REPEATS} THEN '*'
    WHEN a + b > 0 AND aa + bb - a - b > 0 AND abs(s1 - s2) <= {urls.NEAR}
     AND abs(s1 - s2) <= {urls.Z} * sqrt(s * (1 - s) * (1 / (a + b + 2) + 1 / (aa + bb - a - b + 2))) THEN '*'
    ELSE child END AS name FROM z{k}),
t{k + 1} AS (SELECT t.host, segs, n, a, b, CASE WHEN name IS NULL THEN t.template ELSE t.template || '/' || name END AS template
  FROM t{k} t LEFT JOIN n{k} x ON x.host = t.host AND x.template = t.template AND x.child = t.segs[{k + 1}])"""
    last = f"t{_URL_LEVELS}"
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, translate({url}, 1), {UPPER_LOWER}) AS host, {url}, 2) AS path FROM pages),
j AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS by_rule,
        list_filter(string_split(path, '/'), lambda s: s <> '') AS parts FROM u),
g AS (SELECT r, page_id, host, path, rule, by_rule,
        list_transform(parts, lambda s: {general}) AS segs FROM j),
t0 AS (SELECT host, segs, count(*) AS n, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS b,
        '' AS template FROM g GROUP BY host, segs){levels},
f AS (SELECT host, template, sum(a) AS a, sum(b) AS b FROM {last} GROUP BY ALL),
v AS (SELECT host, template, (b + {urls.PRIOR_LABELS} * 0.5::DOUBLE) / (a + b + {urls.PRIOR_LABELS}) AS purity FROM f)
SELECT page_id, g.host, path, rule, coalesce(by_rule, CASE WHEN purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       x.template, purity
FROM g JOIN {last} x ON x.host = g.host AND x.segs = g.segs JOIN v ON v.host = x.host AND v.template = x.template"""


def _vector_sql() -> str:
    """Codebooks by measuring every part against every entry, one triple of steps a round."""
    rounds = ""
    for k in range(vectors.ROUNDS + 1):
        rounds += f""",
a{k} AS (SELECT r, part, min(row(far, entry)) AS hit FROM (
  SELECT p.r, p.part, c.entry, CAST(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far
  FROM p JOIN c{k} AS c USING (part)) GROUP BY r, part)"""
        if k < vectors.ROUNDS:
            rounds += f""",
m{k} AS (SELECT part, entry, pos, CAST(floor(sum(y) / count(*)) AS BIGINT) AS mean FROM (
  SELECT p.part, hit[2] AS entry, unnest(p.x) AS y, unnest(range(len(p.x))) AS pos FROM p JOIN a{k} USING (r, part)) GROUP BY ALL),
c{k + 1} AS (SELECT part, entry, coalesce(n.x, c.x) AS x FROM c{k} AS c
  LEFT JOIN (SELECT part, entry, list(mean ORDER BY pos) AS x FROM m{k} GROUP BY ALL) AS n USING (part, entry))"""
    last = vectors.ROUNDS
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({vectors.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, part, q[part * len(q) // {vectors.PARTS} + 1:(part + 1) * len(q) // {vectors.PARTS}] AS x
      FROM v, range({vectors.PARTS}) AS t(part)),
c0 AS (SELECT part, entry, x FROM p JOIN (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {vectors.ENTRIES}) USING (r)){rounds},
coded AS (SELECT vec_id, label, code, error FROM v JOIN (
  SELECT r, string_agg(printf('%02x', hit[2]), '' ORDER BY part) AS code, CAST(sum(hit[1]) AS BIGINT) AS error FROM a{last}
  GROUP BY r) USING (r)),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"""


#: Characters that the template adds to a text: backslashes, marks that follow another, ends of turns.
_ESCAPES = ("(length({x}) - length(replace({x}, '\\', '')) + length({x}) - length(replace({x}, '#', ''))"
            " - len(regexp_extract_all({x}, '#+')) + (length({x}) - length(replace({x}, '</turn>', ''))) // 7)")

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {BLANK_WORDS.format(x='t')} AS w FROM d),
g AS (SELECT r, unnest(range(len(w) - 2)) AS i, w FROM w WHERE len(w) > 2),
h AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram FROM g),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS n FROM h) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(3) AS x(j) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
parts AS (
  SELECT r, l, len({BLANK_WORDS.format(x='l')}) AS n,
         len(regexp_extract_all(l, '{quality.MARK_RUN}')) AS marks,
         len(regexp_extract_all(l, '{quality.SEPARATOR}')) AS seps FROM lines),
judged AS (
  SELECT *, (marks >= 2 AND marks * 100 > n * {quality.MARK_PERCENT})
         OR (n >= {quality.BARE_WORDS} AND NOT regexp_matches(l, '\p{{P}}'))
         OR (seps >= 2 AND seps * 100 > n * {quality.SEPARATOR_PERCENT})
         OR (n <= {quality.BOILERPLATE_WORDS} AND ({_PHRASES})) AS bad FROM parts),
by_doc AS (
  SELECT r, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
         coalesce(sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (bad), 0) AS lost
  FROM judged GROUP BY r),
m AS (
  SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, n_dup_lines, coalesce(x.n, 0) AS n_repeat_words,
         n_bad_lines, lost
  FROM w JOIN by_doc USING (r) LEFT JOIN repeated x USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND lost * 100 <= word_chars * {quality.LOST_PERCENT} AS kept, n_bad_lines, CAST(lost AS BIGINT) AS lost_chars
FROM m""",

    "op8_minhash_neardup": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         {BLANK_WORDS.format(x=f"translate(coalesce(text, ''), {UPPER_LOWER})")} AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT r, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS (
  SELECT p.a, p.b FROM (
    SELECT s.r AS a, o.r AS b, count(*) AS both_ FROM s JOIN s AS o ON s.x = o.x AND s.r <> o.r GROUP BY ALL) AS p
  JOIN n AS na ON na.r = p.a JOIN n AS nb ON nb.r = p.b
  WHERE 100 * both_ >= 75 * (na.n + nb.n - both_)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN low USING (r) LEFT JOIN n USING (r)""",

    "op10_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM_WORDS.format(x='text')} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS k FROM (SELECT item_id, {ALNUM_WORDS.format(x='text')} AS w FROM benchmark)
      WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x
       FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS x
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
hits AS (SELECT dw.r, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.x = bw.x AND dw.k = bw.k),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, item_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op5_url_filter": _url_sql(),
    "op11_vector_codes": _vector_sql(),
    "op12_chat_format": rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {chat.PROBE[0]}, 0, 'user', '{chat.PROBE[1]}' UNION ALL SELECT {chat.PROBE[0]}, 1, 'assistant', '{chat.PROBE[1]}'),
t AS (SELECT *, replace(replace(role, '%', '%25'), ':', '%3A') AS r FROM c),
m AS (SELECT *, length(r) + {_ESCAPES.format(x="r")} + length(text) + {_ESCAPES.format(x="text")} + 14 AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id""",
}
