"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes its query's result from the driver tables without
the library: the publication shape is built straight from columns rather than
through JSON text, and every rule is spelled with SQL built-ins.
"""

from __future__ import annotations

# Python's whitespace set (str.isspace) as an RE2 class.
WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
JOURNAL_RE = "Published in:" + WS + r"*([^(\n]+)"
STRIP_RE = "^" + WS + "+|" + WS + "+$"


def _key19(c: str) -> str:
    return f"lpad(CAST({c} AS VARCHAR), 19, '0')"


# JSON texts of the values that are false in the original's sense.
FALSY = """('null', 'false', '0', '0.0', '""', '[]', '{}')"""

PART_PUBS = f"""
src AS (
  SELECT {_key19('p_partkey')} AS _id, p_name AS title,
         CASE WHEN p_size > 10 THEN p_type END AS doi,
         CASE WHEN p_size <= 45 THEN p_brand END AS publication_date
  FROM part)"""

# The orders x customer publications pushed through clean -> normalize -> star.
STAR = f"""
src AS (
  SELECT {_key19('o.o_orderkey')} AS load_order, o.o_orderkey AS k,
         c.c_name || ' (' || o.o_orderpriority || ')' AS title,
         CASE WHEN o.o_orderstatus <> 'P' THEN 'doi:' || CAST(o.o_orderkey AS VARCHAR) END AS doi,
         [c.c_mktsegment, 'Clerk ' || CAST(o.o_orderkey % 10 AS VARCHAR)] AS authors,
         CASE o.o_orderpriority
           WHEN '1-URGENT' THEN 'Date of Publication: ' || strftime(o.o_orderdate, '%-d %B %Y')
           WHEN '2-HIGH' THEN strftime(o.o_orderdate, '%-d %B %Y')
           WHEN '3-MEDIUM' THEN strftime(o.o_orderdate, '%-d %b %Y')
           WHEN '4-NOT SPECIFIED' THEN 'Date of Publication: '
           ELSE lower(strftime(o.o_orderdate, '%-d %B %Y')) END AS pd,
         CASE o.o_orderstatus WHEN 'F' THEN 'E' || CAST(c.c_custkey AS VARCHAR)
                              WHEN 'O' THEN 'Non disponible'
                              ELSE 'S' || CAST(o.o_orderkey AS VARCHAR) END AS issn,
         o.o_orderkey % 5 AS qshape, year(o.o_orderdate) AS y,
         'abs ' || CAST(o.o_orderkey AS VARCHAR) AS abstract
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
clean AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY load_order) AS rn FROM src)
  WHERE rn = 1 AND doi IS NOT NULL AND pd IS NOT NULL),
arts0 AS (SELECT *, replace(pd, 'Date of Publication: ', '') AS pdt FROM clean),
arts AS (
  SELECT *,
    CASE WHEN pdt = '' THEN NULL ELSE CAST(try_strptime(pdt, '%d %B %Y') AS DATE) END AS publication_date,
    rtrim(split_part(title, '(', 1)) AS journal_name,
    CASE WHEN qshape IN (0, 1) THEN 'indexe' ELSE 'pas indexe' END AS journal_flag,
    CASE WHEN qshape = 0 THEN 'Q' || CAST((k // 4) % 4 + 1 AS VARCHAR) ELSE 'Non disponible' END AS last_quartil,
    CASE WHEN pdt <> '' AND try_strptime(pdt, '%d %B %Y') IS NULL THEN 'unparseable_publication_date' END AS reject_reason
  FROM arts0),
good AS (SELECT * FROM arts WHERE reject_reason IS NULL),
dim_journal AS (
  SELECT row_number() OVER (ORDER BY load_order) AS journal_id, journal_name AS journal_main, issn,
         journal_flag AS quartils
  FROM (SELECT *, row_number() OVER (PARTITION BY journal_name ORDER BY load_order) AS jr FROM good)
  WHERE jr = 1),
items AS (
  SELECT load_order, journal_name, 0 AS pos, CAST(y AS VARCHAR) AS annee,
         'Q' || CAST(k % 4 + 1 AS VARCHAR) AS quartil FROM good WHERE qshape IN (0, 1)
  UNION ALL
  SELECT load_order, journal_name, 1 AS pos, CAST(y + 1 AS VARCHAR) AS annee,
         'Q' || CAST((k // 4) % 4 + 1 AS VARCHAR) AS quartil FROM good WHERE qshape = 0),
qsrc AS (SELECT i.*, j.journal_id AS id_journal FROM items i JOIN dim_journal j ON i.journal_name = j.journal_main),
qlast AS (SELECT annee, id_journal, quartil FROM (
  SELECT *, row_number() OVER (PARTITION BY annee, id_journal ORDER BY load_order DESC, pos DESC) AS r FROM qsrc)
  WHERE r = 1),
qfirst AS (SELECT annee, id_journal, load_order AS first_lo, pos AS first_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY annee, id_journal ORDER BY load_order, pos) AS r FROM qsrc)
  WHERE r = 1),
journal_quartile AS (
  SELECT row_number() OVER (ORDER BY f.first_lo, f.first_pos) AS quartil_id, l.annee, l.quartil, l.id_journal
  FROM qlast l JOIN qfirst f ON l.annee = f.annee AND l.id_journal = f.id_journal),
fact AS (
  SELECT row_number() OVER (ORDER BY g.load_order) AS publication_id, g.title, g.doi, g.publication_date,
         CAST(NULL AS VARCHAR) AS link, g.abstract, j.journal_id, g.last_quartil AS quartils, g.authors,
         g.load_order
  FROM good g JOIN dim_journal j ON g.journal_name = j.journal_main),
aw AS (
  SELECT publication_id, load_order, unnest(authors) AS author_name, unnest(range(len(authors))) AS pos
  FROM fact),
dim_author AS (
  SELECT row_number() OVER (ORDER BY load_order, pos) AS author_id, author_name,
         CAST(NULL AS VARCHAR) AS affiliation, CAST(NULL AS VARCHAR) AS country
  FROM (SELECT *, row_number() OVER (PARTITION BY author_name ORDER BY load_order, pos) AS r FROM aw
        WHERE author_name IS NOT NULL)
  WHERE r = 1),
bridge AS (SELECT DISTINCT aw.publication_id, d.author_id FROM aw JOIN dim_author d ON aw.author_name = d.author_name),
dim_date AS (
  SELECT row_number() OVER (ORDER BY full_date) AS date_id, full_date, CAST(year(full_date) AS INTEGER) AS year,
         CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day
  FROM (SELECT DISTINCT publication_date AS full_date FROM fact WHERE publication_date IS NOT NULL)),
quarantine AS (
  SELECT load_order, title, reject_reason, 'before_journal' AS reject_stage FROM arts WHERE reject_reason IS NOT NULL)"""


def _star(select: str) -> str:
    return "WITH " + STAR + "\n" + select


ORDER_QUARTILS = """
o AS (
  SELECT o_orderkey,
    '[{"année": "' || CAST(year(o_orderdate) AS VARCHAR) || '", "quartil": "Q' || CAST(o_orderkey % 4 + 1 AS VARCHAR)
    || '"}, {"année": "' || CAST(year(o_orderdate) + 1 AS VARCHAR) || '", "quartil": '
    || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '"Q2"' END
    || '}, {"année": "", "quartil": "Q3"}, {"année": "1999", "quartil": 0.0}, {"année": 0, "quartil": "Q1"}, '
    || '{"année": "1998", "quartil": []}'
    || CASE WHEN o_orderpriority = '5-LOW' THEN ', "junk"' ELSE '' END || ']' AS q
  FROM orders),
c AS (
  SELECT o_orderkey, json_extract(q, '$[*]') AS el,
         list_filter(json_extract(q, '$[*]'), lambda x: json_type(x) = 'OBJECT'
                     AND list_contains(json_keys(x), 'année') AND list_contains(json_keys(x), 'quartil')) AS cand
  FROM o)"""

PART_QUARTILS = """
p0 AS (
  SELECT p_partkey, p_partkey % 13 AS shape,
    CAST(p_size % 30 + 1990 AS VARCHAR) AS y1, CAST(p_size % 30 + 1991 AS VARCHAR) AS y2,
    CAST(p_size % 4 + 1 AS VARCHAR) AS qa, CAST(p_partkey % 4 + 1 AS VARCHAR) AS qb
  FROM part),
p1 AS (
  SELECT p_partkey, shape,
    '{"année": "' || y1 || '", "quartil": "Q' || qa || '"}' AS full1,
    '{"année": "' || y2 || '", "quartil": "Q' || qb || '"}' AS full2, y1, y2
  FROM p0),
p AS (
  SELECT p_partkey, CASE shape
    WHEN 0 THEN '[' || full1 || ', ' || full2 || ']'
    WHEN 1 THEN '[{"année": "' || y1 || '"}, "x", ' || full2 || ']'
    WHEN 2 THEN '[]'
    WHEN 3 THEN 'Journal pas indexé Scopus'
    WHEN 4 THEN 'n/a'
    WHEN 5 THEN full1
    WHEN 7 THEN '[' || full1 || ', "tail"]'
    WHEN 8 THEN '[{"année": null, "quartil": "Q1"}, {"année": "' || y2 || '", "quartil": ""}, {"année": ' || y1
                || ', "quartil": "Q4"}]'
    WHEN 9 THEN '[''Ann'', ''Bo'']'
    WHEN 10 THEN '[1] and [2]'
    WHEN 11 THEN '["a"] x]'
    WHEN 12 THEN '[' || full1 || ', {"année": "' || y2 || '", "quartil": 0}, {"année": 0, "quartil": "Q1"}, {"année": "' || y1
                 || '", "quartil": false}, {"année": "' || y1 || '", "quartil": "0"}]'
    END AS q
  FROM p1),
e AS (
  SELECT p_partkey, q,
    CASE WHEN q IS NULL THEN 'missing'
         WHEN starts_with(q, '[') AND ends_with(q, ']') AND json_valid(q) THEN 'list'
         WHEN starts_with(q, '{') AND json_valid(q) THEN 'object'
         ELSE 'string' END AS kind
  FROM p),
l AS (SELECT *, CASE WHEN kind = 'list' THEN json_extract(q, '$[*]') END AS el FROM e),
c AS (
  SELECT *, list_filter(el, lambda x: json_type(x) = 'OBJECT' AND list_contains(json_keys(x), 'année')
                        AND list_contains(json_keys(x), 'quartil')) AS cand
  FROM l)"""

ORDER_DATES = """
d AS (
  SELECT o_orderkey, CASE
    WHEN o_orderpriority = '1-URGENT' THEN 'Date of Publication: ' || strftime(o_orderdate, '%-d %B %Y')
    WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%-d %B %Y')
    WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%-d %b %Y')
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '31 February ' || CAST(year(o_orderdate) AS VARCHAR)
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%-d %B %Y') || chr(10)
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Date of Publication: '
    ELSE lower(strftime(o_orderdate, '%-d %B %Y')) END AS raw
  FROM orders),
t AS (SELECT o_orderkey, replace(raw, 'Date of Publication: ', '') AS txt FROM d)"""

BANDS = "CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'Q4' WHEN {x} >= 4 THEN 'Q1' WHEN {x} >= 2 THEN 'Q2' WHEN {x} >= 1 THEN 'Q3' ELSE 'Q4' END"

ORACLE_SQL: dict[str, str] = {
    "dedup_then_dropna": "WITH " + PART_PUBS + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _id) AS rn FROM src WHERE title IS NOT NULL)
SELECT _id, title, doi, publication_date FROM ranked
WHERE rn = 1 AND doi IS NOT NULL AND publication_date IS NOT NULL""",

    "dropna_then_dedup": "WITH " + PART_PUBS + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY _id) AS rn FROM src
           WHERE title IS NOT NULL AND doi IS NOT NULL AND publication_date IS NOT NULL)
SELECT _id, title, doi, publication_date FROM ranked WHERE rn = 1""",

    "dedup_documents": f"""
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY {_key19('doc_id')}) AS rn FROM documents)
WHERE rn = 1""",

    "required_fields": """
WITH d AS (
  SELECT event_id, CASE
    WHEN event_type = 'error' THEN '["' || event_type || '", ' || CAST(event_id AS VARCHAR) || ']'
    WHEN event_type = 'view' THEN '{"Title": "e' || CAST(event_id AS VARCHAR) || '", "Authors": ["u' || CAST(user_id AS VARCHAR) || '"]}'
    WHEN event_type = 'click' THEN '{"Title": "e' || CAST(event_id AS VARCHAR) || '", "DOI": null, "Authors": ["u'
         || CAST(user_id AS VARCHAR) || '"], "props": ' || props || '}'
    ELSE '{"Title": "e' || CAST(event_id AS VARCHAR) || '", "DOI": "' || event_type || '", "Authors": ["u'
         || CAST(user_id AS VARCHAR) || '"], "props": ' || props || '}' END AS doc
  FROM events)
SELECT event_id, CASE
  WHEN json_type(doc) <> 'OBJECT' THEN 'not_an_object'
  WHEN NOT (list_contains(json_keys(doc), 'Title') AND list_contains(json_keys(doc), 'DOI')
            AND list_contains(json_keys(doc), 'Authors')) THEN 'missing_required_keys' END AS reject_reason
FROM d""",

    "canonical_projection": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_type AS doi,
  CASE WHEN p_size % 3 <> 0 THEN p_brand END AS issn,
  coalesce(CASE WHEN p_size <= 25 THEN 'Q' || CAST(p_size % 4 + 1 AS VARCHAR) END, 'Journal pas indexé Scopus') AS quartils,
  NOT (p_size <= 25) AS quartils_defaulted,
  'Published in: ' || coalesce(p_name, 'None') AS journal_line,
  CAST(NULL AS VARCHAR) AS link,
  CASE WHEN p_size > 40 THEN 'abstract of ' || p_name END AS abstract
FROM part""",

    "journal_name": f"""
SELECT page_id,
  CASE WHEN regexp_matches(line, '{JOURNAL_RE}')
       THEN regexp_replace(regexp_extract(line, '{JOURNAL_RE}', 1), '{STRIP_RE}', '', 'g') END AS journal
FROM (SELECT page_id, 'Published in: ' || html AS line FROM pages)""",

    "publication_date": "WITH " + ORDER_DATES + """
SELECT o_orderkey,
  CASE WHEN txt = '' OR contains(txt, chr(10)) THEN NULL ELSE CAST(try_strptime(txt, '%d %B %Y') AS DATE) END AS publication_date,
  CASE WHEN txt = '' THEN 'empty' WHEN contains(txt, chr(10)) OR try_strptime(txt, '%d %B %Y') IS NULL THEN 'reject'
       ELSE 'ok' END AS status
FROM t""",

    "quartile_from_score": f"""
SELECT event_id, {BANDS.format(x='s')} AS quartile
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value / 50.0 END AS s
      FROM events)""",

    "normalize_quartile": f"""
WITH t AS (
  SELECT event_id, CASE
    WHEN event_type = 'view' THEN CAST(user_id % 6 AS VARCHAR)
    WHEN event_type = 'click' THEN CAST(user_id % 6 AS VARCHAR) || 'd'
    WHEN event_type = 'signup' THEN 'Q' || CAST(user_id % 4 + 1 AS VARCHAR)
    WHEN event_type = 'purchase' THEN ' ' || CAST(user_id % 5 AS VARCHAR) || '.5 '
    ELSE 'nan' END AS raw
  FROM events)
SELECT event_id, raw, CASE WHEN x IS NULL THEN raw ELSE {BANDS.format(x='x')} END AS quartile
FROM (SELECT *, TRY_CAST(trim(raw) AS DOUBLE) AS x FROM t)""",

    "issn_dispatch": """
WITH s AS (
  SELECT s_suppkey, CASE
    WHEN s_suppkey % 4 = 0 THEN '{"Electronic ISSN": "E-' || CAST(s_suppkey AS VARCHAR) || '", "Print ISSN": "P-'
                                || CAST(s_suppkey AS VARCHAR) || '"}'
    WHEN s_suppkey % 4 = 1 THEN '{"Print ISSN": "P-' || CAST(s_suppkey AS VARCHAR) || '"}'
    WHEN s_suppkey % 4 = 2 THEN 'ISSN ' || s_name END AS txt
  FROM supplier)
SELECT s_suppkey, CASE
  WHEN txt IS NULL THEN 'Non disponible'
  WHEN starts_with(txt, '{') THEN coalesce(json_extract_string(txt, '$."Electronic ISSN"'), 'Non disponible')
  ELSE txt END AS issn
FROM s""",

    "quartils_dispatch": "WITH " + PART_QUARTILS + """
SELECT p_partkey, kind,
  CASE WHEN coalesce(len(cand), 0) > 0 THEN 'indexe' ELSE 'pas indexe' END AS journal_flag,
  CAST(coalesce(len(list_filter(cand, lambda x: CAST(x->'année' AS VARCHAR) NOT IN """ + FALSY + """
                                AND CAST(x->'quartil' AS VARCHAR) NOT IN """ + FALSY + """)), 0) AS BIGINT) AS n_items,
  CASE WHEN coalesce(len(el), 0) = 0 THEN 'Non disponible'
       WHEN json_type(el[-1]) = 'OBJECT' AND list_contains(json_keys(el[-1]), 'quartil') THEN el[-1]->>'quartil'
       ELSE 'Non disponible' END AS last_quartil,
  contains(lower(q), 'pas indexé') AS mentions_not_indexed
FROM c""",

    "filter_quartiles": "WITH " + ORDER_QUARTILS + """,
u AS (SELECT o_orderkey, unnest(cand) AS x, unnest(range(len(cand))) AS pos FROM c)
SELECT o_orderkey, CAST(pos AS BIGINT) AS pos, x->>'année' AS annee, x->>'quartil' AS quartil FROM u
WHERE CAST(x->'année' AS VARCHAR) NOT IN """ + FALSY + """ AND CAST(x->'quartil' AS VARCHAR) NOT IN """ + FALSY,

    "last_quartile": "WITH " + ORDER_QUARTILS + """
SELECT o_orderkey,
  CASE WHEN coalesce(len(el), 0) = 0 THEN 'Non disponible'
       WHEN json_type(el[-1]) = 'OBJECT' AND list_contains(json_keys(el[-1]), 'quartil') THEN el[-1]->>'quartil'
       ELSE 'Non disponible' END AS last_quartil,
  CASE WHEN len(cand) > 0 THEN 'indexe' ELSE 'pas indexe' END AS journal_flag
FROM c""",

    "first_wins_dim": f"""
WITH ex AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS journal_id, c_name AS journal_main,
         'OLD-' || CAST(c_custkey AS VARCHAR) AS issn, 'pas indexe' AS quartils
  FROM customer WHERE c_mktsegment = 'BUILDING'),
cand AS (
  SELECT c.c_name AS journal_main, 'ISSN-' || CAST(o.o_orderkey AS VARCHAR) AS issn,
         CASE WHEN o.o_orderstatus = 'F' THEN 'indexe' ELSE 'pas indexe' END AS quartils,
         {_key19('o.o_orderkey')} AS load_order
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
fw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY journal_main ORDER BY load_order) AS rn FROM cand)
       WHERE rn = 1),
nw AS (SELECT * FROM fw WHERE journal_main NOT IN (SELECT journal_main FROM ex))
SELECT journal_id, journal_main, issn, quartils FROM ex
UNION ALL
SELECT (SELECT coalesce(max(journal_id), 0) FROM ex) + row_number() OVER (ORDER BY load_order),
       journal_main, issn, quartils FROM nw""",

    "author_dim": f"""
WITH ex AS (
  SELECT row_number() OVER (ORDER BY author_name) AS author_id, author_name
  FROM (SELECT DISTINCT lower(p_type) AS author_name FROM part)),
w AS (
  SELECT {_key19('p_partkey')} AS load_order, unnest(string_split(p_name, ' ')) AS author_name,
         unnest(range(len(string_split(p_name, ' ')))) AS pos
  FROM part),
fw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author_name ORDER BY load_order, pos) AS rn
                      FROM w WHERE author_name IS NOT NULL) WHERE rn = 1),
nw AS (SELECT * FROM fw WHERE author_name NOT IN (SELECT author_name FROM ex))
SELECT author_id, author_name, CAST(NULL AS VARCHAR) AS affiliation, CAST(NULL AS VARCHAR) AS country FROM ex
UNION ALL
SELECT (SELECT coalesce(max(author_id), 0) FROM ex) + row_number() OVER (ORDER BY load_order, pos),
       author_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM nw""",

    "upsert_quartile": f"""
WITH r AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS annee, o_custkey AS id_journal, o_orderkey, o_orderstatus,
         {_key19('o_orderkey')} AS load_order
  FROM orders),
tf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY annee, id_journal ORDER BY o_orderkey) AS rn
                      FROM r WHERE o_orderstatus = 'F') WHERE rn = 1),
t AS (SELECT row_number() OVER (ORDER BY id_journal, annee) AS quartil_id, annee,
             'Q' || CAST(o_orderkey % 4 + 1 AS VARCHAR) AS quartil, id_journal FROM tf),
s AS (SELECT annee, id_journal, 'Q' || CAST((o_orderkey // 7) % 4 + 1 AS VARCHAR) AS quartil, load_order
      FROM r WHERE o_orderstatus <> 'F'),
sl AS (SELECT annee, id_journal, quartil FROM (
         SELECT *, row_number() OVER (PARTITION BY annee, id_journal ORDER BY load_order DESC) AS rn FROM s)
       WHERE rn = 1),
sf AS (SELECT annee, id_journal, min(load_order) AS first_lo FROM s GROUP BY annee, id_journal),
src AS (SELECT sl.annee, sl.id_journal, sl.quartil, sf.first_lo FROM sl JOIN sf
        ON sl.annee = sf.annee AND sl.id_journal = sf.id_journal),
m AS (
  SELECT t.quartil_id, coalesce(t.annee, src.annee) AS annee,
         CASE WHEN src.annee IS NOT NULL THEN src.quartil ELSE t.quartil END AS quartil,
         coalesce(t.id_journal, src.id_journal) AS id_journal, src.first_lo
  FROM t FULL OUTER JOIN src ON t.annee = src.annee AND t.id_journal = src.id_journal)
SELECT quartil_id, annee, quartil, id_journal FROM m WHERE quartil_id IS NOT NULL
UNION ALL
SELECT (SELECT coalesce(max(quartil_id), 0) FROM t) + row_number() OVER (ORDER BY first_lo),
       annee, quartil, id_journal FROM m WHERE quartil_id IS NULL""",

    "fact_load": _star("""
SELECT f.publication_id, f.title, f.doi, f.publication_date, f.abstract, f.journal_id, j.journal_main, j.issn,
       j.quartils AS journal_flag, f.quartils
FROM fact f JOIN dim_journal j ON f.journal_id = j.journal_id"""),

    "author_bridge": _star("""
SELECT b.publication_id, b.author_id, d.author_name FROM bridge b JOIN dim_author d ON b.author_id = d.author_id"""),

    "star_author_dim": _star("SELECT author_id, author_name, affiliation, country FROM dim_author"),

    "star_journal_dim": _star("SELECT journal_id, journal_main, issn, quartils FROM dim_journal"),

    "star_journal_quartile": _star("SELECT quartil_id, annee, quartil, id_journal FROM journal_quartile"),

    "date_dim": _star("SELECT date_id, full_date, year, month, day FROM dim_date"),

    "quarantine_split": _star("SELECT load_order, title, reject_reason, reject_stage FROM quarantine"),

    "append_fact": _star("""
SELECT publication_id, title, doi, journal_id FROM fact
UNION ALL
SELECT publication_id + (SELECT count(*) FROM fact), title, doi, journal_id FROM fact"""),

    "idempotent_fact": _star("SELECT publication_id, title, doi, journal_id FROM fact"),

    "pubs_per_year": _star("""
SELECT d.year, f.quartils, count(*) AS n_publications
FROM fact f JOIN dim_date d ON f.publication_date = d.full_date GROUP BY d.year, f.quartils"""),

    "top_authors": _star("""
SELECT author_id, author_name, n_publications FROM (
  SELECT b.author_id, d.author_name, count(*) AS n_publications
  FROM bridge b JOIN dim_author d ON b.author_id = d.author_id GROUP BY b.author_id, d.author_name)
ORDER BY n_publications DESC, author_name, author_id LIMIT 10"""),

    "quartile_change": _star("""
SELECT id_journal, annee, quartil, previous_quartil FROM (
  SELECT *, lag(quartil) OVER (PARTITION BY id_journal ORDER BY annee) AS previous_quartil FROM journal_quartile)
WHERE previous_quartil IS NOT NULL AND previous_quartil <> quartil"""),

    "index_share": _star("""
SELECT quartils, count(*) AS n_journals, count(*) / sum(count(*)) OVER () AS share
FROM dim_journal GROUP BY quartils"""),

    "star_job": _star("""
SELECT 'dim_author' AS table_name, count(*) AS n_rows FROM dim_author
UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'dim_journal', count(*) FROM dim_journal
UNION ALL SELECT 'journal_quartile', count(*) FROM journal_quartile
UNION ALL SELECT 'fact_publication', count(*) FROM fact
UNION ALL SELECT 'publication_author', count(*) FROM bridge
UNION ALL SELECT 'quarantine', count(*) FROM quarantine"""),

    "clean_job": _star("SELECT load_order, title, doi FROM clean"),

    "length_check": f"""
WITH d AS (
  SELECT doc_id, text, source, lang, 'Published in: ' || text AS line FROM documents),
j AS (
  SELECT *, CASE WHEN regexp_matches(line, '{JOURNAL_RE}')
                 THEN regexp_replace(regexp_extract(line, '{JOURNAL_RE}', 1), '{STRIP_RE}', '', 'g') END AS journal
  FROM d)
SELECT doc_id,
  CASE WHEN journal IS NULL THEN 'journal_name_missing'
       WHEN length(journal) > 255 THEN 'journal_main_too_long'
       WHEN length(text) > 255 THEN 'title_too_long'
       WHEN length(source) > 100 THEN 'doi_too_long'
       WHEN length(lang) > 100 THEN 'author_name_too_long' END AS reject_reason,
  CASE WHEN journal IS NULL OR length(journal) > 255 THEN 'before_journal'
       WHEN length(text) > 255 OR length(source) > 100 OR length(lang) > 100 THEN 'after_journal' END AS reject_stage
FROM j""",

    "fk_check": """
SELECT l_orderkey, l_linenumber, l_partkey, 'fact_missing' AS reason FROM lineitem
WHERE l_orderkey IS NOT NULL
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')""",

    "json_roundtrip": """
SELECT event_id, k, CAST(to_json({'event_id': event_id, 'event_type': event_type, 'k': k}) AS VARCHAR) AS json,
       true AS roundtrip_ok
FROM (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",

    "users_explode": """
SELECT p_partkey AS doc_id, CAST(pos AS BIGINT) AS user_pos, p_partkey * 10 + pos AS user_id, w AS user_name,
       w || '@example.com' AS email, p_brand AS theme, 'en' AS language
FROM (SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS w,
             unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part)""",

    "sensor_batch": """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS sensor_id,
       CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND user_id % 3 IN (0, 1)) THEN NULL
            ELSE value END AS temperature,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value + 1.0 END AS humidity,
       CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
       CASE WHEN event_type = 'error' THEN 'malformed_or_not_an_object'
            WHEN event_type = 'signup' THEN 'missing_humidity'
            WHEN event_type = 'purchase' AND user_id % 3 IN (0, 1) THEN 'bad_temperature'
            WHEN event_type = 'click' THEN 'bad_timestamp' END AS reject_reason
FROM events""",

    "sensor_stream": """
WITH m AS (
  SELECT *, '{"sensor_id": ' || CAST(user_id AS VARCHAR) AS sid, ', "temperature": ' || CASE
      WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN '"hot"'
      WHEN event_type = 'purchase' AND user_id % 3 = 1 THEN '"29.5"' ELSE CAST(value AS VARCHAR) END AS temp,
    ', "humidity": ' || CAST(value + 1.0 AS VARCHAR) AS hum,
    ', "timestamp": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' AS tss,
    CASE WHEN event_type = 'error' THEN 'malformed_or_not_an_object'
         WHEN event_type = 'signup' THEN 'missing_humidity'
         WHEN event_type = 'purchase' AND user_id % 3 IN (0, 1) THEN 'bad_temperature'
         WHEN event_type = 'click' THEN 'bad_timestamp' END AS reject_reason
  FROM events)
SELECT CASE WHEN reject_reason IS NULL THEN user_id END AS sensor_id,
       CASE WHEN reject_reason IS NULL THEN value END AS temperature,
       CASE WHEN reject_reason IS NULL THEN value + 1.0 END AS humidity,
       CASE WHEN reject_reason IS NULL THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
       CASE WHEN reject_reason IS NULL THEN NULL
            WHEN event_type = 'error' THEN 'not json ' || CAST(event_id AS VARCHAR)
            WHEN event_type = 'signup' THEN sid || temp || tss
            WHEN event_type = 'click' THEN sid || temp || hum || ', "timestamp": "bad"}'
            ELSE sid || temp || hum || tss END AS raw,
       reject_reason
FROM m""",

    "sensor_dedup_stream": """
SELECT event_id AS sensor_id, value AS temperature, value + 1.0 AS humidity,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reject_reason
FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'broken ' || CAST(event_id AS VARCHAR), 'malformed_or_not_an_object'
FROM events, range(2) WHERE event_type = 'error'
UNION ALL
SELECT NULL, NULL, NULL, NULL, '{"sensor_id": ' || CAST(event_id AS VARCHAR)
       || ', "temperature": "hot", "humidity": 1.0, "timestamp": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}',
       'bad_temperature'
FROM events WHERE event_type = 'error'""",

    "published_readings": """
SELECT event_id AS sensor_id, CAST(round(round(value / 3, 2) * 100) AS BIGINT) AS hundredths,
       CASE WHEN event_type <> 'signup' THEN round(value, 2) END AS humidity,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, true AS has_humidity, CAST(NULL AS VARCHAR) AS reject_reason
FROM events""",

    "journal_match_facts": """
WITH n AS (SELECT p_type AS journal_main FROM part UNION SELECT upper(p_type) FROM part UNION SELECT lower(p_type) FROM part),
d AS (SELECT row_number() OVER (ORDER BY journal_main) AS journal_id, journal_main FROM n),
m AS (SELECT lower(journal_main) AS name, min(journal_id) AS journal_id FROM d GROUP BY 1)
SELECT p_partkey, journal_id FROM part JOIN m ON lower(p_type) = name""",

    "preview": _star("""
SELECT load_order, title, journal_flag, reject_reason FROM arts ORDER BY load_order LIMIT 25"""),

    "typed_parquet": f"""
SELECT {_key19('o_orderkey')} AS load_order,
  CASE WHEN o_orderkey % 7 <> 0 THEN c_mktsegment || '|Clerk ' || CAST(o_orderkey % 10 AS VARCHAR) ELSE '' END AS authors,
  CASE WHEN o_orderstatus = 'F' THEN CAST(c_custkey AS VARCHAR) ELSE 'Non disponible' END AS issn,
  CAST(CASE o_orderkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS n_items,
  CASE o_orderkey % 5 WHEN 0 THEN 'Q2' WHEN 1 THEN 'Q' || CAST(o_orderkey % 4 + 1 AS VARCHAR) ELSE 'Non disponible' END AS last_quartil,
  CASE WHEN o_orderkey % 5 IN (0, 1) THEN 'indexe' ELSE 'pas indexe' END AS journal_flag,
  CAST(NULL AS VARCHAR) AS reject_reason
FROM orders JOIN customer ON o_custkey = c_custkey""",

    "salted_fact_load": _star("""
SELECT f.publication_id, f.title, f.doi, f.publication_date, f.abstract, f.journal_id, j.journal_main, j.issn,
       j.quartils AS journal_flag, f.quartils
FROM fact f JOIN dim_journal j ON f.journal_id = j.journal_id"""),

    "strict_quarantine": _star("""
SELECT load_order, title, reject_reason, reject_stage FROM quarantine
UNION ALL
SELECT load_order, title,
       CASE WHEN qshape = 1 THEN 'last_quartil_not_an_object' ELSE 'quartils_not_a_list' END AS reject_reason,
       'after_journal' AS reject_stage
FROM good WHERE qshape IN (1, 2)"""),

    "journal_match_lower": f"""
WITH c AS (
  SELECT {_key19('p_partkey')} AS load_order,
         CASE WHEN p_size % 2 = 0 THEN lower(p_type) ELSE p_type END AS journal_main,
         'I' || CAST(p_partkey AS VARCHAR) AS issn,
         CASE WHEN p_size > 25 THEN 'indexe' ELSE 'pas indexe' END AS quartils
  FROM part),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(journal_main) ORDER BY load_order) AS rn FROM c)
      WHERE rn = 1)
SELECT row_number() OVER (ORDER BY load_order) AS journal_id, journal_main, issn, quartils FROM f""",

    "source_roundtrip_json": "SELECT * FROM part",
    "source_roundtrip_csv": "SELECT * FROM supplier",
    "source_roundtrip_parquet": "SELECT * FROM orders",
}

# Two loads of the same documents, once in memory and once through the published files.
ORACLE_SQL["warehouse_two_loads"] = ORACLE_SQL["append_fact"]


def _half(odd: int, select: str) -> str:
    """A select over the star tables of one half of the orders, as a subquery."""
    star = STAR.replace("ON o.o_custkey = c.c_custkey", f"ON o.o_custkey = c.c_custkey AND o.o_orderkey % 2 = {odd}")
    return f"(WITH {star}\n{select})"


# Two loads of one half each: the first load's journals, authors and dates stay, quartiles of the second win.
_HALVES = ",\n".join(f"{name}{odd} AS {_half(odd, select)}" for odd in (0, 1) for name, select in (
    ("j", "SELECT journal_main AS a, issn AS b, quartils AS c FROM dim_journal"),
    ("u", "SELECT author_name AS a FROM dim_author"),
    ("d", "SELECT full_date AS a FROM dim_date"),
    ("q", "SELECT journal_main AS a, annee AS b, quartil AS c FROM journal_quartile JOIN dim_journal ON journal_id = id_journal"),
    ("f", "SELECT title AS a, doi AS b, journal_main AS c FROM fact JOIN dim_journal USING (journal_id)"),
    ("p", "SELECT title AS a, author_name AS b FROM bridge JOIN fact USING (publication_id) JOIN dim_author USING (author_id)")))

ORACLE_SQL["warehouse_tables"] = f"""
WITH {_HALVES},
journals AS (SELECT * FROM j0 UNION ALL SELECT * FROM j1 WHERE a NOT IN (SELECT a FROM j0)),
authors AS (SELECT a FROM u0 UNION SELECT a FROM u1),
dates AS (SELECT a FROM d0 UNION SELECT a FROM d1),
quartiles AS (SELECT * FROM q1 UNION ALL SELECT * FROM q0 WHERE (a, b) NOT IN (SELECT (a, b) FROM q1)),
facts AS (SELECT * FROM f0 UNION ALL SELECT * FROM f1),
named AS (
  SELECT 'dim_journal' AS table_name, a, b, c FROM journals
  UNION ALL SELECT 'dim_author', a, NULL, NULL FROM authors
  UNION ALL SELECT 'dim_date', CAST(a AS VARCHAR), CAST(year(a) AS VARCHAR), NULL FROM dates
  UNION ALL SELECT 'journal_quartile', a, b, c FROM quartiles
  UNION ALL SELECT 'fact_publication', a, b, c FROM facts)
SELECT * FROM named
UNION ALL SELECT 'publication_author', a, b, NULL FROM (SELECT * FROM p0 UNION ALL SELECT * FROM p1)
UNION ALL SELECT 'keys of ' || table_name, CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR)
FROM named GROUP BY table_name"""

ORACLE_SQL["orphan_split"] = """
WITH o AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
p AS (SELECT p_partkey FROM part WHERE p_size > 5),
l AS (SELECT *, l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM o) AS no_order,
             l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM p) AS no_part FROM lineitem)
SELECT 'kept' AS fate, CAST(l_orderkey AS VARCHAR) AS key_value, CAST(l_linenumber AS VARCHAR) AS line FROM l
WHERE NOT no_order AND NOT no_part
UNION ALL SELECT 'no_row_in_orders', CAST(l_orderkey AS VARCHAR), NULL FROM l WHERE no_order
UNION ALL SELECT 'no_row_in_part', CAST(l_partkey AS VARCHAR), NULL FROM l WHERE no_part"""

ORACLE_SQL["merge_touched"] = ORACLE_SQL["upsert_quartile"].replace(
    "o_orderstatus <> 'F'", "o_orderstatus <> 'F' AND id_journal % 20 = 0")

ORACLE_SQL["compacted_readings"] = ("SELECT sensor_id, temperature, humidity, timestamp FROM (" + ORACLE_SQL["sensor_stream"]
                                    + ") WHERE reject_reason IS NULL")
