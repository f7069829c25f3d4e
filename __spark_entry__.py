"""

Every query reads the driver tables (or data Spark derives from them) in full
and runs the library's operators on them. The driver tables are TPC-H-like,
so each query first maps a table onto the publication (or sensor) shape the
operator works on; the matching ``oracle_sql()`` entry computes the same
result independently in SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from citeloom import functions as CF  # noqa: E402
from citeloom.operators import (assign_keys, join_dimension, keep_first, merge_last_wins, merge_touched,  # noqa: E402
                                orphans, required_reason, resolve_key, canonical_projection)
from citeloom.plans import (clean_publications, index_share, load_star,  # noqa: E402
                            normalize_publications, publications_per_year, quartile_changes,
                            split_orphans, top_authors)
from citeloom.plans.pipeline import preview, run_batch, stage_clean  # noqa: E402
from citeloom.plans.star import load_authors, written_articles  # noqa: E402
from citeloom.schemas import DIM_AUTHOR, DIM_JOURNAL, JOURNAL_QUARTILE  # noqa: E402
from citeloom.session import scratch_path  # noqa: E402
from citeloom.sources import (create_tables, explode_users, publications_from_json_lines,  # noqa: E402
                              read_csv, read_current, read_json_documents, read_parquet, read_publications,
                              write_staging)
from citeloom.sources.readers import USERS_DOCUMENT  # noqa: E402
from citeloom.sources.sinks import bucket_of, row_counts  # noqa: E402
from citeloom.streaming import (compact_readings, ingest_sensors, parse_sensor_messages,  # noqa: E402
                                publish_readings, read_readings, read_sensor_stream, remove_compacted)
from citeloom.streaming.sensors import READING_COLUMNS  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key19(c) -> F.Column:
    return F.lpad(F.col(c).cast("string"), 19, "0")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# --------------------------------------------------------------------------
# Table -> publication mappings (Spark side)
# --------------------------------------------------------------------------

def part_publications(spark, sf_dir) -> DataFrame:
    """part as publication records: repeated names are repeated titles; DOI
    and date are missing for some sizes (nulls exercise the clean order)."""
    p = _t(spark, sf_dir, "part")
    return p.select(
        _key19("p_partkey").alias("_id"),
        F.col("p_name").alias("Title"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("DOI"),
        F.when(F.col("p_size") <= 45, F.col("p_brand")).alias("Publication Date"))


def order_documents(spark, sf_dir, half: int | None = None) -> DataFrame:
    """orders x customer as raw JSON publication documents (one per line).
    ISSN and Quartils take several JSON types, DOI is sometimes null, dates
    come in good, prefixed, abbreviated, lower-case and empty forms. ``half``:
    the orders whose key leaves that remainder by 2, as one day's landing."""
    o = _t(spark, sf_dir, "orders")
    o = o if half is None else o.where(F.col("o_orderkey") % 2 == half)
    c = _t(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    long_date = F.date_format("o_orderdate", "d MMMM yyyy")
    pd = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Date of Publication: "), long_date))
          .when(F.col("o_orderpriority") == "2-HIGH", long_date)
          .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "d MMM yyyy"))
          .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("Date of Publication: "))
          .otherwise(F.lower(long_date)))
    base = F.to_json(F.struct(
        _key19("o_orderkey").alias("_id"),
        F.concat(F.col("c_name"), F.lit(" ("), F.col("o_orderpriority"), F.lit(")")).alias("Title"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("doi:"), _s(k))).alias("DOI"),
        F.array(F.col("c_mktsegment"), F.concat(F.lit("Clerk "), _s(k % 10))).alias("Authors"),
        pd.alias("Publication Date"),
        F.concat(F.lit("abs "), _s(k)).alias("abstract")), {"ignoreNullFields": "false"})
    issn = (F.when(F.col("o_orderstatus") == "F",
                   F.concat(F.lit('{"Electronic ISSN": "E'), _s("c_custkey"), F.lit('"}')))
            .when(F.col("o_orderstatus") == "O",
                  F.concat(F.lit('{"Print ISSN": "P'), _s("c_custkey"), F.lit('"}')))
            .otherwise(F.concat(F.lit('"S'), _s(k), F.lit('"'))))
    y = F.year("o_orderdate")
    item1 = F.concat(F.lit('{"année": "'), _s(y), F.lit('", "quartil": "Q'), _s(k % 4 + 1), F.lit('"}'))
    item2 = F.concat(F.lit('{"année": "'), _s(y + 1), F.lit('", "quartil": "Q'),
                     _s((k / 4).cast("long") % 4 + 1), F.lit('"}'))
    shape = k % 5
    quartils = (F.when(shape == 0, F.concat(F.lit(', "Quartils": ['), item1, F.lit(", "), item2, F.lit("]")))
                .when(shape == 1, F.concat(F.lit(', "Quartils": ['), item1, F.lit(', "junk"]')))
                .when(shape == 2, F.lit(', "Quartils": "Journal pas indexé Scopus"'))
                .when(shape == 3, F.lit(', "Quartils": []'))
                .otherwise(F.lit("")))
    body = F.expr("substring(__base, 1, length(__base) - 1)")
    return (j.select(base.alias("__base"), issn.alias("__issn"), quartils.alias("__q"))
            .select(F.concat(body, F.lit(', "ISSN": '), F.col("__issn"), F.col("__q"), F.lit("}")).alias("value")))


def order_articles(spark, sf_dir, strict_parity=False) -> DataFrame:
    raw = publications_from_json_lines(order_documents(spark, sf_dir))
    return normalize_publications(clean_publications(raw), strict_parity=strict_parity)


def star(spark, sf_dir, current=None, idempotent=False, salt_buckets=None, strict_parity=False):
    return load_star(order_articles(spark, sf_dir, strict_parity), current, idempotent=idempotent,
                     salt_buckets=salt_buckets)


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

def q_dedup_then_dropna(spark, sf_dir):
    out = clean_publications(part_publications(spark, sf_dir), order="dedupe_first")
    return out.select("_id", F.col("Title").alias("title"), F.col("DOI").alias("doi"),
                      F.col("`Publication Date`").alias("publication_date"))


def q_dropna_then_dedup(spark, sf_dir):
    out = clean_publications(part_publications(spark, sf_dir), order="filter_first")
    return out.select("_id", F.col("Title").alias("title"), F.col("DOI").alias("doi"),
                      F.col("`Publication Date`").alias("publication_date"))


def q_dedup_documents(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    pubs = d.select(_key19("doc_id").alias("_id"), F.col("text").alias("Title"),
                    "doc_id", "lang", "source", "n_chars")
    return keep_first(pubs, ["Title"], ["_id"]).select("doc_id", "lang", "source", "n_chars")


def _event_documents(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    title = F.concat(F.lit('"Title": "e'), _s("event_id"), F.lit('"'))
    authors = F.concat(F.lit('"Authors": ["u'), _s("user_id"), F.lit('"]'))
    doc = (F.when(F.col("event_type") == "error",
                  F.concat(F.lit('["'), F.col("event_type"), F.lit('", '), _s("event_id"), F.lit("]")))
           .when(F.col("event_type") == "view", F.concat(F.lit("{"), title, F.lit(", "), authors, F.lit("}")))
           .when(F.col("event_type") == "click",
                 F.concat(F.lit("{"), title, F.lit(', "DOI": null, '), authors, F.lit(', "props": '),
                          F.col("props"), F.lit("}")))
           .otherwise(F.concat(F.lit("{"), title, F.lit(', "DOI": "'), F.col("event_type"), F.lit('", '),
                               authors, F.lit(', "props": '), F.col("props"), F.lit("}"))))
    return e.select("event_id", doc.alias("value"))


def q_required_fields(spark, sf_dir):
    docs = _event_documents(spark, sf_dir)
    return docs.select("event_id", required_reason(F.col("value")).alias("reject_reason"))


def q_canonical_projection(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    raw = p.select(
        _s("p_partkey").alias("_id"), F.col("p_name").alias("Title"), F.col("p_type").alias("DOI"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("ISSN"),
        F.when(F.col("p_size") <= 25, F.concat(F.lit("Q"), _s(F.col("p_size") % 4 + 1))).alias("Quartils"),
        F.when(F.col("p_size") > 40, F.concat(F.lit("abstract of "), F.col("p_name"))).alias("abstract"))
    c = canonical_projection(raw)
    return c.select(F.col("_id").alias("id"), F.col("Title").alias("title"), F.col("DOI").alias("doi"),
                    F.col("ISSN").alias("issn"), F.col("Quartils").alias("quartils"), "quartils_defaulted",
                    F.col("journal_main_line").alias("journal_line"), F.col("Link").alias("link"),
                    "abstract")


def q_journal_name(spark, sf_dir):
    pg = _t(spark, sf_dir, "pages")
    line = CF.journal_line(F.col("html"))
    return pg.select("page_id", CF.extract_journal_name(line).alias("journal"))


def _order_dates(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    long_date = F.date_format("o_orderdate", "d MMMM yyyy")
    raw = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Date of Publication: "), long_date))
           .when(F.col("o_orderpriority") == "2-HIGH", long_date)
           .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "d MMM yyyy"))
           .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"),
                 F.concat(F.lit("31 February "), _s(F.year("o_orderdate"))))
           .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"),
                 F.concat(long_date, F.lit("\n")))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("Date of Publication: "))
           .otherwise(F.lower(long_date)))
    return o.select("o_orderkey", raw.alias("raw"))


def q_publication_date(spark, sf_dir):
    d = _order_dates(spark, sf_dir)
    parsed = CF.parse_publication_date(F.col("raw"))
    status = (F.when(CF.publication_date_text(F.col("raw")) == "", F.lit("empty"))
              .when(CF.publication_date_rejected(F.col("raw")), F.lit("reject"))
              .otherwise(F.lit("ok")))
    return d.select("o_orderkey", parsed.alias("publication_date"), status.alias("status"))


def q_quartile_from_score(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    score = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value") / 50.0)
    return e.select("event_id", CF.quartile_from_score(score).alias("quartile"))


def _quartile_texts(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    t = (F.when(F.col("event_type") == "view", _s(F.col("user_id") % 6))
         .when(F.col("event_type") == "click", F.concat(_s(F.col("user_id") % 6), F.lit("d")))
         .when(F.col("event_type") == "signup", F.concat(F.lit("Q"), _s(F.col("user_id") % 4 + 1)))
         .when(F.col("event_type") == "purchase", F.concat(F.lit(" "), _s(F.col("user_id") % 5), F.lit(".5 ")))
         .otherwise(F.lit("nan")))
    return e.select("event_id", t.alias("raw"))


def q_normalize_quartile(spark, sf_dir):
    t = _quartile_texts(spark, sf_dir)
    return t.select("event_id", "raw", CF.normalize_quartile(F.col("raw")).alias("quartile"))


def q_issn_dispatch(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    key = _s("s_suppkey")
    txt = (F.when(F.col("s_suppkey") % 4 == 0,
                  F.concat(F.lit('{"Electronic ISSN": "E-'), key, F.lit('", "Print ISSN": "P-'), key, F.lit('"}')))
           .when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit('{"Print ISSN": "P-'), key, F.lit('"}')))
           .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("ISSN "), F.col("s_name"))))
    return s.select("s_suppkey", CF.issn_value(txt).alias("issn"))


def _part_quartils(spark, sf_dir) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    y1 = _s(F.col("p_size") % 30 + 1990)
    y2 = _s(F.col("p_size") % 30 + 1991)
    qa = _s(F.col("p_size") % 4 + 1)
    qb = _s(F.col("p_partkey") % 4 + 1)
    full1 = F.concat(F.lit('{"année": "'), y1, F.lit('", "quartil": "Q'), qa, F.lit('"}'))
    full2 = F.concat(F.lit('{"année": "'), y2, F.lit('", "quartil": "Q'), qb, F.lit('"}'))
    shape = F.col("p_partkey") % 13
    txt = (F.when(shape == 0, F.concat(F.lit("["), full1, F.lit(", "), full2, F.lit("]")))
           .when(shape == 1, F.concat(F.lit('[{"année": "'), y1, F.lit('"}, "x", '), full2, F.lit("]")))
           .when(shape == 2, F.lit("[]"))
           .when(shape == 3, F.lit("Journal pas indexé Scopus"))
           .when(shape == 4, F.lit("n/a"))
           .when(shape == 5, full1)
           .when(shape == 7, F.concat(F.lit("["), full1, F.lit(', "tail"]')))
           .when(shape == 8, F.concat(F.lit('[{"année": null, "quartil": "Q1"}, {"année": "'), y2,
                                      F.lit('", "quartil": ""}, {"année": '), y1, F.lit(', "quartil": "Q4"}]')))
           .when(shape == 9, F.lit("['Ann', 'Bo']"))
           .when(shape == 10, F.lit("[1] and [2]"))
           .when(shape == 11, F.lit('["a"] x]'))
           .when(shape == 12, F.concat(F.lit("["), full1, F.lit(', {"année": "'), y2,
                                       F.lit('", "quartil": 0}, {"année": 0, "quartil": "Q1"}, {"année": "'), y1,
                                       F.lit('", "quartil": false}, {"année": "'), y1, F.lit('", "quartil": "0"}]'))))
    return p.select("p_partkey", txt.alias("q"))


def q_quartils_dispatch(spark, sf_dir):
    p = _part_quartils(spark, sf_dir).withColumn("elements", CF.decode_list("q"))
    elements = F.col("elements")
    return p.select("p_partkey", CF.quartils_kind("q", elements).alias("kind"),
                    CF.journal_flag(elements).alias("journal_flag"),
                    F.size(CF.quartile_items(elements)).cast("long").alias("n_items"),
                    CF.last_quartil(elements).alias("last_quartil"),
                    CF.mentions_not_indexed(F.col("q")).alias("mentions_not_indexed"))


def _order_quartils(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    second = F.when(F.col("o_orderstatus") == "F", F.lit("null")).otherwise(F.lit('"Q2"'))
    txt = F.concat(F.lit('[{"année": "'), _s(y), F.lit('", "quartil": "Q'), _s(F.col("o_orderkey") % 4 + 1),
                   F.lit('"}, {"année": "'), _s(y + 1), F.lit('", "quartil": '), second,
                   F.lit('}, {"année": "", "quartil": "Q3"}, {"année": "1999", "quartil": 0.0}, {"année": 0, "quartil": "Q1"}, '
                         '{"année": "1998", "quartil": []}'),
                   F.when(F.col("o_orderpriority") == "5-LOW", F.lit(', "junk"')).otherwise(F.lit("")),
                   F.lit("]"))
    return o.select("o_orderkey", txt.alias("q"))


def q_filter_quartiles(spark, sf_dir):
    o = _order_quartils(spark, sf_dir)
    items = CF.quartile_items(CF.decode_list("q"))
    return (o.select("o_orderkey", F.explode(items).alias("it"))
            .select("o_orderkey", F.col("it.pos").cast("long").alias("pos"),
                    F.col("it.annee").alias("annee"), F.col("it.quartil").alias("quartil")))


def q_last_quartile(spark, sf_dir):
    o = _order_quartils(spark, sf_dir).withColumn("elements", CF.decode_list("q"))
    el = F.col("elements")
    return o.select("o_orderkey", CF.last_quartil(el).alias("last_quartil"),
                    CF.journal_flag(el).alias("journal_flag"))


def q_first_wins_dim(spark, sf_dir):
    """Lookup-or-insert against a dimension that already holds the BUILDING customers."""
    from citeloom.operators import lookup_or_insert
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    existing_rows = c.where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_name").alias("journal_main"), F.concat(F.lit("OLD-"), _s("c_custkey")).alias("issn"),
        F.lit("pas indexe").alias("quartils"), "c_custkey")
    existing = assign_keys(existing_rows, "journal_id", ["c_custkey"]).select(*DIM_JOURNAL.fieldNames())
    cands = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("journal_main"), F.concat(F.lit("ISSN-"), _s("o_orderkey")).alias("issn"),
        F.when(F.col("o_orderstatus") == "F", F.lit("indexe")).otherwise(F.lit("pas indexe")).alias("quartils"),
        _key19("o_orderkey").alias("load_order"))
    dim, _ = lookup_or_insert(existing, cands, "journal_main", "journal_id", order_by=["load_order"])
    return dim


def q_author_dim(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    existing_rows = p.select(F.lower("p_type").alias("author_name")).distinct()
    existing = assign_keys(existing_rows, "author_id", ["author_name"]).select(
        "author_id", "author_name", F.lit(None).cast("string").alias("affiliation"),
        F.lit(None).cast("string").alias("country"))
    pubs = p.select(_key19("p_partkey").alias("load_order"), F.split("p_name", " ").alias("authors"))
    return load_authors(pubs, existing).select(*DIM_AUTHOR.fieldNames())


def _quartile_rows(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.select(_s(F.year("o_orderdate")).alias("annee"), F.col("o_custkey").alias("id_journal"),
                    "o_orderkey", "o_orderstatus", _key19("o_orderkey").alias("load_order"),
                    F.lit(0).alias("pos"))


def q_upsert_quartile(spark, sf_dir):
    rows = _quartile_rows(spark, sf_dir)
    tgt_rows = rows.where(F.col("o_orderstatus") == "F").select(
        "annee", "id_journal", "o_orderkey",
        F.concat(F.lit("Q"), _s(F.col("o_orderkey") % 4 + 1)).alias("quartil"))
    first = keep_first(tgt_rows, ["annee", "id_journal"], ["o_orderkey"])
    target = assign_keys(first, "quartil_id", ["id_journal", "annee"]).select(*JOURNAL_QUARTILE.fieldNames())
    source = rows.where(F.col("o_orderstatus") != "F").select(
        "annee", "id_journal", "load_order", "pos",
        F.concat(F.lit("Q"), _s((F.col("o_orderkey") / 7).cast("long") % 4 + 1)).alias("quartil"))
    return merge_last_wins(target, source, ["annee", "id_journal"], ["quartil"], ["load_order", "pos"],
                           "quartil_id")


def q_fact_load(spark, sf_dir):
    t = star(spark, sf_dir)
    f = t["fact_publication"]
    j = t["dim_journal"].select("journal_id", "journal_main", "issn", F.col("quartils").alias("journal_flag"))
    return f.join(j, "journal_id").select("publication_id", "title", "doi", "publication_date", "abstract",
                                          "journal_id", "journal_main", "issn", "journal_flag", "quartils")


def q_journal_match_lower(spark, sf_dir):
    """Journal lookup-or-insert with case-insensitive names: part types in two
    spellings collapse to one journal, stored as first written."""
    from citeloom.plans.star import load_journals
    from citeloom.schemas import empty_table
    p = _t(spark, sf_dir, "part")
    name = F.when(F.col("p_size") % 2 == 0, F.lower("p_type")).otherwise(F.col("p_type"))
    line = CF.journal_line(F.concat(name, F.lit(" ("), F.col("p_name"), F.lit(")")))
    arts = p.select(_key19("p_partkey").alias("load_order"),
                    CF.extract_journal_name(line).alias("journal_name"),
                    F.concat(F.lit("I"), _s("p_partkey")).alias("issn"),
                    F.when(F.col("p_size") > 25, F.lit("indexe")).otherwise(F.lit("pas indexe")).alias("journal_flag"),
                    F.lit(None).cast("string").alias("reject_stage"))
    return load_journals(arts, empty_table(spark, "dim_journal"), journal_match="lower")


def q_journal_match_facts(spark, sf_dir):
    """Case-insensitive key resolution against a dimension that holds two spellings of each name:
    every article gets one journal, the older row."""
    p = _t(spark, sf_dir, "part")
    names = p.select(F.col("p_type").alias("journal_main")).union(p.select(F.upper("p_type"))).union(
        p.select(F.lower("p_type"))).distinct()
    dim = assign_keys(names, "journal_id", ["journal_main"])
    arts = p.select("p_partkey", F.lower("p_type").alias("journal_name"))
    return resolve_key(arts, dim, "journal_name", "journal_main", "journal_id", match=F.lower).select(
        "p_partkey", "journal_id")


def _loaded_warehouse(spark, sf_dir, halves: bool):
    """A warehouse after two loads through files: of the same landing data, or of one half each."""
    place = scratch_path(spark, "warehouse")
    warehouse = create_tables(spark, "w_" + place[-32:], place)
    landing = None
    for version, odd in (("1", 0), ("2", 1)):
        if landing is None or halves:  # the same landing data are written once
            landing = scratch_path(spark, "landing")
            # Compressed files are not split; a bounded number of documents in each keeps tasks even.
            (order_documents(spark, sf_dir, odd if halves else None).write.option("maxRecordsPerFile", 100_000)
             .text(landing, compression="gzip"))
        run_batch(spark, landing, warehouse, version=version)
    return read_current(spark, warehouse)


def q_warehouse_two_loads(spark, sf_dir):
    """Tables created, two loads run through files and published, the facts read back."""
    return _loaded_warehouse(spark, sf_dir, halves=False)["fact_publication"].select(
        "publication_id", "title", "doi", "journal_id")


def _by_name(t) -> DataFrame:
    """Every star table's rows by their natural keys, and each table's number of rows and of keys."""
    j = t["dim_journal"].select("journal_id", "journal_main")
    text = F.lit(None).cast("string")
    out = [
        t["dim_journal"].select(F.lit("dim_journal").alias("table_name"), F.col("journal_main").alias("a"),
                                F.col("issn").alias("b"), F.col("quartils").alias("c")),
        t["dim_author"].select(F.lit("dim_author"), "author_name", text, text),
        t["dim_date"].select(F.lit("dim_date"), _s("full_date"), _s("year"), text),
        t["journal_quartile"].join(j, F.col("id_journal") == j["journal_id"]).select(
            F.lit("journal_quartile"), "journal_main", "annee", "quartil"),
        t["fact_publication"].join(j, "journal_id").select(F.lit("fact_publication"), "title", "doi", "journal_main"),
        t["publication_author"].join(t["fact_publication"], "publication_id").join(t["dim_author"], "author_id").select(
            F.lit("publication_author"), "title", "author_name", text)]
    for name, key in (("dim_journal", "journal_id"), ("dim_author", "author_id"), ("dim_date", "date_id"),
                      ("journal_quartile", "quartil_id"), ("fact_publication", "publication_id")):
        out.append(t[name].agg(F.lit("keys of " + name), _s(F.count(F.lit(1))), _s(F.count_distinct(key)), _s(F.max(key))))
    union = out[0]
    for more in out[1:]:
        union = union.union(more)
    return union


def q_warehouse_tables(spark, sf_dir):
    """Two loads of one half of the landing data each: every table by its natural keys, and its keys."""
    return _by_name(_loaded_warehouse(spark, sf_dir, halves=True))


def q_orphan_split(spark, sf_dir):
    """Line items loaded as rows that point to orders and parts: those without a parent, in the load or
    in the tables before it, are told apart. The tables hold the orders before 1996 and the larger
    parts, the load adds the orders of 1996 and 1997."""
    o, p = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "part")
    since = lambda year: F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    kept, orphans_found = split_orphans(
        {"orders": o.where(since(1996) & ~since(1998)), "lineitem": li},
        {"orders": o.where(~since(1996)), "part": p.where(F.col("p_size") > 5)},
        {"lineitem": (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"))})
    return (kept["lineitem"].select(F.lit("kept").alias("fate"), _s("l_orderkey").alias("key_value"), _s("l_linenumber").alias("line"))
            .unionByName(orphans_found.select(F.col("reject_reason").alias("fate"), "key_value", F.lit(None).cast("string").alias("line"))))


def q_merge_touched(spark, sf_dir):
    """The quartiles of finished orders in a table partitioned by journal bucket; those of the
    open ones of every twentieth customer merged into the buckets that they touch, the others kept."""
    rows = _quartile_rows(spark, sf_dir)
    tgt = rows.where(F.col("o_orderstatus") == "F").select(
        "annee", "id_journal", "o_orderkey", F.concat(F.lit("Q"), _s(F.col("o_orderkey") % 4 + 1)).alias("quartil"))
    first = keep_first(tgt, ["annee", "id_journal"], ["o_orderkey"])
    path = scratch_path(spark, "quartiles")
    (assign_keys(first, "quartil_id", ["id_journal", "annee"]).select(*JOURNAL_QUARTILE.fieldNames())
     .withColumn("bucket", bucket_of(F.col("id_journal"))).write.partitionBy("bucket").parquet(path))
    target = spark.read.parquet(path)
    source = rows.where((F.col("o_orderstatus") != "F") & (F.col("id_journal") % 20 == 0)).select(
        "annee", "id_journal", "load_order", "pos",
        F.concat(F.lit("Q"), _s((F.col("o_orderkey") / 7).cast("long") % 4 + 1)).alias("quartil"))
    changed = merge_touched(target, source, ["annee", "id_journal"], ["quartil"], ["load_order", "pos"], "quartil_id",
                            bucket=lambda: bucket_of(F.col("id_journal")), bucket_col="bucket")
    out = scratch_path(spark, "touched")
    changed.withColumn("bucket", bucket_of(F.col("id_journal"))).write.partitionBy("bucket").parquet(out)
    merged = spark.read.schema(target.schema).parquet(out)
    kept = target.join(merged.select("bucket").distinct(), "bucket", "left_anti")
    return kept.unionByName(merged).select(*JOURNAL_QUARTILE.fieldNames())


def q_preview(spark, sf_dir):
    """The first articles in load order: the row limit is the feature."""
    return preview(order_articles(spark, sf_dir), n=25).select("load_order", "title", "journal_flag", "reject_reason")


def q_typed_parquet(spark, sf_dir):
    """A typed landing file: lists and rows are decoded by the rules of their JSON text."""
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    item = lambda year, quartile: F.struct(_s(year).alias("année"), quartile.alias("quartil"))
    first = item(y, F.concat(F.lit("Q"), _s(k % 4 + 1)))
    typed = o.join(c, o.o_custkey == c.c_custkey).select(
        _key19("o_orderkey").alias("_id"), F.concat("c_name", F.lit(" ("), _s(k), F.lit(")")).alias("Title"),
        F.concat(F.lit("doi:"), _s(k)).alias("DOI"),
        F.when(k % 7 != 0, F.array(F.col("c_mktsegment"), F.concat(F.lit("Clerk "), _s(k % 10)))).alias("Authors"),
        F.lit("1 May 2020").alias("Publication Date"),
        F.when(F.col("o_orderstatus") == "F", F.struct(_s("c_custkey").alias("Electronic ISSN"))).alias("ISSN"),
        F.when(k % 5 == 0, F.array(first, item(y + 1, F.lit("Q2")))).when(k % 5 == 1, F.array(first)).alias("Quartils"))
    path = scratch_path(spark, "typed-landing")
    typed.write.parquet(path)
    arts = normalize_publications(read_publications(spark, path, fmt="parquet"))
    return arts.select("load_order", F.array_join("authors", "|").alias("authors"), "issn",
                       F.size("quartile_items").cast("long").alias("n_items"), "last_quartil", "journal_flag",
                       "reject_reason")


def q_salted_fact_load(spark, sf_dir):
    """fact_load with both fact-to-journal joins, by name and by key, salted over 8 buckets."""
    t = star(spark, sf_dir, salt_buckets=8)
    f = t["fact_publication"]
    j = t["dim_journal"].select("journal_id", "journal_main", "issn", F.col("quartils").alias("journal_flag"))
    return join_dimension(f, j, "journal_id", salt_buckets=8, salt_by="publication_id").select("publication_id", "title", "doi", "publication_date", "abstract",
                                          "journal_id", "journal_main", "issn", "journal_flag", "quartils")


def q_strict_quarantine(spark, sf_dir):
    """Quarantine under strict parity: records lost after their journal was made."""
    q = star(spark, sf_dir, strict_parity=True)["quarantine"]
    return q.select("load_order", "title", "reject_reason", "reject_stage")


def q_star_job(spark, sf_dir):
    """E1-E3 end to end through files: landing JSON -> staged Parquet -> star."""
    landing = scratch_path(spark, "landing")
    order_documents(spark, sf_dir).write.mode("overwrite").text(landing)
    staged = stage_clean(spark, landing)
    t = load_star(normalize_publications(staged)).build_all()
    return row_counts(t).select(F.col("table").alias("table_name"), F.col("rows").alias("n_rows"))


def q_clean_job(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    order_documents(spark, sf_dir).write.mode("overwrite").text(landing)
    staged = stage_clean(spark, landing)
    return staged.select(F.col("_id").alias("load_order"), F.col("Title").alias("title"),
                         F.col("DOI").alias("doi"))


def q_author_bridge(spark, sf_dir):
    t = star(spark, sf_dir)
    return (t["publication_author"].join(t["dim_author"], "author_id")
            .select("publication_id", "author_id", "author_name"))


def q_author_dim_star(spark, sf_dir):
    return star(spark, sf_dir)["dim_author"]


def q_journal_dim_star(spark, sf_dir):
    return star(spark, sf_dir)["dim_journal"]


def q_journal_quartile_star(spark, sf_dir):
    return star(spark, sf_dir)["journal_quartile"]


def q_date_dim(spark, sf_dir):
    return star(spark, sf_dir)["dim_date"]


def q_quarantine_split(spark, sf_dir):
    q = star(spark, sf_dir)["quarantine"]
    return q.select("load_order", "title", "reject_reason", "reject_stage")


def _second_load(spark, sf_dir, idempotent):
    # The first load is handed over as it is: only the tables that facts need are built.
    articles = written_articles(order_articles(spark, sf_dir))
    return load_star(articles, load_star(articles), idempotent=idempotent)["fact_publication"]


def q_append_fact(spark, sf_dir):
    return _second_load(spark, sf_dir, False).select("publication_id", "title", "doi", "journal_id")


def q_idempotent_fact(spark, sf_dir):
    return _second_load(spark, sf_dir, True).select("publication_id", "title", "doi", "journal_id")


def q_pubs_per_year(spark, sf_dir):
    t = star(spark, sf_dir)
    return publications_per_year(t["fact_publication"], t["dim_date"])


def q_top_authors(spark, sf_dir):
    t = star(spark, sf_dir)
    return top_authors(t["publication_author"], t["dim_author"], n=10)


def q_quartile_change(spark, sf_dir):
    return quartile_changes(star(spark, sf_dir)["journal_quartile"])


def q_index_share(spark, sf_dir):
    return index_share(star(spark, sf_dir)["dim_journal"])


def q_length_check(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    docs = d.select(F.to_json(F.struct(
        _key19("doc_id").alias("_id"), F.col("text").alias("Title"), F.col("source").alias("DOI"),
        F.array(F.col("lang")).alias("Authors"), F.lit("1 January 2020").alias("Publication Date"),
        F.concat(F.lit("https://docs.example/"), _s("doc_id")).alias("Link"))).alias("value"))
    arts = normalize_publications(publications_from_json_lines(docs), length_check=True)
    return arts.select(F.col("load_order").cast("long").alias("doc_id"), "reject_reason", "reject_stage")


def q_fk_check(spark, sf_dir):
    """Line items whose order is missing from a snapshot; the snapshot leaves out orders since 1998
    so that there are orphans to find."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    snapshot = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    bad = orphans(li, "l_orderkey", snapshot, "o_orderkey")
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", F.lit("fact_missing").alias("reason"))


def q_json_roundtrip(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    k = CF.from_json_text(F.col("props"), "k bigint")["k"]
    dec = e.select("event_id", "event_type", k.alias("k"))
    enc = dec.select("event_id", "k", CF.to_json_text(F.col("event_id"), F.col("event_type"), F.col("k"),
                                                      name="json"))
    back = CF.from_json_text(F.col("json"), "event_id bigint, event_type string, k bigint")
    return enc.select("event_id", "k", "json", (back["k"] == F.col("k")).alias("roundtrip_ok"))


def q_users_explode(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    users = F.transform(F.split("p_name", " "), lambda w, i: F.struct(
        (F.col("p_partkey") * 10 + i).alias("id"), w.alias("name"),
        F.concat(w, F.lit("@example.com")).alias("email")))
    docs = p.select(
        F.col("p_partkey").alias("doc_id"), users.alias("users"),
        F.struct(F.col("p_brand").alias("theme"), (F.col("p_size") > 25).alias("notifications"),
                 F.lit("en").alias("language")).alias("settings"),
        F.struct(F.col("p_type").alias("version"), _s("p_size").alias("generated_at")).alias("metadata"))
    path = scratch_path(spark, "users-json")
    docs.write.mode("overwrite").json(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + USERS_DOCUMENT.fields)
    back = read_json_documents(spark, path, schema=schema, multi_line=False)
    return explode_users(back, ["doc_id"]).withColumn("user_pos", F.col("user_pos").cast("long"))


def sensor_messages(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    sid = F.concat(F.lit('{"sensor_id": '), _s("user_id"))
    mistyped = F.when(F.col("user_id") % 3 == 0, F.lit('"hot"')).when(F.col("user_id") % 3 == 1, F.lit('"29.5"'))
    temp = F.concat(F.lit(', "temperature": '), F.when(F.col("event_type") == "purchase", F.coalesce(
        mistyped, _s("value"))).otherwise(_s("value")))
    hum = F.concat(F.lit(', "humidity": '), _s(F.col("value") + 1.0))
    tss = F.concat(F.lit(', "timestamp": "'), ts, F.lit('"}'))
    msg = (F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), _s("event_id")))
           .when(F.col("event_type") == "signup", F.concat(sid, temp, tss))
           .when(F.col("event_type") == "click", F.concat(sid, temp, hum, F.lit(', "timestamp": "bad"}')))
           .otherwise(F.concat(sid, temp, hum, tss)))
    return e.select("event_id", msg.alias("value"))


def q_sensor_batch(spark, sf_dir):
    r = parse_sensor_messages(sensor_messages(spark, sf_dir))
    return r.select("sensor_id", "temperature", "humidity", "timestamp", "reject_reason")


def _run_stream(spark, messages: DataFrame, dedup_delay=None, files_per_batch=None) -> DataFrame:
    src = scratch_path(spark, "sensor-in")
    messages.select("value").write.mode("overwrite").text(src)
    sink, bad = scratch_path(spark, "sensor-out"), scratch_path(spark, "sensor-bad")
    stream = read_sensor_stream(spark, fmt="text", path=src, max_files_per_trigger=files_per_batch)
    q = ingest_sensors(stream, sink, bad, scratch_path(spark, "sensor-checkpoint"), dedup_delay=dedup_delay)
    q.awaitTermination()
    good = spark.read.parquet(sink).select(*READING_COLUMNS, F.lit(None).cast("string").alias("raw"),
                                           F.lit(None).cast("string").alias("reject_reason"))
    rejected = spark.read.parquet(bad).select(
        *[F.lit(None).cast(t).alias(c) for c, t in good.dtypes if c in READING_COLUMNS], "raw", "reject_reason")
    return good.unionByName(rejected)


def q_sensor_stream(spark, sf_dir):
    msgs = sensor_messages(spark, sf_dir).repartition(4, "event_id")
    return _run_stream(spark, msgs)


def q_compacted_readings(spark, sf_dir):
    """Two streams, the first one compacted before the second begins and both after it: every good reading once."""
    sink, bad, compacted = (scratch_path(spark, f"sensor-{x}") for x in ("out", "bad", "compacted"))
    msgs = sensor_messages(spark, sf_dir)
    for odd in (0, 1):
        src = scratch_path(spark, "sensor-in")
        part = msgs.where(F.col("event_id") % 2 == odd).repartition(4, "event_id")
        part.select("value").write.text(src)
        stream = read_sensor_stream(spark, fmt="text", path=src, max_files_per_trigger=1)
        ingest_sensors(stream, sink, bad, scratch_path(spark, "sensor-checkpoint")).awaitTermination()
        compact_readings(spark, sink, compacted)
        remove_compacted(spark, sink, compacted)
    return read_readings(spark, sink, compacted)


def q_sensor_dedup_stream(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    msg = F.concat(F.lit('{"sensor_id": '), _s("event_id"), F.lit(', "temperature": '), _s("value"),
                   F.lit(', "humidity": '), _s(F.col("value") + 1.0), F.lit(', "timestamp": "'), ts, F.lit('"}'))
    first = e.select("event_id", msg.alias("value"), F.lit(0).alias("copy"))
    replay = e.where(F.col("event_type") == "view").select("event_id", msg.alias("value"), F.lit(1).alias("copy"))
    # Broken messages, also with the key of a good one: none may be lost, none may displace it.
    broken = e.where(F.col("event_type") == "error").select("event_id", F.explode(F.array(
        F.concat(F.lit("broken "), _s("event_id")), F.concat(F.lit("broken "), _s("event_id")),
        F.concat(F.lit('{"sensor_id": '), _s("event_id"), F.lit(', "temperature": "hot", "humidity": 1.0, "timestamp": "'),
                 ts, F.lit('"}')))).alias("value"), F.lit(2).alias("copy"))
    msgs = first.unionByName(replay).unionByName(broken).repartition(4, "copy", "event_id")
    return _run_stream(spark, msgs, dedup_delay="45 days", files_per_batch=2)


def q_published_readings(spark, sf_dir):
    """The producer's messages through files: measurements rounded, a missing one written as null."""
    e = _t(spark, sf_dir, "events")
    readings = e.select(
        F.col("event_id").alias("sensor_id"), (F.col("value") / 3).alias("temperature"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("humidity"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    path = scratch_path(spark, "published-readings")
    publish_readings(readings, fmt="text", path=path)
    return parse_sensor_messages(spark.read.text(path)).select(
        "sensor_id", F.round(F.col("temperature") * 100).cast("long").alias("hundredths"), "humidity", "timestamp",
        F.array_contains(F.json_object_keys("raw"), "humidity").alias("has_humidity"), "reject_reason")


def _roundtrip(spark, sf_dir, name, fmt):
    df = _t(spark, sf_dir, name)
    path = scratch_path(spark, f"roundtrip-{fmt}")
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
        return read_csv(spark, path, df.schema)
    if fmt == "json":
        df.write.mode("overwrite").json(path)
        return read_json_documents(spark, path, schema=df.schema, multi_line=False)
    return read_parquet(spark, write_staging(df, path))


def q_source_roundtrip_json(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "part", "json")


def q_source_roundtrip_csv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "supplier", "csv")


def q_source_roundtrip_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "orders", "parquet")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_then_dropna": q_dedup_then_dropna,
    "dropna_then_dedup": q_dropna_then_dedup,
    "dedup_documents": q_dedup_documents,
    "required_fields": q_required_fields,
    "canonical_projection": q_canonical_projection,
    "journal_name": q_journal_name,
    "publication_date": q_publication_date,
    "quartile_from_score": q_quartile_from_score,
    "normalize_quartile": q_normalize_quartile,
    "issn_dispatch": q_issn_dispatch,
    "quartils_dispatch": q_quartils_dispatch,
    "filter_quartiles": q_filter_quartiles,
    "last_quartile": q_last_quartile,
    "first_wins_dim": q_first_wins_dim,
    "author_dim": q_author_dim,
    "upsert_quartile": q_upsert_quartile,
    "fact_load": q_fact_load,
    "author_bridge": q_author_bridge,
    "star_author_dim": q_author_dim_star,
    "star_journal_dim": q_journal_dim_star,
    "star_journal_quartile": q_journal_quartile_star,
    "date_dim": q_date_dim,
    "quarantine_split": q_quarantine_split,
    "append_fact": q_append_fact,
    "idempotent_fact": q_idempotent_fact,
    "pubs_per_year": q_pubs_per_year,
    "top_authors": q_top_authors,
    "quartile_change": q_quartile_change,
    "index_share": q_index_share,
    "length_check": q_length_check,
    "fk_check": q_fk_check,
    "json_roundtrip": q_json_roundtrip,
    "users_explode": q_users_explode,
    "sensor_batch": q_sensor_batch,
    "sensor_stream": q_sensor_stream,
    "sensor_dedup_stream": q_sensor_dedup_stream,
    "compacted_readings": q_compacted_readings,
    "source_roundtrip_json": q_source_roundtrip_json,
    "source_roundtrip_csv": q_source_roundtrip_csv,
    "source_roundtrip_parquet": q_source_roundtrip_parquet,
    "clean_job": q_clean_job,
    "star_job": q_star_job,
    "salted_fact_load": q_salted_fact_load,
    "journal_match_lower": q_journal_match_lower,
    "journal_match_facts": q_journal_match_facts,
    "warehouse_two_loads": q_warehouse_two_loads,
    "warehouse_tables": q_warehouse_tables,
    "orphan_split": q_orphan_split,
    "merge_touched": q_merge_touched,
    "preview": q_preview,
    "typed_parquet": q_typed_parquet,
    "published_readings": q_published_readings,
    "strict_quarantine": q_strict_quarantine,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the publication star load on sf0.001 (facts with journals)."""
    return q_fact_load(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


from oracle_sql import ORACLE_SQL  # noqa: E402

_ORACLES: dict[str, str] = dict(ORACLE_SQL)

# The training-data operators are an optional part: their folder and the corpus
# pipeline can be absent. Only their own absence is excused.
try:
    import corpus_pipeline
    from citeloom.llm.queries import ORACLE_SQL as _LLM_SQL
    from citeloom.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "citeloom.llm", "citeloom.llm.queries"):
        raise
else:
    _QUERIES |= _LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    _ORACLES |= _LLM_SQL
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _ORACLES.items() if k in _QUERIES}
