"""Canonical schemas of the inputs and of the star schema the loader produces."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw publication document as it lands. Fields whose JSON type varies from
# document to document (Authors, ISSN, Quartils) are read as text: Spark's JSON
# reader keeps the raw JSON of an array/object in a STRING field, so the
# meaning of a field never depends on its neighbours in the batch.
PUBLICATION_RAW = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("DOI", T.StringType()),
    T.StructField("Authors", T.StringType()),
    T.StructField("Publication Date", T.StringType()),
    T.StructField("ISSN", T.StringType()),
    T.StructField("Link", T.StringType()),
    T.StructField("Quartils", T.StringType()),
    T.StructField("journal_main", T.StringType()),
    T.StructField("abstract", T.StringType()),
])

REQUIRED_KEYS = ("Title", "DOI", "Authors")
# Column carrying the outcome of the required-keys check from read to load.
REQUIRED_REASON_COL = "__required_reason"
CLEAN_REQUIRED = ("Title", "DOI", "Publication Date")

DIM_AUTHOR = T.StructType([
    T.StructField("author_id", T.LongType()),
    T.StructField("author_name", T.StringType()),
    T.StructField("affiliation", T.StringType()),
    T.StructField("country", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.LongType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])

DIM_JOURNAL = T.StructType([
    T.StructField("journal_id", T.LongType()),
    T.StructField("journal_main", T.StringType()),
    T.StructField("issn", T.StringType()),
    T.StructField("quartils", T.StringType()),
])

JOURNAL_QUARTILE = T.StructType([
    T.StructField("quartil_id", T.LongType()),
    T.StructField("annee", T.StringType()),
    T.StructField("quartil", T.StringType()),
    T.StructField("id_journal", T.LongType()),
])

FACT_PUBLICATION = T.StructType([
    T.StructField("publication_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("publication_date", T.DateType()),
    T.StructField("link", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("journal_id", T.LongType()),
    T.StructField("quartils", T.StringType()),
])

PUBLICATION_AUTHOR = T.StructType([
    T.StructField("publication_id", T.LongType()),
    T.StructField("author_id", T.LongType()),
])

STAR_TABLES = {
    "dim_author": DIM_AUTHOR,
    "dim_date": DIM_DATE,
    "dim_journal": DIM_JOURNAL,
    "journal_quartile": JOURNAL_QUARTILE,
    "fact_publication": FACT_PUBLICATION,
    "publication_author": PUBLICATION_AUTHOR,
}

#: Rows that a load could not place: articles with their reason, and landing lines that are no documents.
QUARANTINE = (
    "load_order string, title string, doi string, authors array<string>, publication_date_text string, "
    "publication_date date, link string, abstract string, journal_line string, journal_name string, issn string, "
    "quartils_kind string, journal_flag string, quartile_items array<struct<pos:int,annee:string,quartil:string>>, "
    "last_quartil string, reject_reason string, reject_stage string")
QUARANTINE_LANDING = "value string, reject_reason string"
QUARANTINE_ORPHANS = "table_name string, foreign_key string, key_value string, reject_reason string"

# Target column widths of the warehouse DDL (varchar(n)); checked only when a
# load asks for it, since file tables do not enforce them.
COLUMN_LIMITS = {
    "author_name": 100,
    "journal_main": 255,
    "issn": 50,
    "title": 255,
    "doi": 100,
    "link": 255,
    "annee": 4,
    "quartil": 255,
}

SENSOR_MESSAGE = T.StructType([
    T.StructField("sensor_id", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

SENSOR_READING = T.StructType([
    T.StructField("sensor_id", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])


def empty_table(spark, name: str):
    return spark.createDataFrame([], STAR_TABLES[name])
