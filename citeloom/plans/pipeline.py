"""The daily batch as one job: read -> clean -> stage -> normalize -> load -> publish."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citeloom.plans.clean import clean_counts, clean_observations, clean_publications
from citeloom.plans.integrity import split_orphans
from citeloom.plans.normalize import normalize_publications
from citeloom.plans.star import load_star
from citeloom.schemas import REQUIRED_REASON_COL
from citeloom.session import scratch_path
from citeloom.sources.readers import read_publications
from citeloom.sources.sinks import (claim_load, publish_load, published_loads, read_current, release_claim,
                                    write_staging)

#: Numbers the rows of a decoded landing table.
DECODED_ID = "__decoded_id"
NOT_AN_OBJECT = "not_an_object"


def decode_landing(spark: SparkSession, landing: str, fmt: str = "json", options: Mapping[str, str] | None = None,
                   required: str = "present") -> DataFrame:
    """The landing data, read and decoded once, as a written table: publication records, and beside
    them (``raw``) the text of lines that are no JSON object at all. ``DECODED_ID`` numbers the rows."""
    rows = read_publications(spark, landing, fmt=fmt, options=options, required=required, keep_raw=True)
    path = scratch_path(spark, "decoded")
    rows.withColumn(DECODED_ID, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def landing_rejects(decoded: DataFrame) -> DataFrame:
    """Landing lines that are not JSON objects (unparseable or another JSON type): the clean step would
    drop them silently as untitled, so they go to quarantine, raw text and reason."""
    return decoded.where(F.col(REQUIRED_REASON_COL) == NOT_AN_OBJECT).select(
        F.col("raw").alias("value"), F.col(REQUIRED_REASON_COL).alias("reject_reason"))


def stage_decoded(decoded: DataFrame, staging: str | None = None, order: str = "dedupe_first",
                  counts: dict[str, int] | None = None) -> DataFrame:
    """E1 on ``decode_landing`` rows that are objects: cleaned, written to a run-scoped staging path and read back."""
    spark = decoded.sparkSession
    seen = clean_observations()
    objects = decoded.where(F.coalesce(F.col(REQUIRED_REASON_COL) != NOT_AN_OBJECT, F.lit(True))).drop("raw")
    cleaned = clean_publications(objects, order=order, observations=seen, row_id=DECODED_ID).drop(DECODED_ID)
    path = write_staging(cleaned, staging or scratch_path(spark, "staging"))
    if counts is not None:
        counts.update(clean_counts(seen, order))
    return spark.read.schema(cleaned.schema).parquet(path)


def stage_clean(spark: SparkSession, landing: str, staging: str | None = None, fmt: str = "json",
                options: Mapping[str, str] | None = None, order: str = "dedupe_first",
                required: str = "present", counts: dict[str, int] | None = None) -> DataFrame:
    """E1: clean the landing data and write it to a run-scoped staging path,
    then read it back (the staging file cuts the lineage). ``counts`` is filled
    with the records read, dropped (duplicates, incomplete) and kept."""
    return stage_decoded(decode_landing(spark, landing, fmt, options, required), staging, order, counts)


def run_batch(spark: SparkSession, landing: str, warehouse: str, version: str, fmt: str = "json",
              options: Mapping[str, str] | None = None, order: str = "dedupe_first",
              journal_from: str = "title", strict_parity: bool = False,
              normalize_quartiles: bool = False, length_check: bool = False,
              idempotent: bool = False, salt_buckets: int | None = None,
              journal_match: str = "exact", retry: bool = False, counts: dict[str, int] | None = None) -> int:
    """E1 -> E3: one load appended to the warehouse (a database of ``create_tables``). Returns its number.

    The load claims its number before any work: one that is published already, or that another
    load holds, is refused (see ``sinks``). A load that raises gives its claim back; one whose
    driver died can be run again with ``retry``. ``counts`` is filled with what happened to the
    records: ``landing = not_objects + duplicates + incomplete + rejected + already_loaded +
    loaded``, and ``orphans``, rows of the load whose foreign key has no parent.
    """
    base = len(published_loads(spark, warehouse))
    number = claim_load(spark, warehouse, version, base, retry)
    try:
        decoded = decode_landing(spark, landing, fmt=fmt, options=options)
        seen: dict[str, int] = {}
        staged = stage_decoded(decoded, order=order, counts=seen)
        articles = normalize_publications(staged, journal_from=journal_from, strict_parity=strict_parity,
                                          normalize_quartiles=normalize_quartiles,
                                          length_check=length_check)
        current = read_current(spark, warehouse)
        tables = load_star(articles, current, idempotent=idempotent,
                           salt_buckets=salt_buckets, journal_match=journal_match).build_all(added=True)
        added, orphans = split_orphans({name: tables.added(name) for name in tables}, current)
        outputs = {**added, "quarantine_landing": landing_rejects(decoded), "quarantine_orphans": orphans}
        watched = {n: Observation() for n in ("fact_publication", "quarantine", "quarantine_landing", "quarantine_orphans")}
        publish_load({n: df.observe(watched[n], F.count(F.lit(1)).alias("n")) if n in watched else df
                      for n, df in outputs.items()}, spark, warehouse, version, base, claimed=number)
    except BaseException:
        release_claim(spark, warehouse)
        raise
    if counts is not None:
        n = {name: o.get["n"] for name, o in watched.items()}
        counts.update({
            "landing": seen["read"] + n["quarantine_landing"], "not_objects": n["quarantine_landing"],
            "duplicates": seen["duplicates"], "incomplete": seen["incomplete"], "rejected": n["quarantine"],
            "loaded": n["fact_publication"], "already_loaded": seen["kept"] - n["quarantine"] - n["fact_publication"], "orphans": n["quarantine_orphans"]})
    return number


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` records (in load order) for a look at the decoded output."""
    return df.orderBy(F.col("load_order")).limit(n)
