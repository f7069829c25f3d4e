"""Reports over the star schema (grouped counts, top-n, year-over-year change).

The warehouse was built for these reports but the original defined none;
they are the straightforward questions its tables answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def publications_per_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Publications per year and quartile label (partial counts map-side)."""
    # Count by date first (partial counts map-side): the join then sees one row per date and
    # label, however many publications share a date.
    daily = fact.groupBy("publication_date", "quartils").agg(F.count(F.lit(1)).alias("n"))
    dated = daily.join(dim_date.select(F.col("full_date").alias("publication_date"), "year"), "publication_date")
    return dated.groupBy("year", "quartils").agg(F.sum("n").alias("n_publications"))


def top_authors(bridge: DataFrame, dim_author: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` authors with most publications (ties: name, then key)."""
    counts = bridge.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_publications"))
    named = counts.join(dim_author.select("author_id", "author_name"), "author_id", "inner")
    return (named.orderBy(F.col("n_publications").desc(), F.col("author_name"), F.col("author_id"))
            .limit(n).select("author_id", "author_name", "n_publications"))


def quartile_changes(journal_quartile: DataFrame) -> DataFrame:
    """Years in which a journal's quartile differs from its previous year.
    A journal's window holds one row per year, so no window partition grows
    with the number of publications."""
    w = Window.partitionBy("id_journal").orderBy("annee")
    return (journal_quartile
            .select("id_journal", "annee", "quartil", F.lag("quartil").over(w).alias("previous_quartil"))
            .where(F.col("previous_quartil").isNotNull() & (F.col("previous_quartil") != F.col("quartil"))))


def index_share(dim_journal: DataFrame) -> DataFrame:
    """Indexed vs not-indexed journals: count and share of all journals."""
    counts = dim_journal.groupBy("quartils").agg(F.count(F.lit(1)).alias("n_journals"))
    total = F.sum("n_journals").over(Window.partitionBy())
    return counts.select("quartils", "n_journals", (F.col("n_journals") / total).alias("share"))
