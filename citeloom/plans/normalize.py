"""E2: decode cleaned publication records into typed articles.

One projection, no shuffle: every rule is a column expression, and each
record gets at most one ``reject_reason`` with the stage at which the
original per-record loop would have failed. ``before_journal`` failures
create nothing; ``after_journal`` failures still create the journal and merge
its quartiles but lose the publication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import (authors_array, decode_list, extract_journal_name, issn_value,
                                journal_flag, last_item_not_object, last_quartil, normalize_quartile,
                                parse_day_month_year, publication_date_text, quartile_items, quartils_kind)
from citeloom.operators.validate import canonical_projection, first_reason
from citeloom.schemas import COLUMN_LIMITS, REQUIRED_REASON_COL

ARTICLE_COLUMNS = [
    "load_order", "title", "doi", "authors", "publication_date_text", "publication_date",
    "link", "abstract", "journal_line", "journal_name", "issn", "quartils_kind",
    "journal_flag", "quartile_items", "last_quartil", "reject_reason", "reject_stage",
]


def _too_long(c, n):
    return F.coalesce(F.length(c) > n, F.lit(False))


def normalize_publications(df: DataFrame, journal_from: str = "title",
                           strict_parity: bool = False, normalize_quartiles: bool = False,
                           length_check: bool = False) -> DataFrame:
    """Cleaned raw records -> articles (see ``ARTICLE_COLUMNS``).

    * ``journal_from="title"``: the journal line is "Published in: " + title,
      as the original pipeline built it; ``"field"`` uses the source's own
      ``journal_main``.
    * ``strict_parity``: quarantine what the original loop lost after creating
      the journal (a non-empty text ``Quartils``; a list whose last item is not
      an object). Otherwise those load with quartile 'Non disponible'.
    * ``normalize_quartiles``: map numeric quartile scores to Q1..Q4.
    * ``length_check``: enforce the warehouse column widths.
    """
    canon = canonical_projection(df, carry=[REQUIRED_REASON_COL])
    if REQUIRED_REASON_COL in df.columns:
        canon = canon.withColumnRenamed(REQUIRED_REASON_COL, "__required")
    else:
        canon = canon.withColumn("__required", F.lit(None).cast("string"))

    line = F.col("journal_main_line") if journal_from == "title" else F.col("journal_main")
    # Each field is parsed once here; the rules below reuse the parsed values.
    parsed = canon.select(
        "*",
        publication_date_text(F.col("`Publication Date`")).alias("__date_text"),
        decode_list("Quartils").alias("__elements"),
        extract_journal_name(line).alias("__journal_name"),
        line.alias("__journal_line"))
    kind = quartils_kind("Quartils", "__elements")
    date = F.when(F.col("__date_text") != "", parse_day_month_year(F.col("__date_text")))
    dated = parsed.select("*", date.alias("__date"))
    staged = dated.select(
        F.col("_id").alias("load_order"),
        F.col("Title").alias("title"),
        F.col("DOI").alias("doi"),
        authors_array(F.col("Authors")).alias("authors"),
        F.col("__date_text").alias("publication_date_text"),
        F.col("__date").alias("publication_date"),
        ((F.col("__date_text") != "") & F.col("__date").isNull()).alias("__bad_date"),
        F.col("Link").alias("link"),
        F.col("abstract"),
        F.col("__journal_line").alias("journal_line"),
        F.col("__journal_name").alias("journal_name"),
        issn_value(F.col("ISSN")).alias("issn"),
        kind.alias("quartils_kind"),
        (F.col("Quartils") != "").alias("__nonempty_text"),
        F.col("quartils_defaulted"),
        "__elements",
        F.col("__required"),
    )
    items = quartile_items(F.col("__elements"))
    last = last_quartil(F.col("__elements"))
    if normalize_quartiles:
        items = F.transform(items, lambda s: s.withField("quartil", normalize_quartile(s["quartil"])))
        last = normalize_quartile(last)

    before = [
        (F.col("__required").isNotNull(), None),
        (F.col("__bad_date"), "unparseable_publication_date"),
        (F.col("journal_name").isNull(), "journal_name_missing"),
    ]
    after = []
    if length_check:
        before += [(_too_long(F.col("journal_name"), COLUMN_LIMITS["journal_main"]), "journal_main_too_long"),
                   (_too_long(F.col("issn"), COLUMN_LIMITS["issn"]), "issn_too_long")]
    if strict_parity:
        after += [((F.col("quartils_kind") == "string") & ~F.col("quartils_defaulted")
                   & F.col("__nonempty_text"), "quartils_not_a_list"),
                  ((F.col("quartils_kind") == "list") & last_item_not_object(F.col("__elements")),
                   "last_quartil_not_an_object")]
    if length_check:
        after += [(_too_long(F.col("title"), COLUMN_LIMITS["title"]), "title_too_long"),
                  (_too_long(F.col("doi"), COLUMN_LIMITS["doi"]), "doi_too_long"),
                  (_too_long(F.col("link"), COLUMN_LIMITS["link"]), "link_too_long"),
                  (F.exists(F.col("authors"), lambda a: F.length(a) > COLUMN_LIMITS["author_name"]),
                   "author_name_too_long"),
                  (F.exists(items, lambda s: (F.length(s["annee"]) > COLUMN_LIMITS["annee"])
                            | (F.length(s["quartil"]) > COLUMN_LIMITS["quartil"])), "quartile_item_too_long")]
    before_reason = first_reason(*[(c, r) for c, r in before if r])
    before_reason = F.coalesce(F.col("__required"), before_reason)
    after_reason = first_reason(*after)
    reason = F.coalesce(before_reason, after_reason)
    stage = (F.when(before_reason.isNotNull(), F.lit("before_journal"))
             .when(after_reason.isNotNull(), F.lit("after_journal")))

    return staged.select(
        "load_order", "title", "doi", "authors", "publication_date_text", "publication_date",
        "link", "abstract", "journal_line", "journal_name", "issn", "quartils_kind",
        journal_flag(F.col("__elements")).alias("journal_flag"),
        items.alias("quartile_items"),
        last.alias("last_quartil"),
        reason.alias("reject_reason"),
        stage.alias("reject_stage"),
    )
