"""Validation: required keys, canonical projection, limits, quarantine split.

A record that fails a check is not dropped silently: it gets a
``reject_reason`` and goes to a quarantine dataset, so that
``good + quarantine = input`` holds for every step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.constants import QUARTILS_DEFAULT
from citeloom.functions.text import journal_line
from citeloom.schemas import REQUIRED_KEYS


def has_keys(json_text, keys: Sequence[str]) -> Column:
    """The text is a JSON object that contains every key (a null value counts)."""
    t = F.col(json_text) if isinstance(json_text, str) else json_text
    found = F.json_object_keys(t)
    cond = found.isNotNull()
    for k in keys:
        cond = cond & F.array_contains(found, F.lit(k))
    return F.coalesce(cond, F.lit(False))


def required_reason(json_text, keys: Sequence[str] = REQUIRED_KEYS) -> Column:
    """'not_an_object' / 'missing_required_keys' / NULL for a raw JSON record."""
    t = F.col(json_text) if isinstance(json_text, str) else json_text
    return (F.when(F.json_object_keys(t).isNull(), F.lit("not_an_object"))
            .when(~has_keys(t, keys), F.lit("missing_required_keys")))


def required_reason_from_keys(keys, required: Sequence[str] = REQUIRED_KEYS) -> Column:
    """Same as ``required_reason`` from the already extracted top-level keys
    (NULL when the record is not a JSON object), so the text is scanned once."""
    k = F.col(keys) if isinstance(keys, str) else keys
    present = F.lit(True)
    for key in required:
        present = present & F.array_contains(k, F.lit(key))
    return (F.when(k.isNull(), F.lit("not_an_object"))
            .when(~present, F.lit("missing_required_keys")))


def required_non_null_reason(keys: Sequence[str] = REQUIRED_KEYS) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"`{k}`").isNull()
        cond = c if cond is None else cond | c
    return F.when(cond, F.lit("missing_required_keys"))


def canonical_projection(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The nine canonical fields with their defaults.

    Absent fields are NULL in a typed frame. ``Quartils`` defaults to the
    not-indexed text; ``quartils_defaulted`` records that the default was
    used, so a later strict check can tell it from a real text value. The
    journal line is always built from the title ("None" for a NULL title, as
    Python's formatting would print it).
    """
    present = set(df.columns)

    def field(name: str) -> Column:
        return F.col(f"`{name}`") if name in present else F.lit(None).cast("string")

    return df.select(
        field("_id").alias("_id"),
        field("Title").alias("Title"),
        field("DOI").alias("DOI"),
        field("Authors").alias("Authors"),
        field("Publication Date").alias("Publication Date"),
        field("ISSN").alias("ISSN"),
        field("Link").alias("Link"),
        F.coalesce(field("Quartils"), F.lit(QUARTILS_DEFAULT)).alias("Quartils"),
        field("Quartils").isNull().alias("quartils_defaulted"),
        journal_line(F.coalesce(field("Title"), F.lit("None"))).alias("journal_main_line"),
        field("journal_main").alias("journal_main"),
        field("abstract").alias("abstract"),
        *[F.col(f"`{c}`") for c in carry if c in present],
    )


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The reason of the first failing check (checks run in pipeline order)."""
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr if expr is not None else F.lit(None).cast("string")


def split_quarantine(df: DataFrame, reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``; together they hold every input row exactly once."""
    return df.where(F.col(reason_col).isNull()), df.where(F.col(reason_col).isNotNull())
