"""E1: remove repeated titles and incomplete records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from citeloom.operators.dedupe import drop_incomplete, drop_rows, keep_first, repeated_rows
from citeloom.schemas import CLEAN_REQUIRED


def clean_publications(df: DataFrame, order: str = "dedupe_first", key: str = "Title",
                       order_by: Sequence[str] = ("_id",),
                       required: Sequence[str] = CLEAN_REQUIRED,
                       observations: Mapping[str, Observation] | None = None,
                       row_id: str | None = None) -> DataFrame:
    """One record per ``key`` (the lowest ``order_by`` survives), then drop
    records with a NULL in ``required``.

    ``order="dedupe_first"`` is the original order: a title disappears when
    its surviving copy lacks a DOI even if another copy has one.
    ``order="filter_first"`` filters before deduplicating.

    NULL keys form one group like any other; partial aggregation reduces it
    to one row per map task, so it never lands whole in one task. (A separate
    ``key IS NOT NULL`` filter is not added: Catalyst would push it below the
    JSON decoding and decode every record twice.)

    ``observations`` (``clean_observations()``) count the records before,
    between and after the two steps in the job that writes the result.
    ``row_id`` names a stored column that numbers the rows: repeated records
    are then found on narrow rows (``repeated_rows``).
    """
    if order not in ("dedupe_first", "filter_first"):
        raise ValueError(f"unknown order {order!r}")

    def counted(d: DataFrame, place: str) -> DataFrame:
        return d.observe(observations[place], F.count(F.lit(1)).alias("n")) if observations else d

    def dedupe(d: DataFrame, plain: DataFrame) -> DataFrame:
        if row_id is None:
            return keep_first(d, [key], list(order_by))
        return drop_rows(d, repeated_rows(plain, [key], list(order_by), row_id), row_id)

    # ``plain`` is the same without counters: the narrow scan reads few columns and counts nothing.
    out, plain = counted(df, "read"), df
    if order == "dedupe_first":
        out = counted(dedupe(out, plain), "between")
        return counted(drop_incomplete(out, required), "kept")
    out, plain = counted(drop_incomplete(out, required), "between"), drop_incomplete(plain, required)
    return counted(dedupe(out, plain), "kept")


def clean_observations() -> dict[str, Observation]:
    return {place: Observation() for place in ("read", "between", "kept")}


def clean_counts(observations: Mapping[str, Observation], order: str = "dedupe_first") -> dict[str, int]:
    """Records read, dropped as duplicates, dropped as incomplete, and kept: read = the other three."""
    read, between, kept = (observations[p].get["n"] for p in ("read", "between", "kept"))
    first, second = read - between, between - kept
    repeated, incomplete = (first, second) if order == "dedupe_first" else (second, first)
    return {"read": read, "duplicates": repeated, "incomplete": incomplete, "kept": kept}
