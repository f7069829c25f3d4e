"""Distinct-on-key with a deterministic survivor.

``dropDuplicates`` keeps an arbitrary row per key. ``keep_first`` keeps the
row with the smallest ordering value instead, and is expressed as a
``min_by`` aggregate, which Spark evaluates partially on the map side: a hot
key (one title on a third of all rows) is reduced to one row per map task
before the shuffle, so no task ever receives the whole group. (A filter
``row_number() over (partition by key) = 1`` is cut per task before its
shuffle too; it sorts the whole rows on both sides as well.)

Where rows are wide and stored with a row id, ``repeated_rows`` finds the rows
that lose on digests of their keys alone, and ``drop_rows`` reads the wide rows
once, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order_by: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # A struct is never NULL, so rows with a NULL ordering value still compete
    # (NULL sorts first inside a struct).
    return F.struct(*cols)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
               last: bool = False) -> DataFrame:
    """One row per ``keys`` (NULL keys form one group, as in SQL GROUP BY):
    the row with the lowest ``order_by`` value, or the highest with ``last``."""
    cols = df.columns
    # The keys travel once, as the group.
    rest = [c for c in cols if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    pick = F.max_by(row, _order(order_by)) if last else F.min_by(row, _order(order_by))
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias("__row"))
            .select(*[(F.col(f"__row.`{c}`") if c in rest else F.col(f"`{c}`")).alias(c) for c in cols]))


def repeated_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], row_id: str) -> DataFrame:
    """The ``row_id`` of every row that ``keep_first`` drops, found without its other columns.

    Keys travel as 128-bit digests (NULL keys form one group); the winner of each is an aggregate
    that combines in each task, so a hot key is one row a task. ``row_id`` has to be a stored
    column, unique and the same in every scan.
    """
    digests = [F.coalesce(F.md5(F.col(f"`{k}`").cast("string")), F.lit("")) for k in keys]
    narrow = df.select(F.concat_ws(",", *digests).alias("__key"), _order([*order_by, row_id]).alias("__order"), row_id)
    winners = narrow.groupBy("__key").agg(F.min_by(row_id, "__order").alias(row_id))
    return narrow.select(row_id).join(winners, row_id, "left_anti")


def drop_rows(df: DataFrame, dropped: DataFrame, row_id: str) -> DataFrame:
    """``df`` without the rows whose id is in ``dropped``. The wide rows stay where they are if the
    dropped ids are few enough to broadcast, by their measured size."""
    return df.join(dropped, row_id, "left_anti").select(*df.columns)


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset`` (empty strings survive)."""
    return df.dropna(subset=list(subset))
