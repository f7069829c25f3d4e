"""Set-based lookup-or-insert for dimension tables.

Per record the pipeline looked a name up and inserted it when absent; the
first record to mention a name decided its attributes. As a set operation:
pick the first writer per natural key (map-side combined), anti-join the
existing dimension, give the survivors keys after the current maximum, and
union. Existing rows are never updated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.dedupe import keep_first
from citeloom.operators.keys import assign_keys


def lookup_or_insert(existing: DataFrame, candidates: DataFrame, natural_key: str,
                     key_col: str, order_by: Sequence[str] | None = None,
                     match: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(dimension, inserted)``.

    ``candidates`` carries ``natural_key``, the dimension's attribute columns and,
    when ``order_by`` is given, the load-order columns: the earliest candidate
    of a key wins and new keys follow first appearance. Without ``order_by``
    candidates are distinct values and keys follow the natural key.
    """
    attrs = [c for c in existing.columns if c != key_col]
    present = candidates.where(F.col(natural_key).isNotNull())
    group = natural_key
    existing_keys = existing.select(natural_key)
    if match is not None:
        present = present.withColumn("__match", match(F.col(natural_key)))
        existing_keys = existing.select(match(F.col(natural_key)).alias("__match"))
        group = "__match"
    if order_by:
        winners = keep_first(present, [group], order_by)
        key_order = list(order_by)
    else:
        winners = present.select(*attrs, *([group] if match is not None else [])).dropDuplicates([group])
        key_order = [natural_key]
    new = winners.join(existing_keys, group, "left_anti")
    keyed = assign_keys(new, key_col, key_order, after=existing)
    inserted = keyed.select(*existing.columns)
    return existing.unionByName(inserted), inserted
