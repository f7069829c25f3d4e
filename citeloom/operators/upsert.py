"""MERGE (update when matched, insert when not) as a set operation.

Source rows are first reduced to one per merge key, the last writer winning
(``max_by`` on the load order, combined map-side). Target and reduced source
then hold at most one row per key each, so their full outer join has no hot
key. Matched keys keep their surrogate key and take the source values;
unmatched source keys get new keys in order of their first appearance.

``merge_touched`` rewrites only the buckets of the target that the source has
rows of, for targets that are partitioned by bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.keys import assign_keys


def merge_last_wins(target: DataFrame, source: DataFrame, keys: Sequence[str],
                    values: Sequence[str], order_by: Sequence[str], key_col: str,
                    after: DataFrame | None = None) -> DataFrame:
    """The target after the merge. New keys follow the largest of ``after`` (the target itself, unless
    that is a part of a table)."""
    order = F.struct(*[F.col(c) for c in order_by])
    reduced = (source.groupBy(*keys)
               .agg(F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("__last"),
                    F.min(order).alias("__first"))
               .select(*keys, *[F.col(f"__last.{v}").alias(f"__src_{v}") for v in values],
                       "__first", F.lit(True).alias("__matched_src")))
    joined = target.join(reduced, list(keys), "full_outer")
    from_source = F.coalesce(F.col("__matched_src"), F.lit(False))
    merged = joined.select(
        F.col(key_col), *keys,
        *[F.when(from_source, F.col(f"__src_{v}")).otherwise(F.col(v)).alias(v) for v in values],
        "__first")
    kept = merged.where(F.col(key_col).isNotNull()).drop("__first")
    new = merged.where(F.col(key_col).isNull()).drop(key_col)
    keyed = assign_keys(new, key_col, ["__first"], after=target if after is None else after)
    return kept.unionByName(keyed.drop("__first")).select(*target.columns)


def merge_touched(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str],
                  order_by: Sequence[str], key_col: str, bucket: Callable[[], Column],
                  bucket_col: str | None = None) -> DataFrame:
    """The rows, after the merge, of those buckets of the target that the source touches.

    ``bucket()`` is a row's bucket, of the columns that target and source share; ``bucket_col`` is
    the target's partition column of that value, which prunes the buckets that are not read. The
    touched buckets reach the driver, as many as there are buckets at most.
    """
    touched = [r["b"] for r in source.select(bucket().alias("b")).distinct().collect()]
    place = F.col(bucket_col) if bucket_col else bucket()
    part = target.where(place.isin(touched)) if touched else target.limit(0)
    return merge_last_wins(part.drop(bucket_col) if bucket_col else part, source, keys, values, order_by, key_col,
                           after=target)
