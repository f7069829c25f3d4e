"""Fact-side operators: foreign-key resolution, bridge rows, appends, checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_key(df: DataFrame, dim: DataFrame, natural_key: str, dim_natural_key: str,
                key_col: str, how: str = "inner", salt_buckets: int | None = None,
                salt_by: str | None = None, match: Callable[[Column], Column] | None = None) -> DataFrame:
    """Attach the dimension's surrogate key by natural key.

    The dimension has one row per key. By default AQE decides: it broadcasts
    the dimension when its runtime size is under the threshold, otherwise it
    sort-merge joins and splits oversized partitions of ``df`` (skew join).
    With ``salt_buckets`` the join is salted explicitly: each fact row gets a
    bucket from a hash of ``salt_by`` (a column unique per row, so reruns
    give the same bucket) and each dimension row is replicated once per
    bucket, so one natural key holding a third of the facts is spread over
    ``salt_buckets`` tasks whatever the AQE thresholds are. ``match`` compares
    the keys through a function (see ``lookup_or_insert``).
    """
    same = match or (lambda c: c)
    lookup = dim.select(same(F.col(dim_natural_key)).alias("__nk"), F.col(key_col))
    if match is not None:  # several spellings may match: the oldest row stands for them
        lookup = lookup.groupBy("__nk").agg(F.min(key_col).alias(key_col))
    if salt_buckets and not salt_by:
        raise ValueError("salt_by must name a column that is unique per row")
    if not salt_buckets:
        return df.join(lookup, same(F.col(natural_key)) == F.col("__nk"), how).drop("__nk")
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt_buckets)))
    replicated = lookup.withColumn("__salt2", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
    cond = (same(F.col(natural_key)) == F.col("__nk")) & (F.col("__salt") == F.col("__salt2"))
    return salted.join(replicated, cond, how).drop("__nk", "__salt", "__salt2")


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, salt_buckets: int, salt_by: str) -> DataFrame:
    """Facts with their dimension's attributes, by surrogate key, salted as in ``resolve_key``: a
    dimension row that a third of the facts point to is read by ``salt_buckets`` tasks."""
    salted = fact.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt_buckets)))
    copies = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
    return salted.join(copies, [key, "__salt"]).drop("__salt")


def bridge_rows(keyed: DataFrame, key_col: str, names_col: str, dim: DataFrame,
                dim_name: str, dim_key: str, salt_buckets: int | None = None) -> DataFrame:
    """Many-to-many rows (fact key, dimension key) from an array of names
    (``salt_buckets``: see ``resolve_key``; the fact key is the salt source)."""
    pairs = (keyed.select(F.col(key_col), F.explode(F.col(names_col)).alias("__name"))
             .where(F.col("__name").isNotNull()))
    joined = resolve_key(pairs, dim, "__name", dim_name, dim_key, salt_buckets=salt_buckets, salt_by=key_col)
    return joined.select(key_col, dim_key).distinct()


def not_loaded(new: DataFrame, existing: DataFrame, natural_keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose natural key (NULL-safe equality) is not in ``existing``."""
    keys = existing.select(*[F.col(k).alias(f"__x_{k}") for k in natural_keys])
    cond = None
    for k in natural_keys:
        c = F.col(k).eqNullSafe(F.col(f"__x_{k}"))
        cond = c if cond is None else cond & c
    return new.join(keys, cond, "left_anti")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row. (An anti join
    needs no distinct parent keys, so none is computed: that would be a shuffle
    of the parent for nothing.)"""
    parents = parent.select(F.col(parent_key).alias("__pk"))
    return (child.where(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == F.col("__pk"), "left_anti"))
