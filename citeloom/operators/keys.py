"""Dense surrogate keys without a global single-partition sort.

``row_number() over (order by k)`` moves every row to one task. Here:

1. range-partition the new rows on the ordering columns (AQE picks the
   partition count from the data) and sort each partition (a distributed sort),
2. ``checkpoint()`` the result into the shared checkpoint folder, so the
   partition a row sits in and its position there are fixed facts that a lost
   executor cannot change on recomputation (range bounds come from sampling,
   which could differ on a rerun),
3. count rows per partition (one row per partition reaches the driver; the
   current maximum key of the table being extended is read in the same job),
4. key = start + rows in earlier partitions + position in the partition + 1,
   where the per-partition offsets are a broadcast table whose size is the
   number of partitions, not the number of rows.

The result equals ``start + row_number() over (order by order_by)`` when the
ordering columns are unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.session import shared_root

_ROW_BITS = 33  # monotonically_increasing_id = partition << 33 | row position


def assign_keys(df: DataFrame, key_col: str, order_by: Sequence[str], start: int = 0,
                num_partitions: int | None = None, after: DataFrame | None = None) -> DataFrame:
    """Keys ``start + 1, start + 2, ...`` in ``order_by`` order; with ``after``
    (a table holding ``key_col``) numbering continues after its largest key,
    read in the same job as the partition counts."""
    spark = df.sparkSession
    shared_root(spark)
    order = [F.col(f"`{c}`") for c in order_by]
    # Without an explicit count AQE sizes the range partitions from the data
    # (it merges neighbouring ranges, so order is kept): a few hundred new
    # dimension rows do not turn into thousands of empty partitions and files.
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    fixed = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = fixed.select("*", F.spark_partition_id().alias("__pid"),
                          F.monotonically_increasing_id().alias("__mid"))
    stats = tagged.groupBy("__pid").agg(F.count(F.lit(1)).cast("long").alias("__n"))
    if after is not None:  # one extra row: pid -1 carries the current maximum key
        stats = stats.unionByName(after.agg(F.lit(-1).alias("__pid"),
                                            F.coalesce(F.max(key_col), F.lit(0)).cast("long").alias("__n")))
    counts = sorted((r["__pid"], r["__n"]) for r in stats.collect())
    if counts and counts[0][0] == -1:
        start = int(counts.pop(0)[1])
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    offset_schema = T.StructType([T.StructField("__pid", T.IntegerType(), False),
                                  T.StructField("__off", T.LongType(), False)])
    # At most one row per partition: a proven bound, safe to broadcast.
    offset_df = F.broadcast(spark.createDataFrame(offsets, offset_schema))
    position = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _ROW_BITS)
    key = (F.lit(start).cast("long") + F.col("__off") + position + F.lit(1)).alias(key_col)
    return (tagged.join(offset_df, "__pid", "inner")
            .select(key, *[F.col(f"`{c}`") for c in df.columns if c != key_col]))
