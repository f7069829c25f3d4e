"""Compaction of the sensor sink: closed micro-batches rewritten into day partitions.

The sink writes a folder a micro-batch, which a stream that runs for months
turns into a great many small files. ``compact_readings`` rewrites the batches
that are closed into ``compaction=<n>/day=<d>`` partitions, one file a day and
task at most, and then adds a row a stream to the list of compactions: how far
its batches are covered. Readers (``read_readings``) take the covered rows from
the listed compactions and the others from the batches, so they see every
reading once, before, while and after a compaction runs; one that died is not
listed and its files are never read, and the next one writes under a number of its own.

A stream's newest batch stays open: it is the only one that a restarted query
writes again. ``remove_compacted`` deletes the folders of covered batches, but
for those that the last compaction covered, which readers may still be at. One compaction runs at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.streaming.sensors import READING_COLUMNS

READINGS = "sensor_id bigint, temperature double, humidity double, timestamp string"
BATCHES = f"{READINGS}, stream_id string, batch_id bigint"
LISTED = "position bigint, compaction string, stream_id string, upto bigint"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows at a path; none if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as none:
        if "PATH_NOT_FOUND" not in (none.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def _listed(spark: SparkSession, compacted: str) -> list:
    """The list of compactions as it is now: a row a compaction and stream."""
    return _table(spark, f"{compacted}/listed", LISTED).collect()


def open_batches(spark: SparkSession, sink: str, listed: list) -> DataFrame:
    """The rows of batches that the listed compactions do not cover, with their stream and batch."""
    covered: dict[str, int] = {}
    for r in listed:
        covered[r["stream_id"]] = max(r["upto"], covered.get(r["stream_id"], -1))
    limits = F.broadcast(spark.createDataFrame(list(covered.items()), "stream_id string, upto bigint"))  # a row a stream
    return (_table(spark, sink, BATCHES).join(limits, "stream_id", "left")
            .where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))).drop("upto"))


def read_readings(spark: SparkSession, sink: str, compacted: str) -> DataFrame:
    """Every reading of the sink, each once, whatever has been compacted."""
    # The list is read once: what it names is complete, and what it does not name is still in the batches.
    listed = _listed(spark, compacted)
    still_open = open_batches(spark, sink, listed).select(*READING_COLUMNS)
    if not listed:
        return still_open
    done = _table(spark, f"{compacted}/readings", f"{READINGS}, compaction string, day string")
    names = sorted({r["compaction"] for r in listed})
    return done.where(F.col("compaction").isin(names)).select(*READING_COLUMNS).unionByName(still_open)


def compact_readings(spark: SparkSession, sink: str, compacted: str) -> int:
    """Rewrites the closed batches that are not covered yet. Returns how many batches it covered."""
    before = _listed(spark, compacted)
    rows = open_batches(spark, sink, before)
    newest = rows.groupBy("stream_id").agg(F.max("batch_id").alias("newest"))
    closed = rows.join(F.broadcast(newest), "stream_id").where("batch_id < newest").drop("newest")
    # One row a stream; partition columns only.
    upto = closed.groupBy("stream_id").agg(F.max("batch_id").alias("upto"), F.count_distinct("batch_id").alias("batches")).collect()
    if not upto:
        return 0
    name = uuid.uuid4().hex
    day = F.coalesce(F.substring("timestamp", 1, 10), F.lit("unknown"))
    limits = F.broadcast(spark.createDataFrame([(r["stream_id"], r["upto"]) for r in upto], "stream_id string, upto bigint"))
    # A batch that closes meanwhile is left to the next compaction.
    taken = rows.join(limits, "stream_id").where("batch_id <= upto").select(*READING_COLUMNS)
    (taken.withColumns({"compaction": F.lit(name), "day": day}).repartition("day")
     .write.mode("append").partitionBy("compaction", "day").parquet(f"{compacted}/readings"))
    position = max((r["position"] for r in before), default=0) + 1
    listed = spark.createDataFrame([(position, name, r["stream_id"], r["upto"]) for r in upto], LISTED)
    listed.coalesce(1).write.mode("append").parquet(f"{compacted}/listed")  # one file: all of it is visible, or nothing
    return sum(r["batches"] for r in upto)


def remove_compacted(spark: SparkSession, sink: str, compacted: str) -> int:
    """Deletes the folders of batches that compactions before the last one covered. Returns their number."""
    listed = _table(spark, f"{compacted}/listed", LISTED)
    last = listed.agg(F.max("position")).first()[0]
    before = listed.where(F.col("position") < F.lit(last)).groupBy("stream_id").agg(F.max("upto").alias("upto"))
    gone = (_table(spark, sink, BATCHES).select("stream_id", "batch_id").distinct()
            .join(F.broadcast(before), "stream_id").where("batch_id <= upto").collect())  # folders, not rows
    for r in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/stream_id={r['stream_id']}/batch_id={r['batch_id']}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(gone)
