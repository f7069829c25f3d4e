"""Sensor message ingestion with Structured Streaming.

Source  : Kafka topic (``fmt="kafka"``) or a folder of JSON-lines files
          (``fmt="text"``), read from the earliest offset; progress lives in
          the query checkpoint instead of a consumer group.
Parse   : ``from_json`` with a fixed schema, key-presence checks on the raw
          text, timestamp text -> ISO-8601 with a literal 'Z'.
Sink    : ``foreachBatch`` writes good readings and quarantined messages
          into ``stream_id=<s>/batch_id=<n>`` partitions with dynamic overwrite, so a batch
          replayed after a failure replaces its own output (idempotent).
Optional: ``dropDuplicatesWithinWatermark`` on (sensor_id, timestamp); its
          state lies in RocksDB, outside the heap, with changelog checkpoints.
Counts  : ``observe`` on the stream before and after deduplication; a listener
          adds the micro-batches up (``stream_counts``).
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from citeloom.functions.dates import iso_utc_text, parse_sensor_timestamp
from citeloom.operators.validate import split_quarantine
from citeloom.schemas import SENSOR_MESSAGE

SENSOR_KEYS = ("sensor_id", "temperature", "humidity", "timestamp")
READING_COLUMNS = ["sensor_id", "temperature", "humidity", "timestamp"]
TOPIC = "sensor_data"


def _reason(raw: Column, ts: Column) -> Column:
    keys = F.json_object_keys(raw)
    expr = F.when(keys.isNull(), F.lit("malformed_or_not_an_object"))
    for k in SENSOR_KEYS:
        expr = expr.when(~F.array_contains(keys, F.lit(k)), F.lit(f"missing_{k}"))
    for k in ("sensor_id", "temperature", "humidity"):
        # A value that is there but not of its type would become NULL and pass.
        expr = expr.when(F.col(f"m.{k}").isNull() & F.get_json_object(raw, f"$.{k}").isNotNull(), F.lit(f"bad_{k}"))
    return expr.when(ts.isNull(), F.lit("bad_timestamp"))


def parse_sensor_messages(messages: DataFrame, value_col: str = "value",
                          source_tz: str | None = None) -> DataFrame:
    """Message text -> readings with ``reject_reason`` (batch or streaming).

    ``timestamp`` becomes ISO-8601 + 'Z' without zone conversion, unless
    ``source_tz`` names the producer's zone. ``event_time`` (TIMESTAMP) is
    kept for watermarking.
    """
    raw = F.col(value_col).cast("string")
    parsed = messages.select(raw.alias("__raw"), F.from_json(raw, SENSOR_MESSAGE).alias("m"))
    ts = parse_sensor_timestamp(F.col("m.timestamp"))
    return parsed.select(
        F.col("m.sensor_id").alias("sensor_id"),
        F.col("m.temperature").alias("temperature"),
        F.col("m.humidity").alias("humidity"),
        iso_utc_text(ts, source_tz).alias("timestamp"),
        ts.cast("timestamp").alias("event_time"),
        F.col("__raw").alias("raw"),
        _reason(F.col("__raw"), ts).alias("reject_reason"),
    )


def read_sensor_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                       options: Mapping[str, str] | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with one message text per row in ``value``."""
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", TOPIC)
        opts.setdefault("startingOffsets", "earliest")
        return (spark.readStream.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text").options(**opts)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _batch_writer(sink_path: str, quarantine_path: str, es_options: Mapping[str, str] | None,
                  stream_id: str = "0"):
    def write(batch: DataFrame, batch_id: int) -> None:
        # Two writes of one micro-batch: without the cache the second one would run the
        # batch, and its deduplication state, again.
        batch = batch.persist()
        good, bad = split_quarantine(batch.withColumns({
            "stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("long")}))
        good = good.select(*READING_COLUMNS, "stream_id", "batch_id")
        bad = bad.select("raw", "reject_reason", "stream_id", "batch_id")
        for df, path in ((good, sink_path), (bad, quarantine_path)):
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("stream_id", "batch_id").parquet(path))
        if es_options:
            # Document id from (sensor_id, timestamp): a replay updates, not duplicates.
            (good.drop("stream_id", "batch_id").withColumn("doc_id", F.concat_ws("|", "sensor_id", "timestamp"))
             .write.format("org.elasticsearch.spark.sql").options(**es_options)
             .option("es.mapping.id", "doc_id").option("es.mapping.exclude", "doc_id")
             .mode("append").save())
        batch.unpersist()
    return write


#: State outside the heap, written as changes instead of whole snapshots.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Names of the observations before and after deduplication.
SEEN, KEPT = "sensor_messages", "sensor_rows"


class StreamCounts(StreamingQueryListener):
    """What became of the messages, by run of a query, over all of its batches.

    ``query.recentProgress`` keeps the last reports only; a listener gets every one, in order, and
    the end of a run after all of its reports.
    """

    def __init__(self):
        self.counts: dict[str, dict[str, int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _of(self, run: str) -> dict[str, int]:
        return self.counts.setdefault(run, {"read": 0, "rejected": 0, "good": 0, "late": 0, "repeated": 0})

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        c, seen, kept = self._of(str(progress.runId)), progress.observedMetrics.get(SEEN), progress.observedMetrics.get(KEPT)
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        c["late"] += late
        if seen is not None and kept is not None:
            c["read"] += seen["n"]
            c["rejected"] += kept["rejected"]
            c["good"] += kept["good"]
            c["repeated"] += seen["n"] - seen["rejected"] - kept["good"] - late

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()


_COUNTS = StreamCounts()
_LISTENED: set[int] = set()


def _listen(spark: SparkSession) -> None:
    if id(spark) not in _LISTENED:
        spark.streams.addListener(_COUNTS)
        _LISTENED.add(id(spark))


def _counted(readings: DataFrame, name: str) -> DataFrame:
    bad = F.col("reject_reason").isNotNull()
    return readings.observe(name, F.count(F.lit(1)).alias("n"), F.count(F.when(bad, 1)).alias("rejected"),
                            F.count(F.when(~bad, 1)).alias("good"))


def ingest_sensors(stream: DataFrame, sink_path: str, quarantine_path: str,
                   checkpoint_location: str, source_tz: str | None = None,
                   dedup_delay: str | None = None, available_now: bool = True,
                   processing_time: str | None = None,
                   es_options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start the ingest query (``availableNow`` drains what is there and stops).

    ``checkpoint_location`` is where the query keeps its progress: the same
    one on every restart, so that no message is read twice or lost. Output
    lies below ``stream_id=<digest of it>/batch_id=<n>``: a replayed batch
    replaces itself, and a stream with another checkpoint, whose batch numbers
    start again, never touches it.

    ``dedup_delay`` (e.g. "10 minutes") drops a repeated (sensor_id,
    timestamp) of valid readings seen within that delay; rejected messages pass
    it by. Rows later than the watermark are then dropped as late and counted
    (``stream_counts``). The state of that lies in RocksDB unless the session
    names another state store.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location must name the stream's checkpoint folder")
    _listen(stream.sparkSession)
    readings = _counted(parse_sensor_messages(stream, source_tz=source_tz), SEEN)
    if dedup_delay:
        conf = stream.sparkSession.conf
        if "RocksDB" not in conf.get("spark.sql.streaming.stateStore.providerClass", "HDFSBackedStateStoreProvider"):
            for key, value in STATE_CONF.items():
                conf.set(key, value)
        good, bad = split_quarantine(readings)
        readings = (good.withWatermark("event_time", dedup_delay)
                    .dropDuplicatesWithinWatermark(["sensor_id", "timestamp"]).unionByName(bad))
    readings = _counted(readings, KEPT)
    stream_id = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]
    writer = (readings.writeStream.foreachBatch(_batch_writer(sink_path, quarantine_path, es_options, stream_id))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stream_counts(query: StreamingQuery, wait_s: float = 60.0) -> dict[str, int]:
    """What became of the messages of a finished run: ``read = good + rejected + late + repeated``."""
    run = str(query.runId)
    if not _COUNTS.end_of(run).wait(wait_s):
        raise TimeoutError(f"the run {run} of the query has not ended")
    return dict(_COUNTS._of(run))


def dropped_late_rows(query: StreamingQuery, wait_s: float = 60.0) -> int:
    """Rows that a finished run of the query dropped as later than the watermark, over all of its
    batches (0 when no dedup runs)."""
    return stream_counts(query, wait_s)["late"]


def reading_messages(readings: DataFrame, decimals: int | None = 2, stamp_now: bool = False) -> DataFrame:
    """Readings -> JSON message text, the producer's format: measurements
    rounded to ``decimals``; with ``stamp_now`` a missing timestamp becomes the
    current time as 'yyyy-MM-dd HH:mm:ss'."""
    cols = []
    for c in READING_COLUMNS:
        if c in ("temperature", "humidity") and c in readings.columns and decimals is not None:
            cols.append(F.round(F.col(c), decimals).alias(c))
        elif c == "timestamp" and stamp_now:
            now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
            cols.append((F.coalesce(F.col(c), now) if c in readings.columns else now).alias(c))
        elif c in readings.columns:
            cols.append(F.col(c))
    return readings.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def publish_readings(readings: DataFrame, fmt: str = "kafka", path: str | None = None,
                     options: Mapping[str, str] | None = None, decimals: int | None = 2,
                     stamp_now: bool = False) -> None:
    """Serialize readings to JSON messages and publish them (batch write)."""
    messages = reading_messages(readings, decimals, stamp_now)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("topic", TOPIC)
        messages.write.format("kafka").options(**opts).save()
    else:
        messages.write.mode("append").text(path)
