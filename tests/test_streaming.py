"""Sensor ingestion: file source with availableNow, checkpoint restart, dedup."""

from __future__ import annotations

import json
import os

from citeloom.streaming import ingest_sensors, parse_sensor_messages, read_sensor_stream
from conftest import canon


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _msg(sid, t, h=50.5, ts="2024-01-02 03:04:05"):
    return json.dumps({"sensor_id": sid, "temperature": t, "humidity": h, "timestamp": ts})


BATCH1 = [_msg(1, 29.41), _msg(2, 29.5, ts="2024-01-02 03:04:06"),
          json.dumps({"sensor_id": 3, "temperature": 29.0, "timestamp": "2024-01-02 03:04:07"}),
          _msg(4, 29.9, ts="bad"), "this is not json", _msg(5, 29.1, h=None)]


def _run(spark, src, out, ckpt, **kw):
    stream = read_sensor_stream(spark, fmt="text", path=src, max_files_per_trigger=1)
    q = ingest_sensors(stream, f"{out}/readings", f"{out}/quarantine", checkpoint_location=ckpt, **kw)
    q.awaitTermination()
    return q


def _readings(spark, out):
    return canon(tuple(r) for r in spark.read.parquet(f"{out}/readings")
                 .select("sensor_id", "temperature", "humidity", "timestamp").collect())


def test_stream_matches_batch_and_quarantines(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.json", BATCH1)
    _run(spark, src, out, ckpt)
    got = _readings(spark, out)
    assert got == canon([(1, 29.41, 50.5, "2024-01-02T03:04:05Z"), (2, 29.5, 50.5, "2024-01-02T03:04:06Z"),
                         (5, 29.1, None, "2024-01-02T03:04:05Z")])
    bad = {r["reject_reason"] for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert bad == {"missing_humidity", "bad_timestamp", "malformed_or_not_an_object"}
    batch = parse_sensor_messages(spark.read.text(src)).where("reject_reason is null")
    assert canon(tuple(r) for r in batch.select("sensor_id", "temperature", "humidity", "timestamp").collect()) == got


def test_restart_from_checkpoint_adds_nothing(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.json", BATCH1)
    _run(spark, src, out, ckpt)
    first = _readings(spark, out)
    _run(spark, src, out, ckpt)  # same checkpoint, no new files
    assert _readings(spark, out) == first
    _write(src, "b.json", [_msg(9, 29.2, ts="2024-01-02 03:05:00")])
    _run(spark, src, out, ckpt)  # only the new file is read
    assert _readings(spark, out) == canon(first + [(9, 29.2, 50.5, "2024-01-02T03:05:00Z")])


def test_replayed_batch_overwrites_its_partition(spark, tmp_path):
    """The sink writes batch_id partitions with dynamic overwrite: writing the
    same batch id again replaces rather than duplicates."""
    from citeloom.streaming.sensors import _batch_writer
    out = str(tmp_path / "out")
    df = parse_sensor_messages(spark.createDataFrame([(m,) for m in BATCH1], "value string"))
    write = _batch_writer(f"{out}/readings", f"{out}/quarantine", None)
    write(df, 0)
    write(df, 0)
    assert len(_readings(spark, out)) == 3


def test_dedup_within_watermark(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.json", [_msg(1, 29.4), _msg(2, 29.5)])
    _write(src, "b.json", [_msg(1, 29.4), _msg(3, 29.6)])  # sensor 1 delivered twice
    q = _run(spark, src, out, ckpt, dedup_delay="1 hour")
    assert [r[0] for r in _readings(spark, out)] == [1, 2, 3]
    from citeloom.streaming import dropped_late_rows
    assert dropped_late_rows(q) == 0


def test_rejects_pass_deduplication_by(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    broken = ["nonsense"] * 3 + ["{}"] * 2 + [json.dumps({"sensor_id": 1, "temperature": "hot", "humidity": 1.0,
                                                         "timestamp": "2024-01-02 03:04:05"})] * 2
    _write(src, "a.json", [*broken, _msg(1, 29.4), _msg(1, 29.4)])
    _run(spark, src, out, ckpt, dedup_delay="1 hour")
    assert [r[0] for r in _readings(spark, out)] == [1]
    reasons = sorted(r["reject_reason"] for r in spark.read.parquet(f"{out}/quarantine").collect())
    assert reasons == ["bad_temperature"] * 2 + ["malformed_or_not_an_object"] * 3 + ["missing_sensor_id"] * 2


def test_mistyped_values_are_quarantined(spark):
    cases = {'"hot"': "bad_temperature", '"29.5"': "bad_temperature", "null": None, "29": None, "[]": "bad_temperature"}
    rows = [(k, f'{{"sensor_id": 3000000000, "temperature": {k}, "humidity": 1.5, "timestamp": "2024-01-02 03:04:05"}}') for k in cases]
    rows.append(("id", '{"sensor_id": "s-7", "temperature": 1.0, "humidity": 1.5, "timestamp": "2024-01-02 03:04:05"}'))
    got = parse_sensor_messages(spark.createDataFrame(rows, "k string, value string")).collect()
    assert [r["reject_reason"] for r in got] == [*cases.values(), "bad_sensor_id"]
    assert got[0]["sensor_id"] == 3000000000


def test_a_new_checkpoint_never_replaces_stored_readings(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(src, "a.json", [_msg(1, 29.4), _msg(2, 29.5)])
    _run(spark, src, out, str(tmp_path / "one"))
    other = str(tmp_path / "in2")
    _write(other, "b.json", [_msg(3, 29.6)])
    _run(spark, other, out, str(tmp_path / "two"))
    assert [r[0] for r in _readings(spark, out)] == [1, 2, 3]


def test_source_timezone_conversion(spark):
    df = parse_sensor_messages(spark.createDataFrame([(_msg(1, 29.0, ts="2024-07-01 12:00:00"),)], "value string"),
                               source_tz="Europe/Paris")
    assert df.collect()[0]["timestamp"] == "2024-07-01T10:00:00Z"


def test_reading_messages_round_and_stamp(spark):
    from citeloom.streaming import reading_messages
    df = spark.createDataFrame([(1, 29.4149, 50.7751, None)], "sensor_id int, temperature double, humidity double, timestamp string")
    msg = json.loads(reading_messages(df, decimals=2, stamp_now=True).collect()[0]["value"])
    assert (msg["sensor_id"], msg["temperature"], msg["humidity"]) == (1, 29.41, 50.78)
    assert len(msg["timestamp"]) == 19 and msg["timestamp"][10] == " "
    back = parse_sensor_messages(spark.createDataFrame([(json.dumps(msg),)], "value string")).collect()[0]
    assert back["reject_reason"] is None
    missing = reading_messages(df.selectExpr("sensor_id", "temperature", "cast(null as double) as humidity", "'2024-01-02 03:04:05' as timestamp"))
    assert json.loads(missing.collect()[0]["value"])["humidity"] is None
    assert parse_sensor_messages(missing).collect()[0]["reject_reason"] is None


def test_dedup_reports_rows_later_than_watermark(spark, tmp_path):
    """A row behind the watermark is dropped (and counted) once the watermark
    has moved in an earlier batch; the file source replays files in
    modification-time order, one file per batch here."""
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    files = [("a.json", [_msg(1, 29.4, ts="2024-01-02 12:00:00")]),
             ("b.json", [_msg(9, 29.9, ts="2024-01-02 12:05:00")]),
             ("c.json", [_msg(2, 29.5, ts="2024-01-02 10:00:00"), _msg(3, 29.6, ts="2024-01-02 11:30:00")])]
    for i, (name, lines) in enumerate(files):
        _write(src, name, lines)
        os.utime(os.path.join(src, name), (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    from citeloom.streaming import dropped_late_rows
    q = _run(spark, src, out, ckpt, dedup_delay="1 hour")
    assert [r[0] for r in _readings(spark, out)] == [1, 3, 9]  # sensor 2 is before the watermark
    assert dropped_late_rows(q) == 1


def test_counts_over_several_batches_add_up(spark, tmp_path):
    """Good, rejected, late and repeated messages, one file a batch: together they are what was read."""
    from citeloom.streaming import stream_counts
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    files = [[_msg(1, 29.4, ts="2024-01-02 12:00:00"), "broken", _msg(1, 29.4, ts="2024-01-02 12:00:00")],
             [_msg(9, 29.9, ts="2024-01-02 12:05:00"), "broken", "[]"],
             [_msg(2, 29.5, ts="2024-01-02 10:00:00"), _msg(3, 29.6, ts="2024-01-02 11:30:00"), _msg(1, 29.4, ts="2024-01-02 12:00:00")]]
    for i, lines in enumerate(files):
        _write(src, f"{i}.json", lines)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    counts = stream_counts(_run(spark, src, out, ckpt, dedup_delay="1 hour"))
    assert counts == {"read": 9, "rejected": 3, "good": 3, "late": 1, "repeated": 2}
    assert counts["read"] == sum(counts[k] for k in ("rejected", "good", "late", "repeated"))
    assert [r[0] for r in _readings(spark, out)] == [1, 3, 9]
    # A run with nothing new counts nothing; without deduplication every good message is kept.
    assert stream_counts(_run(spark, src, out, ckpt, dedup_delay="1 hour"))["read"] == 0
    plain = stream_counts(_run(spark, src, str(tmp_path / "plain"), str(tmp_path / "ck2")))
    assert plain == {"read": 9, "rejected": 3, "good": 6, "late": 0, "repeated": 0}


def test_deduplication_state_lies_in_rocksdb(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write(src, "a.json", [_msg(i, 29.4, ts="2024-01-02 12:00:00") for i in range(5)])
    _run(spark, src, out, ckpt, dedup_delay="1 hour")
    state = spark.read.format("statestore").load(ckpt)
    assert sorted(r["key"]["sensor_id"] for r in state.collect()) == list(range(5))
    _write(src, "b.json", [_msg(1, 29.4, ts="2024-01-02 12:00:00"), _msg(7, 29.4, ts="2024-01-02 12:00:00")])
    _run(spark, src, out, ckpt, dedup_delay="1 hour")
    assert [r[0] for r in _readings(spark, out)] == [0, 1, 2, 3, 4, 7]
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    files = [f for _, _, names in os.walk(os.path.join(ckpt, "state")) for f in names]
    assert any(f.endswith(".changelog") for f in files)


def test_compaction_leaves_every_reading_once(spark, tmp_path):
    from citeloom.streaming import compact_readings, read_readings, remove_compacted
    src, out, compacted = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "compacted")
    sink = os.path.join(out, "readings")

    def ids():
        return sorted(r["sensor_id"] for r in read_readings(spark, sink, compacted).collect())

    def files(folder):
        return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)

    assert compact_readings(spark, sink, compacted) == 0 and ids() == []
    for i in range(5):
        _write(src, f"{i}.json", [_msg(10 * i + k, 29.4, ts=f"2024-01-0{1 + k % 2} 12:00:00") for k in range(4)] + ["broken"])
    want = sorted(10 * i + k for i in range(5) for k in range(4))
    _run(spark, src, out, str(tmp_path / "ck"))
    assert ids() == want
    assert compact_readings(spark, sink, compacted) == 4  # the newest batch stays open
    assert ids() == want and files(os.path.join(compacted, "readings")) == 2  # one file a day
    assert compact_readings(spark, sink, compacted) == 0 and remove_compacted(spark, sink, compacted) == 0
    # A compaction that died before it was listed is never read.
    spark.read.parquet(sink).drop("stream_id", "batch_id").selectExpr("*", "'dead' as compaction", "'2024-01-01' as day").write.mode(
        "append").partitionBy("compaction", "day").parquet(os.path.join(compacted, "readings"))
    assert ids() == want
    _write(src, "9.json", [_msg(90, 29.4, ts="2024-01-03 12:00:00")])
    _run(spark, src, out, str(tmp_path / "ck"))
    _write(src, "91.json", [_msg(91, 29.4, ts="2024-01-03 12:00:00")])
    _run(spark, src, out, str(tmp_path / "ck"))
    assert ids() == [*want, 90, 91]
    assert compact_readings(spark, sink, compacted) == 2 and ids() == [*want, 90, 91]
    assert remove_compacted(spark, sink, compacted) == 4 and ids() == [*want, 90, 91]
