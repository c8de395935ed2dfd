from datetime import datetime, timedelta

from strandloom.streaming.sessions import event_stream, hourly, sessions

T = datetime(2026, 1, 1)
SCHEMA = "user_id bigint, ts timestamp, event_type string, value double"


def at(*minutes):
    return [T + timedelta(minutes=m) for m in minutes]


def test_batch_sessions(spark):
    rows = [(1, t, "a", 1.0) for t in at(0, 10, 39, 70)] + [(2, at(5)[0], "b", 2.0), (None, at(5)[0], "b", 2.0), (3, None, "b", 1.0)]
    got = {(r.user_id, r.started): (r.ended, r.events) for r in sessions(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, T): (at(69)[0], 3), (1, at(70)[0]): (at(100)[0], 1), (2, at(5)[0]): (at(35)[0], 1)}
    assert sessions(spark.createDataFrame([], SCHEMA)).collect() == []


def test_stream_equals_batch(spark, tmp_path):
    parts = [[(1, t, "a", 1.0) for t in at(0, 20)], [(1, t, "a", 1.0) for t in at(45, 200)], [(2, t, "b", 3.0) for t in at(900, 2000)]]
    for k, p in enumerate(parts):
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = sessions(event_stream(spark, str(tmp_path / "in"), 10), late="1 hour")
    q = stream.writeStream.format("memory").queryName("found").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    whole = {(r.user_id, r.started) for r in sessions(spark.read.parquet(str(tmp_path / "in"))).collect()}
    closed = {(r.user_id, r.started) for r in spark.table("found").collect()}
    assert closed == {s for s in whole if s[1] < at(1800)[0]}


def test_hourly(spark):
    got = {(r.hour, r.event_type): (r.events, r.value) for r in hourly(spark.createDataFrame([(1, t, "a", 1.5) for t in at(0, 59, 60)], SCHEMA)).collect()}
    assert got == {(T, "a"): (2, 3.0), (at(60)[0], "a"): (1, 1.5)}
