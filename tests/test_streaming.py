"""Streams give what the batch jobs give, late rows aside."""

import time

from pyspark.sql import functions as F

from modelpulse.plans import medallion
from modelpulse.plans.data_ops import raw_event_lines
from modelpulse.sources.tables import requests, requests_from_events
from modelpulse.streaming import live


def test_closed_windows_equal_batch(spark, sf_dir):
    stream = requests_from_events(live.read_table_stream(spark, sf_dir, "events"))
    closed = live.run_to_table(live.live_request_metrics(stream), "test-live")
    batch = requests(spark, sf_dir).groupBy(F.window("start_ts", "1 hour").alias("w"), "method", "endpoint", "status").count()
    batch = batch.select(F.col("w.end").alias("window_end"), "method", "endpoint", "status", "count")
    last = closed.agg(F.max("window_end")).first()[0]
    got = {tuple(r) for r in closed.groupBy("window_end", "method", "endpoint", "status").agg(F.sum("total")).collect()}
    want = {tuple(r) for r in batch.where(F.col("window_end") <= last).collect()}
    assert got == want and len(got) > 100


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"

    def put(name, rows):
        df = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    job = live.live_request_metrics(requests_from_events(source))
    put("a", [(1, "2024-01-01 10:05:00", 1, "view", 1.0, '{"k": 1}'), (2, "2024-01-01 12:00:00", 1, "view", 1.0, '{"k": 1}')])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    live.start_table(job, out, state).awaitTermination()
    # The window of ten o'clock is closed now; its late row is too old, the one of twelve is not.
    put("b", [(3, "2024-01-01 10:06:00", 1, "view", 1.0, '{"k": 1}'), (4, "2024-01-01 12:01:00", 1, "view", 1.0, '{"k": 1}')])
    put("c", [(5, "2024-01-01 15:00:00", 1, "view", 1.0, '{"k": 1}')])
    live.start_table(job, out, state).awaitTermination()
    got = {r["window_start"].hour: r["total"] for r in spark.read.parquet(out).collect()}
    assert got == {10: 1, 12: 2}


def test_silver_drops_repeats_and_broken_lines(spark, sf_dir):
    raw = raw_event_lines(spark, sf_dir)
    n = requests(spark, sf_dir).count()
    assert medallion.silver_from(raw).count() == n
    assert medallion.broken_lines(raw).count() == raw.where("value = '{broken'").count() > 0


def test_late_and_repeated_rows_reach_silver_in_any_number_of_batches(spark, tmp_path):
    event = '{"event_id": %d, "ts": "2024-01-0%d %s:00:00", "user_id": 1, "event_type": "view", "value": 1.0, "props": "{}"}'
    deliveries = [
        [event % (1, 2, "12"), event % (2, 2, "13")],
        [event % (3, 2, "09"), event % (1, 2, "12"), "{broken"],
        [event % (4, 1, "23"), event % (4, 1, "23"), event % (3, 2, "09"), '{"event_id": 5}'],
        [event % (5, 3, "00"), '{"event_id": 5}'],
    ]
    (tmp_path / "in").mkdir()
    bronze = spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i, lines in enumerate(deliveries):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        live.start_silver(bronze, out, state).awaitTermination()
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props", "day"]
    stream = spark.read.parquet(out).select(columns)
    batch = medallion.silver_from(spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))).select(columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    assert stream.count() == 6


def _until(query, done, seconds=60):
    """Wait until the running query's table is as asked."""
    end = time.monotonic() + seconds
    while time.monotonic() < end and query.isActive and not done():
        time.sleep(0.2)
    assert done(), query.exception()


def test_batches_close_by_size_or_time(spark, tmp_path):
    """Eight and three rows come: one batch by size, and the rest by time, in triggers of one running query."""
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema("endpoint string, request_id bigint").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))

    def put(name, rows):
        spark.createDataFrame(rows, "endpoint string, request_id bigint").coalesce(1).write.parquet(str(tmp_path / "in" / name))

    out = str(tmp_path / "out")
    table = lambda: [tuple(r) for r in spark.read.schema(batched.schema).parquet(out).orderBy("endpoint", "batch", "place").collect()]
    batched = live.size_or_time_batches(source, ["endpoint"], ["request_id"], size=8, wait_ms=50)
    put("a", [("/a", i) for i in range(11)] + [("/b", 100)])
    query = live.start_table(batched, out, str(tmp_path / "state"), every="200 milliseconds")
    try:
        _until(query, lambda: len(table()) == 12)
        put("b", [("/a", i) for i in range(11, 13)])
        _until(query, lambda: len(table()) == 14)
    finally:
        query.stop()
    rows = table()
    assert [r for r in rows if r[:3] == ("/a", 0, 8)] == [("/a", 0, 8, "size", i, i) for i in range(8)]
    rest = [r for r in rows if r[0] == "/a" and r[1] > 0]
    assert [r[5] for r in rest] == list(range(8, 13)) and {r[3] for r in rest} == {"time"}
    assert [r for r in rows if r[0] == "/b"] == [("/b", 0, 1, "time", 0, 100)]


def test_waiting_rows_survive_a_restart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema("endpoint string, request_id bigint").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    batched = live.size_or_time_batches(source, ["endpoint"], ["request_id"], size=8, wait_ms=86_400_000)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i, n in enumerate((5, 2, 10)):
        rows = [("/a", 100 * i + k) for k in range(n)]
        spark.createDataFrame(rows, "endpoint string, request_id bigint").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        live.start_table(batched, out, state, once=True).awaitTermination()
    rows = spark.read.schema(batched.schema).parquet(out).orderBy("batch", "place").collect()
    assert [r.request_id for r in rows] == [0, 1, 2, 3, 4, 100, 101, *range(200, 209)] and {(r.batch, r.cause) for r in rows} == {(0, "size"), (1, "size")}


def test_silver_reads_no_written_row(spark, tmp_path):
    """A batch works without the table: state alone tells repeats, also after a restart."""
    line = '{"event_id": %d, "ts": "2024-01-02 10:00:00", "user_id": 1, "event_type": "view", "value": 1.0, "props": "{}"}'
    (tmp_path / "in").mkdir()
    bronze = spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    state, found = str(tmp_path / "state"), []
    for i, ids in enumerate(([1, 2, 2], [2, 3, 1], [4, 3])):
        spark.createDataFrame([(line % k,) for k in ids], "value string").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        query = live.without_earlier(medallion.parsed_events(bronze)).writeStream.option("checkpointLocation", state)
        query.foreachBatch(lambda batch, _: found.append(sorted(r.event_id for r in batch.collect()))).trigger(availableNow=True).start().awaitTermination()
    assert [ids for ids in found if ids] == [[1, 2], [3], [4]]


def test_snapshots_take_turns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema("id bigint").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for i in range(3):
        spark.range(i + 1).write.parquet(str(tmp_path / "in" / str(i)))
        live.start_snapshots(source.groupBy().count(), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["0", "1"]
    assert spark.read.parquet(str(tmp_path / "out" / "0")).first()[0] == 6


def test_a_repeat_on_another_day_counts_once(spark, tmp_path):
    def put(name, *stamps):
        lines = [(f'{{"event_id": 7, "ts": "{ts}", "user_id": 1, "event_type": "view", "value": 1.0, "props": "k=1"}}',) for ts in stamps]
        spark.createDataFrame(lines, "value string").coalesce(1).write.parquet(str(tmp_path / "in" / name))

    out, state = str(tmp_path / "silver"), str(tmp_path / "state")
    for name, stamps in (("a", ["2024-01-01T23:59:59Z", "2024-01-02T00:00:01Z"]), ("b", ["2024-01-02T00:00:02Z"])):
        put(name, *stamps)
        bronze = spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        live.start_silver(bronze, out, state).awaitTermination()
    raw = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    streamed = spark.read.parquet(out).select("event_id", "ts").collect()
    assert streamed == medallion.silver_from(raw).select("event_id", "ts").collect() and len(streamed) == 1


def test_repeats_of_a_trigger_are_folded_without_a_call_per_key(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    # One key after the other in Python costs about a millisecond an event.
    (tmp_path / "in").mkdir()
    bronze = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    silver = live.without_earlier(medallion.parsed_events(bronze))
    assert "TransformWithState" not in silver._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(live, "FOLD_ROWS", 3)
    rows = [(i % 4, i % 4 == 3, None if i == 8 else float(20 - i)) for i in range(17)] + [(None, False, 1.0), (None, False, 0.5)]
    whole = pa.Table.from_pylist([dict(zip(("event_id", "_timeless", "value"), r)) for r in rows])
    got = pa.Table.from_batches(list(live._first_of_trigger(["event_id", "_timeless"])(whole.to_batches(max_chunksize=2)))).to_pylist()
    assert {(r["event_id"], r["value"]) for r in got} == {(0, None), (1, 7.0), (2, 6.0), (3, 5.0), (None, 0.5)} and len(got) == 5
