"""Structured Streaming jobs over the request log."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from modelpulse.operators import requests as R
from modelpulse.operators.batching import MAX_BATCH, TICK_US
from modelpulse.operators.scoring import score_in_batches
from modelpulse.plans.medallion import RAW_SCHEMA as SILVER_SCHEMA
from modelpulse.plans.medallion import parsed_events
from modelpulse.session import scratch_path

# Our choice: lifetime counters never expire, windowed ones need a bound for late data.
WATERMARK = "10 minutes"
WIDTH = "1 hour"
# Rows that a task takes in before it folds repeats among them.
FOLD_ROWS = 100_000


def read_table_stream(spark: SparkSession, folder: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a table as they arrive; the schema is read once, never inferred per file."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The exact name, as a file or as a folder of files; a table whose name only begins alike is another one.
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{table}.parquet*")


def live_request_metrics(
    requests: DataFrame,
    bounds: Sequence[float] = tuple(b * 100 for b in R.DURATION_BOUNDS),
    watermark: str = WATERMARK,
    width: str = WIDTH,
) -> DataFrame:
    """Counters and cumulative latency buckets per closed window and label set.

    One stateful aggregate keyed by the label names holds all families; request totals, error counts
    and histograms per endpoint are sums over its rows.
    """
    ok = R.succeeded()
    windowed = requests.withWatermark("start_ts", watermark).groupBy(
        F.window("start_ts", width).alias("w"), "method", "endpoint", "status", F.coalesce("error_type", F.lit("")).alias("error_type")
    )
    counted = windowed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        F.sum("latency_ms").alias("latency_sum"),
        *[F.count_if(F.col("latency_ms") <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)],
    )
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counted.columns[1:])


def lifetime_counters(requests: DataFrame) -> DataFrame:
    """Counters that never reset; the state is one row per label set."""
    return requests.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("value"))


def score_stream(stream: DataFrame, features: str, width: int, make_predict: Callable, batch_size: int = 8) -> DataFrame:
    """Micro-batched scoring of arriving rows; stateless, so the file sink makes it exactly-once."""
    return score_in_batches(stream, features, width, make_predict, batch_size)


def _smallest_rows(table, keys: Sequence[str]):
    """One row per key of an Arrow table: of several the smallest, as the batch job orders them: a missing value is the smallest."""
    import pyarrow as pa
    import pyarrow.compute as pc

    place = pa.array(range(len(table)), pa.int64())
    found = table.select(list(keys)).append_column("_at", place).group_by(list(keys)).aggregate([("_at", "min"), ("_at", "count")])
    alone = found.filter(pc.equal(found.column("_at_count"), 1)).column("_at_min").combine_chunks()
    if len(alone) == len(table):
        return table
    several = {}
    for at, row in zip((rest := place.filter(pc.invert(pc.is_in(place, alone)))).to_pylist(), table.take(rest).to_pylist()):
        several.setdefault(tuple(row[k] for k in keys), []).append(([(v is not None, v) for v in row.values()], at))
    smallest = [min(rows, key=lambda row: row[0])[1] for rows in several.values()]
    return table.take(pa.concat_arrays([alone, pa.array(smallest, pa.int64())]))


def _first_of_trigger(keys: Sequence[str]) -> Callable:
    """What a task hands on of the rows of a trigger that it was dealt by their keys: repeats are folded whenever so many rows have come."""

    def run(batches):
        import pyarrow as pa

        held, new, n = [], 0, 0
        for batch in batches:
            held.append(batch)
            new += batch.num_rows
            if new >= max(FOLD_ROWS, n):
                table = _smallest_rows(pa.Table.from_batches(held), keys)
                held, new, n = table.to_batches(), 0, len(table)
        if held:
            yield from _smallest_rows(pa.Table.from_batches(held), keys).to_batches(max_chunksize=10_000)

    return run


class SizeOrTime(StatefulProcessor):
    """Batches of ``size`` rows of a key in the order in which they come, or of what waits once the first has waited long enough."""

    def __init__(self, size: int, wait_ms: int, keys: Sequence[str], columns: Sequence[str], types: str):
        self.size, self.wait_ms, self.keys, self.columns, self.types = size, wait_ms, list(keys), list(columns), types

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.types)
        self.sent = handle.getValueState("sent", "batches bigint")
        self.row = Row(*self.keys, "batch", "batch_size", "cause", "place", *self.columns)

    def _batch(self, key, rows, cause: str) -> Iterator[Row]:
        number = self.sent.get()[0] if self.sent.exists() else 0
        self.sent.update((number + 1,))
        for place, row in enumerate(rows):
            yield self.row(*key, number, len(rows), cause, place, *row)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        timed = bool(held)
        for row in rows:
            held.append(tuple(row[c] for c in self.columns))
            if len(held) == self.size:
                yield from self._batch(key, held, "size")
                held, timed = [], False
        if held:
            self.waiting.put(held)
        else:
            self.waiting.clear()
        if not timed:
            # Those that the timer was set for are gone; what waits now has come in this trigger.
            self._stop()
            if held:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        self.waiting.clear()
        if held:
            yield from self._batch(key, held, "time")

    def _stop(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def close(self) -> None:
        pass


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keyed state in RocksDB: it may outgrow the memory, and its changes are what a checkpoint writes."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def without_earlier(events: DataFrame) -> DataFrame:
    """Events whose id has not come before, however long ago; one without a time stands beside one with a time.

    Of rows that come in one trigger the smallest stays. The state is one key per id; no written row is read again. A task holds
    its share of a trigger's distinct rows; bound a trigger by the source or take more shuffle partitions.
    """
    keep_state_on_disk(events.sparkSession)
    keys = ["event_id", "_timeless"]
    marked = events.withColumn("_timeless", F.col("day").isNull())
    one = marked.repartition(*keys).mapInArrow(_first_of_trigger(keys), marked.schema)
    return one.dropDuplicates(keys).drop("_timeless")


def size_or_time_batches(requests: DataFrame, keys: Sequence[str], columns: Sequence[str], size: int = MAX_BATCH, wait_ms: int = TICK_US // 1000) -> DataFrame:
    """Each row of a stream with its batch: keys, ``batch`` (from 0 per key), ``batch_size``, ``cause`` (size or time), ``place``, columns.

    A batch closes with its ``size``-th row or when its first row has waited ``wait_ms`` of processing time, whichever comes
    first. The state is at most ``size`` - 1 rows per key; a busy endpoint is spread by a further key, such as the replica.
    """
    keep_state_on_disk(requests.sparkSession)
    kinds = {f.name: f.dataType for f in requests.schema}
    types = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in columns)
    out = T.StructType(
        [
            *[T.StructField(k, kinds[k]) for k in keys],
            T.StructField("batch", T.LongType()),
            T.StructField("batch_size", T.IntegerType()),
            T.StructField("cause", T.StringType()),
            T.StructField("place", T.IntegerType()),
            *[T.StructField(c, kinds[c]) for c in columns],
        ]
    )
    return requests.select(*keys, *columns).groupBy(*keys).transformWithState(SizeOrTime(size, wait_ms, keys, columns, types), out, "append", "processingTime")


def start_silver(bronze: DataFrame, path: str, state: str, every: str | None = None) -> StreamingQuery:
    """Append parsed events without repeats to a table by day, exactly once, however late they come.

    The first arrival stays; of repeats that come together and differ the smallest, as in the batch job.
    """
    silver = without_earlier(parsed_events(bronze))
    writer = silver.writeStream.format("parquet").outputMode("append").partitionBy("day").option("checkpointLocation", state).option("path", path)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_table(stream: DataFrame, path: str, state: str, every: str | None = None, once: bool = False) -> StreamingQuery:
    """Append to a Parquet table, exactly once; without an interval all present data is taken, then it stops.

    ``once`` takes it in a single trigger. A stream with timers needs that or an interval: while it keeps any it always asks
    for a further trigger.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).option("path", path)
    if once:
        return writer.trigger(once=True).start()
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_snapshots(stream: DataFrame, path: str, state: str, every: str | None = None) -> StreamingQuery:
    """Write the whole current result of each trigger; a repeated batch overwrites itself.

    Two folders take turns, so the last complete snapshot stays readable and none is kept for ever.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{batch_id % 2}")

    writer = stream.writeStream.outputMode("complete").option("checkpointLocation", state).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_to_table(stream: DataFrame, name: str, once: bool = False) -> DataFrame:
    """Run over everything that is present and read back the finished table."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    start_table(stream, f"{base}/table", f"{base}/state", once=once).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def run_to_snapshot(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    query = start_snapshots(stream, f"{base}/table", f"{base}/state")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/table/{query.lastProgress['batchId'] % 2}")


def run_to_silver(bronze: DataFrame, name: str) -> DataFrame:
    spark = bronze.sparkSession
    base = scratch_path(spark, name)
    start_silver(bronze, f"{base}/table", f"{base}/state").awaitTermination()
    return spark.read.schema(f"{SILVER_SCHEMA}, day date").parquet(f"{base}/table")
