"""Spans, request traces and facts mined from log messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.functions import scalar as S

# Messages that mark the stages of a request and of a batch.
RECEIVED = "Request received"
QUEUED = "Adding to batch queue"
COMPLETED = "Request completed successfully"
FAILED = "Request failed"
BATCH_SIZE = r"Processing batch of size (\d+)"
BATCH_MS = r"Batch inference completed in (\d+\.\d+)ms"


def span_summary(spans: DataFrame) -> DataFrame:
    """Spans per operation and status, with the error types seen.

    Counted per error type first, so that a type moves once per task however often it occurs.
    """
    typed = spans.groupBy("operation", "status", "error_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("_sum"), F.count("duration_ms").alias("_timed"), F.max("duration_ms").alias("max_ms")
    )
    return typed.groupBy("operation", "status").agg(
        F.sum("n").alias("n"),
        F.round(F.try_divide(F.sum("_sum"), F.sum("_timed")), 6).alias("mean_ms"),
        F.max("max_ms").alias("max_ms"),
        F.array_join(F.array_sort(F.collect_list("error_type")), ",").alias("error_types"),
    )


def request_traces(logs: DataFrame) -> DataFrame:
    """Stage times per request and the gaps between them; lines without a request id take no part.

    The time column is ``at_us``. Each stage is a minimum, so a long trace is reduced before the shuffle.
    """

    def stage(*messages):
        return F.min(F.when(F.col("message").isin(*messages), F.col("at_us")))

    traced = logs.where(F.col("request_id").isNotNull() & (F.col("request_id") != S.NO_REQUEST_ID))
    staged = traced.groupBy("request_id").agg(
        stage(RECEIVED).alias("received_us"),
        stage(QUEUED).alias("queued_us"),
        stage(COMPLETED, FAILED).alias("done_us"),
        F.count(F.lit(1)).alias("lines"),
        F.max(F.when(F.col("message") == FAILED, "failed").when(F.col("message") == COMPLETED, "completed")).alias("result"),
    )
    return staged.withColumns(
        {
            "to_queue_ms": (F.col("queued_us") - F.col("received_us")) / F.lit(1000.0),
            "in_queue_ms": (F.col("done_us") - F.col("queued_us")) / F.lit(1000.0),
        }
    )


def mine_batches(lines: DataFrame) -> DataFrame:
    """Batch sizes and inference times stated in log messages, summed up per logger."""
    size = F.regexp_extract("message", BATCH_SIZE, 1)
    took = F.regexp_extract("message", BATCH_MS, 1)
    mined = lines.select(
        "name",
        F.when(size != "", size.cast("bigint")).alias("batch_size"),
        F.when(took != "", took.cast("double")).alias("batch_ms"),
    )
    return mined.groupBy("name").agg(
        F.count("batch_size").alias("batches"),
        F.sum("batch_size").alias("items"),
        F.round(F.avg("batch_size"), 6).alias("mean_size"),
        F.count("batch_ms").alias("timed"),
        F.round(F.avg("batch_ms"), 6).alias("mean_ms"),
        F.max("batch_ms").alias("max_ms"),
    )
