"""Streaming queries, run over all data present and read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.operators.scoring import linear_scorer
from modelpulse.operators.requests import DURATION_BOUNDS
from modelpulse.plans import medallion
from modelpulse.plans.data_ops import raw_event_lines
from modelpulse.plans.inference import batched_scores
from modelpulse.plans.registry import ORACLE, query, with_requests
from modelpulse.session import scratch_path
from modelpulse.sources.tables import requests_from_events
from modelpulse.streaming import live


def _requests(spark, sf_dir):
    return requests_from_events(live.read_table_stream(spark, sf_dir, "events"))


@query(
    with_requests(
        """,
hourly AS (SELECT date_trunc('hour', ts) AS w, method, endpoint, status, coalesce(error_type, '') AS error_type, count(*) AS total,
                  count(*) FILTER (status = 200) AS successful, round(sum(latency_ms), 4) AS latency_sum,
                  count(*) FILTER (latency_ms <= 10) AS le_10ms,
                  count(*) FILTER (latency_ms <= 50) AS le_50ms,
                  count(*) FILTER (latency_ms <= 100) AS le_100ms,
                  count(*) FILTER (latency_ms <= 200) AS le_200ms,
                  count(*) FILTER (latency_ms <= 500) AS le_500ms,
                  count(*) FILTER (latency_ms <= 1000) AS le_1000ms,
                  count(*) FILTER (latency_ms <= 3000) AS le_3000ms,
                  count(*) FILTER (latency_ms <= 6000) AS le_6000ms
           FROM requests GROUP BY ALL)
SELECT epoch_us(w) AS window_us, method, endpoint, status, error_type, total, successful, latency_sum,
       le_10ms, le_50ms, le_100ms, le_200ms, le_500ms, le_1000ms, le_3000ms, le_6000ms
FROM hourly WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
    )
)
def live_request_metrics(spark, sf_dir):
    """Only closed windows leave the stream; the last one stays open."""
    closed = live.run_to_table(live.live_request_metrics(_requests(spark, sf_dir)), "live-metrics")
    return closed.select(
        F.unix_micros("window_start").alias("window_us"), "method", "endpoint", "status", "error_type", "total", "successful",
        F.round("latency_sum", 4).alias("latency_sum"), *[F.col(f"le_{i}").alias(f"le_{b * 100:.0f}ms") for i, b in enumerate(DURATION_BOUNDS)],
    )


@query(with_requests("SELECT method, endpoint, status, count(*) AS value FROM requests GROUP BY method, endpoint, status"))
def lifetime_counters(spark, sf_dir):
    return live.run_to_snapshot(live.lifetime_counters(_requests(spark, sf_dir)), "lifetime-counters")


@query(ORACLE[batched_scores.__name__])
def streamed_scores(spark, sf_dir):
    vectors = live.read_table_stream(spark, sf_dir, "embeddings")
    scored = live.run_to_table(live.score_stream(vectors, "embedding", 64, linear_scorer(64, 10)), "streamed-scores")
    return scored.select("vec_id", F.posexplode("logits").alias("class_id", "v")).select(
        "vec_id", F.col("class_id").cast("bigint").alias("class_id"), F.round("v", 6).alias("logit")
    )


@query(with_requests("SELECT endpoint, count(*) // 8 AS batches, 8 * (count(*) // 8) AS batched FROM requests GROUP BY endpoint"))
def bounded_batches(spark, sf_dir):
    """Batches of eight rows per endpoint; what is left would wait for the timer, here longer than the stream runs."""
    batched = live.size_or_time_batches(_requests(spark, sf_dir), ["endpoint"], ["request_id"], wait_ms=86_400_000)
    full = live.run_to_table(batched, "bounded-batches", once=True).where("cause = 'size'")
    return full.groupBy("endpoint").agg(F.count_if(F.col("place") == 0).alias("batches"), F.count_distinct("request_id").alias("batched"))


@query(ORACLE["medallion_gold"])
def streamed_medallion_gold(spark, sf_dir):
    base = scratch_path(spark, "medallion-stream")
    medallion.write_bronze(raw_event_lines(spark, sf_dir), f"{base}/bronze")
    bronze = spark.readStream.schema("value string").parquet(f"{base}/bronze")
    return medallion.gold_from(live.run_to_silver(bronze, "silver"))
