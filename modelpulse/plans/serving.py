"""Queries over the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.operators import requests as R
from modelpulse.operators.ordered import join_totals
from modelpulse.plans.registry import REQUESTS, histogram_sql, query, with_requests
from modelpulse.session import scratch_path
from modelpulse.sources.tables import load, requests


@query(
    with_requests(
        """
SELECT endpoint, count(*) AS total, count(*) FILTER (status = 200) AS successful,
       count(*) FILTER (status <> 200) AS failed,
       round(100.0 * count(*) FILTER (status = 200) / count(*), 2) AS success_rate,
       round(avg(latency_ms) FILTER (status = 200), 6) AS avg_latency_ms,
       round(sum(latency_ms) FILTER (status = 200), 2) AS total_latency_ms,
       min(latency_ms) FILTER (status = 200) AS min_latency_ms,
       max(latency_ms) FILTER (status = 200) AS max_latency_ms,
       round(avg(inference_ms) FILTER (status = 200), 6) AS avg_inference_ms,
       round(quantile_cont(latency_ms, 0.5) FILTER (status = 200), 6) AS p50_ms,
       round(quantile_cont(latency_ms, 0.95) FILTER (status = 200), 6) AS p95_ms,
       round(quantile_cont(latency_ms, 0.99) FILTER (status = 200), 6) AS p99_ms
FROM requests GROUP BY endpoint"""
    )
)
def endpoint_request_summary(spark, sf_dir):
    log = requests(spark, sf_dir)
    summary = R.request_and_latency_summary(log, ["endpoint"])
    percentiles = R.slo_report(log, ["endpoint"]).select("endpoint", "p50_ms", "p95_ms", "p99_ms")
    return R.with_latency_percentiles(summary, percentiles, ["endpoint"])


@query(
    with_requests(
        """
SELECT count(*) AS total, count(*) FILTER (status = 200) AS successful,
       count(*) FILTER (status <> 200) AS failed,
       round(100.0 * count(*) FILTER (status = 200) / count(*), 2) AS success_rate,
       round(avg(latency_ms) FILTER (status = 200), 6) AS avg_latency_ms,
       round(sum(latency_ms) FILTER (status = 200), 2) AS total_latency_ms
FROM requests"""
    )
)
def request_summary(spark, sf_dir):
    return R.request_summary(requests(spark, sf_dir))


@query(
    with_requests(
        """
SELECT run, count(*) AS n, round(avg(latency_ms), 6) AS avg_latency_ms, min(latency_ms) AS min_latency_ms,
       max(latency_ms) AS max_latency_ms, round(avg(inference_ms), 6) AS avg_inference_ms
FROM requests WHERE status = 200 GROUP BY run"""
    )
)
def run_latency_summary(spark, sf_dir):
    return R.latency_summary(requests(spark, sf_dir), ["run"])


@query(
    with_requests(
        """,
s AS (SELECT run, count(*) FILTER (status = 200) AS successful,
             (max(end_us) - min(start_us)) / 1e6 AS wall, avg(latency_ms) FILTER (status = 200) AS mean_ms
      FROM requests GROUP BY run)
SELECT run, successful, round(wall, 6) AS wall_seconds, round(successful / wall, 9) AS throughput_rps,
       round(successful / wall * mean_ms / 1000, 9) AS mean_in_flight FROM s"""
    )
)
def run_throughput(spark, sf_dir):
    return R.throughput(requests(spark, sf_dir), ["run"])


@query(
    with_requests("SELECT method, endpoint, status, count(*) AS value FROM requests GROUP BY method, endpoint, status")
)
def request_counter(spark, sf_dir):
    return R.request_counter(requests(spark, sf_dir))


@query(
    with_requests(
        "SELECT error_type, endpoint, count(*) AS value FROM requests WHERE error_type IS NOT NULL "
        "GROUP BY error_type, endpoint"
    )
)
def error_counter(spark, sf_dir):
    return R.error_counter(requests(spark, sf_dir))


# Latencies reach 490 ms, so they are read as hundredths of a second to fill the duration bounds.
@query(
    histogram_sql(
        "secs", "method, endpoint", "seconds", R.DURATION_BOUNDS,
        f"{REQUESTS}, secs AS (SELECT method, endpoint, latency_ms / 100.0 AS seconds FROM requests)",
    )
)
def duration_histogram(spark, sf_dir):
    seconds = F.col("latency_ms") / F.lit(100.0)
    return R.histogram(requests(spark, sf_dir), ["method", "endpoint"], seconds, R.DURATION_BOUNDS)


@query(
    histogram_sql(
        "secs", "model_name", "seconds", R.INFERENCE_BOUNDS,
        f"{REQUESTS}, secs AS (SELECT 'resnet50' AS model_name, inference_ms / 100.0 AS seconds FROM requests)",
    )
)
def inference_histogram(spark, sf_dir):
    log = requests(spark, sf_dir).withColumn("model_name", F.lit("resnet50"))
    return R.histogram(log, ["model_name"], F.col("inference_ms") / F.lit(100.0), R.INFERENCE_BOUNDS)


@query(
    histogram_sql(
        "sized", "family, label", "bytes", R.BYTE_BOUNDS,
        """sized AS (
  SELECT 'http_request_size_bytes' AS family, lang AS label, CAST(strlen(text) AS DOUBLE) AS bytes FROM documents
  UNION ALL
  SELECT 'http_response_size_bytes', role, CAST(strlen(text) AS DOUBLE) FROM conversations)""",
    )
)
def size_histograms(spark, sf_dir):
    def sized(table, family, label):
        return load(spark, sf_dir, table).select(
            F.lit(family).alias("family"),
            F.col(label).alias("label"),
            F.octet_length("text").cast("double").alias("bytes"),
        )

    both = sized("documents", "http_request_size_bytes", "lang").unionByName(
        sized("conversations", "http_response_size_bytes", "role")
    )
    return R.histogram(both, ["family", "label"], "bytes", R.BYTE_BOUNDS)


@query(
    with_requests(
        """
SELECT endpoint, arg_max(k, (ts, request_id)) AS value FROM requests GROUP BY endpoint"""
    )
)
def queue_length_gauge(spark, sf_dir):
    return R.last_value_gauge(requests(spark, sf_dir), ["endpoint"], "k", "start_us", "request_id")


CONCURRENCY = """,
changes AS (SELECT endpoint, start_us AS at_us, 1 AS change FROM requests
            UNION ALL SELECT endpoint, end_us, -1 FROM requests),
net AS (SELECT endpoint, at_us, CAST(sum(change) AS BIGINT) AS change FROM changes GROUP BY endpoint, at_us)
"""


@query(
    with_requests(
        CONCURRENCY
        + "SELECT endpoint, at_us, CAST(sum(change) OVER (PARTITION BY endpoint ORDER BY at_us) AS BIGINT) AS active FROM net"
    )
)
def active_requests_gauge(spark, sf_dir):
    return R.concurrency_gauge(requests(spark, sf_dir), ["endpoint"])


@query(
    with_requests(
        CONCURRENCY
        + """,
total AS (SELECT at_us, sum(change) AS change FROM net GROUP BY at_us),
running AS (SELECT at_us, sum(change) OVER (ORDER BY at_us) AS active FROM total)
SELECT CAST(max(active) AS BIGINT) AS peak_active, CAST(arg_max(active, at_us) AS BIGINT) AS final_active,
       count(*) AS instants FROM running"""
    )
)
def peak_concurrency(spark, sf_dir):
    gauge = R.concurrency_gauge(requests(spark, sf_dir), [])
    return gauge.agg(
        F.max("active").alias("peak_active"),
        F.max_by("active", "at_us").alias("final_active"),
        F.count(F.lit(1)).alias("instants"),
    )


@query(with_requests("SELECT request_id, run, latency_ms, inference_ms FROM requests WHERE status = 200"))
def successful_results(spark, sf_dir):
    return R.successful(requests(spark, sf_dir)).select("request_id", "run", "latency_ms", "inference_ms")


@query(
    with_requests(
        """
SELECT request_id, status,
       CASE WHEN status <> 200 THEN 'failed' WHEN k % 7 = 0 OR k % 5 = 0 THEN 'invalid' ELSE 'ok' END AS outcome,
       CASE WHEN status = 200 AND k % 7 <> 0 AND k % 5 <> 0 THEN 'class_' || k END AS top_prediction,
       CASE WHEN status = 200 AND k % 7 <> 0 AND k % 5 <> 0 THEN k / 100.0 END AS confidence,
       latency_ms, CASE WHEN k % 3 = 0 THEN 0.0 ELSE inference_ms END AS inference_ms
FROM requests"""
    )
)
def response_validation(spark, sf_dir):
    # Bodies as the service sends them: some without the list, some with an empty one.
    k = F.col("k")
    item = F.struct(
        F.lit(1).alias("rank"),
        k.cast("int").alias("class_id"),
        F.concat(F.lit("class_"), k.cast("string")).alias("class_name"),
        (k / F.lit(100.0)).alias("confidence"),
    )
    predictions = F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.slice(F.array(item), 1, 0)).otherwise(F.array(item))
    body = F.to_json(
        F.struct(
            F.lit(True).alias("success"),
            F.col("request_id").cast("string").alias("request_id"),
            predictions.alias("predictions"),
            F.col("latency_ms"),
            F.when(k % 3 != 0, F.col("inference_ms")).alias("inference_ms"),
        )
    )
    responses = requests(spark, sf_dir).select("request_id", "status", body.alias("body"))
    return R.validate_responses(responses)


@query(
    with_requests(
        """
-- Half-up on the shortest decimal form of the double, which is what Spark rounds.
SELECT request_id, CAST(round(CAST(CAST(latency_ms / 7.0 AS VARCHAR) AS DECIMAL(38, 24)), 2) AS DOUBLE) AS latency_2,
       CAST(round(CAST(CAST(inference_ms / 700.0 AS VARCHAR) AS DECIMAL(38, 24)), 4) AS DOUBLE) AS confidence_4
FROM requests"""
    )
)
def rounded_report(spark, sf_dir):
    return requests(spark, sf_dir).select(
        "request_id",
        F.round(F.col("latency_ms") / F.lit(7.0), 2).alias("latency_2"),
        F.round(F.col("inference_ms") / F.lit(700.0), 4).alias("confidence_4"),
    )


@query(with_requests("SELECT request_id, substr(md5(CAST(request_id AS VARCHAR)), 1, 8) AS short_id FROM requests"))
def short_request_ids(spark, sf_dir):
    return requests(spark, sf_dir).select("request_id", S.short_id(F.col("request_id")).alias("short_id"))


@query(with_requests("SELECT request_id, (end_us - start_us) / 1000.0 AS duration_ms FROM requests"))
def request_durations(spark, sf_dir):
    return requests(spark, sf_dir).select(
        "request_id", S.duration_ms(F.col("start_us"), F.col("end_us")).alias("duration_ms")
    )


@query(with_requests("SELECT coalesce(error_type, 'none') AS error_type, status, count(*) AS n FROM requests GROUP BY 1, 2"))
def outcome_status_codes(spark, sf_dir):
    return (
        requests(spark, sf_dir)
        .groupBy(F.coalesce("error_type", F.lit("none")).alias("error_type"), "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    with_requests(
        """
SELECT request_id, 'WARNING' AS level, 'High latency detected' AS message, latency_ms,
       CAST(250.0 AS DOUBLE) AS threshold_ms FROM requests WHERE latency_ms > 250.0"""
    )
)
def latency_breaches(spark, sf_dir):
    return R.threshold_breaches(requests(spark, sf_dir), 250.0)


@query(
    with_requests(
        """,
staged AS (SELECT *, CAST(floor((start_us - epoch_us(TIMESTAMP '2024-01-01')) / (432000 * 1e6)) AS BIGINT) AS s FROM requests),
steps AS (SELECT *, CASE WHEN s BETWEEN 0 AND 3 THEN s END AS step,
                 CASE s WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 10 WHEN 3 THEN 20 END AS users FROM staged)
SELECT step, CAST(users AS BIGINT) AS users, count(*) AS total, count(*) FILTER (status = 200) AS successful,
       round(100.0 * count(*) FILTER (status = 200) / count(*), 2) AS success_rate,
       round(avg(latency_ms) FILTER (status = 200), 6) AS avg_latency_ms,
       max(latency_ms) FILTER (status = 200) AS max_latency_ms
FROM steps GROUP BY step, users"""
    )
)
def load_step_profile(spark, sf_dir):
    # The table spans a month, so a step lasts five days instead of thirty seconds.
    start_us = 1_704_067_200_000_000
    return R.load_step_summary(requests(spark, sf_dir), start_us, step_seconds=432_000)


@query(
    with_requests(
        """
SELECT task, count(*) AS n, round(count(*) / (sum(count(*)) OVER ()), 6) AS share,
       round(CASE task WHEN 'predict' THEN 10 ELSE 1 END / 12.0, 6) AS expected_share
FROM requests GROUP BY task"""
    )
)
def traffic_mix(spark, sf_dir):
    return R.traffic_mix(requests(spark, sf_dir))


@query(
    with_requests(
        """,
p AS (SELECT endpoint, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
             quantile_cont(latency_ms, 0.99) AS p99 FROM requests WHERE status = 200 GROUP BY endpoint)
SELECT endpoint, round(p50, 6) AS p50_ms, round(p95, 6) AS p95_ms, round(p99, 6) AS p99_ms,
       p50 < 50 AS p50_met, p95 < 150 AS p95_met, p99 < 250 AS p99_met FROM p"""
    )
)
def latency_slo(spark, sf_dir):
    return R.slo_report(requests(spark, sf_dir), ["endpoint"])


@query(
    with_requests(
        "SELECT endpoint, count(*) AS n, true AS p50_in_bounds, true AS p95_in_bounds, true AS p99_in_bounds FROM requests WHERE status = 200 GROUP BY endpoint"
    )
)
def latency_slo_sketch(spark, sf_dir):
    """Whether the rank of each sketched percentile lies within the error that the sketch promises."""
    log = R.successful(requests(spark, sf_dir))
    ranked = join_totals(log, R.approximate_percentiles(log, ["endpoint"], accuracy=10_000), ["endpoint"])
    n, slack = F.count(F.lit(1)), F.count(F.lit(1)) / 10_000 + 1

    return ranked.groupBy("endpoint").agg(n.alias("n"), *_in_bounds(n, slack))


def _in_bounds(n, slack):
    """Whether the ranks of p50_ms, p95_ms and p99_ms are those asked for, give or take ``slack`` rows."""

    def one(name, share):
        below, upto = F.count_if(F.col("latency_ms") < F.col(name)), F.count_if(F.col("latency_ms") <= F.col(name))
        return (F.coalesce(below <= share * n + slack, F.lit(False)) & (upto >= share * n - slack)).alias(name.replace("_ms", "_in_bounds"))

    return [one(f"p{p}_ms", p / 100) for p in (50, 95, 99)]


@query(
    with_requests(
        """
SELECT endpoint, count(*) AS n, count(DISTINCT date_trunc('hour', ts)) AS sketches, true AS p50_in_bounds, true AS p95_in_bounds, true AS p99_in_bounds
FROM requests WHERE status = 200 GROUP BY endpoint"""
    )
)
def latency_slo_merged(spark, sf_dir):
    """Percentiles from one stored sketch per endpoint and hour, merged; whether their ranks lie within a percent."""
    log = R.successful(requests(spark, sf_dir)).withColumn("hour", F.date_trunc("hour", "start_ts"))
    path = scratch_path(spark, "latency-sketches")
    R.latency_sketches(log, ["endpoint", "hour"]).write.parquet(path)
    stored = spark.read.parquet(path)
    merged = R.merged_percentiles(stored, ["endpoint"]).join(stored.groupBy("endpoint").agg(F.count(F.lit(1)).alias("sketches")), "endpoint")
    n = F.count(F.lit(1))
    return (
        join_totals(log.select("endpoint", "latency_ms"), merged, ["endpoint"])
        .groupBy("endpoint")
        .agg(n.alias("n"), F.max("sketches").alias("sketches"), *_in_bounds(n, 0.01 * n + 1))
    )


@query(
    with_requests(
        """
SELECT strftime(ts, '%Y-%m-%d') AS period, count(*) AS checks,
       round(100.0 * count(*) FILTER (status = 200) / count(*), 6) AS uptime_pct,
       100.0 * count(*) FILTER (status = 200) / count(*) >= 99.9 AS met
FROM requests GROUP BY 1"""
    )
)
def daily_uptime(spark, sf_dir):
    return R.uptime(requests(spark, sf_dir), F.date_format("start_ts", "yyyy-MM-dd"))
