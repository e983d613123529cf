"""Request-log analytics: counters, histograms, gauges, latency, load profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql import types as T

from modelpulse.functions import scalar as S
from modelpulse.operators.ordered import exact_quantiles, join_null_safe, running

# Histogram bounds per metric family, in the family's own unit.
DURATION_BOUNDS = [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0]
INFERENCE_BOUNDS = [0.5, 1.0, 2.0, 3.0, 5.0, 10.0]
BATCH_BOUNDS = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]
# Byte-scaled bounds are our own choice; bounds meant for seconds would put every size in +Inf.
BYTE_BOUNDS = [256.0, 1024.0, 4096.0, 16384.0, 65536.0, 262144.0, 1048576.0]

# Step load profile (users per step, seconds per step) and task weights.
STEP_USERS = [1, 5, 10, 20]
STEP_SECONDS = 30
TASK_WEIGHTS = {"predict": 10, "health": 1, "metrics": 1}

# Latency targets in milliseconds and the uptime target in percent.
SLO_MS = {"p50": 50.0, "p95": 150.0, "p99": 250.0}
UPTIME_TARGET = 99.9

# Size of a stored latency sketch: ranks err by less than half a percent.
SKETCH_SIZE = 1024


def succeeded(status: str = "status") -> Column:
    return F.col(status) == 200


def successful(results: DataFrame) -> DataFrame:
    return results.where(succeeded())


def mean_of(total: str, count: str, digits: int = 6) -> Column:
    """Mean from a sum, 0 without rows; the sum sheds its last digits, which depend on the order of summation."""
    return F.coalesce(F.round(F.try_divide(F.round(total, digits), count), digits), F.lit(0.0))


def request_summary(requests: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Totals, success rate and mean latency of the successes; zeros on an empty log."""
    ok = succeeded()
    summed = requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.col("latency_ms"))).alias("_sum"),
    )
    return summed.select(
        *keys,
        "total",
        "successful",
        "failed",
        S.success_rate(F.col("successful"), F.col("total")).alias("success_rate"),
        mean_of("_sum", "successful").alias("avg_latency_ms"),
        F.coalesce(F.round("_sum", 2), F.lit(0.0)).alias("total_latency_ms"),
    )


def latency_summary(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, minimum and maximum latency and mean inference time of the successes.

    A request carries the inference time of its whole batch, so the mean weights batches by size.
    """
    return (
        successful(requests)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
            F.min("latency_ms").alias("min_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
            F.round(F.avg("inference_ms"), 6).alias("avg_inference_ms"),
        )
    )


def request_and_latency_summary(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The request summary and the latency summary of the successes from one scan."""
    ok = succeeded()
    good = F.when(ok, F.col("latency_ms"))
    summed = requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.sum(good).alias("_sum"),
        F.min(good).alias("min_latency_ms"),
        F.max(good).alias("max_latency_ms"),
        F.round(F.avg(F.when(ok, F.col("inference_ms"))), 6).alias("avg_inference_ms"),
    )
    return summed.select(
        *keys,
        "total",
        "successful",
        "failed",
        S.success_rate(F.col("successful"), F.col("total")).alias("success_rate"),
        mean_of("_sum", "successful").alias("avg_latency_ms"),
        F.coalesce(F.round("_sum", 2), F.lit(0.0)).alias("total_latency_ms"),
        "min_latency_ms",
        "max_latency_ms",
        "avg_inference_ms",
    )


def throughput(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Successes per wall second of each run, and the mean number of requests in flight.

    The latter is throughput x mean latency (Little's law); it is not a speed-up over a serial run.
    """
    ok = succeeded()
    wall = (F.max("end_us") - F.min("start_us")) / F.lit(1e6)
    summed = requests.groupBy(*keys).agg(
        F.count_if(ok).alias("successful"),
        wall.alias("_wall"),
        F.avg(F.when(ok, F.col("latency_ms"))).alias("_mean"),
    )
    rate = F.try_divide(F.col("successful"), F.col("_wall"))
    return summed.select(
        *keys,
        "successful",
        F.round("_wall", 6).alias("wall_seconds"),
        F.round(rate, 9).alias("throughput_rps"),
        F.round(rate * F.col("_mean") / 1000, 9).alias("mean_in_flight"),
    )


def request_counter(requests: DataFrame) -> DataFrame:
    return requests.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("value"))


def error_counter(requests: DataFrame) -> DataFrame:
    return (
        requests.where(F.col("error_type").isNotNull())
        .groupBy("error_type", "endpoint")
        .agg(F.count(F.lit(1)).alias("value"))
    )


def bound_label(bound: float) -> str:
    return str(float(bound))


def histogram_aggs(value: Column, bounds: Sequence[float]) -> list[Column]:
    """One cumulative count per bound, the total count and the sum, all from one pass."""
    return [
        *[F.count_if(value <= F.lit(float(b))).alias(f"_le{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_count"),
        F.sum(value).alias("_sum"),
    ]


def histogram_long(wide: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """Rows (keys, sample, le, value) with sample one of bucket, count, sum."""
    rows = [
        *[
            F.struct(F.lit("bucket").alias("sample"), F.lit(bound_label(b)).alias("le"), F.col(f"_le{i}").cast("double").alias("value"))
            for i, b in enumerate(bounds)
        ],
        F.struct(F.lit("bucket").alias("sample"), F.lit("+Inf").alias("le"), F.col("_count").cast("double").alias("value")),
        F.struct(F.lit("count").alias("sample"), F.lit("").alias("le"), F.col("_count").cast("double").alias("value")),
        F.struct(
            F.lit("sum").alias("sample"),
            F.lit("").alias("le"),
            F.round(F.coalesce(F.col("_sum"), F.lit(0.0)), 4).cast("double").alias("value"),
        ),
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def histogram(df: DataFrame, keys: Sequence[str], value: str | Column, bounds: Sequence[float]) -> DataFrame:
    """Cumulative-bucket histogram: rows with value <= bound, plus +Inf, count and sum."""
    value = F.col(value) if isinstance(value, str) else value
    return histogram_long(df.groupBy(*keys).agg(*histogram_aggs(value, bounds)), keys, bounds)


def last_value_gauge(samples: DataFrame, keys: Sequence[str], value: str, ts: str, tie: str) -> DataFrame:
    """Latest value per label set; the tie column decides between equal timestamps."""
    return samples.groupBy(*keys).agg(F.max_by(value, F.struct(ts, tie)).alias("value"))


def concurrency_gauge(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of requests in progress after every instant at which it may change.

    Starts and ends are netted per instant first, so the ordered scan sees distinct instants only.
    """
    changes = requests.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("start_us").alias("at_us"), F.lit(1).alias("change")),
                F.struct(F.col("end_us").alias("at_us"), F.lit(-1).alias("change")),
            )
        ),
    )
    net = changes.groupBy(*keys, "at_us").agg(F.sum("change").alias("change"))
    return running(net, keys, ["at_us"], {"active": ("sum", "change")}).select(*keys, "at_us", "active")


def threshold_breaches(requests: DataFrame, threshold_ms: float) -> DataFrame:
    """Warning events for latencies above the threshold."""
    return requests.where(F.col("latency_ms") > threshold_ms).select(
        "request_id",
        F.lit("WARNING").alias("level"),
        F.lit("High latency detected").alias("message"),
        "latency_ms",
        F.lit(float(threshold_ms)).alias("threshold_ms"),
    )


PREDICTION = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("class_id", T.IntegerType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
RESPONSE = T.StructType(
    [
        T.StructField("success", T.BooleanType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("predictions", T.ArrayType(PREDICTION)),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("inference_ms", T.DoubleType()),
        T.StructField("model", T.StringType()),
        T.StructField("batched", T.BooleanType()),
    ]
)


def validate_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """One outcome per response: ok, invalid (200 without predictions) or failed; and its top prediction.

    The body is JSON; missing numbers default to 0.
    """
    parsed = responses.withColumn("_r", F.from_json(body, RESPONSE))
    top = F.try_element_at(F.col("_r.predictions"), F.lit(1))
    outcome = (
        F.when(~succeeded(), "failed").when(F.size("_r.predictions") > 0, "ok").otherwise("invalid")
    )
    kept = [c for c in responses.columns if c != body]
    return parsed.select(
        *kept,
        outcome.alias("outcome"),
        F.when(outcome == "ok", top["class_name"]).alias("top_prediction"),
        F.when(outcome == "ok", top["confidence"]).alias("confidence"),
        F.coalesce(F.col("_r.latency_ms"), F.lit(0.0)).alias("latency_ms"),
        F.coalesce(F.col("_r.inference_ms"), F.lit(0.0)).alias("inference_ms"),
    )


def load_step_summary(
    requests: DataFrame, start_us: int, step_seconds: float = STEP_SECONDS, users: Sequence[int] = STEP_USERS
) -> DataFrame:
    """Request and latency summary per load step; rows after the last step carry no user count."""
    step = F.floor((F.col("start_us") - F.lit(start_us)) / F.lit(step_seconds * 1e6)).cast("bigint")
    per_step = F.array(*[F.lit(int(u)) for u in users])
    staged = requests.withColumn("step", F.when((step >= 0) & (step < len(users)), step)).withColumn(
        "users", F.get(per_step, F.col("step").cast("int")).cast("bigint")
    )
    ok = succeeded()
    return staged.groupBy("step", "users").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("successful"),
        S.success_rate(F.count_if(ok), F.count(F.lit(1))).alias("success_rate"),
        F.round(F.avg(F.when(ok, F.col("latency_ms"))), 6).alias("avg_latency_ms"),
        F.max(F.when(ok, F.col("latency_ms"))).alias("max_latency_ms"),
    )


def traffic_mix(requests: DataFrame, weights: dict[str, int] = TASK_WEIGHTS) -> DataFrame:
    """Share of each task beside the share its weight asks for."""
    counted = requests.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    total = sum(weights.values())
    expected = F.lit(0.0)
    for task, weight in weights.items():
        expected = F.when(F.col("task") == task, F.lit(weight / total)).otherwise(expected)
    # One row per task, so the window over all of them is small.
    share = counted.withColumn("_all", F.sum("n").over(Window.partitionBy()))
    return share.select(
        "task",
        "n",
        F.round(F.col("n") / F.col("_all"), 6).alias("share"),
        F.round(expected, 6).alias("expected_share"),
    )


def slo_report(requests: DataFrame, keys: Sequence[str], targets: dict[str, float] = SLO_MS) -> DataFrame:
    """Exact latency percentiles of the successes beside their targets."""
    probs = {name: float(name[1:]) / 100 for name in targets}
    found = exact_quantiles(successful(requests), keys, "latency_ms", probs)
    return found.select(
        *keys,
        *[F.round(name, 6).alias(f"{name}_ms") for name in targets],
        *[(F.col(name) < F.lit(limit)).alias(f"{name}_met") for name, limit in targets.items()],
    )


def approximate_percentiles(
    requests: DataFrame, keys: Sequence[str], targets: dict[str, float] = SLO_MS, accuracy: int = 10000
) -> DataFrame:
    """One-pass percentiles by a mergeable sketch, for live boards where an exact rank is not needed."""
    probs = [float(name[1:]) / 100 for name in targets]
    sketched = successful(requests).groupBy(*keys).agg(F.percentile_approx("latency_ms", probs, accuracy).alias("_p"))
    return sketched.select(*keys, *[F.col("_p")[i].alias(f"{name}_ms") for i, name in enumerate(targets)])


def latency_sketches(requests: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Keys, ``requests`` and ``sketch``: a mergeable sketch of the successes' latencies, to be stored per hour or day."""
    return successful(requests).groupBy(*keys).agg(
        F.count("latency_ms").alias("requests"), F.kll_sketch_agg_double("latency_ms", F.lit(size)).alias("sketch")
    )


def merged_percentiles(sketches: DataFrame, keys: Sequence[str], targets: dict[str, float] = SLO_MS) -> DataFrame:
    """Percentiles over any stored sketches, such as those of a day's hours, without the rows that they came from."""
    merged = sketches.groupBy(*keys).agg(F.sum("requests").alias("requests"), F.kll_merge_agg_double("sketch").alias("_all"))
    shares = F.array(*[F.lit(float(name[1:]) / 100) for name in targets])
    found = merged.select(*keys, "requests", F.kll_sketch_get_quantile_double("_all", shares).alias("_p"))
    return found.select(*keys, "requests", *[F.col("_p")[i].alias(f"{name}_ms") for i, name in enumerate(targets)])


def uptime(requests: DataFrame, period: Column, target: float = UPTIME_TARGET) -> DataFrame:
    """Success share in percent per period, with a verdict against the target."""
    rate = 100.0 * F.count_if(succeeded()) / F.count(F.lit(1))
    return (
        requests.groupBy(period.alias("period"))
        .agg(F.count(F.lit(1)).alias("checks"), rate.alias("_rate"))
        .select(
            "period",
            "checks",
            F.round("_rate", 6).alias("uptime_pct"),
            (F.col("_rate") >= target).alias("met"),
        )
    )


def with_latency_percentiles(summary: DataFrame, percentiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_null_safe(summary, percentiles, keys, "left")
