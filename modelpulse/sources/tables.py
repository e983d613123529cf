"""Table loader and the canonical views the operators are wired to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.session import spread


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, spread over the cores when it has fewer splits than there are."""
    return spread(load(spark, sf_dir, name))


def requests_from_events(events: DataFrame) -> DataFrame:
    """The request log: one row per request with its outcome and durations.

    Works on a batch or a streaming frame; only row-wise expressions are used.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    failed = F.col("event_type") == "error"
    ts = F.col("ts").cast("timestamp")
    return (
        events.select(
            F.col("event_id").alias("request_id"),
            "user_id",
            "event_type",
            k.alias("k"),
            ts.alias("start_ts"),
            F.unix_micros(ts).alias("start_us"),
            F.col("value").alias("latency_ms"),
        )
        .withColumn("end_us", F.col("start_us") + F.round(F.col("latency_ms") * 1000).cast("bigint"))
        .withColumn("inference_ms", F.col("latency_ms") * F.lit(0.75))
        .withColumn("endpoint", F.concat(F.lit("/ep"), (F.col("k") % 4).cast("string")))
        .withColumn("method", F.when(F.col("k") % 3 == 0, "GET").otherwise("POST"))
        .withColumn(
            "run",
            F.when(F.col("user_id") % 3 == 0, "sequential")
            .when(F.col("user_id") % 3 == 1, "async")
            .otherwise("threads"),
        )
        .withColumn(
            "task",
            F.when(F.col("event_type") == "view", "health")
            .when(F.col("event_type") == "signup", "metrics")
            .otherwise("predict"),
        )
        .withColumn(
            "error_type",
            F.when(failed & (F.col("k") % 2 == 0), "HTTPException").when(failed, "ValueError"),
        )
        .withColumn("http_code", F.when(failed & (F.col("k") % 4 == 0), 503))
        .withColumn("status", S.status_code(F.col("error_type"), F.col("http_code")))
        .drop("http_code")
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(load(spark, sf_dir, "events"))


def text_features(documents: DataFrame) -> DataFrame:
    """Numeric features of each whole text."""
    tokens = S.words(F.col("text"))
    return documents.select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(tokens).cast("double").alias("n_words"),
        F.size(F.array_distinct(tokens)).cast("double").alias("n_distinct"),
        (F.regexp_count("text", F.lit("\n")) + 1).cast("double").alias("n_lines"),
    )


FEATURES = ["n_words", "n_distinct", "n_lines"]


def labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: features joined to the 0/1 target."""
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    # Features first: where the join shuffles, a few numbers per document travel instead of its text.
    return text_features(load_texts(spark, sf_dir, "documents")).join(labels, "doc_id")
