"""Bronze, silver and gold layers as batch jobs over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelpulse.operators import requests as R
from modelpulse.sources.tables import requests_from_events

RAW_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def write_bronze(raw_lines: DataFrame, path: str) -> None:
    """Raw lines as they came."""
    raw_lines.write.mode("append").parquet(path)


def parsed_events(bronze: DataFrame) -> DataFrame:
    """Events with their day; a line that does not parse is left to ``broken_lines``."""
    parsed = bronze.select(F.from_json("value", RAW_SCHEMA).alias("r")).select("r.*")
    return parsed.where(F.col("event_id").isNotNull()).withColumn("day", F.to_date("ts"))


def without_repeats(events: DataFrame) -> DataFrame:
    """One row per event id, the smallest if repeats differ, whatever their days; one without a time stands beside it."""
    rest = [c for c in events.columns if c != "event_id"]
    one = events.groupBy("event_id", F.col("day").isNull()).agg(F.min(F.struct(*rest)).alias("r"))
    return one.select("event_id", "r.*")


def silver_from(bronze: DataFrame) -> DataFrame:
    return without_repeats(parsed_events(bronze))


def broken_lines(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.coalesce(F.from_json("value", RAW_SCHEMA)["event_id"].isNull(), F.lit(True)))


def gold_from(silver: DataFrame) -> DataFrame:
    """Request summary per hour and endpoint."""
    log = requests_from_events(silver).withColumn("hour", F.date_format("start_ts", "yyyy-MM-dd HH"))
    return R.request_summary(log, ["hour", "endpoint"])


def run(spark: SparkSession, raw_lines: DataFrame, base: str) -> DataFrame:
    """All three layers under ``base``, and the broken lines; each is written before the next one reads it."""
    write_bronze(raw_lines, f"{base}/bronze")
    broken_lines(spark.read.parquet(f"{base}/bronze")).write.mode("overwrite").parquet(f"{base}/broken")
    silver_from(spark.read.parquet(f"{base}/bronze")).write.mode("overwrite").parquet(f"{base}/silver")
    gold_from(spark.read.parquet(f"{base}/silver")).write.mode("overwrite").parquet(f"{base}/gold")
    return spark.read.parquet(f"{base}/gold")
