"""Feature tables: aggregates per key, point-in-time lookup, churn features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.operators.ordered import running


def customer_features(transactions: DataFrame, customer: str, amount: str) -> DataFrame:
    """customer_id, txn_count, avg_amount; one row per customer by construction."""
    return transactions.groupBy(F.col(customer).cast("int").alias("customer_id")).agg(
        F.count(F.lit(1)).cast("int").alias("txn_count"), F.avg(amount).alias("avg_amount")
    )


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; empty for a valid feature table."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def point_in_time(
    spine: DataFrame, snapshots: DataFrame, key: str, ts: str, spine_id: str, snapshot_id: str, value: str
) -> DataFrame:
    """For every spine row, the latest snapshot value at or before its time (NULL when there is none).

    Both sides are stacked and the last snapshot is carried forward along each key, so no row is
    multiplied. Of snapshots with equal time the one with the largest id counts.
    """
    fields = [key, ts, "_rank", "_tie", "_snapshot", "_id"]
    left = spine.select(
        key, ts, F.lit(1).alias("_rank"), F.col(spine_id).alias("_tie"), F.lit(None).cast("struct<v:double>").alias("_snapshot"), F.col(spine_id).alias("_id")
    )
    right = snapshots.select(
        key, ts, F.lit(0).alias("_rank"), F.col(snapshot_id).alias("_tie"),
        F.struct(F.col(value).cast("double").alias("v")).alias("_snapshot"), F.lit(None).cast(spine.schema[spine_id].dataType).alias("_id"),
    )
    stacked = left.unionByName(right).select(*fields)
    carried = running(stacked, [key], [ts, "_rank", "_tie"], {"_last": ("last", "_snapshot")})
    return carried.where(F.col("_rank") == 1).select(
        F.col("_id").alias(spine_id), key, ts, F.col("_last.v").alias(value)
    )


def churn_features(events: DataFrame, cutoff: str) -> DataFrame:
    """Activity of each user before the cutoff, and churned = 1 without a purchase from then on."""
    before = F.col("ts") < F.to_timestamp_ntz(F.lit(cutoff))

    def count_of(kind):
        return F.count_if(before & (F.col("event_type") == kind))

    last_seen = F.max(F.when(before, F.col("ts")))
    return events.groupBy("user_id").agg(
        F.count_if(before).alias("n_events"),
        count_of("purchase").alias("n_purchases"),
        count_of("error").alias("n_errors"),
        count_of("click").alias("n_clicks"),
        F.round(F.coalesce(F.sum(F.when(before, F.col("value"))), F.lit(0.0)), 4).alias("total_value"),
        F.coalesce(F.date_diff(F.to_date(F.lit(cutoff)), F.to_date(last_seen)), F.lit(-1)).cast("bigint").alias("days_since"),
        F.when(F.count_if(~before & (F.col("event_type") == "purchase")) > 0, 0).otherwise(1).alias("churned"),
    )


CHURN_FEATURES = ["n_events", "n_purchases", "n_errors", "n_clicks", "total_value", "days_since"]
