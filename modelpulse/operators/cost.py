"""Cost tables, scaling tables and rate limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cost_by_resource(usage: DataFrame, prices: DataFrame, period: str, digits: int = 4) -> DataFrame:
    """Cost per period and resource, with a TOTAL row per period.

    A resource without a price has no cost, and neither has the total of a period in which it was used.
    Usage is summed before the price lookup; the rollup only sees one row per resource and period.
    """
    summed = usage.groupBy(period, "resource").agg(F.sum("usage").alias("usage"))
    priced = summed.join(prices, "resource", "left").withColumn(
        "cost", F.col("usage") * F.col("unit_price")
    )
    rolled = priced.rollup(period, "resource").agg(F.when(F.count_if(F.col("cost").isNull()) == 0, F.sum("cost")).alias("cost"), F.grouping_id().alias("_g"))
    return rolled.where(F.col("_g") <= 1).select(
        period,
        F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("resource")).alias("resource"),
        F.round("cost", digits).alias("cost"),
    )


def cost_per_million(requests: DataFrame, keys: Sequence[str], price_per_second: float, digits: int = 6) -> DataFrame:
    """Compute cost per query and per million queries from the inference time spent."""
    seconds = F.sum("inference_ms") / 1000.0
    per_query = seconds * F.lit(price_per_second) / F.count(F.lit(1))
    return requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("queries"),
        F.round(per_query, 9).alias("cost_per_query"),
        F.round(per_query * 1e6, digits).alias("cost_per_million"),
    )


def scaling_table(runs: DataFrame, benchmark: str, workers: str, hours: str) -> DataFrame:
    """Speed-up against the one-worker run and efficiency in percent; one row per run."""
    alone = Window.partitionBy(benchmark)
    first = F.max(F.when(F.col(workers) == 1, F.col(hours))).over(alone)
    speedup = F.try_divide(first, F.col(hours))
    return runs.select(
        benchmark,
        workers,
        hours,
        F.round(speedup, 4).alias("speedup"),
        F.round(speedup / F.col(workers) * 100, 4).alias("efficiency_pct"),
    )


def rate_limited(requests: DataFrame, user: str, window: Column, order: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` requests of each user in each window.

    The rank filter lets every task drop all but ``limit`` rows per user before the shuffle.
    """
    first = Window.partitionBy(user, "window").orderBy(*order)
    ranked = requests.withColumn("window", window).withColumn("_rn", F.row_number().over(first))
    return ranked.where(F.col("_rn") <= limit).drop("_rn")
