"""Data validation: row rules in one pass, key uniqueness, references between tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def in_range(column: str, low: float, high: float) -> Column:
    return F.col(column).between(low, high)


def in_set(column: str, allowed: Sequence) -> Column:
    return F.col(column).isin(*allowed)


def matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def _verdict(df: DataFrame) -> DataFrame:
    return df.select("rule", "checked", "failed", (F.col("failed") == 0).alias("passed"))


def row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row rules from a single scan; a NULL outcome counts as failed."""
    failed = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"_{i}") for i, ok in enumerate(rules.values())]
    counted = df.agg(F.count(F.lit(1)).alias("checked"), *failed)
    rows = [F.struct(F.lit(name).alias("rule"), F.col("checked"), F.col(f"_{i}").alias("failed")) for i, name in enumerate(rules)]
    return _verdict(counted.select(F.inline(F.array(*rows))))


def unique_rule(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows that share their key with another row."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
    )
    return _verdict(total.withColumn("rule", F.lit(name)))


def reference_rule(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows whose key is missing in the parent; keys are counted first, so a hot key is one row."""
    counted = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_k"), F.lit(True).alias("_known")).distinct()
    joined = counted.join(known, "_k", "left")
    total = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
    )
    return _verdict(total.withColumn("rule", F.lit(name)))


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
