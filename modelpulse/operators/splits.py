"""Reproducible splits and folds; none depends on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelpulse.functions.scalar import hash32
from modelpulse.operators.ordered import first_n_by_hash, join_totals, positions

# Seed, test share and fold count.
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
_SPAN = float(2**32)


def in_fraction(key: Column, fraction: float, seed: int = SEED) -> Column:
    """True for about ``fraction`` of the keys; a larger fraction includes every smaller one."""
    return hash32(key, seed) < F.lit(fraction * _SPAN)


def holdout(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Row-wise split by a seeded hash of the key: no shuffle, and retries give the same side."""
    return df.withColumn("is_test", in_fraction(F.col(key), test_share, seed))


def stratified_holdout(
    df: DataFrame, label: str, key: str, test_share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Exactly ceil(share x class size) test rows per class, those with the smallest hashes.

    Classes are never sorted whole: a histogram of hashes finds each class's threshold, and the
    split itself is a filter against one threshold row per class.
    """
    hashed = df.select(label, key).withColumn("_h", hash32(F.col(key), seed))
    limits = first_n_by_hash(hashed, [label], "_h", key, test_share)
    joined = join_totals(df.withColumn("_h", hash32(F.col(key), seed)), limits, [label], "left")
    below = (F.col("_h") < F.col("h_max")) | ((F.col("_h") == F.col("h_max")) & (F.col(key) <= F.col("id_max")))
    return joined.withColumn("is_test", F.coalesce(below, F.lit(False))).drop("_h", "h_max", "id_max")


def contiguous_folds(df: DataFrame, label: str, order: Sequence[str], k: int = FOLDS) -> DataFrame:
    """Folds of consecutive rows within each class, as an unshuffled stratified k-fold makes them."""
    placed = positions(df, [label], order, out="_p")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    joined = join_totals(placed, sizes, [label])
    small, larger = F.floor(F.col("_n") / k), F.col("_n") % k
    border = larger * (small + 1)
    fold = F.when(F.col("_p") < border, F.floor(F.col("_p") / (small + 1))).otherwise(
        larger + F.floor((F.col("_p") - border) / F.greatest(small, F.lit(1)))
    )
    return joined.withColumn("fold", fold.cast("int")).drop("_p", "_n")


def hash_folds(df: DataFrame, key: str, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Folds by hash, for tables where row order carries no meaning: no shuffle at all."""
    return df.withColumn("fold", (hash32(F.col(key), seed) % k).cast("int"))
