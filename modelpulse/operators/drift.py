"""Drift between two windows, and the gate that compares model versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelpulse.operators.ordered import exact_quantiles, order_blocks, running

PSI_ALERT = 0.2
BINS = 10
EPSILON = 1e-6
# Coefficient of the two-sample test at the 5 % level.
KS_5_PERCENT = 1.358


def population_stability(df: DataFrame, is_reference: Column, value: str, bins: int = BINS, digits: int = 6) -> DataFrame:
    """PSI over equal-frequency bins of the reference window, one row.

    The bin edges are a handful of numbers; the shares of both windows come from one further scan.
    """
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    edges = list(exact_quantiles(df.where(is_reference), [], value, probs).first())
    if any(edge is None for edge in edges):
        raise ValueError("the reference window holds no values")
    v = F.col(value)
    place = reduce(lambda a, b: a + b, [(v > F.lit(edge)).cast("int") for edge in edges])
    tagged = df.where(v.isNotNull()).select(is_reference.alias("_ref"), place.alias("_bin"))
    counted = tagged.agg(
        F.count_if("_ref").alias("n_reference"),
        F.count_if(~F.col("_ref")).alias("n_current"),
        *[F.count_if(F.col("_ref") & (F.col("_bin") == b)).alias(f"_r{b}") for b in range(bins)],
        *[F.count_if(~F.col("_ref") & (F.col("_bin") == b)).alias(f"_c{b}") for b in range(bins)],
    )

    def share(name, total):
        return F.greatest(F.coalesce(F.try_divide(F.col(name).cast("double"), F.col(total)), F.lit(0.0)), F.lit(EPSILON))

    terms = []
    for b in range(bins):
        r, c = share(f"_r{b}", "n_reference"), share(f"_c{b}", "n_current")
        terms.append((c - r) * F.log(c / r))
    psi = reduce(lambda a, b: a + b, terms)
    return counted.select(
        F.lit(value).alias("feature"), "n_reference", "n_current", F.round(psi, digits).alias("psi"), (psi > PSI_ALERT).alias("alert")
    )


def kolmogorov_smirnov(df: DataFrame, is_reference: Column, value: str, digits: int = 9) -> DataFrame:
    """Largest gap between the two running shares, beside the 5 % critical value."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count_if(is_reference).alias("_r"), F.count_if(~is_reference).alias("_c"))
    )
    counts = order_blocks(counts, [], [value])
    cum = running(counts, [], [value], {"_cr": ("sum", "_r"), "_cc": ("sum", "_c")})
    sizes = counts.agg(F.sum("_r"), F.sum("_c")).first()
    n, m = sizes[0] or 0, sizes[1] or 0
    if not n or not m:
        raise ValueError("both windows need values")
    gap = F.abs(F.col("_cr") / F.lit(float(n)) - F.col("_cc") / F.lit(float(m)))
    critical = KS_5_PERCENT * ((n + m) / (n * m)) ** 0.5
    return cum.agg(F.max(gap).alias("_d")).select(
        F.lit(value).alias("feature"),
        F.lit(n).cast("bigint").alias("n_reference"),
        F.lit(m).cast("bigint").alias("n_current"),
        F.round("_d", digits).alias("ks"),
        (F.col("_d") > F.lit(critical)).alias("alert"),
    )


def regression_gate(baseline: DataFrame, candidate: DataFrame, tolerance: float = 0.01, digits: int = 9) -> DataFrame:
    """Rows (metric, score) of two versions side by side; a fall beyond the tolerance asks for a rollback."""
    joined = baseline.select("metric", F.col("score").alias("baseline")).join(
        candidate.select("metric", F.col("score").alias("candidate")), "metric", "full_outer"
    )
    delta = F.round(F.col("candidate") - F.col("baseline"), digits)
    return joined.select(
        "metric",
        "baseline",
        "candidate",
        delta.alias("delta"),
        F.when(delta.isNull(), "missing").when(delta < -tolerance, "rollback").otherwise("keep").alias("decision"),
    )
