"""Block scans against plain Python on skewed keys, ties and NULL keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelpulse.operators import ordered
from modelpulse.operators.ordered import exact_quantiles, first_n_by_hash, positions, running
from modelpulse.operators.splits import contiguous_folds, holdout, stratified_holdout


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        rows.append((key, rng.randint(0, 200), i, rng.choice([None, rng.randint(-50, 50)])))
    return rows, spark.createDataFrame(rows, "k string, t bigint, id bigint, v bigint").repartition(5)


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def test_positions(skewed):
    rows, df = skewed
    got = {r["id"]: r["position"] for r in positions(df, ["k"], ["t", "id"]).collect()}
    want = {row[2]: i for group in by_key(rows).values() for i, row in enumerate(group)}
    assert got == want


def test_running_aggregates(skewed):
    rows, df = skewed
    specs = {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "last": ("last", "v")}
    got = {r["id"]: (r["s"], r["lo"], r["hi"], r["last"]) for r in running(df, ["k"], ["t", "id"], specs).collect()}
    assert len(got) == len(rows)
    for group in by_key(rows).values():
        seen = []
        for row in group:
            if row[3] is not None:
                seen.append(row[3])
            total, lo, hi, last = got[row[2]]
            assert (lo, hi, last) == ((min(seen), max(seen), seen[-1]) if seen else (None, None, None))
            assert total == (pytest.approx(sum(seen)) if seen else None)


def test_running_sum_carries_over_blocks_of_nulls(spark):
    df = spark.range(80).select("id", F.lit("k").alias("k"), F.when(F.col("id") < 40, 1).alias("v"))
    got = running(df, ["k"], ["id"], {"s": ("sum", "v")}).orderBy("id").collect()
    assert [r["s"] for r in got] == [min(i + 1, 40) for i in range(80)]


def test_running_sum_without_keys(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    got = running(df, [], ["id"], {"s": ("sum", "v")}).orderBy("id").collect()
    assert [r["s"] for r in got] == list(np.cumsum([i % 7 for i in range(1000)]))


def test_exact_quantiles(skewed):
    rows, df = skewed
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    for row in exact_quantiles(df, ["k"], "v", probs).collect():
        values = [r[3] for r in rows if r[0] == row["k"] and r[3] is not None]
        assert [row[n] for n in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()])


@pytest.mark.parametrize("few", [True, False])
def test_exact_quantiles_of_large_groups(spark, monkeypatch, few):
    """Groups beyond the sketch's accuracy: near-distinct values, heavy ties, wide ranges, a hot group, a small one, a null key."""
    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 200)
    if not few:
        monkeypatch.setattr(ordered, "MAX_BROADCAST_ROWS", 10)
    rng = np.random.default_rng(6)
    groups = {
        "near": rng.normal(size=30_000),
        "ties": np.floor(rng.exponential(3, size=5_000)),
        "wide": np.exp(rng.normal(size=4_000) * 20),
        "small": rng.normal(size=7),
        None: rng.normal(size=900),
        "one": np.full(3_000, 4.25),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("near", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probs = {"p99": 0.99, "p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = exact_quantiles(df, ["k"], "v", probs).collect()
    assert len(got) == len(groups)
    for row in got:
        assert [row[n] for n in probs] == pytest.approx([np.quantile(groups[row["k"]], p) for p in probs.values()], rel=1e-12)
    everything = np.concatenate(list(groups.values()))
    row = exact_quantiles(df, [], "v", probs).first()
    assert [row[n] for n in probs] == pytest.approx([np.quantile(everything, p) for p in probs.values()], rel=1e-12)
    assert exact_quantiles(df.where("false"), [], "v", probs).first()["p50"] is None
    assert exact_quantiles(df.where("false"), ["k"], "v", probs).count() == 0


def test_few_rows_of_a_large_group_move(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 1000)
    df = spark.range(200_000).select((F.col("id") % 2).alias("k"), F.rand(5).alias("v"))
    near = ordered._between_sketched(df, ["k"], "v", [0.5, 0.95, 0.99])
    assert near.groupBy("k", "v").count().count() < 0.03 * 200_000


def test_hash_threshold_is_exact(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("k"), F.pmod(F.xxhash64("id"), F.lit(2**32)).alias("h"))
    for share, wanted in ((0.28, 700), (0.0001, 1), (1.0, 2500)):
        limits = first_n_by_hash(df, ["k"], "h", "id", share).collect()
        assert len(limits) == 2
        for row in limits:
            hashes = sorted((r["h"], r["id"]) for r in df.where(F.col("k") == row["k"]).collect())
            assert (row["h_max"], row["id_max"]) == hashes[wanted - 1]


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("y"))
    for split in (lambda d: holdout(d, "id"), lambda d: stratified_holdout(d, "y", "id")):
        one = {r["id"]: r["is_test"] for r in split(df.repartition(1)).collect()}
        many = {r["id"]: r["is_test"] for r in split(df.repartition(9)).collect()}
        assert one == many and len(one) == 2000


def test_stratified_sizes(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    counted = stratified_holdout(df, "y", "id").groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t"))
    for row in counted.collect():
        assert row["t"] == int(np.ceil(row["n"] * 0.2))


def test_folds_match_ntile_for_uneven_classes(spark):
    df = spark.createDataFrame([(i, "a" if i < 13 else "b") for i in range(16)], "id bigint, y string")
    folds = {}
    for row in contiguous_folds(df, "y", ["id"], 5).orderBy("id").collect():
        folds.setdefault(row["y"], []).append(row["fold"])
    assert folds["a"] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 4]
    assert folds["b"] == [0, 1, 2]
