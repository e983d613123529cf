"""Fits against closed forms, drift, validation, features."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelpulse.operators import cost as CO
from modelpulse.operators import drift as DR
from modelpulse.operators import features as FE
from modelpulse.operators import linear as LI
from modelpulse.operators import metrics as ME
from modelpulse.operators import models as MO
from modelpulse.operators import trees as TR
from modelpulse.operators import validation as V


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.2]
    y = x @ [1.5, -2.0, 4.0] + 7 + rng.normal(size=200)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    return x, y, MO.assembled(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"], "y")


def test_ols_equals_closed_form(linear):
    x, y, df = linear
    want = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    model = MO.fit_ols(df)
    assert np.allclose([*model.coefficients, model.intercept], want)


def test_ridge_equals_closed_form(linear):
    x, y, df = linear
    centred, target = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(centred.T @ centred + np.eye(3), centred.T @ target)
    model = MO.fit_ridge(df, 1.0)
    assert np.allclose(list(model.coefficients), want, atol=1e-7)
    assert np.isclose(model.intercept, y.mean() - x.mean(0) @ want)


def test_best_gini_split_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(float(rng.randint(0, 30)), rng.randint(0, 1)) for _ in range(300)]

    def gini(part):
        p = sum(part) / len(part)
        return 1 - p * p - (1 - p) ** 2

    def gain(cut):
        left, right = [y for v, y in rows if v <= cut], [y for v, y in rows if v > cut]
        return gini([y for _, y in rows]) - len(left) / len(rows) * gini(left) - len(right) / len(rows) * gini(right)

    best = max(sorted({v for v, _ in rows})[:-1], key=lambda c: (round(gain(c), 9), -c))
    row = ME.best_gini_splits(spark.createDataFrame(rows, "f double, y int"), ["f"], "y").first()
    assert row["split_value"] == best and row["gain"] == pytest.approx(gain(best), abs=1e-8)


def test_tree_learns_a_step(spark):
    df = MO.assembled(spark.range(400).select((F.col("id") * 1.0).alias("f"), (F.col("id") > 250).cast("int").alias("y")), ["f"], "y")
    model = MO.fit_tree(df)
    assert ME.binary_scores(model.transform(df), "label", "prediction").first()["accuracy"] > 0.99
    assert MO.feature_importances(spark, model, ["f"]).first()["importance"] == pytest.approx(1.0)


def test_point_in_time_takes_the_latest_known(spark):
    rng = random.Random(9)
    spine = [(i, "hot" if i % 3 else "b", rng.randint(0, 400)) for i in range(300)]
    snaps = [(i, "hot" if i % 2 else "b", rng.randint(0, 400), float(i)) for i in range(200)]
    got = FE.point_in_time(
        spark.createDataFrame(spine, "id bigint, k string, t bigint"),
        spark.createDataFrame(snaps, "sid bigint, k string, t bigint, v double"), "k", "t", "id", "sid", "v",
    )
    got = {r["id"]: r["v"] for r in got.collect()}
    for i, k, t in spine:
        known = [(s[2], s[0], s[3]) for s in snaps if s[1] == k and s[2] <= t]
        assert got[i] == (max(known)[2] if known else None)


def test_drift_measures(spark):
    same = spark.range(2000).select((F.col("id") % 100).cast("double").alias("v"), (F.col("id") % 2 == 0).alias("ref"))
    moved = same.withColumn("v", F.when(F.col("ref"), F.col("v")).otherwise(F.col("v") + 40))
    assert not DR.kolmogorov_smirnov(moved.where("false").unionByName(same), F.col("ref"), "v").first()["alert"]
    assert DR.kolmogorov_smirnov(moved, F.col("ref"), "v").first()["ks"] >= 0.4
    assert DR.population_stability(moved, F.col("ref"), "v").first()["alert"]
    assert not DR.population_stability(same, F.col("ref"), "v").first()["alert"]


def test_gate(spark):
    base = spark.createDataFrame([("f1", 0.9), ("auc", 0.8), ("gone", 0.5)], "metric string, score double")
    new = spark.createDataFrame([("f1", 0.88), ("auc", 0.795)], "metric string, score double")
    got = {r["metric"]: r["decision"] for r in DR.regression_gate(base, new).collect()}
    assert got == {"f1": "rollback", "auc": "keep", "gone": "missing"}


def test_validation_counts_nulls_as_failed(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (7, None)], "n int, s string")
    rules = {"range": V.in_range("n", 0, 5), "set": V.in_set("s", ["a", "b"]), "present": V.not_null("s")}
    assert {r["rule"]: r["failed"] for r in V.row_rules(df, rules).collect()} == {"range": 2, "set": 1, "present": 1}
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert V.unique_rule(keys, ["k"], "u").first()["failed"] == 2
    assert V.reference_rule(keys, "k", keys.where("k = 2"), "k", "r").first()["failed"] == 2


def test_costs_without_price_are_unknown(spark):
    usage = spark.createDataFrame([("m", "cpu", 2.0), ("m", "cpu", 3.0), ("m", "odd", 9.0)], "month string, resource string, usage double")
    prices = spark.createDataFrame([("cpu", 0.5)], "resource string, unit_price double")
    got = {r["resource"]: r["cost"] for r in CO.cost_by_resource(usage, prices, "month").collect()}
    assert got == {"cpu": 2.5, "odd": None, "TOTAL": None}


def test_churn_label(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, day(5), "purchase", 1.0), (1, day(29), "view", 1.0), (2, day(5), "click", 2.0), (2, day(30), "purchase", 1.0)]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_type string, value double")
    got = {r["user_id"]: (r["churned"], r["n_events"], r["days_since"]) for r in FE.churn_features(df, "2024-01-28").collect()}
    assert got == {1: (1, 1, 23), 2: (0, 1, 23)}


def brute_tree(rows, depth, node=1):
    """Nodes {node: (n0, n1, feature, threshold)} of rows (features, label), by trying every cut."""
    n = len(rows)
    n1 = sum(y for _, y in rows)
    here = {node: (n - n1, n1, None, None)}
    best = None
    gini = lambda part: 1 - (sum(y for _, y in part) / len(part)) ** 2 - (1 - sum(y for _, y in part) / len(part)) ** 2
    if depth and 0 < n1 < n:
        for f in range(len(rows[0][0])):
            values = sorted({x[f] for x, _ in rows})
            for v, after in zip(values, values[1:]):
                left, right = [r for r in rows if r[0][f] <= v], [r for r in rows if r[0][f] > v]
                gain = round(gini(rows) - len(left) / n * gini(left) - len(right) / n * gini(right), 9)
                if best is None or (-gain, f, v) < best[0]:
                    best = (-gain, f, v), (v + after) / 2, left, right
    if best:
        (_, f, _), threshold, left, right = best
        here[node] = (n - n1, n1, f"f{f}", threshold)
        here |= brute_tree(left, depth - 1, 2 * node) | brute_tree(right, depth - 1, 2 * node + 1)
    return here


@pytest.mark.parametrize("few", [True, False])
def test_exact_tree_equals_trying_every_cut(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(TR, "MAX_BROADCAST_ROWS", 5)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        x = [float(rng.integers(0, 40)), float(np.round(rng.normal(), 3)), float(rng.integers(0, 3))]
        rows.append((i, i % 2, *x, int((x[0] > 15) ^ (x[1] > 0.3) if rng.random() < 0.9 else rng.integers(0, 2))))
    df = spark.createDataFrame(rows, "id int, k int, f0 double, f1 double, f2 double, y int")
    features = ["f0", "f1", "f2"]
    nodes, placed = TR.grow(df, features, "y", 4, ["k"], F.col("id") % 5 != 0)
    got = {k: {} for k in (0, 1)}
    for r in nodes.collect():
        got[r.k][r.node] = (r.n0, r.n1, r.feature, r.threshold)
    for k in (0, 1):
        assert got[k] == brute_tree([(r[2:5], r[5]) for r in rows if r[1] == k and r[0] % 5], 4)
    assert placed.count() == 400
    for depth in (1, 2, 4):
        said = {r.id: r.prediction for r in TR.predictions(nodes, placed, ["k"], depth).collect()}
        for i, k, *x, _ in rows:
            node = 1
            while got[k][node][2] and node < 2**depth:
                _, _, f, t = got[k][node]
                node = 2 * node + (x[features.index(f)] > t)
            assert said[i] == float(got[k][node][1] > got[k][node][0])


def test_tree_of_one_class_or_of_nothing_is_a_leaf(spark):
    schema = "x double, y int"
    nodes, placed = TR.grow(spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 1), (5.0, None)], schema), ["x"], "y", 3)
    assert [tuple(r) for r in nodes.collect()] == [(1, 0, 2, None, None, None)] and placed.count() == 4
    nodes, placed = TR.grow(spark.createDataFrame([], schema), ["x"], "y", 3)
    assert nodes.count() == placed.count() == 0


def test_penalised_models_are_minima(spark):
    """The conditions of a minimum hold, weights vanish under large penalties, and ridge and least squares are the library's."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) * [1, 5, 0.2, 3]
    y = x @ [2.0, 0.0, -3.0, 0.5] + rng.normal(size=500)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double, y double")
    names = ["a", "b", "c", "d"]
    m = LI.moments(df, names, "y")
    assert m.n == 500
    for alpha in (0.01, 0.5, 2.0):
        assert LI.optimality_gap(m, LI.lasso(m, alpha), l1=alpha) < 1e-6
        assert LI.optimality_gap(m, LI.elastic_net(m, alpha), l1=alpha / 2, l2=alpha / 2) < 1e-6
    assert LI.lasso(m, 100.0).weights == [0.0] * 4 and LI.lasso(m, 100.0).intercept == pytest.approx(y.mean())
    train = MO.assembled(df.dropna(), names, "y")
    for mine, library in ((LI.fit(m), MO.fit_ols(train)), (LI.ridge(m, 1.0), MO.fit_ridge(train))):
        assert mine.weights == pytest.approx(list(library.coefficients), rel=1e-6) and mine.intercept == pytest.approx(library.intercept, rel=1e-5)
    assert LI.moments(df.where("false"), names, "y") is None
