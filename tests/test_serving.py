"""Counters, histograms, batches, scores and load profile on small cases."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.operators import batching as B
from modelpulse.operators import cost as CO
from modelpulse.operators import metrics as ME
from modelpulse.operators import requests as R
from modelpulse.operators import scoring as P

LOG = "request_id bigint, endpoint string, start_us bigint, end_us bigint, status int, latency_ms double"


def test_empty_log_gives_zeros(spark):
    row = R.request_summary(spark.createDataFrame([], LOG)).first()
    assert (row["total"], row["successful"], row["failed"], row["success_rate"], row["avg_latency_ms"]) == (0, 0, 0, 0.0, 0.0)


def test_bucket_edge_counts_and_inf_is_total(spark):
    df = spark.createDataFrame([(0.1,), (0.5,), (0.50001,), (99.0,)], "v double")
    got = {(r["sample"], r["le"]): r["value"] for r in R.histogram(df, [], "v", R.DURATION_BOUNDS).collect()}
    assert got[("bucket", "0.1")] == 1 and got[("bucket", "0.5")] == 2 and got[("bucket", "1.0")] == 3
    assert got[("bucket", "60.0")] == 3 and got[("bucket", "+Inf")] == got[("count", "")] == 4
    counts = [got[("bucket", str(b))] for b in R.DURATION_BOUNDS]
    assert counts == sorted(counts)


def test_concurrency_ends_at_zero(spark):
    rng = random.Random(3)
    rows = [(i, "e", s := rng.randint(0, 500), s + rng.randint(0, 90), 200, 1.0) for i in range(400)]
    gauge = R.concurrency_gauge(spark.createDataFrame(rows, LOG), ["endpoint"]).orderBy("at_us").collect()
    assert gauge[-1]["active"] == 0 and min(r["active"] for r in gauge) >= 0
    for r in gauge[:: len(gauge) // 20]:
        assert r["active"] == sum(1 for row in rows if row[2] <= r["at_us"] < row[3])


def queue_loop(arrivals, capacity, tick):
    """The queue as it runs: every tick takes the oldest waiting items."""
    waiting = sorted(arrivals)
    out, now = {}, 0
    while waiting:
        now += 1
        due = [a for a in waiting if a[0] <= now * tick][:capacity]
        for item in due:
            out[item[1]] = now
        waiting = [a for a in waiting if a not in due]
    return out


def test_batches_equal_the_queue_loop(spark):
    rng = random.Random(11)
    rows, wanted = [], {}
    for case in range(60):
        n, span = rng.randint(1, 60), rng.choice([5, 40, 400])
        queue = [(rng.randint(1, span), case * 1000 + i) for i in range(n)]
        wanted.update(queue_loop(queue, 4, 10))
        rows += [(case, a, i) for a, i in queue]
    df = spark.createDataFrame(rows, "replica bigint, at bigint, id bigint")
    got = B.assign_batches(df, ["replica"], "at", "id", capacity=4, tick_us=10)
    assert {r["id"]: r["batch_tick"] for r in got.collect()} == wanted


def test_full_tick_spreads_over_following_ticks(spark):
    df = spark.createDataFrame([("r", 1, i) for i in range(20)], "replica string, at bigint, id bigint")
    sizes = B.batch_sizes(B.assign_batches(df, ["replica"], "at", "id"), ["replica"]).orderBy("batch_tick").collect()
    assert [r["batch_size"] for r in sizes] == [8, 8, 4]


def test_one_bad_item_fails_its_batch_only(spark):
    df = spark.createDataFrame([("r", 1, i, i == 3) for i in range(20)], "replica string, at bigint, id bigint, bad boolean")
    spread = B.spread_failures(B.assign_batches(df, ["replica"], "at", "id"), ["replica"], "bad")
    assert sorted(r["id"] for r in spread.where("batch_failed").collect()) == list(range(8))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(-700, 700), min_size=3, max_size=8), min_size=1, max_size=20))
def test_softmax_sums_to_one(spark, vectors):
    df = spark.createDataFrame([(v,) for v in vectors], "z array<double>")
    for row in df.select(S.softmax(F.col("z")).alias("p")).collect():
        assert abs(sum(row["p"]) - 1) < 1e-9


def test_softmax_is_linear_in_the_classes(spark):
    """A thousand classes: the maximum and the total are worked out once per row, not per class."""
    z = F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda c: F.sin((F.col("id") * 37 + c * 11).cast("double")) * 8)
    df = spark.range(2000, numPartitions=8).select("id", z.alias("z"))
    df.where("id < 8").select(S.softmax(F.col("z"))).collect()
    began = time.perf_counter()
    rows = P.ranked_predictions(df, "id", "z").orderBy("id", "rank").collect()
    assert time.perf_counter() - began < 3
    for i in (0, 777, 1999):
        logits = np.sin(i * 37 + np.arange(1, 1001) * 11) * 8
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = np.lexsort((np.arange(1000), -p))[:5]
        assert [(r.class_id, r.confidence) for r in rows[5 * i : 5 * i + 5]] == [(int(c), pytest.approx(p[c], abs=6e-5)) for c in best]


def test_softmax_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [5.0])], "id int, z array<double>")
    assert [r.p for r in df.select("id", S.softmax(F.col("z")).alias("p")).orderBy("id").collect()] == [None, [], [1.0]]


def test_ranked_forms_agree_and_break_ties_by_class(spark):
    df = spark.createDataFrame([(1, [2.0, 3.0, 3.0, 1.0])], "id bigint, z array<double>")
    short = P.ranked_predictions(df, "id", "z", 3).collect()
    assert [(r["rank"], r["class_id"]) for r in short] == [(1, 1), (2, 2), (3, 0)]
    long = df.select("id", F.posexplode(S.softmax(F.col("z"))).alias("class_id", "probability"))
    rows = P.ranked_predictions_long(long, "id", 3).orderBy("rank").collect()
    assert [(r["class_id"], r["confidence"]) for r in rows] == [(r["class_id"], r["confidence"]) for r in short]


def test_class_names(spark):
    df = spark.createDataFrame([(207,), (999,)], "class_id int")
    named = {r["class_id"]: r["class_name"] for r in P.with_class_name(df, P.class_dimension(spark)).collect()}
    assert named == {207: "golden retriever", 999: "class_999"}


def test_batched_scores_do_not_depend_on_batch_size(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(50)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    results = []
    for size in (8, 50):
        scored = P.score_in_batches(df, "v", 6, P.linear_scorer(6, 3), size).orderBy("id").collect()
        results.append(np.array([r["logits"] for r in scored]))
    assert np.allclose(results[0], results[1])


def test_status_codes(spark):
    df = spark.createDataFrame([(None, None), ("HTTPException", 503), ("HTTPException", None), ("ValueError", 404)], "e string, c int")
    assert [r[0] for r in df.select(S.status_code(F.col("e"), F.col("c"))).collect()] == [200, 503, 500, 500]


def test_load_steps(spark):
    rows = [(i, "e", int(t * 1e6), 0, 200, 1.0) for i, t in enumerate([29.9, 30, 119.9, 120])]
    got = R.load_step_summary(spark.createDataFrame(rows, LOG), 0).collect()
    assert sorted(((r["step"], r["users"]) for r in got), key=str) == [(0, 1), (1, 5), (3, 20), (None, None)]


def test_response_outcomes(spark):
    good = '{"predictions": [{"class_name": "tench", "confidence": 0.5}], "latency_ms": 3.5}'
    rows = [(1, 200, good), (2, 200, '{"predictions": []}'), (3, 200, "{}"), (4, 500, good), (5, 200, "not json")]
    got = R.validate_responses(spark.createDataFrame(rows, "id int, status int, body string")).orderBy("id").collect()
    assert [r["outcome"] for r in got] == ["ok", "invalid", "invalid", "failed", "invalid"]
    assert (got[0]["top_prediction"], got[0]["latency_ms"], got[0]["inference_ms"]) == ("tench", 3.5, 0.0)


def test_published_binary_metrics(spark):
    row = ME.scores_from_counts(spark.createDataFrame([(39, 3, 4, 68)], "tn bigint, fp bigint, fn bigint, tp bigint"), 4).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.9386, 0.9577, 0.9444, 0.951)


def test_scores_on_zero_denominators(spark):
    row = ME.binary_scores(spark.createDataFrame([(0, 0)], "a int, p int"), "a", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_published_scaling(spark):
    runs = spark.createDataFrame([("b", 1, 8.5), ("b", 2, 4.7), ("b", 4, 2.6)], "benchmark string, workers int, hours double")
    got = CO.scaling_table(runs, "benchmark", "workers", "hours").orderBy("workers").collect()
    assert [(round(r["speedup"], 2), round(r["efficiency_pct"])) for r in got] == [(1.0, 100), (1.81, 90), (3.27, 82)]


def test_confusion_matrix_keeps_unseen_classes(spark):
    got = ME.confusion_matrix(spark.createDataFrame([(0, 1)], "a int, p int"), "a", "p", [0, 1, 2]).orderBy("actual").collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, 0, 0), (1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]


def test_confusion_matrix_counts_unlisted_predictions(spark):
    rows = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 7), (1, None)], "a int, p int")
    got = ME.confusion_matrix(rows, "a", "p", [0, 1]).orderBy("actual").collect()
    assert [tuple(r) for r in got] == [(0, 1, 0, 1), (1, 0, 1, 2)]


def test_auc_counts_ties_half(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.randint(0, 9)) for _ in range(300)]
    pos, neg = [s for a, s in rows if a], [s for a, s in rows if not a]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    got = ME.auc(spark.createDataFrame(rows, "a int, s int"), "a", "s").first()["auc"]
    assert abs(got - want) < 1e-8
