"""Queries over queued and scored requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.functions import scalar as S
from modelpulse.operators import batching as B
from modelpulse.operators import requests as R
from modelpulse.operators import scoring as P
from modelpulse.plans.registry import REQUESTS, histogram_sql, query, with_requests
from modelpulse.sources.tables import load, requests

# Events arrive minutes apart, so the tick that fills batches is two hours instead of 50 ms.
TICK_US = 7_200_000_000

# The same closed form over item positions: a running maximum per residue class of the position.
BATCHES = f"""
ticked AS (SELECT *, CAST(ceil(start_us / {float(TICK_US)}) AS BIGINT) AS arrival_tick,
                  row_number() OVER (PARTITION BY endpoint ORDER BY start_us, request_id) - 1 AS n FROM requests),
batches AS (SELECT *, CAST(n // 8 + max(arrival_tick - n // 8) OVER (
                PARTITION BY endpoint, n % 8 ORDER BY n) AS BIGINT) AS batch_tick FROM ticked)
"""


def assigned_batches(spark, sf_dir):
    queue = requests(spark, sf_dir).select("request_id", "endpoint", "start_us", "k", "event_type")
    return B.assign_batches(queue, ["endpoint"], "start_us", "request_id", tick_us=TICK_US)


@query(with_requests(f", {BATCHES} SELECT request_id, endpoint, arrival_tick, batch_tick FROM batches"))
def fifo_batches(spark, sf_dir):
    return assigned_batches(spark, sf_dir).select("request_id", "endpoint", "arrival_tick", "batch_tick")


@query(
    with_requests(
        f""", {BATCHES}
SELECT request_id, batch_tick, event_type = 'error' AS is_bad,
       max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint, batch_tick) = 1 AS batch_failed
FROM batches"""
    )
)
def batch_failures(spark, sf_dir):
    assigned = assigned_batches(spark, sf_dir).withColumn("is_bad", F.col("event_type") == "error")
    return B.spread_failures(assigned, ["endpoint"], "is_bad").select("request_id", "batch_tick", "is_bad", "batch_failed")


@query(
    histogram_sql(
        "sized", "endpoint", "batch_size", R.BATCH_BOUNDS,
        f"{REQUESTS}, {BATCHES}, sized AS (SELECT endpoint, batch_tick, CAST(count(*) AS DOUBLE) AS batch_size "
        "FROM batches GROUP BY endpoint, batch_tick)",
    )
)
def batch_size_histogram(spark, sf_dir):
    sizes = B.batch_sizes(assigned_batches(spark, sf_dir), ["endpoint"])
    return R.histogram(sizes, ["endpoint"], F.col("batch_size").cast("double"), R.BATCH_BOUNDS)


LOGITS = """
logits AS (SELECT vec_id, label, [CAST(x AS DOUBLE) * 10 FOR x IN embedding] AS z FROM embeddings),
shifted AS (SELECT vec_id, label, z, list_max(z) AS top FROM logits),
long AS (SELECT vec_id, label, unnest(z) AS v, top, generate_subscripts(z, 1) - 1 AS class_id FROM shifted),
probs AS (SELECT vec_id, label, CAST(class_id AS INTEGER) AS class_id,
                 exp(v - top) / sum(exp(v - top)) OVER (PARTITION BY vec_id) AS p FROM long)
"""


def _logits(spark, sf_dir):
    """One class score per coordinate of the row's vector."""
    scores = F.transform("embedding", lambda x: x.cast("double") * F.lit(10.0))
    return load(spark, sf_dir, "embeddings").select("vec_id", "label", scores.alias("z"))


@query(f"WITH {LOGITS} SELECT vec_id, class_id, round(p, 6) AS probability FROM probs")
def class_probabilities(spark, sf_dir):
    return _logits(spark, sf_dir).select(
        "vec_id", F.posexplode(S.softmax(F.col("z"))).alias("class_id", "p")
    ).select("vec_id", "class_id", F.round("p", 6).alias("probability"))


RANKED = f"""{LOGITS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class_id) AS rank FROM probs)
"""


@query(
    f"""WITH {RANKED}
SELECT vec_id, CAST(rank AS INTEGER) AS rank, class_id, round(p, 4) AS confidence,
       CASE class_id WHEN 0 THEN 'tench' WHEN 1 THEN 'goldfish' WHEN 2 THEN 'great white shark'
                     ELSE 'class_' || class_id END AS class_name
FROM ranked WHERE rank <= 5"""
)
def top_predictions(spark, sf_dir):
    ranked = P.ranked_predictions(_logits(spark, sf_dir), "vec_id", "z")
    return P.with_class_name(ranked, P.class_dimension(spark))


@query(
    f"""WITH {RANKED}
SELECT vec_id, CAST(rank AS INTEGER) AS rank, class_id, round(p, 4) AS confidence FROM ranked WHERE rank <= 5"""
)
def top_predictions_long(spark, sf_dir):
    long = _logits(spark, sf_dir).select(
        "vec_id", F.posexplode(S.softmax(F.col("z"))).alias("class_id", "probability")
    )
    return P.ranked_predictions_long(long, "vec_id")


@query(
    """
SELECT l_partkey % 300 AS class_id, count(*) AS n,
       CASE l_partkey % 300 WHEN 0 THEN 'tench' WHEN 1 THEN 'goldfish' WHEN 2 THEN 'great white shark'
            WHEN 207 THEN 'golden retriever' WHEN 208 THEN 'Labrador retriever' WHEN 258 THEN 'Samoyed'
            WHEN 259 THEN 'Pomeranian' WHEN 260 THEN 'Chow' WHEN 281 THEN 'tabby cat' WHEN 282 THEN 'tiger cat'
            WHEN 283 THEN 'Persian cat' ELSE 'class_' || (l_partkey % 300) END AS class_name
FROM lineitem GROUP BY l_partkey % 300"""
)
def class_name_counts(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 300).alias("class_id"))
    # Counting before the lookup joins one row per class instead of one per item.
    counted = items.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    return P.with_class_name(counted, P.class_dimension(spark))


@query(
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS predicted FROM embeddings"
)
def argmax_class(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select("vec_id", S.argmax(F.col("embedding")).alias("predicted"))


@query(
    """
WITH long AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round((x - [0.485, 0.456, 0.406][pos % 3 + 1]) / [0.229, 0.224, 0.225][pos % 3 + 1], 6) AS value
FROM long"""
)
def standardised_channels(spark, sf_dir):
    """Every value of the vector, read as interleaved channels."""
    table = load(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(S.standardise_interleaved(F.col("embedding"))).alias("pos", "value"))
    return table.select("vec_id", "pos", F.round("value", 6).alias("value"))


@query(
    """
WITH long AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS i
              FROM embeddings),
scored AS (SELECT vec_id, j AS class_id, sum(x * (((i * 31 + j * 17) % 11 - 5) / 10.0)) AS logit
           FROM long, range(10) AS c(j) GROUP BY vec_id, j)
SELECT vec_id, CAST(class_id AS BIGINT) AS class_id, round(logit, 6) AS logit FROM scored"""
)
def batched_scores(spark, sf_dir):
    scored = P.score_in_batches(load(spark, sf_dir, "embeddings"), "embedding", 64, P.linear_scorer(64, 10))
    return scored.select("vec_id", F.posexplode("logits").alias("class_id", "v")).select(
        "vec_id", F.col("class_id").cast("bigint").alias("class_id"), F.round("v", 6).alias("logit")
    )
