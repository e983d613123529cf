"""Queries for features, validation, drift, cost and layered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.operators import cost as CO
from modelpulse.operators import drift as DR
from modelpulse.operators import features as FE
from modelpulse.operators import metrics as ME
from modelpulse.operators import validation as V
from modelpulse.plans import medallion
from modelpulse.plans.registry import query, with_requests
from modelpulse.session import literal_table, scratch_path
from modelpulse.sources.tables import load, requests


@query(
    """
SELECT CAST(o_custkey AS INTEGER) AS customer_id, CAST(count(*) AS INTEGER) AS txn_count,
       round(avg(o_totalprice), 6) AS avg_amount FROM orders GROUP BY o_custkey"""
)
def customer_features(spark, sf_dir):
    table = FE.customer_features(load(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")
    return table.withColumn("avg_amount", F.round("avg_amount", 6))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return FE.duplicate_keys(load(spark, sf_dir, "orders"), "o_custkey")


@query(
    """
WITH clicks AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'click' GROUP BY user_id, ts)
SELECT p.event_id, p.user_id, epoch_us(p.ts) AS ts_us, c.value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN clicks c
  ON p.user_id = c.user_id AND p.ts >= c.ts"""
)
def point_in_time_features(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
    spine = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts_us")
    clicks = events.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", "ts_us", "value"
    )
    return FE.point_in_time(spine, clicks, "user_id", "ts_us", "event_id", "click_id", "value")


@query(
    """
WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_custkey IS NULL) AS f1,
                  count(*) FILTER (NOT coalesce(o_totalprice BETWEEN 1000 AND 500000, false)) AS f2,
                  count(*) FILTER (NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) AS f3,
                  count(*) FILTER (NOT coalesce(regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$'), false)) AS f4 FROM orders),
k AS (SELECT count(*) AS n FROM orders GROUP BY o_orderkey),
l AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
r AS (SELECT 'order customer known' AS rule, count(*) AS checked, count(*) FILTER (c_custkey IS NULL) AS failed
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      UNION ALL SELECT 'item order known', count(*), count(*) FILTER (o_orderkey IS NULL)
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
rules AS (SELECT 'customer present' AS rule, n AS checked, f1 AS failed FROM o
  UNION ALL SELECT 'price in range', n, f2 FROM o UNION ALL SELECT 'status in set', n, f3 FROM o
  UNION ALL SELECT 'priority form', n, f4 FROM o
  UNION ALL SELECT 'order key unique', sum(n), coalesce(sum(n) FILTER (n > 1), 0) FROM k
  UNION ALL SELECT 'item key unique', sum(n), coalesce(sum(n) FILTER (n > 1), 0) FROM l
  UNION ALL SELECT * FROM r)
SELECT rule, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed, failed = 0 AS passed FROM rules"""
)
def validation_report(spark, sf_dir):
    orders, items = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    rules = {
        "customer present": V.not_null("o_custkey"),
        "price in range": V.in_range("o_totalprice", 1000, 500000),
        "status in set": V.in_set("o_orderstatus", ["F", "O", "P"]),
        "priority form": V.matches("o_orderpriority", "^[1-5]-[A-Z]+$"),
    }
    return V.report(
        [
            V.row_rules(orders, rules),
            V.unique_rule(orders, ["o_orderkey"], "order key unique"),
            V.unique_rule(items, ["l_orderkey", "l_linenumber"], "item key unique"),
            V.reference_rule(orders, "o_custkey", load(spark, sf_dir, "customer"), "c_custkey", "order customer known"),
            V.reference_rule(items, "l_orderkey", orders, "o_orderkey", "item order known"),
        ]
    )


SPLIT = "2024-01-16"


def _windows(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return events, F.col("ts") < F.to_timestamp_ntz(F.lit(SPLIT))


@query(
    f"""
WITH e AS (SELECT value, ts < TIMESTAMP '{SPLIT}' AS ref FROM events),
edges AS (SELECT unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edge FROM e WHERE ref),
binned AS (SELECT ref, (SELECT count(*) FROM edges WHERE e.value > edge) AS bin FROM e),
shares AS (SELECT b.bin, greatest(count(*) FILTER (ref) / (SELECT count(*) FROM e WHERE ref), 1e-6) AS r,
                  greatest(count(*) FILTER (NOT ref) / (SELECT count(*) FROM e WHERE NOT ref), 1e-6) AS c
           FROM range(10) AS b(bin) LEFT JOIN binned USING (bin) GROUP BY b.bin)
SELECT 'value' AS feature, (SELECT count(*) FROM e WHERE ref) AS n_reference, (SELECT count(*) FROM e WHERE NOT ref) AS n_current,
       round(sum((c - r) * ln(c / r)), 6) AS psi, sum((c - r) * ln(c / r)) > 0.2 AS alert FROM shares"""
)
def stability_index(spark, sf_dir):
    events, reference = _windows(spark, sf_dir)
    return DR.population_stability(events, reference, "value")


@query(
    f"""
WITH e AS (SELECT value, ts < TIMESTAMP '{SPLIT}' AS ref FROM events),
n AS (SELECT count(*) FILTER (ref) AS n, count(*) FILTER (NOT ref) AS m FROM e),
v AS (SELECT value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM e GROUP BY value),
cdf AS (SELECT sum(r) OVER (ORDER BY value) AS cr, sum(c) OVER (ORDER BY value) AS cc FROM v),
d AS (SELECT max(abs(cr / n - cc / m)) AS ks FROM cdf, n)
SELECT 'value' AS feature, n AS n_reference, m AS n_current, round(ks, 9) AS ks,
       ks > 1.358 * sqrt((n + m) / (CAST(n AS DOUBLE) * m)) AS alert FROM d, n"""
)
def distribution_shift(spark, sf_dir):
    events, reference = _windows(spark, sf_dir)
    return DR.kolmogorov_smirnov(events, reference, "value")


WEEKLY = """
judged AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS BIGINT) AS week,
                  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS actual,
                  CASE WHEN value > 100 THEN 1 ELSE 0 END AS predicted FROM events),
counted AS (SELECT week, count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 0 AND predicted = 1) AS fp,
                   count(*) FILTER (actual = 1 AND predicted = 0) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp
            FROM judged GROUP BY week),
scored AS (SELECT *, round(coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0), 9) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM counted)
"""


def _weekly(spark, sf_dir):
    week = F.floor(F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).cast("bigint")
    judged = load(spark, sf_dir, "events").select(
        week.alias("week"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("actual"),
        F.when(F.col("value") > 100, 1).otherwise(0).alias("predicted"),
    )
    return ME.binary_scores(judged, "actual", "predicted", ["week"])


@query(f"WITH {WEEKLY} SELECT * FROM scored")
def concept_drift(spark, sf_dir):
    return _weekly(spark, sf_dir)


@query(
    f"""WITH {WEEKLY},
long AS (SELECT week, unnest(['accuracy', 'precision', 'recall', 'f1']) AS metric, unnest([accuracy, precision, recall, f1]) AS score FROM scored)
SELECT metric, b.score AS baseline, c.score AS candidate, round(c.score - b.score, 9) AS delta,
       CASE WHEN round(c.score - b.score, 9) < -0.01 THEN 'rollback' ELSE 'keep' END AS decision
FROM (SELECT * FROM long WHERE week = 0) b JOIN (SELECT * FROM long WHERE week = 3) c USING (metric)"""
)
def regression_gate(spark, sf_dir):
    names = ["accuracy", "precision", "recall", "f1"]
    long = _weekly(spark, sf_dir).select(
        "week", F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("score")) for n in names]))
    )
    return DR.regression_gate(long.where(F.col("week") == 0), long.where(F.col("week") == 3))


# Unit prices per resource; a handful of rows that the cost report takes as its price table.
PRICES = [("compute", 0.002), ("storage", 0.0005), ("egress", 0.01)]


@query(
    with_requests(
        """,
usage AS (SELECT strftime(ts, '%Y-%m') AS month, 'compute' AS resource, inference_ms / 1000.0 AS usage FROM requests
          UNION ALL SELECT strftime(ts, '%Y-%m'), 'storage', 1.0 FROM requests
          UNION ALL SELECT strftime(ts, '%Y-%m'), 'egress', latency_ms / 100.0 FROM requests WHERE status = 200),
priced AS (SELECT month, resource, sum(usage) * CASE resource WHEN 'compute' THEN 0.002 WHEN 'storage' THEN 0.0005 ELSE 0.01 END AS cost
           FROM usage GROUP BY month, resource)
SELECT month, resource, round(CAST(cost AS DOUBLE), 4) AS cost FROM priced
UNION ALL SELECT month, 'TOTAL', round(CAST(sum(cost) AS DOUBLE), 4) FROM priced GROUP BY month"""
    )
)
def monthly_cost(spark, sf_dir):
    log = requests(spark, sf_dir)
    month = F.date_format("start_ts", "yyyy-MM").alias("month")

    def line(resource, amount):
        return F.struct(F.lit(resource).alias("resource"), amount.cast("double").alias("usage"))

    served = F.when(F.col("status") == 200, F.col("latency_ms") / 100.0).otherwise(0.0)
    usage = log.select(
        month,
        F.inline(F.array(line("compute", F.col("inference_ms") / 1000.0), line("storage", F.lit(1.0)), line("egress", served))),
    )
    prices = literal_table(spark, ["resource", "unit_price"], PRICES)
    return CO.cost_by_resource(usage, prices, "month")


@query(
    with_requests(
        """
SELECT endpoint, count(*) AS queries, round(sum(inference_ms) / 1000.0 * 0.002 / count(*), 9) AS cost_per_query,
       round(sum(inference_ms) / 1000.0 * 0.002 / count(*) * 1e6, 6) AS cost_per_million FROM requests GROUP BY endpoint"""
    )
)
def cost_per_million(spark, sf_dir):
    return CO.cost_per_million(requests(spark, sf_dir), ["endpoint"], 0.002)


@query(
    """
WITH runs AS (SELECT l_returnflag AS benchmark, l_linenumber AS workers, sum(l_quantity) / 1000.0 AS hours FROM lineitem GROUP BY 1, 2)
SELECT benchmark, workers, hours, round(first_value(hours) OVER (PARTITION BY benchmark ORDER BY workers) / hours, 4) AS speedup,
       round(first_value(hours) OVER (PARTITION BY benchmark ORDER BY workers) / hours / workers * 100, 4) AS efficiency_pct FROM runs"""
)
def scaling_table(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    runs = items.groupBy(F.col("l_returnflag").alias("benchmark"), F.col("l_linenumber").alias("workers")).agg(
        (F.sum("l_quantity") / 1000.0).alias("hours")
    )
    return CO.scaling_table(runs, "benchmark", "workers", "hours")


@query(
    """
SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= 2"""
)
def rate_limited_requests(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return CO.rate_limited(events, "user_id", F.to_date("ts"), ["ts", "event_id"], 2).select("event_id", "user_id")


def raw_event_lines(spark, sf_dir):
    """Events as raw JSON lines; every tenth line arrives twice and some are broken, as raw data is."""
    events = load(spark, sf_dir, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")
    line = F.to_json(F.struct("event_id", stamp, "user_id", "event_type", "value", "props"))
    lines = events.select("event_id", line.alias("value"))
    again = lines.where(F.col("event_id") % 10 == 0)
    broken = lines.where(F.col("event_id") % 50 == 0).withColumn("value", F.lit("{broken"))
    return lines.unionByName(again).unionByName(broken).select("value")


@query(
    with_requests(
        """
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, endpoint, count(*) AS total, count(*) FILTER (status = 200) AS successful,
       count(*) FILTER (status <> 200) AS failed, round(100.0 * count(*) FILTER (status = 200) / count(*), 2) AS success_rate,
       coalesce(CAST(round(CAST(CAST(round(sum(latency_ms) FILTER (status = 200), 6) / count(*) FILTER (status = 200) AS VARCHAR)
                                     AS DECIMAL(38, 24)), 6) AS DOUBLE), 0.0) AS avg_latency_ms,
       coalesce(round(sum(latency_ms) FILTER (status = 200), 2), 0.0) AS total_latency_ms
FROM requests GROUP BY 1, 2"""
    )
)
def medallion_gold(spark, sf_dir):
    return medallion.run(spark, raw_event_lines(spark, sf_dir), scratch_path(spark, "medallion"))
