"""Queries over feature tables: splits, scores, fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelpulse.operators import features as FE
from modelpulse.operators import linear as LI
from modelpulse.operators import metrics as ME
from modelpulse.operators import models as MO
from modelpulse.operators import splits as SP
from modelpulse.operators import trees as TR
from modelpulse.plans.registry import query
from modelpulse.session import pin
from modelpulse.sources.tables import FEATURES, labelled_frame, load, load_texts, text_features

# The word features of sources.tables, in SQL.
TEXT = """
tokens AS (SELECT *, regexp_extract_all(text, '\\S+') AS w FROM documents),
features AS (SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(w) AS DOUBLE) AS n_words,
                    CAST(len(list_distinct(w)) AS DOUBLE) AS n_distinct,
                    CAST(len(regexp_extract_all(text, chr(10))) + 1 AS DOUBLE) AS n_lines FROM tokens),
frame AS (SELECT f.*, l.quality AS target FROM features f JOIN labels l USING (doc_id))
"""
HASH = "CAST(concat('0x', substr(md5('42:' || doc_id), 1, 8)) AS BIGINT)"
TEST_LIMIT = "858993459.2"


@query(f"WITH {TEXT} SELECT * FROM frame")
def labelled_table(spark, sf_dir):
    return labelled_frame(spark, sf_dir)


@query(f"WITH {TEXT} SELECT doc_id, n_words, n_distinct, n_lines FROM frame")
def feature_columns(spark, sf_dir):
    return labelled_frame(spark, sf_dir).drop("target", "lang", "source", "n_chars")


@query("SELECT doc_id, quality FROM labels ORDER BY doc_id LIMIT 5")
def head_rows(spark, sf_dir):
    return load(spark, sf_dir, "labels").select("doc_id", "quality").orderBy("doc_id").limit(5)


@query(f"SELECT doc_id, {HASH} < {TEST_LIMIT} AS is_test FROM documents")
def holdout_split(spark, sf_dir):
    return SP.holdout(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(
    f"""
WITH ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {HASH}, doc_id) AS rn,
                       count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, rn <= ceil(0.2 * n) AS is_test FROM ranked"""
)
def stratified_split(spark, sf_dir):
    return SP.stratified_holdout(load(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("SELECT doc_id, quality, CAST(ntile(5) OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM labels")
def stratified_folds(spark, sf_dir):
    return SP.contiguous_folds(load(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", ["doc_id"])


@query(f"SELECT doc_id, CAST({HASH} % 5 AS INTEGER) AS fold FROM labels")
def hashed_folds(spark, sf_dir):
    return SP.hash_folds(load(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query(
    f"""WITH {TEXT}
SELECT lang, count(*) AS n, round(avg((n_chars - n_words * 6.0) ** 2), 6) AS mse,
       round(1 - avg((n_chars - n_words * 6.0) ** 2) / var_pop(n_chars), 9) AS r2 FROM features GROUP BY lang"""
)
def regression_scores(spark, sf_dir):
    predicted = text_features(load_texts(spark, sf_dir, "documents")).withColumn("predicted", F.col("n_words") * 6.0)
    return ME.regression_scores(predicted, "n_chars", "predicted", ["lang"])


# A fixed rule stands in for a model, so that no fit enters the SQL comparison.
RULE = """
judged AS (SELECT l.doc_id, l.quality AS actual, CASE WHEN d.n_chars BETWEEN 200 AND 5000 THEN 1 ELSE 0 END AS predicted,
                  d.lang, d.n_chars FROM labels l JOIN documents d USING (doc_id))
"""


def _judged(spark, sf_dir):
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("actual"))
    rule = F.when(F.col("n_chars").between(200, 5000), 1).otherwise(0)
    return labels.join(documents, "doc_id").withColumn("predicted", rule)


BINARY = """
counted AS (SELECT {keys} count(*) FILTER (actual <> 1 AND predicted <> 1) AS tn, count(*) FILTER (actual <> 1 AND predicted = 1) AS fp,
                   count(*) FILTER (actual = 1 AND predicted <> 1) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp
            FROM judged {group})
SELECT *, round(coalesce((tp + tn) / nullif(tn + fp + fn + tp, 0), 0), 9) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM counted
"""


@query(f"WITH {RULE}, {BINARY.format(keys='lang,', group='GROUP BY lang')}")
def binary_scores(spark, sf_dir):
    return ME.binary_scores(_judged(spark, sf_dir), "actual", "predicted", ["lang"])


@query(
    f"""WITH {RULE}
SELECT CAST(actual AS BIGINT) AS actual, count(*) FILTER (predicted = 0) AS pred_0, count(*) FILTER (predicted = 1) AS pred_1,
       count(*) FILTER (predicted IS NULL OR predicted NOT IN (0, 1)) AS pred_other
FROM judged GROUP BY actual"""
)
def confusion_matrix(spark, sf_dir):
    return ME.confusion_matrix(_judged(spark, sf_dir), "actual", "predicted", [0, 1])


@query(
    f"""WITH {RULE},
classes AS (SELECT c, count(*) FILTER (actual = c) AS support, count(*) FILTER (predicted = c) AS said,
                   count(*) FILTER (actual = c AND predicted = c) AS tp
            FROM judged, (VALUES (0), (1)) AS v(c) GROUP BY c),
scores AS (SELECT CAST(c AS VARCHAR) AS label, coalesce(tp / nullif(said, 0), 0) AS precision,
                  coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(said + support, 0), 0) AS f1,
                  support, tp FROM classes),
report AS (
  SELECT label, precision, recall, f1, support FROM scores
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM scores)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM report"""
)
def classification_report(spark, sf_dir):
    return ME.classification_report(_judged(spark, sf_dir), "actual", "predicted")


@query(
    f"""WITH {RULE},
folded AS (SELECT *, {HASH} % 5 AS fold FROM judged),
depths AS (SELECT lang AS setting, fold, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS score FROM folded GROUP BY lang, fold)
SELECT setting, count(*) AS folds, round(avg(score), 9) AS mean_score FROM depths GROUP BY setting"""
)
def mean_fold_scores(spark, sf_dir):
    folded = SP.hash_folds(_judged(spark, sf_dir), "doc_id")
    hit = F.when(F.col("actual") == F.col("predicted"), 1.0).otherwise(0.0)
    scores = folded.groupBy(F.col("lang").alias("setting"), "fold").agg(F.avg(hit).alias("score"))
    return ME.mean_fold_scores(scores, ["setting"], "score")


@query(
    f"""WITH {RULE},
ranked AS (SELECT actual, (rank() OVER (ORDER BY n_chars)) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS r FROM judged),
s AS (SELECT count(*) FILTER (actual = 1) AS positives, count(*) FILTER (actual <> 1) AS negatives,
             sum(r) FILTER (actual = 1) AS rank_sum FROM ranked)
SELECT positives, negatives, round((rank_sum - positives * (positives + 1) / 2) / (CAST(positives AS DOUBLE) * negatives), 9) AS auc FROM s"""
)
def area_under_roc(spark, sf_dir):
    return ME.auc(_judged(spark, sf_dir), "actual", "n_chars")


@query(
    f"""WITH {TEXT},
long AS (SELECT target, 'n_words' AS feature, n_words AS v FROM frame
         UNION ALL SELECT target, 'n_distinct', n_distinct FROM frame UNION ALL SELECT target, 'n_lines', n_lines FROM frame),
counted AS (SELECT feature, v, count(*) FILTER (target = 0) AS n0, count(*) FILTER (target = 1) AS n1 FROM long GROUP BY feature, v),
cum AS (SELECT feature, v, sum(n0) OVER w AS l0, sum(n1) OVER w AS l1, sum(n0) OVER a AS t0, sum(n1) OVER a AS t1
        FROM counted WINDOW w AS (PARTITION BY feature ORDER BY v), a AS (PARTITION BY feature)),
cuts AS (SELECT feature, v, CAST(l0 + l1 AS BIGINT) AS n_left, CAST(t0 + t1 - l0 - l1 AS BIGINT) AS n_right,
           round((1 - (t0 / (t0 + t1)) ** 2 - (t1 / (t0 + t1)) ** 2)
             - (l0 + l1) / (t0 + t1) * (1 - (l0 / (l0 + l1)) ** 2 - (l1 / (l0 + l1)) ** 2)
             - (t0 + t1 - l0 - l1) / (t0 + t1) * (1 - ((t0 - l0) / (t0 + t1 - l0 - l1)) ** 2 - ((t1 - l1) / (t0 + t1 - l0 - l1)) ** 2), 9) AS gain
         FROM cum WHERE t0 + t1 > l0 + l1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, v) AS rn FROM cuts)
SELECT feature, v AS split_value, gain, n_left, n_right FROM ranked WHERE rn = 1"""
)
def best_gini_splits(spark, sf_dir):
    return ME.best_gini_splits(labelled_frame(spark, sf_dir), FEATURES, "target")


@query(
    f"""WITH {TEXT},
train AS (SELECT * FROM features WHERE NOT ({HASH} < {TEST_LIMIT}))
SELECT round(regr_slope(n_chars, n_words), 6) AS slope, round(regr_intercept(n_chars, n_words), 4) AS intercept,
       round(regr_r2(n_chars, n_words), 9) AS r2, count(*) AS n FROM train"""
)
def simple_regression(spark, sf_dir):
    train = SP.holdout(text_features(load_texts(spark, sf_dir, "documents")), "doc_id").where(~F.col("is_test"))
    return train.agg(
        F.round(F.regr_slope("n_chars", "n_words"), 6).alias("slope"),
        F.round(F.regr_intercept("n_chars", "n_words"), 4).alias("intercept"),
        F.round(F.regr_r2("n_chars", "n_words"), 9).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def _regression_sides(spark, sf_dir):
    # Seven passes or more follow, so the small numeric frame is pinned (and freed with its last use) instead of re-tokenising the texts.
    frame = SP.holdout(text_features(load_texts(spark, sf_dir, "documents")), "doc_id")
    ready = pin(MO.assembled(frame, FEATURES, "n_chars").select("doc_id", "features", "label", "is_test"))
    return ready.where(~F.col("is_test")), ready.where(F.col("is_test"))


def _classification_sides(spark, sf_dir):
    frame = SP.stratified_holdout(labelled_frame(spark, sf_dir), "target", "doc_id")
    ready = pin(MO.assembled(frame, FEATURES, "target").select("doc_id", "features", "label", "is_test"))
    return ready.where(~F.col("is_test")), ready.where(F.col("is_test"))


# Normal equations of three centred features, solved by Cramer's rule; ridge adds 1/n to the diagonal.
SIDES = f"{TEXT}, sides AS (SELECT *, {HASH} < {TEST_LIMIT} AS is_test FROM features)"
MOMENTS = """count(*) AS n, avg(n_words) AS m1, avg(n_distinct) AS m2, avg(n_lines) AS m3, avg(n_chars) AS my,
  var_pop(n_words) AS v1, var_pop(n_distinct) AS v2, var_pop(n_lines) AS v3, covar_pop(n_words, n_distinct) AS c12,
  covar_pop(n_words, n_lines) AS c13, covar_pop(n_distinct, n_lines) AS c23, covar_pop(n_words, n_chars) AS y1,
  covar_pop(n_distinct, n_chars) AS y2, covar_pop(n_lines, n_chars) AS y3"""
SOLUTION = """
solved AS (SELECT *, a * (b * c - c23 * c23) - c12 * (c12 * c - c23 * c13) + c13 * (c12 * c23 - b * c13) AS det FROM penal),
weights AS (SELECT model, m1, m2, m3, my,
  (y1 * (b * c - c23 * c23) - c12 * (y2 * c - c23 * y3) + c13 * (y2 * c23 - b * y3)) / det AS w1,
  (a * (y2 * c - c23 * y3) - y1 * (c12 * c - c23 * c13) + c13 * (c12 * y3 - y2 * c13)) / det AS w2,
  (a * (b * y3 - y2 * c23) - c12 * (c12 * y3 - y2 * c13) + y1 * (c12 * c23 - b * c13)) / det AS w3 FROM solved),
fitted AS (SELECT *, my - w1 * m1 - w2 * m2 - w3 * m3 AS w0 FROM weights)
"""
NORMAL = f"""{SIDES},
moments AS (SELECT {MOMENTS} FROM sides WHERE NOT is_test),
penal AS (SELECT 'ols' AS model, m.*, v1 AS a, v2 AS b, v3 AS c FROM moments m
          UNION ALL SELECT 'ridge', m.*, v1 + 1.0 / n, v2 + 1.0 / n, v3 + 1.0 / n FROM moments m),
{SOLUTION}"""


@query(
    f"""WITH {NORMAL},
scored AS (SELECT model, n_chars AS y, w0 + w1 * n_words + w2 * n_distinct + w3 * n_lines AS p FROM fitted, sides WHERE is_test)
SELECT model, count(*) AS n, round(avg((y - p) ** 2), 2) AS mse, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2
FROM scored GROUP BY model"""
)
def ols_and_ridge_scores(spark, sf_dir):
    train, test = _regression_sides(spark, sf_dir)
    parts = [
        ME.regression_scores(model.transform(test), "label", "prediction").select(
            F.lit(name).alias("model"), "n", F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2")
        )
        for name, model in (("ols", MO.fit_ols(train)), ("ridge", MO.fit_ridge(train)))
    ]
    return parts[0].unionByName(parts[1])


# Lasso and elastic net by the conditions of a minimum: of all patterns of signs (0: left out) the one whose solution has these
# signs and whose left-out features correlate less with the error than the penalty.
PENALISED = f"""{SIDES},
moments AS (SELECT {MOMENTS} FROM sides WHERE NOT is_test),
penalties AS (SELECT * FROM (VALUES ('ols', 0.0::DOUBLE, 0.0::DOUBLE), ('ridge', 0.0, -1.0), ('lasso', 1.0, 0.0), ('elastic_net', 0.5, 0.5)) AS v(name, l1, l2)),
signs AS (SELECT unnest([-1, 0, 1]) AS s),
patterns AS (SELECT concat_ws(' ', name, s1, s2, s3) AS model, name, l1, CASE WHEN l2 < 0 THEN 1.0 / n ELSE l2 END AS l2, s1, s2, s3
             FROM penalties, moments, (SELECT x.s AS s1, y.s AS s2, z.s AS s3 FROM signs x, signs y, signs z) WHERE l1 > 0 OR (s1 = 1 AND s2 = 1 AND s3 = 1)),
penal AS (SELECT model, m1, m2, m3, my, CASE WHEN s1 = 0 THEN 1 ELSE v1 + l2 END AS a, CASE WHEN s2 = 0 THEN 1 ELSE v2 + l2 END AS b,
                 CASE WHEN s3 = 0 THEN 1 ELSE v3 + l2 END AS c, CASE WHEN s1 * s2 = 0 THEN 0 ELSE c12 END AS c12,
                 CASE WHEN s1 * s3 = 0 THEN 0 ELSE c13 END AS c13, CASE WHEN s2 * s3 = 0 THEN 0 ELSE c23 END AS c23,
                 CASE WHEN s1 = 0 THEN 0 ELSE y1 - l1 * s1 END AS y1, CASE WHEN s2 = 0 THEN 0 ELSE y2 - l1 * s2 END AS y2,
                 CASE WHEN s3 = 0 THEN 0 ELSE y3 - l1 * s3 END AS y3 FROM patterns, moments),
{SOLUTION.strip()},
optimal AS (SELECT p.name, f.* FROM fitted f JOIN patterns p USING (model), moments t WHERE p.l1 = 0 OR (
  (s1 = 0 OR sign(w1) = s1) AND (s2 = 0 OR sign(w2) = s2) AND (s3 = 0 OR sign(w3) = s3)
  AND (s1 <> 0 OR abs(t.y1 - t.v1 * w1 - t.c12 * w2 - t.c13 * w3) <= l1) AND (s2 <> 0 OR abs(t.y2 - t.c12 * w1 - t.v2 * w2 - t.c23 * w3) <= l1)
  AND (s3 <> 0 OR abs(t.y3 - t.c13 * w1 - t.c23 * w2 - t.v3 * w3) <= l1)))
"""


@query(
    f"""WITH {PENALISED},
scored AS (SELECT name, n_chars AS y, w0 + w1 * n_words + w2 * n_distinct + w3 * n_lines AS p FROM optimal, sides WHERE is_test)
SELECT name AS model, count(*) AS n, round(avg((y - p) ** 2), 2) AS mse, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2
FROM scored GROUP BY name"""
)
def linear_models(spark, sf_dir):
    """Test MSE and R2 of least squares, ridge, lasso and elastic net, all from one aggregate of the training rows."""
    frame = pin(SP.holdout(text_features(load_texts(spark, sf_dir, "documents")), "doc_id").select("doc_id", *FEATURES, "n_chars", "is_test"))
    m = LI.moments(frame.where(~F.col("is_test")), FEATURES, "n_chars")
    models = {"ols": LI.fit(m), "ridge": LI.ridge(m), "lasso": LI.lasso(m), "elastic_net": LI.elastic_net(m)}
    said = F.array(*[F.struct(F.lit(name).alias("model"), model.prediction(FEATURES).alias("prediction")) for name, model in models.items()])
    judged = frame.where(F.col("is_test")).select("n_chars", F.inline(said))
    scores = ME.regression_scores(judged, "n_chars", "prediction", ["model"])
    return scores.select("model", "n", F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2"))


@query(
    f"""WITH {NORMAL}
SELECT model, unnest(['n_words', 'n_distinct', 'n_lines', '(intercept)']) AS term, round(unnest([w1, w2, w3, w0]), 5) AS weight FROM fitted"""
)
def linear_coefficients(spark, sf_dir):
    train, _ = _regression_sides(spark, sf_dir)
    ols = MO.coefficients(spark, MO.fit_ols(train), FEATURES, "ols")
    both = ols.unionByName(MO.coefficients(spark, MO.fit_ridge(train), FEATURES, "ridge"))
    return both.withColumn("weight", F.round("weight", 5))


@query(
    f"""WITH {NORMAL}
SELECT doc_id, n_chars AS actual, round(w0 + w1 * n_words + w2 * n_distinct + w3 * n_lines, 4) AS predicted
FROM fitted, sides WHERE is_test AND model = 'ols'"""
)
def actual_vs_predicted(spark, sf_dir):
    train, test = _regression_sides(spark, sf_dir)
    return (
        MO.fit_ols(train)
        .transform(test)
        .select("doc_id", F.col("label").alias("actual"), F.round("prediction", 4).alias("predicted"))
    )


def _levels(rows: str, depth: int, train: str, key: str = "0") -> str:
    """The exact tree in SQL: per level the counted values, running counts, the best cut of every node and the rows in their children.

    ``rows`` has doc_id, target, the features and what ``train`` (a condition) and ``key`` (the tree) need.
    """
    value = "CASE f WHEN 0 THEN n_words WHEN 1 THEN n_distinct ELSE n_lines END"
    gini = lambda one, size: f"(1 - ({one} / {size}) ** 2 - (({size} - {one}) / {size}) ** 2)"
    parts = [f"placed0 AS MATERIALIZED (SELECT *, {key} AS tree, CAST(1 AS BIGINT) AS node FROM {rows})"]
    for i in range(depth):
        parts.append(
            f"""counted{i} AS MATERIALIZED (SELECT tree, node, f, {value} AS v, CAST(sum(1 - target) AS BIGINT) AS c0, CAST(sum(target) AS BIGINT) AS c1
  FROM placed{i}, (SELECT unnest([0, 1, 2]) AS f) WHERE node >= {2**i} AND {train} GROUP BY ALL),
cum{i} AS (SELECT tree, node, f, v, lead(v) OVER w AS following, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, sum(c0) OVER a AS n0, sum(c1) OVER a AS n1
  FROM counted{i} WINDOW w AS (PARTITION BY tree, node, f ORDER BY v), a AS (PARTITION BY tree, node, f)),
cuts{i} AS (SELECT *, round({gini("n1", "(n0 + n1)")} - (l0 + l1) / (n0 + n1) * {gini("l1", "(l0 + l1)")}
    - (n0 + n1 - l0 - l1) / (n0 + n1) * {gini("(n1 - l1)", "(n0 + n1 - l0 - l1)")}, 9) AS gain FROM cum{i} WHERE following IS NOT NULL AND n0 > 0 AND n1 > 0),
splits{i} AS MATERIALIZED (SELECT tree, node, f, (v + following) / 2 AS threshold, gain FROM cuts{i} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, v) = 1),
placed{i + 1} AS MATERIALIZED (SELECT p.* EXCLUDE (node), CASE WHEN f IS NULL THEN p.node ELSE 2 * p.node + CASE WHEN {value} > threshold THEN 1 ELSE 0 END END AS node
  FROM placed{i} p LEFT JOIN splits{i} s ON p.tree = s.tree AND p.node = s.node)"""
        )
    return ",\n".join(parts)


STRATIFIED = f"""{TEXT},
ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {HASH}, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels),
divided AS (SELECT frame.*, rn <= ceil(0.2 * n) AS is_test FROM frame JOIN ranked USING (doc_id))"""
TREE = f"{STRATIFIED}, {_levels('divided', 4, 'NOT is_test')}"


def _grown(spark, sf_dir):
    frame = SP.stratified_holdout(labelled_frame(spark, sf_dir), "target", "doc_id")
    return TR.grow(frame.select("doc_id", *FEATURES, "target", "is_test"), FEATURES, "target", MO.TREE_DEPTH, is_train=~F.col("is_test"))


@query(
    f"""WITH {TREE},
said AS (SELECT node, CASE WHEN sum(target) > sum(1 - target) THEN 1 ELSE 0 END AS predicted FROM placed4 WHERE NOT is_test GROUP BY node),
judged AS (SELECT target AS actual, predicted FROM placed4 JOIN said USING (node) WHERE is_test), {BINARY.format(keys="", group="").strip()}"""
)
def tree_scores(spark, sf_dir):
    """Scores on the held-out rows of the exact tree of depth four."""
    nodes, placed = _grown(spark, sf_dir)
    return ME.binary_scores(TR.predictions(nodes, placed.where(F.col("is_test"))), "target", "prediction")


@query(
    f"""WITH {TREE},
falls AS ({" UNION ALL ".join(f"SELECT f, gain * (SELECT count(*) FROM placed{i} p WHERE p.node = s.node AND NOT is_test) AS fall FROM splits{i} s" for i in range(4))}),
named AS (SELECT feature, coalesce(sum(fall), 0) AS fall FROM (SELECT unnest(['n_words', 'n_distinct', 'n_lines']) AS feature, unnest([0, 1, 2]) AS f) LEFT JOIN falls USING (f) GROUP BY feature)
SELECT feature, round(coalesce(fall / nullif((SELECT sum(fall) FROM named), 0), 0), 6) AS importance FROM named ORDER BY importance DESC, feature LIMIT 10"""
)
def tree_importances(spark, sf_dir):
    nodes, _ = _grown(spark, sf_dir)
    return MO.top_features(TR.importances(nodes, FEATURES).withColumn("importance", F.round("importance", 6)))


SWEEP = ", ".join(str(d) for d in MO.SWEEP_DEPTHS)


@query(
    f"""WITH {TEXT},
folded AS (SELECT frame.*, ntile(5) OVER (PARTITION BY target ORDER BY doc_id) - 1 AS fold FROM frame),
tried AS (SELECT folded.*, held FROM folded, (SELECT unnest([0, 1, 2, 3, 4]) AS held)),
{_levels("tried", max(MO.SWEEP_DEPTHS), "fold <> held", "held")},
depths AS (SELECT unnest([{SWEEP}]) AS depth),
cut AS (SELECT doc_id, tree, target, fold <> held AS is_train, depth,
               node >> greatest(CAST(floor(log2(node + 0.5)) AS BIGINT) - depth, 0) AS node FROM placed{max(MO.SWEEP_DEPTHS)}, depths),
said AS (SELECT tree, depth, node, CASE WHEN sum(target) > sum(1 - target) THEN 1 ELSE 0 END AS predicted FROM cut WHERE is_train GROUP BY ALL),
accuracies AS (SELECT tree, depth, avg(CASE WHEN target = predicted THEN 1.0 ELSE 0.0 END) AS accuracy
               FROM cut JOIN said USING (tree, depth, node) WHERE NOT is_train GROUP BY ALL)
SELECT CAST(depth AS INTEGER) AS depth, round(avg(accuracy), 9) AS mean_accuracy FROM accuracies GROUP BY depth"""
)
def tree_depth_sweep(spark, sf_dir):
    """Mean accuracy over five folds for each depth up to ten."""
    folded = SP.contiguous_folds(labelled_frame(spark, sf_dir), "target", ["doc_id"])
    swept = TR.depth_sweep(folded.select(*FEATURES, "target", "fold"), FEATURES, "target", "fold", 5, MO.SWEEP_DEPTHS)
    return swept.withColumn("mean_accuracy", F.round("mean_accuracy", 9))


@query()
def ensemble_scores(spark, sf_dir):
    return MO.ensemble_scores(*_classification_sides(spark, sf_dir))


@query(
    f"""WITH {SIDES},
parts AS (SELECT f, sides.* FROM sides, (SELECT unnest([0.2, 0.4, 0.6, 0.8, 1.0])::DOUBLE AS f)
          WHERE NOT is_test AND {HASH.replace("42:", "43:")} < f * 4294967296.0),
penal AS (SELECT *, v1 AS a, v2 AS b, v3 AS c FROM (SELECT f AS model, {MOMENTS} FROM parts GROUP BY f)),
{SOLUTION.rstrip()},
r2 AS (SELECT model, side, 1 - avg((y - p) ** 2) / var_pop(y) AS r2 FROM (
  SELECT model, 'train' AS side, n_chars AS y, w0 + w1 * n_words + w2 * n_distinct + w3 * n_lines AS p FROM fitted JOIN parts ON f = model
  UNION ALL SELECT model, 'test', n_chars, w0 + w1 * n_words + w2 * n_distinct + w3 * n_lines FROM fitted, sides WHERE is_test) GROUP BY ALL)
SELECT model AS fraction, round(max(r2) FILTER (side = 'train'), 6) AS train_r2, round(max(r2) FILTER (side = 'test'), 6) AS test_r2
FROM r2 GROUP BY model"""
)
def learning_curve(spark, sf_dir):
    train, test = _regression_sides(spark, sf_dir)
    curve = MO.learning_curve(train, test, "doc_id")
    return curve.select("fraction", F.round("train_r2", 6).alias("train_r2"), F.round("test_r2", 6).alias("test_r2"))


CUTOFF = "2024-01-28"


@query(
    f"""
SELECT user_id, count(*) FILTER (b) AS n_events, count(*) FILTER (b AND event_type = 'purchase') AS n_purchases,
       count(*) FILTER (b AND event_type = 'error') AS n_errors, count(*) FILTER (b AND event_type = 'click') AS n_clicks,
       round(coalesce(sum(value) FILTER (b), 0), 4) AS total_value,
       coalesce(date_diff('day', CAST(max(ts) FILTER (b) AS DATE), DATE '{CUTOFF}'), -1) AS days_since,
       CASE WHEN count(*) FILTER (NOT b AND event_type = 'purchase') > 0 THEN 0 ELSE 1 END AS churned
FROM (SELECT *, ts < TIMESTAMP '{CUTOFF}' AS b FROM events) GROUP BY user_id"""
)
def churn_features(spark, sf_dir):
    return FE.churn_features(load(spark, sf_dir, "events"), CUTOFF)


CHURN_L2 = 0.01


def _churn(spark, sf_dir):
    table = SP.holdout(FE.churn_features(load(spark, sf_dir, "events"), CUTOFF), "user_id")
    table = pin(table.select("user_id", "churned", "is_test", *FE.CHURN_FEATURES))
    train = table.where(~F.col("is_test"))
    return table, train, LI.fit_logistic(train, FE.CHURN_FEATURES, "churned", CHURN_L2)


@query()
def churn_model(spark, sf_dir):
    """Precision, recall and exact AUC of a logistic model on held-out users."""
    table, _, model = _churn(spark, sf_dir)
    scored = table.where(F.col("is_test")).select(F.col("churned").alias("label"), model.score(FE.CHURN_FEATURES).alias("score"))
    scored = scored.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    quality = ME.binary_scores(scored, "label", "prediction").select("precision", "recall", F.lit(1).alias("j"))
    ranking = ME.auc(scored, "label", "score").withColumn("j", F.lit(1))
    return quality.join(ranking, "j").drop("j")


@query(
    "SELECT unnest(['(intercept)', 'n_events', 'n_purchases', 'n_errors', 'n_clicks', 'total_value', 'days_since']) AS term, true AS vanishes, "
    f"(SELECT count(*) FROM (SELECT DISTINCT user_id FROM events) WHERE NOT ({HASH.replace('doc_id', 'user_id')} < {TEST_LIMIT})) AS users"
)
def churn_model_optimality(spark, sf_dir):
    """Whether the slope of the penalised loss vanishes along every weight of the churn model, by an aggregate of the training users."""
    _, train, model = _churn(spark, sf_dir)
    found = LI.slopes(train, FE.CHURN_FEATURES, "churned", model, CHURN_L2)
    rows = [(term, abs(slope) < 1e-9) for term, slope in zip(["(intercept)", *FE.CHURN_FEATURES], found)]
    return spark.createDataFrame(rows, "term string, vanishes boolean").withColumn("users", F.lit(train.count()))
