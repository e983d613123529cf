"""Model fitting on feature tables with MLlib, and the tables that describe the fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelpulse.operators import metrics as ME
from modelpulse.operators.splits import SEED, in_fraction

# Ridge penalty, tree depth of the single model and depths of the sweep.
RIDGE_ALPHA = 1.0
TREE_DEPTH = 4
SWEEP_DEPTHS = list(range(1, 11))


def assembled(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    ready = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)
    return ready.withColumn("label", F.col(target).cast("double"))


def fit_ols(train: DataFrame):
    """Ordinary least squares by the normal equations: one pass over the rows."""
    return LinearRegression(solver="normal").fit(train)


def fit_ridge(train: DataFrame, alpha: float = RIDGE_ALPHA):
    """Minimises sum of squared errors + alpha * |w|^2.

    The library divides the loss by n and scales the label to unit deviation, hence the penalty below.
    """
    stats = train.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    penalty = alpha * (stats[1] or 0.0) / max(stats[0], 1)
    return LinearRegression(
        solver="normal", regParam=penalty, elasticNetParam=0.0, standardization=False
    ).fit(train)


def coefficients(spark: SparkSession, model, features: Sequence[str], name: str) -> DataFrame:
    rows = [(name, f, float(w)) for f, w in zip(features, model.coefficients)]
    rows.append((name, "(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "model string, term string, weight double")


def fit_tree(train: DataFrame, depth: int = TREE_DEPTH, seed: int = SEED):
    return DecisionTreeClassifier(maxDepth=depth, impurity="gini", seed=seed).fit(train)


def feature_importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    weights = model.featureImportances
    rows = [(f, float(weights[i]) if weights.size else 0.0) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(importances: DataFrame, k: int = 10) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def ensemble_scores(train: DataFrame, test: DataFrame, seed: int = SEED) -> DataFrame:
    """Test scores of a random forest and of gradient-boosted trees, each picked from a small grid."""
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    forest = RandomForestClassifier(seed=seed, numTrees=20)
    boosted = GBTClassifier(seed=seed, maxIter=5)
    scored = None
    for name, estimator in (("random_forest", forest), ("gradient_boosting", boosted)):
        grid = ParamGridBuilder().addGrid(estimator.maxDepth, [2, 4]).build()
        search = CrossValidator(
            estimator=estimator, estimatorParamMaps=grid, evaluator=accuracy, numFolds=3, seed=seed, parallelism=4
        )
        predictions = search.fit(train).transform(test)
        row = ME.binary_scores(predictions, "label", "prediction").withColumn("model", F.lit(name))
        scored = row if scored is None else scored.unionByName(row)
    return scored


def learning_curve(
    train: DataFrame, test: DataFrame, key: str, fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0)
) -> DataFrame:
    """Train and test R2 on nested fractions of the training rows."""
    evaluator = RegressionEvaluator(metricName="r2")
    rows = []
    for fraction in fractions:
        part = train.where(in_fraction(F.col(key), fraction, seed=SEED + 1))
        model = fit_ols(part)
        rows.append((float(fraction), float(model.summary.r2), float(evaluator.evaluate(model.transform(test)))))
    return train.sparkSession.createDataFrame(rows, "fraction double, train_r2 double, test_r2 double")
