"""Model quality measures computed as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelpulse.operators.ordered import join_totals, order_blocks, running
from modelpulse.session import literal_table


def regression_scores(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MSE and R2; R2 is measured against the mean of the evaluated rows."""
    error = F.col(actual) - F.col(predicted)
    summed = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(actual).alias("_var"),
    )
    return summed.select(
        *keys, "n", F.round("_mse", 6).alias("mse"), F.round(1 - F.try_divide("_mse", "_var"), 9).alias("r2")
    )


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 on a zero denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def binary_scores(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = (), digits: int = 9) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class 1, and the four counts."""
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    counted = df.groupBy(*keys).agg(
        F.count_if(~a & ~p).alias("tn"),
        F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"),
        F.count_if(a & p).alias("tp"),
    )
    return scores_from_counts(counted, digits)


def scores_from_counts(counted: DataFrame, digits: int = 9) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counted.select(
        "*",
        F.round(ratio(tp + tn, tn + fp + fn + tp), digits).alias("accuracy"),
        F.round(ratio(tp, tp + fp), digits).alias("precision"),
        F.round(ratio(tp, tp + fn), digits).alias("recall"),
        F.round(ratio(2 * tp, 2 * tp + fp + fn), digits).alias("f1"),
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Sequence) -> DataFrame:
    """Rows actual, one column per predicted class, zero where a pair never occurs.

    ``pred_other`` counts predictions that are none of ``classes`` or null, so that every row is counted once.
    """
    listed = F.coalesce(F.col(predicted).isin(list(classes)), F.lit(False))
    columns = [F.count_if(F.col(predicted) == c).alias(f"pred_{c}") for c in classes] + [F.count_if(~listed).alias("pred_other")]
    names = [f"pred_{c}" for c in classes] + ["pred_other"]
    known = literal_table(df.sparkSession, ["actual"], [(c,) for c in classes])
    known = known.select(F.col("actual").cast("bigint" if isinstance(classes[0], int) else "string").alias("actual"))
    seen = df.groupBy(F.col(actual).cast(known.schema["actual"].dataType).alias("actual")).agg(*columns)
    zeros = known.select("actual", *[F.lit(0).cast("bigint").alias(n) for n in names])
    return seen.unionByName(zeros).groupBy("actual").agg(*[F.sum(n).alias(n) for n in names])


def classification_report(df: DataFrame, actual: str, predicted: str, digits: int = 9) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    One shuffle of (actual, predicted) pair counts; all else works on classes.
    """
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        "n",
        F.inline(
            F.array(
                F.struct(F.col("a").cast("string").alias("label"), F.lit(True).alias("is_actual"), (F.col("a") == F.col("p")).alias("hit")),
                F.struct(F.col("p").cast("string").alias("label"), F.lit(False).alias("is_actual"), (F.col("a") == F.col("p")).alias("hit")),
            )
        ),
    )
    per_class = sides.groupBy("label").agg(
        F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("_predicted"),
        F.sum(F.when(F.col("is_actual") & F.col("hit"), F.col("n")).otherwise(0)).alias("_tp"),
    )
    per_class = per_class.select(
        "label",
        ratio(F.col("_tp"), F.col("_predicted")).alias("precision"),
        ratio(F.col("_tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("_tp"), F.col("_predicted") + F.col("support")).alias("f1"),
        "support",
        "_tp",
    )
    scores = ["precision", "recall", "f1"]
    averages = per_class.agg(
        F.sum("support").alias("support"),
        F.sum("_tp").alias("_tp"),
        *[F.avg(s).alias(f"m_{s}") for s in scores],
        *[ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"w_{s}") for s in scores],
    )
    accuracy = ratio(F.col("_tp"), F.col("support"))
    summary = averages.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(s) for s in scores], F.col("support")),
                F.struct(F.lit("macro avg").alias("label"), *[F.col(f"m_{s}").alias(s) for s in scores], F.col("support")),
                F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"w_{s}").alias(s) for s in scores], F.col("support")),
            )
        )
    )
    rows = per_class.select("label", *scores, "support").unionByName(summary)
    return rows.select("label", *[F.round(s, digits).alias(s) for s in scores], "support")


def mean_fold_scores(scores: DataFrame, keys: Sequence[str], score: str, digits: int = 9) -> DataFrame:
    return scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("folds"), F.round(F.avg(score), digits).alias("mean_score"))


def auc(df: DataFrame, actual: str, score: str, digits: int = 9) -> DataFrame:
    """Exact area under the ROC curve from rank sums; equal scores count half.

    Scores are counted per value first; the running count of negatives cuts the values into blocks.
    """
    positive = F.col(actual) == 1
    counts = df.groupBy(score).agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    cum = running(counts, [], [score], {"_below": ("sum", "_neg")})
    wins = F.col("_pos") * (F.col("_below") - F.col("_neg") / 2.0)
    return cum.agg(
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
        F.round(F.try_divide(F.sum(wins), F.sum("_pos").cast("double") * F.sum("_neg")), digits).alias("auc"),
    )


def best_gini_splits(
    df: DataFrame, features: Sequence[str], label: str, classes: Sequence[int] = (0, 1), digits: int = 9
) -> DataFrame:
    """For each feature, the cut ``feature <= split_value`` with the largest fall in gini impurity.

    Feature values are counted first; the running class counts per feature are block scans, because
    every row of the table carries every feature.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    long = df.select(F.col(label).alias("_y"), F.inline(pairs)).where(F.col("v").isNotNull())
    counted = long.groupBy("feature", "v").agg(*[F.count_if(F.col("_y") == c).alias(f"n{c}") for c in classes])
    counted = order_blocks(counted, ["feature"], ["v"])
    left = running(counted, ["feature"], ["v"], {f"l{c}": ("sum", f"n{c}") for c in classes})
    totals = counted.groupBy("feature").agg(*[F.sum(f"n{c}").alias(f"t{c}") for c in classes])
    joined = join_totals(left, totals, ["feature"])

    def gini(parts, size):
        squares = F.lit(0.0)
        for part in parts:
            squares = squares + F.pow(part / size, F.lit(2.0))
        return 1 - squares

    lefts, alls = [F.col(f"l{c}") for c in classes], [F.col(f"t{c}") for c in classes]
    rights = [t - x for t, x in zip(alls, lefts)]
    n_left, n_all = sum(lefts[1:], lefts[0]), sum(alls[1:], alls[0])
    n_right = n_all - n_left
    gain = gini(alls, n_all) - n_left / n_all * gini(lefts, n_left) - n_right / n_all * gini(rights, n_right)
    cuts = joined.where(n_right > 0).select("feature", "v", F.round(gain, digits).alias("gain"), n_left.alias("n_left"), n_right.alias("n_right"))
    best = cuts.groupBy("feature").agg(
        F.max(F.struct("gain", (-F.col("v")).alias("neg"), "n_left", "n_right")).alias("b")
    )
    return best.select(
        "feature", (-F.col("b.neg")).alias("split_value"), F.col("b.gain").alias("gain"), "b.n_left", "b.n_right"
    )
