"""Batched model scoring, ranked predictions and class names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from modelpulse.functions import scalar as S
from modelpulse.session import literal_table

# The known class names; any other id is shown as class_<id>.
CLASS_NAMES = {
    0: "tench",
    1: "goldfish",
    2: "great white shark",
    207: "golden retriever",
    208: "Labrador retriever",
    258: "Samoyed",
    259: "Pomeranian",
    260: "Chow",
    281: "tabby cat",
    282: "tiger cat",
    283: "Persian cat",
}


def class_dimension(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ["class_id", "class_name"], list(CLASS_NAMES.items()))


def with_class_name(df: DataFrame, dimension: DataFrame, class_id: str = "class_id") -> DataFrame:
    """Class name from the dimension, ``class_<id>`` where it has none.

    No broadcast hint: the optimizer broadcasts a dimension it knows to be small, such as
    ``class_dimension``, and shuffles any other, splitting hot class ids.
    """
    names = dimension.select(F.col("class_id").alias("_id"), F.col("class_name").alias("_name"))
    joined = df.join(names, F.col(class_id) == F.col("_id"), "left")
    return joined.select(
        *[c for c in df.columns if c != "class_name"],
        F.coalesce("_name", F.concat(F.lit("class_"), F.col(class_id).cast("string"))).alias("class_name"),
    )


def ranked_predictions(scored: DataFrame, key: str, logits: str, k: int = 5) -> DataFrame:
    """Rows (key, rank, class_id, confidence), worked out inside each row, without a shuffle."""
    probabilities = S.softmax(F.col(logits))
    return scored.select(key, F.inline_outer(S.top_k(probabilities, k))).where(F.col("rank").isNotNull())


def ranked_predictions_long(scores: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The same from rows (key, class_id, probability); tasks keep k rows per key before the shuffle."""
    best = Window.partitionBy(key).orderBy(F.desc("probability"), "class_id")
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(key, "rank", "class_id", F.round("probability", 4).alias("confidence"))
    )


def score_in_batches(
    df: DataFrame, features: str, width: int, make_predict: Callable, batch_size: int = 8, out: str = "logits"
) -> DataFrame:
    """Call a user's model on stacked rows; the model is built once per Python worker.

    ``make_predict()`` returns a function from a float array [rows, width] to [rows, classes].
    """
    score = predict_batch_udf(
        make_predict,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=[[width]],
    )
    return df.withColumn(out, score(F.col(features)))


def linear_scorer(width: int, classes: int) -> Callable:
    """A fixed linear model, used where no trained one is at hand."""

    def make_predict():
        import numpy as np

        rows, cols = np.indices((width, classes))
        weights = ((rows * 31 + cols * 17) % 11 - 5) / 10.0

        def predict(batch):
            return batch.astype(np.float64) @ weights

        return predict

    return make_predict
