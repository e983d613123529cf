"""Column functions: vectors, text rules, log fields, rounding and identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Per-channel mean and deviation used to standardise colour images.
CHANNEL_MEAN = [0.485, 0.456, 0.406]
CHANNEL_STD = [0.229, 0.224, 0.225]

# Constant service fields of a log record and the id given to lines without one.
SERVICE_NAME = "resnet-serving"
ENVIRONMENT = "development"
NO_REQUEST_ID = "no-request-id"

# File name by marker text, first match wins.
PLOT_RULES = [
    (["Actual vs Predicted"], "01_regression_actual_vs_predicted.png"),
    (["Confusion Matrix"], "02_classification_confusion_matrix.png"),
    (["feature_importances"], "03_feature_importances.png"),
    (["Model Complexity", "CV Accuracy"], "04_model_complexity_cv.png"),
]

WORD = r"\S+"


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with the value worked out once.

    A column that is used inside a lambda is evaluated anew for every element; as the element of an array of one it is not.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def softmax(logits: Column) -> Column:
    """Probabilities from logits, shifted by the maximum so that exp cannot overflow; work in proportion to the classes."""

    def scaled(shifted: Column) -> Column:
        total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
        return bound(total, lambda t: F.transform(shifted, lambda x: x / t))

    def below_top(z: Column) -> Column:
        return bound(F.array_max(z).cast("double"), lambda top: F.transform(z, lambda x: F.exp(x.cast("double") - top)))

    return bound(bound(logits, below_top), scaled)


def standardise(values: Column, mean: Sequence[float] = CHANNEL_MEAN, std: Sequence[float] = CHANNEL_STD) -> Column:
    """(x - mean) / std per position."""
    m, s = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std))
    return F.zip_with(F.zip_with(values, m, lambda x, a: x.cast("double") - a), s, lambda x, b: x / b)


def standardise_interleaved(values: Column, mean: Sequence[float] = CHANNEL_MEAN, std: Sequence[float] = CHANNEL_STD) -> Column:
    """(x - mean) / std of any number of values whose channels alternate."""
    m, s, n = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std)), len(mean)
    return F.transform(values, lambda x, i: (x.cast("double") - F.element_at(m, i % n + 1)) / F.element_at(s, i % n + 1))


def argmax(values: Column) -> Column:
    """0-based position of the largest value, the first one on ties."""
    return F.array_position(values, F.array_max(values)) - 1


def top_k(probabilities: Column, k: int = 5) -> Column:
    """The k largest as array<struct<rank, class_id, confidence>>, lower class id first on ties."""
    ranked = F.array_sort(
        F.transform(probabilities, lambda p, i: F.struct((-p).alias("neg"), i.cast("int").alias("class_id")))
    )
    return F.transform(
        F.slice(ranked, 1, k),
        lambda s, i: F.struct(
            (i + 1).cast("int").alias("rank"),
            s["class_id"].alias("class_id"),
            F.round(-s["neg"], 4).alias("confidence"),
        ),
    )


def short_id(key: Column) -> Column:
    """Eight-character id; a digest of the key, so a retried task gives the same id."""
    return F.substring(F.md5(key.cast("string")), 1, 8)


def hash32(key: Column, seed: int) -> Column:
    """A 32-bit number from the seeded md5 of a key; independent of partitioning and of the engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def duration_ms(start_us: Column, end_us: Column) -> Column:
    return (end_us - start_us) / F.lit(1000.0)


def status_code(error_type: Column, http_code: Column) -> Column:
    """No error gives 200, an HTTP exception its own code (500 when it has none), anything else 500."""
    return (
        F.when(error_type.isNull(), F.lit(200))
        .when(error_type == "HTTPException", F.coalesce(http_code.cast("int"), F.lit(500)))
        .otherwise(F.lit(500))
    )


def success_rate(good: Column, total: Column) -> Column:
    """Percent with two decimals, 0 when there is nothing to rate."""
    return F.coalesce(F.round(F.try_divide(good * F.lit(100.0), total), 2), F.lit(0.0))


def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def log_level(level: Column, record_level: Column) -> Column:
    """Upper-cased level, or the record's own level name when the field is missing or empty."""
    return F.when(F.length(level) > 0, F.upper(level)).otherwise(record_level)


def request_id_or_default(request_id: Column) -> Column:
    return F.coalesce(request_id, F.lit(NO_REQUEST_ID))


def plot_name(source: Column, counter: Column, rules=PLOT_RULES) -> Column:
    """File name of the first rule whose marker occurs in the source, else plot_NN."""
    default = F.concat(
        F.lit("plot_"),
        F.when(counter < 10, F.lpad(counter.cast("string"), 2, "0")).otherwise(counter.cast("string")),
        F.lit(".png"),
    )
    name = None
    for markers, file_name in rules:
        hit = F.lit(False)
        for marker in markers:
            hit = hit | F.contains(source, F.lit(marker))
        name = F.when(hit, F.lit(file_name)) if name is None else name.when(hit, F.lit(file_name))
    return name.otherwise(default)


def percent(ratio: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", ratio * F.lit(100.0))


def words(text: Column) -> Column:
    """Whitespace-separated words of the whole text."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")
