"""Text exposition of metrics: sample lines out, sample lines in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelpulse.session import literal_table


def _escaped(value: Column) -> Column:
    out = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("\n"), F.lit("\\n"))
    return F.replace(out, F.lit('"'), F.lit('\\"'))


def _labels(names: Sequence[str], le: Column | None = None) -> Column:
    """{a="x",b="y"} with label names in alphabetical order; nothing when there are no labels."""
    pairs = {n: F.concat(F.lit(f'{n}="'), _escaped(F.col(n)), F.lit('"')) for n in names}
    if le is not None:
        pairs["le"] = F.when(le != "", F.concat(F.lit('le="'), le, F.lit('"')))
    joined = F.concat_ws(",", *[pairs[n] for n in sorted(pairs)]) if pairs else F.lit("")
    return F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit("{"), joined, F.lit("}")))


def _number(value: Column) -> Column:
    """A number as monitoring clients write it: 25000000.0, not 2.5E7. What four digits can't hold keeps its own form."""
    value = value.cast("double")
    plain = value.try_cast("decimal(38,4)")
    short = F.regexp_replace(F.regexp_replace(plain.cast("string"), "0+$", ""), "[.]$", ".0")
    return F.when((F.abs(value) < 1e16) & (plain.cast("double") == value), short).otherwise(value.cast("string"))


def histogram_lines(long: DataFrame, metric: str, labels: Sequence[str]) -> DataFrame:
    """Sample lines of a long histogram (labels, sample, le, value)."""
    text = F.concat(
        F.lit(metric + "_"), F.col("sample"), _labels(labels, F.col("le")), F.lit(" "), _number(F.col("value"))
    )
    # Buckets by rising bound, then count and sum.
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.when(F.col("le") != "", F.col("le").cast("double")))
    return long.select(
        F.lit(metric).alias("family"), F.lit(2).alias("part"), _labels(labels).alias("series"), F.col("sample").alias("sample"),
        bound.alias("bound"), text.alias("value"),
    )


def value_lines(values: DataFrame, metric: str, labels: Sequence[str]) -> DataFrame:
    """Sample lines of a counter or gauge (labels, value)."""
    return values.select(
        F.lit(metric).alias("family"), F.lit(2).alias("part"), _labels(labels).alias("series"), F.lit("").alias("sample"),
        F.lit(0.0).alias("bound"), F.concat(F.lit(metric), _labels(labels), F.lit(" "), _number(F.col("value"))).alias("value"),
    )


def header_lines(spark: SparkSession, metric: str, help_text: str, kind: str) -> DataFrame:
    names = ["family", "part", "series", "sample", "bound", "value"]
    lines = [(metric, 0, "", "", 0.0, f"# HELP {metric} {help_text}"), (metric, 1, "", "", 0.0, f"# TYPE {metric} {kind}")]
    return literal_table(spark, names, lines)


def write_exposition(lines: DataFrame, path: str) -> None:
    """Families one after the other, header first; the files joined in name order are one valid page."""
    ordered = lines.orderBy("family", "part", "series", "sample", "bound", "value")
    ordered.select("value").write.mode("overwrite").text(path)


def sample_lines(lines: DataFrame) -> DataFrame:
    """Only sample lines: comments and blank lines dropped."""
    return lines.where((F.length("value") > 0) & ~F.startswith(F.col("value"), F.lit("#")))


def first_samples(lines: DataFrame, n: int = 5) -> DataFrame:
    return sample_lines(lines).orderBy("value").limit(n)


def parse_samples(lines: DataFrame) -> DataFrame:
    """(metric, labels text, value) of each sample line."""
    form = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})? (\S+)$"
    return sample_lines(lines).select(
        F.regexp_extract("value", form, 1).alias("metric"),
        F.regexp_extract("value", form, 2).alias("labels"),
        F.regexp_extract("value", form, 3).cast("double").alias("sample_value"),
    )
