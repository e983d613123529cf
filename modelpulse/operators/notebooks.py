"""Image outputs of notebooks: numbering, naming, last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from modelpulse.functions import scalar as S

PNG = "image/png"


def image_outputs(notebooks: DataFrame, mime: str = PNG) -> DataFrame:
    """Every image output with its number in document order.

    A notebook is one row, so numbering is the position in a flattened array and needs no shuffle.
    The number advances for every image, also for those that get a name from a rule.
    """
    found = F.flatten(
        F.transform(
            F.coalesce(F.col("cells"), F.array()),
            lambda cell, i: F.transform(
                F.filter(
                    F.coalesce(cell["outputs"], F.array()),
                    lambda out: F.coalesce(F.map_contains_key(out["data"], mime), F.lit(False)),
                ),
                lambda out: F.struct(
                    i.alias("cell_idx"),
                    F.array_join(F.coalesce(cell["source"], F.array()), "").alias("source"),
                    F.try_element_at(out["data"], F.lit(mime)).alias("encoded"),
                ),
            ),
        )
    )
    numbered = notebooks.select("path", F.posexplode_outer(found).alias("pos", "o")).where(F.col("pos").isNotNull())
    n = F.col("pos") + 1
    return numbered.select(
        "path",
        n.alias("n"),
        F.col("o.cell_idx").alias("cell_idx"),
        S.plot_name(F.col("o.source"), n).alias("filename"),
        F.unbase64("o.encoded").alias("content"),
    )


def last_write_wins(images: DataFrame) -> DataFrame:
    """The last image of each file name per notebook; tasks keep one row per name before the shuffle."""
    latest = Window.partitionBy("path", "filename").orderBy(F.desc("n"))
    return images.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") == 1).drop("_rn")
