"""Session settings, the shared checkpoint folder and scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "modelpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; the cluster's own settings win for everything else."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) gets a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="modelpulse-")
        context.setCheckpointDir(configured)
    return (configured or context.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location in the shared folder for a written table or a stream's state."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before costly row-wise work, if the input comes in fewer pieces than that.

    Meant for plain scans: a table of many splits is returned as it is, so nothing is shuffled at
    scale, while counting the partitions of a join would already run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def literal_table(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A few fixed rows as an expression, so the planner knows that the table is tiny and broadcasts it.

    A table made from Python rows has an unknown size and would make the other side shuffle.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later branches read one and the same copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
