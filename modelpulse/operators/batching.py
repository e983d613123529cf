"""First-in-first-out batch assignment and what follows from sharing a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from modelpulse.operators.ordered import join_null_safe, positions, running

# At most 8 requests per batch, one dispatch every 50 ms.
MAX_BATCH = 8
TICK_US = 50_000


def assign_batches(
    queue: DataFrame,
    keys: Sequence[str],
    arrival_us: str,
    item_id: str,
    capacity: int = MAX_BATCH,
    tick_us: int = TICK_US,
) -> DataFrame:
    """Dispatch tick of every queued item when each tick takes the ``capacity`` oldest ones.

    Closed form for a model that answers at once. With P the number of items that arrived before
    tick t and Y(t) = P - capacity * (t - 1), the items still waiting when tick t comes number
    Y(t) - min over ticks s <= t of Y(s); an item with r older ones in its own tick leaves
    (waiting + r) // capacity ticks later. Only the ticks are scanned in order, not the items, and
    both scans cut a hot key into blocks.
    """
    arrived = queue.withColumn("arrival_tick", F.ceil(F.col(arrival_us) / F.lit(tick_us)).cast("bigint"))
    placed = positions(arrived, keys, [arrival_us, item_id], out="_n")
    ticks = placed.groupBy(*keys, "arrival_tick").agg(F.min("_n").alias("_before"))
    ticks = ticks.withColumn("_y", F.col("_before") - capacity * (F.col("arrival_tick") - 1))
    ticks = running(ticks, keys, ["arrival_tick"], {"_low": ("min", "_y")})
    ticks = ticks.select(*keys, "arrival_tick", "_before", (F.col("_y") - F.col("_low")).alias("_waiting"))
    joined = join_null_safe(placed, ticks, [*keys, "arrival_tick"])
    behind = F.col("_waiting") + F.col("_n") - F.col("_before")
    return joined.select(
        *queue.columns,
        "arrival_tick",
        (F.col("arrival_tick") + F.floor(behind / F.lit(capacity))).cast("bigint").alias("batch_tick"),
    )


def batch_sizes(assigned: DataFrame, keys: Sequence[str]) -> DataFrame:
    return assigned.groupBy(*keys, "batch_tick").agg(F.count(F.lit(1)).alias("batch_size"))


def spread_failures(assigned: DataFrame, keys: Sequence[str], is_bad: str) -> DataFrame:
    """One bad item fails its whole batch; a batch never exceeds its capacity, so windows stay small."""
    batch = Window.partitionBy(*keys, "batch_tick")
    return assigned.withColumn("batch_failed", F.max(F.col(is_bad).cast("int")).over(batch) == 1)
