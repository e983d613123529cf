"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.operators.ordered import join_totals
from modelpulse.session import pin, scratch_path

_STEP = 0x9E3779B97F4A7C15
PLAIN_ROUNDS = 4


def _written(df: DataFrame) -> DataFrame:
    """A copy that knows nothing of its origin: what a checkpoint inherits of known conditions doubles with every round."""
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``edges`` (``a``, ``b``, whole numbers).

    In each round a node points to its first neighbour (or itself), and the edges are drawn between what their ends point
    to; only nodes that one points to remain. First is the smallest, so that a star around its smallest node is gone in a
    round. In that order alone a chain whose numbers ascend would lose one node a round; from the ``PLAIN_ROUNDS``-th round
    on the order therefore changes from round to round, in which any numbering loses a share of its nodes, so the rounds
    are about the logarithm of the nodes. Minima are combined before the shuffle, so a node with very many
    neighbours is no burden. Each round's tables are checkpointed, those of later rounds written.
    """
    edges = pin(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").cast("bigint").alias("a"), F.greatest("a", "b").cast("bigint").alias("b")).distinct())
    labels, rounds = None, 0
    while not edges.isEmpty():
        # Numbers with some bits turned over: another order, and turned over again the numbers themselves.
        mask = 0 if rounds < PLAIN_ROUNDS else _STEP * rounds % (1 << 63)
        turned = lambda c, mask=mask: F.col(c).bitwiseXOR(F.lit(mask).cast("bigint")) if mask else F.col(c)
        keep = pin if rounds < PLAIN_ROUNDS else _written
        rounds += 1
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(turned("b")).alias("m")).select(F.col("a").alias("node"), F.least(turned("a"), "m").alias("to"))
        points = pin(first.select("node", turned("to").alias("to")))
        if labels is None:
            labels = points
        else:
            step = points.select(F.col("node").alias("to"), F.col("to").alias("_next"))
            labels = keep(labels.join(step, "to", "left").select("node", F.coalesce("_next", "to").alias("to")))
        ends = lambda c: points.select(F.col("node").alias(c), F.col("to").alias(f"_{c}"))
        moved = edges.join(ends("a"), "a").join(ends("b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = keep(moved.where(F.col("a") != F.col("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if rounds <= PLAIN_ROUNDS:
        return labels.select("node", F.col("to").alias("component"))
    # What is left of a component after a changed order need not be its smallest node.
    smallest = labels.groupBy("to").agg(F.min("node").alias("component"))
    return join_totals(labels, smallest, ["to"]).select("node", "component")
