"""Exact decision trees for two classes, grown level by level.

All nodes of a level are split at once. Feature values are counted per node with map-side combine, so a level is one
aggregate of value counts whatever the number of rows; running class counts along the values give the fall in gini
impurity of every cut, without binning. Rows find their child by a broadcast join with the splits of the level, of which
there are at most 2 ** level per tree. Several trees, one per value of the keys, grow in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from modelpulse.operators.metrics import ratio
from modelpulse.operators.ordered import MAX_BROADCAST_ROWS, join_null_safe, join_totals, order_blocks, running
from modelpulse.session import pin

NODE, LABEL = "_node", "_label"
GAIN_DIGITS = 9


def _gini(one: Column, size: Column) -> Column:
    return 1 - F.pow(one / size, F.lit(2.0)) - F.pow((size - one) / size, F.lit(2.0))


def _best_cuts(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, the class counts ``n0``, ``n1`` of the node and its best cut: ``feature`` (a number), ``threshold``, midway between the
    values on either side, and ``gain``, null where nothing can be cut. Ties go to the first feature and the smallest value."""
    group = [*keys, "_feature"]
    if counted.count() <= MAX_BROADCAST_ROWS:
        ordered, whole = Window.partitionBy(*group).orderBy("_v"), Window.partitionBy(*group)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cut = counted.select(
            *group, "_v", F.lead("_v").over(ordered).alias("_next"),
            *[F.sum(f"c{c}").over(upto).alias(f"l{c}") for c in (0, 1)], *[F.sum(f"c{c}").over(whole).alias(f"n{c}") for c in (0, 1)],
        )
    else:
        # The following value is the last one of the same scan from above.
        blocks = order_blocks(counted.withColumn("_down", -F.col("_v")), group, ["_down"])
        later = running(blocks, group, ["_down"], {"_upto": ("min", "_v"), **{f"r{c}": ("sum", f"c{c}") for c in (0, 1)}})
        totals = counted.groupBy(*group).agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"))
        cut = join_totals(later, totals, group)
        left = [(F.col(f"n{c}") - F.col(f"r{c}")).alias(f"l{c}") for c in (0, 1)]
        # A cut before this value: what is left of it is below. The value below comes with the next row of the scan.
        cut = cut.select(*group, F.col("_v").alias("_next"), "n0", "n1", *left)
        below = running(order_blocks(counted, group, ["_v"]), group, ["_v"], {f"l{c}": ("sum", f"c{c}") for c in (0, 1)})
        below = below.select(*group, "_v", "l0", "l1")
        # Left counts rise with every value, so they tell which value lies below the cut.
        cut = join_null_safe(below, cut, [*group, "l0", "l1"], "left")
        cut = join_totals(cut.drop("n0", "n1"), totals, group)
    n, n_left = F.col("n0") + F.col("n1"), F.col("l0") + F.col("l1")
    gain = F.round(_gini(F.col("n1"), n) - n_left / n * _gini(F.col("l1"), n_left) - (n - n_left) / n * _gini(F.col("n1") - F.col("l1"), n - n_left), GAIN_DIGITS)
    open_ = F.col("_next").isNotNull() & (F.col("n0") > 0) & (F.col("n1") > 0)
    cut = cut.select(*group, "_v", "_next", "n0", "n1", F.when(open_, gain).alias("_gain"))
    best = F.max(F.when(F.col("_gain").isNotNull(), F.struct("_gain", (-F.col("_feature")).alias("f"), (-F.col("_v")).alias("v"), "_next")))
    found = cut.groupBy(*keys).agg(F.max("n0").alias("n0"), F.max("n1").alias("n1"), best.alias("_b"))
    return found.select(*keys, "n0", "n1", (-F.col("_b.f")).alias("feature"), ((F.col("_b._next") - F.col("_b.v")) / 2).alias("threshold"), F.col("_b._gain").alias("gain"))


def grow(rows: DataFrame, features: Sequence[str], label: str, depth: int, keys: Sequence[str] = (), is_train: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trees and the rows with ``_node``, the last node that they reach.

    A node is numbered from 1, its children 2 n and 2 n + 1; it has ``n0`` and ``n1`` training rows of each class and, unless
    it is a leaf, ``feature``, ``threshold`` (midway between two values; larger ones go right) and ``gain``. A node is
    split until it is pure, all its rows are alike or ``depth`` is reached. Only rows with ``is_train`` are counted, all are
    placed. Labels are 0 and 1; rows with a null feature or label don't count, and a null goes left. The nodes, at most
    2 ** (depth + 1) per tree, pass through the driver; they are the model.
    """
    train = (F.lit(True) if is_train is None else is_train) & F.col(label).isNotNull()
    for f in features:
        train = train & F.col(f).isNotNull()
    base = pin(rows.select("*", train.alias("_counts"), F.col(label).cast("int").alias(LABEL), F.lit(1).cast("bigint").alias(NODE)))
    spark, placed = base.sparkSession, base
    values = F.array(*[F.struct(F.lit(i).alias("_feature"), F.col(f).cast("double").alias("_v")) for i, f in enumerate(features)])
    group = [*keys, NODE]
    kinds = T.StructType([base.schema[k] for k in keys] + [T.StructField(NODE, T.LongType())])
    nodes: list[tuple] = []
    for level in range(depth + 1):
        # Rows that still move are those whose node is on the level at hand.
        here = placed.where(F.col("_counts") & (F.col(NODE) >= 2**level))
        if level == depth:
            last = here.groupBy(*group).agg(F.count_if(F.col(LABEL) == 0), F.count_if(F.col(LABEL) == 1))
            nodes += [(*r, None, None, None) for r in last.collect()]
            break
        long = here.select(*group, LABEL, F.inline(values))
        counted = pin(long.groupBy(*group, "_feature", "_v").agg(F.count_if(F.col(LABEL) == 0).alias("c0"), F.count_if(F.col(LABEL) == 1).alias("c1")))
        found = [tuple(r) for r in _best_cuts(counted, group).collect()]
        nodes += found
        splits = [(*r[: len(group)], r[-3], r[-2]) for r in found if r[-2] is not None]
        if not splits:
            break
        table = spark.createDataFrame(splits, T.StructType([*kinds, T.StructField("_f", T.IntegerType()), T.StructField("_t", T.DoubleType())]))
        value = F.coalesce(*[F.when(F.col("_f") == i, F.col(f).cast("double")) for i, f in enumerate(features)])
        child = 2 * F.col(NODE) + F.coalesce(value > F.col("_t"), F.lit(False)).cast("int")
        # At most 2 ** level splits per tree.
        moved = join_null_safe(placed, F.broadcast(table), group, "left")
        placed = moved.withColumn(NODE, F.when(F.col("_t").isNotNull(), child).otherwise(F.col(NODE))).drop("_f", "_t")
    made = [(*r[:-3], None if r[-3] is None else features[r[-3]], *r[-2:]) for r in nodes]
    fields = [T.StructField(c, t) for c, t in (("n0", T.LongType()), ("n1", T.LongType()), ("feature", T.StringType()), ("threshold", T.DoubleType()), ("gain", T.DoubleType()))]
    model = spark.createDataFrame(made, T.StructType([*kinds, *fields])).withColumnRenamed(NODE, "node")
    return model, placed.drop("_counts", LABEL)


def predictions(nodes: DataFrame, placed: DataFrame, keys: Sequence[str] = (), depth: int | None = None, out: str = "prediction") -> DataFrame:
    """The placed rows with the commoner class of their node (0 if both are equally common), as a tree cut at ``depth`` would say."""
    node = F.col(NODE)
    if depth is not None:
        level = F.floor(F.log2(F.col(NODE).cast("double") + 0.5)).cast("int")
        node = F.call_function("shiftright", F.col(NODE), F.greatest(level - depth, F.lit(0)))
    said = nodes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("node").alias("_n"), (F.col("n1") > F.col("n0")).cast("double").alias(out))
    same = node == F.col("_n")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # At most 2 ** depth nodes per tree.
    return placed.join(F.broadcast(said), same, "left").drop("_n", *[f"_k_{k}" for k in keys])


def importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature``, ``importance``: its share of the fall in impurity that all splits bring, weighted by their rows."""
    fall = (F.col("n0") + F.col("n1")) * F.col("gain")
    summed = nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum(fall).alias("_fall"))
    named = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string").join(summed, "feature", "left").fillna(0.0, ["_fall"])
    return named.select("feature", ratio(F.col("_fall"), F.sum("_fall").over(Window.partitionBy())).alias("importance"))


def depth_sweep(rows: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, depths: Sequence[int]) -> DataFrame:
    """``depth``, ``mean_accuracy`` over the folds, each judged by a tree of the others.

    A tree cut at a depth is the tree of that depth, so each fold's deepest tree serves all; all folds grow at once.
    """
    tried = rows.select(*features, label, F.col(fold).alias("_own"), F.explode(F.array(*[F.lit(i) for i in range(folds)])).alias("_held"))
    nodes, placed = grow(tried, features, label, max(depths), ["_held"], F.col("_own") != F.col("_held"))
    judged = placed.where(F.col("_own") == F.col("_held")).select("_held", label, NODE)
    level = F.floor(F.log2(F.col(NODE).cast("double") + 0.5)).cast("int")
    up = F.call_function("shiftright", F.col(NODE), F.greatest(level - F.col("depth"), F.lit(0)))
    cut = judged.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]))).withColumn(NODE, up)
    hit = (F.col(label) == F.col("prediction")).cast("double")
    scores = predictions(nodes, cut, ["_held"]).groupBy("depth", "_held").agg(F.avg(hit).alias("accuracy"))
    return scores.groupBy("depth").agg(F.avg("accuracy").alias("mean_accuracy"))
