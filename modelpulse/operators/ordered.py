"""Ordered scans per key that never put one key into one task.

A plain window over ``partitionBy(key)`` sorts a whole key in a single task, which fails when one
key holds a third of the rows. Here the rows are range-partitioned on (keys, order), so a hot key
is cut into consecutive blocks. Each block is scanned on its own, and the blocks' totals, at most
one row per key plus one per block, are scanned in turn to give a block the starting value of the
key that runs on into it.

The range-partitioned rows are checkpointed because the block numbers are used twice and a second
evaluation could sample other range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from modelpulse.session import pin

BLOCK = "_block"
SEQ = "_seq"
# monotonically_increasing_id keeps the row's place within its partition in the lower 33 bits.
_ROW_BITS = 33
# Rows of a per-key table (keys and a few numbers, about 100 bytes each) that may be broadcast.
MAX_BROADCAST_ROWS = 200_000
# Quantile sketches err by one rank in so many; exact values are looked for within a few such errors.
SKETCH_ACCURACY = 10_000
SKETCH_ERRORS = 3


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; ``right`` gives up its key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def join_totals(
    left: DataFrame, totals: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Join a table of one row per key, broadcast when its counted rows are few.

    The planner cannot foresee how small an aggregate gets and would shuffle ``left`` by the keys,
    all rows of a hot key to one place. Beyond ``max_rows`` there are many keys, and a shuffle is right.
    """
    totals = pin(totals)
    return join_null_safe(left, F.broadcast(totals) if totals.count() <= max_rows else totals, keys, how)


def order_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None
) -> DataFrame:
    """Rows cut into evenly filled blocks along (keys, order), with ``_block`` and the place ``_seq``."""
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = [*keys, *order]
    ranged = (
        df.repartitionByRange(n, *cut)
        .sortWithinPartitions(*cut)
        .withColumn(SEQ, F.monotonically_increasing_id())
        .withColumn(BLOCK, F.shiftright(F.col(SEQ), _ROW_BITS))
    )
    return pin(ranged)


def _block_offsets(totals: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Starting values of the blocks in which a key goes on from an earlier one.

    A block border cuts one key at most, so there are fewer rows than blocks, whatever the number of keys.
    """
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    started = totals.select(
        *keys,
        BLOCK,
        F.count(F.lit(1)).over(earlier).alias("_earlier"),
        *[agg.over(earlier).alias(f"_off_{out}") for out, agg in aggs.items()],
    )
    return started.where(F.col("_earlier") > 0).drop("_earlier")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: dict[str, tuple[str, str]],
    keep_blocks: bool = False,
) -> DataFrame:
    """Inclusive running aggregates per key, in ascending ``order`` (which must be unique per key).

    ``specs`` maps an output name to (kind, column), kind one of sum, min, max, last; ``last``
    carries the latest non-NULL value forward.
    """
    ranged = df if BLOCK in df.columns else order_blocks(df, keys, order)
    inside = (
        Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    place = F.struct(*order)
    whole = {
        "sum": lambda c: F.sum(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "last": lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)),
    }
    scan = {
        "sum": lambda c: F.sum(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "last": lambda c: F.last(c, ignorenulls=True),
    }
    combine = {
        "sum": lambda here, off: F.coalesce(off + here, here, off),
        "min": lambda here, off: F.least(here, off),
        "max": lambda here, off: F.greatest(here, off),
        "last": lambda here, off: F.coalesce(here, off),
    }
    local = ranged.select("*", *[scan[kind](c).over(inside).alias(f"_in_{out}") for out, (kind, c) in specs.items()])
    totals = ranged.groupBy(*keys, BLOCK).agg(*[whole[kind](c).alias(f"_t_{out}") for out, (kind, c) in specs.items()])
    offsets = _block_offsets(totals, keys, {out: scan[kind](f"_t_{out}") for out, (kind, _) in specs.items()})
    # Bounded by the number of blocks, so always small enough to broadcast.
    joined = join_null_safe(local, F.broadcast(offsets), [*keys, BLOCK], "left")
    base = [c for c in df.columns if c not in (BLOCK, SEQ)]
    extra = [BLOCK, SEQ] if keep_blocks else []
    return joined.select(
        *base,
        *extra,
        *[combine[kind](F.col(f"_in_{out}"), F.col(f"_off_{out}")).alias(out) for out, (kind, _) in specs.items()],
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position") -> DataFrame:
    """0-based place of every row within its key, in ascending ``order``."""
    ranged = order_blocks(df, keys, order)
    starts = ranged.groupBy(*keys, BLOCK).agg(F.min(SEQ).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        *keys, BLOCK, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    joined = join_totals(ranged, starts, [*keys, BLOCK])
    return joined.select(*df.columns, (F.col(SEQ) + F.col("_shift")).alias(out))


def _between_sketched(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """``keys`` and ``value``, with values that cannot be a quantile moved to the nearest end of where one lies.

    A first pass sketches, per key, values a few rank errors below and above each quantile; the sketch errs by one rank in
    ``SKETCH_ACCURACY`` at most. Between them values stay as they are, all others become the nearest such end above them (or
    the last one): how many rows lie below a quantile remains the same. Keys with few rows keep all values.
    """
    slack = SKETCH_ERRORS / SKETCH_ACCURACY
    wanted = sorted(set(probs))
    shares = [min(max(p + sign * slack, 0.0), 1.0) for p in wanted for sign in (-1, 1)]
    sketch = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.percentile_approx(value, shares, SKETCH_ACCURACY).alias("_ends"))
    plain = df.select(*keys, F.col(value).alias("_value"))
    if keys:
        known = join_totals(plain, sketch, keys)
        rows, ends = F.col("_rows"), [F.col("_ends")[i] for i in range(len(shares))]
    else:
        found = sketch.first()
        known = plain
        rows, ends = F.lit(found["_rows"]), [F.lit(x) for x in found["_ends"] or [None] * len(shares)]
    own = F.col("_value")
    moved = F.when(rows <= SKETCH_ACCURACY, own)
    for low, high in zip(ends[::2], ends[1::2]):
        moved = moved.when(own < low, low).when(own <= high, own)
    return known.select(*keys, moved.otherwise(ends[-1]).alias(value))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``probs``.

    Two passes, and few rows leave their tasks: the first sketches where the quantiles lie, the second counts the values
    there and how many rows are below (with map-side combine). The counts are located by running sums: in a window
    where they are counted few, else in blocks, so that no group is gathered in one task.
    """
    present = df.where(F.col(value).isNotNull())
    near = _between_sketched(present, keys, value, list(probs.values()))
    counts = pin(near.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")))
    if counts.count() <= MAX_BROADCAST_ROWS:
        upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = counts.select(*keys, value, F.sum("_c").over(upto).alias("_cum"), F.sum("_c").over(Window.partitionBy(*keys)).alias("_n"))
    else:
        cum = running(order_blocks(counts, keys, [value]), keys, [value], {"_cum": ("sum", "_c")})
        # Sizes come from the pinned counts, not from the scan, which would then run again.
        if keys:
            cum = join_totals(cum, counts.groupBy(*keys).agg(F.sum("_c").alias("_n")), list(keys))
        else:
            cum = cum.withColumn("_n", F.lit(counts.agg(F.sum("_c")).first()[0] or 0))
    parts = []
    for i, p in enumerate(probs.values()):
        place = F.lit(float(p)) * (F.col("_n") - 1)
        parts += [
            F.min(F.when(F.col("_cum") > F.floor(place), F.col(value))).alias(f"_lo{i}"),
            F.min(F.when(F.col("_cum") > F.ceil(place), F.col(value))).alias(f"_hi{i}"),
            F.max(place - F.floor(place)).alias(f"_f{i}"),
        ]
    located = cum.groupBy(*keys).agg(*parts)
    return located.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(name)
            for i, name in enumerate(probs)
        ],
    )


def first_n_by_hash(
    df: DataFrame, keys: Sequence[str], hash_col: str, id_col: str, share: float, bits: int = 32, coarse_bits: int = 16
) -> DataFrame:
    """Per key, the exact (hash, id) threshold below which lie ceil(share x size of the key) rows.

    Counts per coarse hash bucket locate the bucket that holds the threshold, and only that
    bucket's rows are ranked. Returns keys, ``h_max``, ``id_max``.
    """
    coarse = F.shiftright(F.col(hash_col), bits - coarse_bits)
    hist = df.groupBy(*keys, coarse.alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    # At most 2**coarse_bits rows per key, whatever the size of the key.
    upto = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("_c").over(Window.partitionBy(*keys))
    # In decimals, since 0.28 * 2500 is a little above 700 in binary.
    n_take = F.ceil(whole * F.lit(Decimal(str(share)))).cast("bigint")
    hist = hist.select("*", F.sum("_c").over(upto).alias("_cum"), n_take.alias("n_take"))
    edge = (
        hist.where((F.col("_cum") >= F.col("n_take")) & (F.col("_cum") - F.col("_c") < F.col("n_take")))
        .select(*keys, F.col("_b").alias("_edge"), (F.col("n_take") - F.col("_cum") + F.col("_c")).alias("_need"))
    )
    at_edge = join_totals(df.select(*keys, hash_col, id_col), edge, keys).where(coarse == F.col("_edge"))
    by_hash = Window.partitionBy(*keys).orderBy(hash_col, id_col)
    return (
        at_edge.withColumn("_rn", F.row_number().over(by_hash))
        .where(F.col("_rn") == F.col("_need"))
        .select(*keys, F.col(hash_col).alias("h_max"), F.col(id_col).alias("id_max"))
    )
