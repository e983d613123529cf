"""Hard negatives by inner product, found with pruning by coordinates.

Vectors are range-partitioned by length, so a partition is a run of lengths; a task cuts it into buckets, longest first,
and keeps for each bucket the sorted list of every coordinate of the unit vectors. A score that an anchor still needs
becomes, by the length of the bucket, a least cosine. A bucket that cannot reach it is left out; in the others that
cosine bounds every coordinate of a unit vector from below and above. The anchor's focus coordinates, its largest, give
a range of their sorted lists each, and what lies in all of these ranges is verified with the exact inner product.

Anchors travel to the tasks in slices of bounded size, and every slice scans all vectors twice: for the positives, which
say what scores a negative may have, and for the negatives. A task keeps the few best rows per anchor, which are then
merged in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from modelpulse.llm.registry import query
from modelpulse.llm.text import bounded_batches
from modelpulse.session import pin, scratch_path, spread
from modelpulse.sources.tables import load

# Rows of a bucket, and coordinates whose ranges are intersected.
BUCKET = 2048
FOCUS = 5
# Bytes of anchors that travel to the tasks at once.
MAX_SENT_BYTES = 16 * 1024 * 1024
# Parts in which the best rows of an anchor are found before they are merged.
MERGE_PARTS = 64
# What rounding may move a bound of a unit coordinate.
MARGIN = 1e-9
NO_ID = (1 << 63) - 1
_EXACT = float(1 << 53)


@dataclass
class Vectors:
    """Some rows as arrays; shorter vectors are filled with zeros."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    matrix: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> Vectors:
        row, key, label = (batch.column(i).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(i).to_numpy() for i in range(3))
        lists = batch.column(3)
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        width = int(sizes.max(initial=0))
        matrix = np.zeros((len(sizes), width))
        if len(flat) == matrix.size:
            matrix = flat.reshape(matrix.shape).astype(np.float64)
        else:
            at = np.concatenate(([0], np.cumsum(sizes)))
            for i in range(len(sizes)):
                matrix[i, : sizes[i]] = flat[at[i] : at[i + 1]]
        return cls(row, key, label, matrix)

    def __len__(self) -> int:
        return len(self.row)

    def take(self, at) -> Vectors:
        return Vectors(self.row[at], self.id[at], self.label[at], self.matrix[at])

    def as_wide_as(self, width: int) -> Vectors:
        """With ``width`` coordinates. Those beyond, where the anchors have none, meet nothing."""
        have = self.matrix.shape[1]
        matrix = self.matrix[:, :width] if have >= width else np.pad(self.matrix, ((0, 0), (0, width - have)))
        return Vectors(self.row, self.id, self.label, matrix)

    @staticmethod
    def together(parts: list[Vectors]) -> Vectors:
        return Vectors(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("row", "id", "label", "matrix")))


def exact_products(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in floating point where no sum can be rounded, else with numbers of any size.

    What no 64 bits hold becomes the nearest number that they hold.
    """
    if matrix.shape[1] * np.abs(matrix).max(initial=0) * np.abs(vector).max(initial=0) < _EXACT:
        return (matrix @ vector).astype(np.int64)
    whole = [int(x) for x in vector]
    sums = [sum(int(a) * b for a, b in zip(line, whole)) for line in matrix]
    return np.array([min(max(s, -NO_ID), NO_ID) for s in sums], dtype=np.int64)


class Bucket:
    """Vectors of similar length with the sorted list of every coordinate."""

    def __init__(self, vectors: Vectors):
        self.vectors = vectors
        length = np.sqrt((vectors.matrix**2).sum(axis=1))
        self.longest = float(length.max(initial=0.0))
        self.unit = vectors.matrix / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, least: float) -> np.ndarray | None:
        """Places of all vectors whose product with ``anchor`` may reach ``least``; None says that there are none."""
        everything = np.arange(len(self.vectors))
        if not least > 0:
            return everything
        size = float(np.sqrt((anchor**2).sum())) * self.longest
        if size * (1 + MARGIN) < least:
            return None
        focus = np.argsort(-np.abs(anchor), kind="stable")[:FOCUS]
        along = anchor[focus] / np.sqrt((anchor**2).sum())
        # The angle to the anchor is at most that of the least cosine, the anchor's to the axis is known.
        reach, off = np.arccos(min(1.0, least / size)), np.arccos(np.clip(along, -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, off + reach)) - MARGIN
        high = np.cos(np.maximum(0.0, off - reach)) + MARGIN
        first = np.array([np.searchsorted(self.sorted[:, f], a, "left") for f, a in zip(focus, low)])
        last = np.array([np.searchsorted(self.sorted[:, f], b, "right") for f, b in zip(focus, high)])
        narrow = np.argsort(last - first, kind="stable")
        f = focus[narrow[0]]
        found = self.order[first[narrow[0]] : last[narrow[0]], f]
        for k in narrow[1:]:
            # A range that holds the whole list excludes nothing.
            if last[k] - first[k] < len(self.vectors):
                x = self.unit[found, focus[k]]
                found = found[(x >= low[k]) & (x <= high[k])]
        return found


def _buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Bucket]:
    """Buckets of the rows in their order, across Arrow batches."""
    held: list[Vectors] = []
    for batch in batches:
        if batch.num_rows:
            held.append(Vectors.of(batch).as_wide_as(width))
        while sum(map(len, held)) >= BUCKET:
            rows = Vectors.together(held)
            yield Bucket(rows.take(slice(0, BUCKET)))
            held = [rows.take(slice(BUCKET, None))]
    if sum(map(len, held)):
        yield Bucket(Vectors.together(held))


def _best(score: np.ndarray, key: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: the highest scores, of equal ones the smallest ids."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= -np.partition(-score, k - 1)[k - 1])
        return near[np.lexsort((row[near], key[near], -score[near]))[:k]]
    return np.lexsort((row, key, -score))[:k]


class _Kept:
    """The k best rows found so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.id = self.row = np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int | None:
        """The score that a further row must reach."""
        return int(self.score[-1]) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, key: np.ndarray, row: np.ndarray) -> None:
        if len(score):
            score, key, row = (np.concatenate(x) for x in ((self.score, score), (self.id, key), (self.row, row)))
            at = _best(score, key, row, self.k)
            self.score, self.id, self.row = score[at], key[at], row[at]


def _scan_positives(batches, anchors: Vectors, k: int):
    """Per anchor the k best other rows of its label in these batches."""
    kept = [_Kept(k) for _ in range(len(anchors))]
    for bucket in _buckets(batches, anchors.matrix.shape[1]):
        rows = bucket.vectors
        for a, best in enumerate(kept):
            least = best.least
            found = bucket.candidates(anchors.matrix[a], -np.inf if least is None else float(least))
            if found is None:
                continue
            found = found[(rows.label[found] == anchors.label[a]) & (rows.row[found] != anchors.row[a])]
            if len(found):
                score = exact_products(rows.matrix[found], anchors.matrix[a])
                best.add(score, rows.id[found], rows.row[found])
    return kept


def _scan_negatives(batches, anchors: Vectors, wanted: list[list[tuple[int, int, int]]], k: int):
    """Per anchor and positive (its number and the least and greatest score) the k best rows of other labels."""
    kept = [[_Kept(k) for _ in lists] for lists in wanted]
    for bucket in _buckets(batches, anchors.matrix.shape[1]):
        rows = bucket.vectors
        for a, lists in enumerate(wanted):
            bounds = [max(low, best.least) if best.least is not None else low for (_, low, high), best in zip(lists, kept[a]) if low <= high]
            if not bounds:
                continue
            found = bucket.candidates(anchors.matrix[a], float(min(bounds)))
            if found is None:
                continue
            found = found[rows.label[found] != anchors.label[a]]
            if not len(found):
                continue
            score = exact_products(rows.matrix[found], anchors.matrix[a])
            for (_, low, high), best in zip(lists, kept[a]):
                fits = (score >= low) & (score <= high)
                if fits.any():
                    best.add(score[fits], rows.id[found[fits]], rows.row[found[fits]])
    return kept


def _merged(found: DataFrame, group: list[str], k: int) -> DataFrame:
    """``rank`` of the k best of every group. Tasks keep k before the shuffle; many tasks' rows are merged in parts first."""
    order = [F.desc("score"), F.col("id"), F.col("row")]
    part = Window.partitionBy(*group, "_part").orderBy(*order)
    some = found.withColumn("_part", F.pmod(F.col("row"), F.lit(MERGE_PARTS))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k).drop("_part")


def length_index(items: DataFrame) -> DataFrame:
    """``row``, ``id``, ``label``, ``vector``, ``anchor``: the rows that take part, partitioned and sorted by length, longest first."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    whole = items.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", number))
    size = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)
    # By id where lengths are equal, so that very many vectors of one length are cut as well.
    sized = whole.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "vector", F.coalesce("anchor", F.lit(False)).alias("anchor"), (-size).alias("_order"))
    parts = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = sized.repartitionByRange(parts, "_order", "id").sortWithinPartitions("_order", "id")
    return pin(ranged.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector", "anchor"))


def hard_negatives(
    items: DataFrame, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, max_sent_bytes: int = MAX_SENT_BYTES
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``items`` has ``id`` (a whole number), ``label``, ``vector`` (doubles that are whole numbers) and ``anchor`` (whether
    the row is one); further columns are left out. An anchor's positives are the best other rows of its label, the
    negatives of a positive the best rows of other labels whose score lies within the percentages of the positive's.
    Higher scores come first, of equal ones smaller ids, rows without an id last.

    Rows with a null label or vector, or with a component that is null or not finite, take no part. Every row counts:
    of rows that repeat each is an item of its own, an anchor may have its own copy as a positive, and copies of an
    anchor have results of their own. Components that one vector lacks are zero. An anchor without positives, or a
    positive without negatives (such as one with a negative score), gives no row. Products are exact; one that 64 bits
    don't hold becomes the nearest number that they do.
    """
    spark = items.sparkSession
    bounded_batches(spark, BUCKET)
    index = length_index(items)
    asked = index.where("anchor").select("row", "id", F.col("label").cast("bigint"), "vector")
    size = asked.agg(F.sum(32 + 8 * F.size("vector").cast("bigint"))).first()[0] or 0
    slices = max(1, -(-size // max_sent_bytes))
    path, schema = scratch_path(spark, "hard-negatives"), "anchor bigint, place int, row bigint, id bigint, score bigint"
    rows = index.select("row", "id", F.col("label").cast("bigint"), "vector")
    for i in range(slices):
        # By the hash, which spreads anchors evenly; the slice's size is bounded by the measured bytes.
        part = asked.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == i).orderBy("row").toArrow()
        anchors = Vectors.of(part)
        sent = spark.sparkContext.broadcast(anchors)

        def scan_positives(batches, sent=sent):
            mine = sent.value
            yield _rows([(int(mine.row[a]), 0, kept) for a, kept in enumerate(_scan_positives(batches, mine, positives))])

        near = pin(_merged(rows.mapInArrow(scan_positives, schema), ["anchor"], positives))
        wanted: dict[int, list[tuple[int, int, int]]] = {}
        for r in near.select("anchor", "rank", "score").orderBy("anchor", "rank").toArrow().to_pylist():
            # 100 * score between the percentages of the positive's, in whole numbers.
            wanted.setdefault(r["anchor"], []).append((r["rank"], -(-low_percent * r["score"] // 100), high_percent * r["score"] // 100))
        lists = spark.sparkContext.broadcast([wanted.get(int(row), []) for row in anchors.row])

        def scan_negatives(batches, sent=sent, lists=lists):
            mine, wanted = sent.value, lists.value
            found = _scan_negatives(batches, mine, wanted, negatives)
            yield _rows([(int(mine.row[a]), place, kept) for a in range(len(mine)) for (place, _, _), kept in zip(wanted[a], found[a])])

        far = _merged(rows.mapInArrow(scan_negatives, schema), ["anchor", "place"], negatives)
        anchor_ids = spark.createDataFrame(pa.table({"anchor": pa.array(anchors.row), "anchor_id": pa.array(anchors.id)}))
        known = near.join(F.broadcast(anchor_ids), "anchor").select(
            "anchor", F.col("rank").alias("place"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        # One row per positive of a bounded slice of anchors.
        out = far.join(F.broadcast(known), ["anchor", "place"])
        named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
        out.select(
            named("anchor_id"), named("positive_id"), F.col("rank").cast("int").alias("rank"),
            F.when(F.col("id") != NO_ID, F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
        sent.destroy()
        lists.destroy()
    return spark.read.parquet(path)


def _rows(kept: list[tuple[int, int, _Kept]]) -> pa.RecordBatch:
    flat = lambda values: np.concatenate([*values, np.zeros(0, dtype=np.int64)])
    sizes = [len(k.score) for _, _, k in kept]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array([a for a, _, _ in kept], dtype=np.int64), sizes)),
            pa.array(np.repeat(np.array([p for _, p, _ in kept], dtype=np.int32), sizes)),
            pa.array(flat([k.row for _, _, k in kept])),
            pa.array(flat([k.id for _, _, k in kept])),
            pa.array(flat([k.score for _, _, k in kept])),
        ],
        names=["anchor", "place", "row", "id", "score"],
    )


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as whole numbers."""
    # As a double, since Spark's floor gives a 64-bit number, which a large component would not fit into.
    return F.transform(vector, lambda x: _floor(scale * x.cast("double")))


def _floor(x: Column) -> Column:
    """The floor as a double; beyond 2**53 doubles are whole already."""
    return F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)


SQL = """
WITH items AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
           FROM items a, items b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@query(SQL)
def op12_hard_negatives(spark, sf_dir):
    vectors = spread(load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchor = F.col("vec_id") % 100 == 0
    return hard_negatives(vectors.select(F.col("vec_id").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("vector"), anchor.alias("anchor")))
