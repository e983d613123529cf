"""MinHash near-dedup with tensored banding, exact verification and exact components.

Two small collections of minhash keys are computed for a document; the key of a table is a pair, one from
each. With m keys of two minhashes in a collection, 4 m minhashes serve m * m tables of four each,
where plain banding needs 4 m * m.

A class stands for all documents with the same shingles. Every class in a bucket is compared with the
bucket's center (its smallest class) on full sets; the shingles in which the two differ are kept. Classes that
share a center and are not yet connected are then compared with one another through these differences alone:
|x - y| follows from |x - c|, |y - c| and what they have in common, so this comparison is exact too. It runs in
blocks of bounded size, and a block returns only the links that connect something, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.components import components
from modelpulse.llm.registry import query
from modelpulse.llm.text import RangeHash, bounded_batches, documents, mix64, read, signed, windows
from modelpulse.session import pin

WORDS = 5
# Keys per collection and minhashes per key: 49 tables from 28 minhashes. Two sets that share 85 %
# meet in no table with a probability of 0.00025.
KEYS = 7
ROWS = 2
# Classes and shingles of a side of a block of comparisons.
BLOCK = 512
BLOCK_SHINGLES = 2_000_000

_U = np.uint64
_SEEDS = mix64(np.arange(1, 2 * KEYS * ROWS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text, the sorted different hashes of its shingles; a short text is one shingle, an empty one none."""
    batch = read(texts, lower=True)
    hashes = batch.word_hashes()
    runs, at = windows(batch, hashes, words)
    edges = np.searchsorted(at, batch.first)
    n_words = batch.n_words
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    whole = RangeHash(hashes).of(batch.first[short], batch.first[short + 1])
    sets = [np.unique(runs[a:b]) for a, b in zip(edges, edges[1:])]
    for i, h in zip(short, whole):
        sets[i] = np.array([h], dtype=np.uint64)
    return sets


def minhash_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row per set: the keys of the first collection, then those of the second. Sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    low = np.empty((len(sets), 2 * KEYS * ROWS), dtype=np.uint64)
    for i, seed in enumerate(_SEEDS):
        x = (flat ^ seed) * (seed | _U(1))
        low[:, i] = np.minimum.reduceat(x ^ (x >> _U(32)), starts)
    keys = low[:, ::ROWS].copy()
    for r in range(1, ROWS):
        keys = mix64(keys * _U(0x9E3779B97F4A7C15) + low[:, r::ROWS])
    return keys


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set, ``keys`` of both collections (null when empty)."""
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            full = [s for s in sets if len(s)]
            rows = iter(signed(minhash_keys(full)).tolist() if full else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "keys"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col)
    return rows.mapInArrow(work, "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``digest``, ``shingles`` of every row of ``docs`` (``text``) with words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(0).to_pylist(), words) if len(s)]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64)))
            values = pa.array(signed(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                ],
                names=["digest", "shingles"],
            )

    return docs.select("text").mapInArrow(work, "digest binary, shingles array<bigint>")


def centered_pairs(classes: DataFrame) -> DataFrame:
    """``x``, ``c``: every class with the centers of the buckets that it shares with others."""
    tables = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(KEYS)),
            lambda i: F.transform(
                F.sequence(F.lit(KEYS + 1), F.lit(2 * KEYS)),
                lambda j: F.xxhash64(i, j, F.element_at("keys", i), F.element_at("keys", j)),
            ),
        )
    )
    rows = classes.select(F.col("id").alias("x"), F.explode(tables).alias("bucket"))
    centers = rows.groupBy("bucket").agg(F.min("x").alias("c"), F.max("x").alias("_most")).where("c < _most").select("bucket", "c")
    return rows.join(centers, "bucket").where("x != c").select("x", "c").distinct()


def linked(inter, nx, ny, percent: int):
    return 100 * inter >= percent * (nx + ny - inter)


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: links between members of a unit that belong to different components.

    A unit is cut into blocks by hash; each pair of blocks is one group of bounded size.
    """
    size = members.groupBy("c").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.size("diff")).alias("_s"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
    # Only units that still fall into several components.
    size = size.where("_lo < _hi").select(
        "c", F.greatest(F.ceil(F.col("_n") / BLOCK), F.ceil(F.col("_s") / BLOCK_SHINGLES)).cast("int").alias("_g")
    )
    cut = members.join(size, "c").withColumn("_i", F.pmod(F.xxhash64("x"), F.col("_g")).cast("int"))
    cut = cut.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    cut = cut.select("c", F.least("_i", "_o").alias("_p"), F.greatest("_i", "_o").alias("_q"), "x", "n", "comp", "diff")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": np.zeros(0, dtype=np.int64), "b": np.zeros(0, dtype=np.int64)})
        comp = group["comp"].to_numpy()
        if len(group) < 2 or (comp == comp[0]).all():
            return none
        ids, n = group["x"].to_numpy(), group["n"].to_numpy().astype(np.float32)
        sizes = np.array([len(d) for d in group["diff"]])
        flat = np.concatenate([np.asarray(d, dtype=np.int64) for d in group["diff"]])
        owner = np.repeat(np.arange(len(ids)), sizes)
        # Shingles that differ from the center in one member alone are shared with nobody.
        _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        column = (np.cumsum(shared) - 1)[inverse]
        many = shared[inverse]
        owner, column = owner[many], column[many]
        common = np.zeros((len(ids), len(ids)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        step = 4096
        for low in range(0, int(shared.sum()), step):
            a, b = np.searchsorted(column, [low, low + step])
            part = np.zeros((len(ids), step), dtype=np.float32)
            part[owner[a:b], column[a:b] - low] = 1
            common += part @ part.T
        apart = sizes[:, None] + sizes[None, :] - 2 * common
        inter = (n[:, None] + n[None, :] - apart) / 2
        hit = linked(inter, n[:, None], n[None, :], percent) & (comp[:, None] != comp[None, :])
        first, second = np.nonzero(np.triu(hit, 1))
        parent = {c: c for c in set(comp.tolist())}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        links = []
        for i, j in zip(first.tolist(), second.tolist()):
            p, q = root(int(comp[i])), root(int(comp[j]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                links.append((int(ids[i]), int(ids[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64") if links else none

    return cut.groupBy("c", "_p", "_q").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when their sets of word shingles share at least ``percent`` of their union; a component
    is named by its smallest id. A text without words is linked with nothing. Rows with equal ids
    are one document, linked through any of its texts. A row with a null id takes part in nothing: its
    component is null and it is kept.
    """
    signed_docs = pin(signatures(docs, id_col, text_col, words))
    named = signed_docs.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    # Equal sets first: one class for each, numbered once and kept so by the checkpoint.
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    classes = pin(classes.withColumn("id", F.monotonically_increasing_id()))
    pairs = pin(centered_pairs(classes))
    links = _links(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), classes, pairs, percent, words)
    # Several texts under one id make one document.
    shared = named.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("d0 < d1").select("doc_id", "d0")
    number = lambda d, out: classes.select(F.col("digest").alias(d), F.col("id").alias(out))
    shared = named.select("doc_id", "digest").join(shared, "doc_id").join(number("d0", "a"), "d0").join(number("digest", "b"), "digest")
    group = components(links.unionByName(shared.select("a", "b"))).withColumnRenamed("node", "id")
    known = classes.select("digest", "id", "first_doc").join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = known.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    known = known.join(smallest, "component").select("digest", "component_id")
    out = signed_docs.select("doc_id", "n_shingles", "digest").join(known, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int, words: int) -> DataFrame:
    """``a``, ``b``: links between classes that span the components of all links found in the buckets."""
    wanted = pairs.select(F.col("x").alias("id")).union(pairs.select("c")).distinct()
    wanted = pin(wanted.join(classes.select("id", "digest", "n", F.col("first_doc").alias("doc_id")), "id"))
    sets = full_sets(docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi"), words)
    sets = pin(sets.join(wanted.select("id", "digest", "n"), "digest").dropDuplicates(["id"]).select("id", "n", "shingles"))
    one = lambda side: sets.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("shingles").alias(f"s{side}"))
    both = pairs.join(one("x"), "x").join(one("c"), "c")
    diff = F.concat(F.array_except("sx", "sc"), F.array_except("sc", "sx"))
    compared = pin(both.select("x", "c", "nx", "nc", diff.alias("diff")))
    inter = (F.col("nx") + F.col("nc") - F.size("diff")) / 2
    direct = compared.where(linked(inter, F.col("nx"), F.col("nc"), percent)).select(F.col("x").alias("a"), F.col("c").alias("b"))
    group = components(direct).withColumnRenamed("node", "x").withColumnRenamed("component", "comp")
    centers = compared.select("c", F.col("c").alias("x"), F.col("nc").alias("n")).distinct().withColumn("diff", F.array().cast("array<bigint>"))
    members = compared.select("c", "x", F.col("nx").alias("n"), "diff").unionByName(centers)
    members = members.join(group, "x", "left").withColumn("comp", F.coalesce("comp", "x"))
    return direct.unionByName(_blocks(members, percent))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` but those whose document is not the smallest id of its component."""
    gone = near_duplicates(docs, id_col, text_col, percent, words).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).cast("bigint").alias("_own"))
    return rows.join(gone, F.col("_own") == F.col("_gone"), "left_anti").select("_doc.*")


@query()
def op10_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), percent=85)
