"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions on the presence of hashed words and
word beginnings; a later model also sees the probabilities of the earlier categories. In training these are
out-of-fold predictions, so that a later model learns from probabilities as good as those it will meet.
Training uses a bounded sample of the labelled rows, by hash of the id; all documents are scored, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import RangeHash, bounded_batches, documents, is_separator, mix64, read
from modelpulse.session import pin
from modelpulse.sources.tables import load

# Labelled rows and their features (4 bytes each) that the chain is fitted on, at most.
SAMPLE = 12_000
SAMPLE_FEATURES = 6_000_000
BITS = 17
BEGINNING = 5
FOLDS = 3
ITERATIONS = 30
PENALTY = 0.002
BINS = 100


@dataclass
class Sparse:
    """Rows of present features: those of row i are index[edges[i] : edges[i + 1]]."""

    index: np.ndarray
    edges: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(weights[self.index])))
        return total[self.edges[1:]] - total[self.edges[:-1]]

    def back(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, weights=np.repeat(values, np.diff(self.edges)), minlength=size)

    def rows(self, at: np.ndarray) -> Sparse:
        sizes = np.diff(self.edges)[at]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return Sparse(self.index[np.repeat(self.edges[at], sizes) + inside], np.concatenate(([0], np.cumsum(sizes))))


def features(texts: list[str | None]) -> Sparse:
    """The different words and beginnings of longer words of every text, hashed to 17 bits."""
    batch = read([(t or "").lower() for t in texts], gap=is_separator)
    by_point = RangeHash(mix64(batch.points.astype(np.uint64)))
    long = np.flatnonzero(batch.end - batch.start > BEGINNING)
    doc = batch.doc()
    start = batch.start[long]
    words = by_point.of(batch.start, batch.end) >> np.uint64(64 - BITS)
    begins = mix64(by_point.of(start, start + BEGINNING)) >> np.uint64(64 - BITS)
    key = np.unique(np.concatenate((doc, doc[long])).astype(np.int64) << BITS | np.concatenate((words, begins)).astype(np.int64))
    return Sparse((key & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key >> BITS, np.arange(batch.n + 1)))


def fit_logistic(x: Sparse, dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the hashed features, of the dense ones and of the constant, with an L2 penalty; L-BFGS."""
    size, extra = 1 << BITS, dense.shape[1]
    n = len(y)

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.dot(w[:size]) + dense @ w[size : size + extra] + w[-1]
        loss = np.logaddexp(0, z).sum() - z @ y
        off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        grad = np.concatenate((x.back(off, size), dense.T @ off, [off.sum()])) / n
        grad[:-1] += PENALTY * w[:-1]
        return loss / n + PENALTY / 2 * (w[:-1] @ w[:-1]), grad

    w = np.zeros(size + extra + 1)
    f, g = value(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ITERATIONS):
        step, alphas = g.copy(), []
        for s, d in reversed(past):
            alphas.append((s @ step) / (s @ d))
            step -= alphas[-1] * d
        if past:
            s, d = past[-1]
            step *= (s @ d) / (d @ d)
        for (s, d), a in zip(past, reversed(alphas)):
            step += s * (a - (d @ step) / (s @ d))
        rate = 1.0
        while rate > 1e-8:
            new = w - rate * step
            f_new, g_new = value(new)
            if f_new <= f - 1e-4 * rate * (g @ step):
                break
            rate /= 2
        if rate <= 1e-8 or f - f_new < 1e-7:
            break
        if (new - w) @ (g_new - g) > 1e-12:
            past = [*past[-7:], (new - w, g_new - g)]
        w, f, g = new, f_new, g_new
    return w


def predict(x: Sparse, dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    size = 1 << BITS
    return 1 / (1 + np.exp(-np.clip(x.dot(w[:size]) + dense @ w[size:-1] + w[-1], -500, 500)))


@dataclass
class Chain:
    """Models of categories in order; ``threshold`` is that of the last one, found on out-of-fold predictions."""

    categories: list[str]
    models: list[np.ndarray]
    threshold: float

    @classmethod
    def fit(cls, categories: list[str], x: Sparse, y: np.ndarray, fold: np.ndarray) -> Chain:
        if not len(y):
            return cls(categories, [np.zeros((1 << BITS) + k + 1) for k in range(len(categories))], 2.0)
        models: list[np.ndarray] = []
        dense = np.zeros((len(y), 0))
        for k in range(len(categories)):
            models.append(fit_logistic(x, dense, y[:, k]))
            unseen = np.zeros(len(y))
            for f in range(FOLDS):
                train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if len(train) and len(test):
                    unseen[test] = predict(x.rows(test), dense[test], fit_logistic(x.rows(train), dense[train], y[train, k]))
            dense = np.column_stack((dense, unseen))
        return cls(categories, models, best_threshold(dense[:, -1], y[:, -1]))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """A row of probabilities per text, and which texts are flagged; a text without words is not."""
        x = features(texts)
        dense = np.zeros((len(texts), 0))
        for w in self.models:
            dense = np.column_stack((dense, predict(x, dense, w)))
        return dense, (dense[:, -1] >= self.threshold) & (np.diff(x.edges) > 0)


def best_threshold(score: np.ndarray, label: np.ndarray) -> float:
    """The score of the best F0.5 (precision counts more) among hundredths; 2 if nothing is positive."""
    best = (0.0, 2.0)
    for b in range(BINS):
        flagged = score >= b / BINS
        hit = float(label[flagged].sum())
        if hit:
            best = max(best, (1.25 * hit / (0.25 * label.sum() + flagged.sum()), b / BINS))
    return best[1]


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Chain:
    """A chain over 0/1 columns of ``labels``, fitted on at most ``sample`` labelled rows and ``SAMPLE_FEATURES`` features.

    Labels without an id or with a null category are left out; of several labels of an id, the largest count. Where
    nothing is labelled positive in the last category, nothing will be flagged.
    """
    bounded_batches(docs.sparkSession)
    known = reduce(lambda a, c: a & F.col(c).isNotNull(), categories, F.col(id_col).isNotNull())
    one = labels.where(known).groupBy(F.col(id_col).alias("_id")).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories])
    chosen = pin(one.orderBy(F.xxhash64("_id"), "_id").limit(sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(x.edges, pa.int32()), pa.array(x.index))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["_id", "index"])

    # The sample is bounded, so its ids may go to the texts rather than the texts to them.
    text = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    text = text.join(F.broadcast(chosen.select("_id")), "_id", "left_semi")
    made = pin(text.mapInArrow(work, "_id bigint, index array<int>").dropDuplicates(["_id"]).join(F.broadcast(chosen), "_id"))
    sizes = sorted((r.h, r._id, r.n) for r in made.select(F.xxhash64("_id").alias("h"), "_id", F.size("index").alias("n")).collect())
    upto = np.searchsorted(np.cumsum([n for _, _, n in sizes]), SAMPLE_FEATURES, "right")
    taken = made.where(F.xxhash64("_id") <= sizes[upto - 1][0]) if upto else made.limit(0)
    rows = taken.toArrow().sort_by("_id")
    index = rows["index"].combine_chunks()
    counts = np.array([len(v) for v in index], dtype=np.int64)
    x = Sparse(index.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.concatenate(([0], np.cumsum(counts))))
    y = np.column_stack([rows[c].to_numpy() for c in categories]).astype(float)
    fold = (mix64(rows["_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
    return Chain.fit(categories, x, y, fold)


def flag_toxic(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the probabilities of all categories, and ``toxic``: the last one reaches its threshold.

    One row per row of ``docs``, also for null and repeated ids; a null text has no features
    and is never toxic.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(fit_chain(docs, labels, categories, id_col, text_col))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, flagged = shipped.value.score(batch.column(1).to_pylist())
            columns = [pa.array(np.ascontiguousarray(p[:, k])) for k in range(p.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(flagged)], names=["doc_id", *[f"p_{c}" for c in categories], "toxic"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"`p_{c}` double" for c in categories], "toxic boolean"])
    return docs.select(id_col, text_col).mapInArrow(work, schema)


@query()
def op8_toxicity(spark, sf_dir):
    """Documents that the chain over low quality and toxicity calls toxic."""
    labels = load(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    scored = flag_toxic(documents(spark, sf_dir), labels, ["low_quality", "toxic"]).where("toxic")
    return scored.select("doc_id", F.round("p_low_quality", 3).alias("p_low_quality"), F.round("p_toxic", 3).alias("p_toxic"), "toxic")
