"""Benchmark decontamination: a BM25 index of the test items, searched with every passage of every text.

The inverted index holds the items in pieces of at most 48 words. A weight in it is the BM25 weight
divided by the score of the piece for itself, so that a score is the share of a piece that a passage
holds, and one threshold fits pieces of any length. Passages are overlapping windows of the texts. A
window whose weights could not reach the threshold at best is passed over; the others are searched with
block-max WAND, which returns every piece above the threshold. A retrieved item is verified on the text around
the passage: of the word trigrams of its question and of its answer (the last third of its words),
a share of each must stand there.

Spark counts document frequencies and lengths. The index is cut into shards of a bounded number of words
by the hash of the item; each is sent to the tasks and searched in a pass of its own, so that the benchmark
may grow without a limit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import Batch, RangeHash, bounded_batches, documents, is_separator, read, signed
from modelpulse.session import pin
from modelpulse.sources.tables import load

PIECE = 48
WINDOW = 64
STRIDE = 32
MIN_SHARE = 0.5
MIN_OVERLAP = 0.5
GRAM = 3
K1, B = 1.2, 0.75
# Postings in a block of a list, and pieces in a block that all lists share.
BLOCK = 32
SHARED = 4
# Cells (window and block) that are bounded at a time.
CELLS = 4_000_000
# Words of all items in a shard: some 60 bytes each in the index.
SHARD_WORDS = 500_000

HITS = "hits array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>"


def _lower(texts: list[str | None]) -> list[str]:
    """Texts in lower case in all scripts, so that capitals hide nothing."""
    return [(t or "").lower() for t in texts]


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item`` (a number made of the words), ``words`` (hashes in order), ``ids``: one row for all items of the same words.

    Items without words are left out. ``ids`` holds no nulls, so it is empty where no item has an id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = read(_lower(batch.column(1).to_pylist()), gap=is_separator)
            hashes = signed(parsed.word_hashes())
            words = [hashes[a:b].tolist() for a, b in zip(parsed.first, parsed.first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "words"])

    rows = items.select(F.col(id_col).cast("bigint").alias("item_id"), text_col)
    held = rows.mapInArrow(work, "item_id bigint, words array<bigint>").where(F.size("words") > 0)
    return held.groupBy(F.xxhash64("words").alias("item"), "words").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))


def weighted_postings(words: DataFrame) -> DataFrame:
    """``item``, ``piece``, ``term``, ``weight``: the inverted index as a table."""
    pieces = F.ceil(F.size("words") / PIECE).cast("int")
    cut = words.withColumn("_k", pieces).withColumn("_w", F.ceil(F.size("words") / F.col("_k")).cast("int"))
    cut = cut.select("item", "words", "_w", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("piece"))
    cut = cut.select("item", "piece", F.slice("words", F.col("piece") * F.col("_w") + 1, F.col("_w")).alias("words"))
    cut = pin(cut.where(F.size("words") > 0))
    tf = cut.select("item", "piece", F.size("words").alias("len"), F.explode("words").alias("term"))
    tf = tf.groupBy("item", "piece", "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n, mean = cut.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.lit(mean or 1.0)))
    scored = tf.join(df, "term").select("item", "piece", "term", (idf * part).alias("w"))
    own = scored.groupBy("item", "piece").agg(F.sum("w").alias("own"))
    return scored.join(own, ["item", "piece"]).select("item", "piece", "term", (F.col("w") / F.col("own")).alias("weight"))


class Index:
    """A shard: terms in order of hash, and per term its postings in order of the piece, in blocks with maxima."""

    def __init__(self, postings: list[tuple[int, int, int, float]], words: dict[int, list[int]], ids: dict[int, list[int]] | None = None):
        # Pieces of similar length are neighbours: their weights are alike, so that block maxima are tight.
        sizes = Counter((i, p) for i, p, _, _ in postings)
        pieces = sorted(sizes, key=lambda k: (sizes[k], k))
        number = {k: n for n, k in enumerate(pieces)}
        self.item = [i for i, _ in pieces]
        rows = sorted((t & 0xFFFFFFFFFFFFFFFF, number[i, p], w) for i, p, t, w in postings)
        terms = np.array([r[0] for r in rows], dtype=np.uint64)
        self.terms, first = np.unique(terms, return_index=True)
        edges = [*first.tolist(), len(rows)]
        self.pieces = [[r[1] for r in rows[a:b]] for a, b in zip(edges, edges[1:])]
        self.weights = [[r[2] for r in rows[a:b]] for a, b in zip(edges, edges[1:])]
        self.maxima = [[max(w[k : k + BLOCK]) for k in range(0, len(w), BLOCK)] for w in self.weights]
        self.most = np.array([max(m) for m in self.maxima])
        # The same maxima for the vectorised bound, in blocks of pieces that all terms share: those of term t are
        # shared_max[shared_at[t] : shared_at[t + 1]].
        self.blocks = -(-len(pieces) // SHARED)
        term = np.searchsorted(self.terms, terms)
        cell, at = np.unique(term * max(1, self.blocks) + np.array([r[1] // SHARED for r in rows], dtype=np.int64), return_inverse=True)
        self.shared_max = np.zeros(len(cell))
        np.maximum.at(self.shared_max, at, np.array([r[2] for r in rows]))
        self.shared_block = cell % max(1, self.blocks)
        self.shared_at = np.searchsorted(cell, np.arange(len(self.terms) + 1) * max(1, self.blocks))
        self.words = words
        # The ids by which an item is reported; all texts of the same words are one item.
        self.ids = ids or {}
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def parts(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of the question and of the answer."""
        if item not in self.grams:
            w = np.array(self.words[item], dtype=np.int64).view(np.uint64)
            cut = len(w) - max(len(w) // 3, min(GRAM, len(w)))
            self.grams[item] = tuple(np.unique(_grams(x)) for x in (w[:cut], w[cut:]))
        return self.grams[item]

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Every piece whose weights of ``terms`` add up to ``least``, by block-max WAND."""
        lists = [[self.pieces[t][0], 0, t] for t in terms]  # where a list stands, its place, its term
        found = []
        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(lists):
                bound += self.most[t]
                if bound >= least - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            target = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
                pivot += 1
            # What the blocks that would hold the target can add at most, and where the first of them ends.
            bound, until = 0.0, lists[pivot + 1][0] if pivot + 1 < len(lists) else 1 << 60
            for stand in lists[: pivot + 1]:
                _, at, t = stand
                posted, block = self.pieces[t], at // BLOCK
                while (block + 1) * BLOCK < len(posted) and posted[(block + 1) * BLOCK - 1] < target:
                    block += 1
                last = posted[min((block + 1) * BLOCK, len(posted)) - 1]
                if last >= target:
                    bound += self.maxima[t][block]
                    until = min(until, last + 1)
            if bound < least - 1e-9:
                target = max(until, target + 1)
            elif lists[0][0] == target:
                score = sum(self.weights[t][at] for _, at, t in lists[: pivot + 1])
                if score >= least:
                    found.append((target, score))
                target += 1
            # All lists up to the pivot move to the target or beyond; spent ones go.
            moved = []
            for k, (here, at, t) in enumerate(lists):
                if k <= pivot and here < target:
                    posted = self.pieces[t]
                    while at < len(posted) and posted[at] < target:
                        at += 1
                    if at == len(posted):
                        continue
                    here = posted[at]
                moved.append([here, at, t])
            lists = moved
        return found


def _grams(words: np.ndarray) -> np.ndarray:
    """Hashes of runs of three words; of all words together where there are fewer."""
    width = min(GRAM, len(words))
    if not width:
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(len(words) - width + 1)
    return RangeHash(words).of(at, at + width)


def _candidates(batch: Batch, hashes: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, list[int]]]:
    """Windows that can reach the threshold: text, first word, last word, their terms in the index."""
    if not len(hashes) or not len(index.terms):
        return
    at = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    term = np.where(index.terms[at] == hashes, at, -1)
    bound = np.where(term >= 0, index.most[at], 0.0)
    total = np.concatenate(([0.0], np.cumsum(bound)))
    counts = np.maximum(-(-(batch.n_words - (WINDOW - STRIDE)) // STRIDE), (batch.n_words > 0).astype(np.int64))
    doc = np.repeat(np.arange(batch.n), counts)
    start = batch.first[doc] + STRIDE * (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts))
    end = np.minimum(start + WINDOW, batch.first[doc + 1])
    likely = np.flatnonzero(total[end] - total[start] >= MIN_SHARE - 1e-6)
    for part in np.array_split(likely, len(likely) * index.blocks // CELLS + len(likely) // 20_000 + 1):
        place = start[part, None] + np.arange(WINDOW)
        inside = place < end[part, None]
        terms = np.sort(np.where(inside, term[np.minimum(place, len(term) - 1)], -1), axis=1)
        new = terms >= 0
        new[:, 1:] &= terms[:, 1:] != terms[:, :-1]
        # What the terms of a window add up to at most in each block of pieces.
        window, column = np.nonzero(new)
        held = terms[window, column]
        size = index.shared_at[held + 1] - index.shared_at[held]
        entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - index.shared_at[held], size)
        cell = np.repeat(window * index.blocks, size) + index.shared_block[entry]
        reach = np.bincount(cell, weights=index.shared_max[entry], minlength=len(part) * index.blocks)
        for k in np.flatnonzero((reach >= MIN_SHARE - 1e-6).reshape(len(part), index.blocks).any(axis=1)):
            yield int(doc[part[k]]), int(start[part[k]]), int(end[part[k]]), terms[k][new[k]].tolist()


def batch_hits(texts: list[str | None], index: Index) -> list[list[dict]]:
    """Per text its verified items, best passage first."""
    batch = read(_lower(texts), gap=is_separator)
    hashes = batch.word_hashes()
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for doc, start, end, terms in _candidates(batch, hashes, index):
        scores: dict[int, float] = {}
        for piece, score in index.search(terms, MIN_SHARE):
            item = index.item[piece]
            scores[item] = max(score, scores.get(item, 0.0))
        for item, score in scores.items():
            reach = len(index.words[item])
            around = hashes[max(batch.first[doc], start - reach) : min(batch.first[doc + 1], end + reach)]
            here = _grams(around)
            question, answer = (float(np.isin(part, here).mean()) if len(part) else 1.0 for part in index.parts(item))
            if question >= MIN_OVERLAP and answer >= MIN_OVERLAP:
                best[doc, item] = max(best.get((doc, item), (0.0, 0.0, 0.0)), (score, question, answer))
    hits: list[list[dict]] = [[] for _ in texts]
    for (doc, item), (score, question, answer) in sorted(best.items()):
        hits[doc].append({"item_id": item, "score": score, "question_overlap": question, "answer_overlap": answer})
    return hits


def shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Parts of the index, each of a bounded number of words."""
    words = pin(item_words(items, id_col, text_col))
    n = 1 + (words.agg(F.sum(F.size("words"))).first()[0] or 0) // SHARD_WORDS
    postings = pin(weighted_postings(words))
    mine = lambda df, k: df.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
    for k in range(n):
        rows = [tuple(r) for r in mine(postings, k).collect()]
        held = mine(words, k).collect()
        yield Index(rows, {r.item: list(r.words) for r in held}, {r.item: list(r.ids) for r in held})


def _reported(hits: list[list[dict]], index: Index) -> list[list[dict]]:
    """Each hit under every id of its item, or under none; of hits under one id the best."""
    out = []
    for mine in hits:
        best: dict[int | None, dict] = {}
        for hit in mine:
            for name in index.ids.get(hit["item_id"]) or [None]:
                if name not in best or hit["score"] > best[name]["score"]:
                    best[name] = {**hit, "item_id": name}
        out.append(list(best.values()))
    return out


def with_hits(docs: DataFrame, index: Index, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of every row and ``hits``, the items of the shard that its text holds."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))
        for batch in batches:
            hits = pa.array(_reported(batch_hits(batch.column(0).to_pylist(), shipped.value), shipped.value), kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], hits], names=[*columns, "hits"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields]
    return docs.select(F.col(text_col).alias("_text"), *columns).mapInArrow(work, ", ".join([*fields, HITS]))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``: every item in every text.

    A null text holds nothing; a row with a null or repeated id reports its own items. Each text of an item is
    looked for by itself; items of the same words are reported under each of their ids, those without an id under null.
    """
    out = None
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for index in shards(items):
        found = with_hits(rows, index, ["doc_id"]).select("doc_id", F.inline("hits"))
        out = found if out is None else out.unionByName(found)
    return out


def keep_uncontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with their own columns."""
    packed = docs.select(F.struct("*").alias("_doc"), F.col(text_col).alias("_t"))
    for index in shards(items):
        packed = with_hits(packed, index, ["_doc", "_t"], "_t").where(F.size("hits") == 0).select("_doc", "_t")
    return packed.select("_doc.*")


@query()
def op7_decontamination(spark, sf_dir):
    return contaminated(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))
