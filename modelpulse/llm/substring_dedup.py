"""Substring dedup: spans of consecutive sentences that stand elsewhere before are removed.

A span is the shortest run of at least two sentences with at least 20 words, once forwards from every
sentence and once backwards, so that a repeated passage is covered to its last sentence; or a single sentence
of at least 50 words, such as a long line without a full stop. Spans are compared
by 96-bit hashes of their words in lower case. Repeats inside a document are found in the task; between
documents, the smallest id of every hash is found with map-side combine and joined back to the spans. Only
hashes and places travel until the end, when the texts that lose something are joined to what they lose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import Batch, RangeHash, bounded_batches, documents, mix64, read, signed

MIN_SENTENCES = 2
MIN_WORDS = 20
# Words from which a sentence is a span by itself.
LONG_SENTENCE = 50


def sentences(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """First word of every sentence (and the number of words at the end), and per text its first sentence.

    A sentence ends with a word in . ! ? or before a line feed.
    """
    n = len(batch.start)
    breaks = np.concatenate(([0], np.cumsum(batch.points == 10)))
    last = np.isin(batch.points[batch.end - 1], np.array([33, 46, 63], dtype=batch.points.dtype)) if n else np.zeros(0, dtype=bool)
    following = np.concatenate((batch.start[1:], [len(batch.points)])) if n else batch.start
    last |= breaks[following] > breaks[batch.end]  # the line feed after each text ends its last sentence
    first = np.concatenate(([0], np.flatnonzero(last) + 1)) if n else np.zeros(1, dtype=np.int64)
    return first, np.searchsorted(first, batch.first)


def spans(batch: Batch, hashes: np.ndarray, min_sentences: int, min_words: int) -> tuple[np.ndarray, ...]:
    """Text, first sentence, end sentence (both counted in the batch) and two hashes of every span."""
    first, of_text = sentences(batch)
    n = len(first) - 1
    number = np.diff(of_text)
    text = np.repeat(np.arange(batch.n), number)
    at = np.arange(n)
    ahead = np.maximum(at + min_sentences, np.searchsorted(first, first[:-1] + min_words))
    ends = at + 1
    back = np.minimum(ends - min_sentences, np.searchsorted(first, first[1:] - min_words, "right") - 1)
    good = ahead <= of_text[text + 1]
    fine = back >= of_text[text]
    long = np.diff(first) >= LONG_SENTENCE
    start = np.concatenate((at[good], back[fine], at[long]))
    end = np.concatenate((ahead[good], ends[fine], ends[long]))
    if not len(start):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    key = np.unique(start * (n + 1) + end)
    start, end = key // (n + 1), key % (n + 1)
    one = RangeHash(hashes).of(first[start], first[end])
    two = RangeHash(mix64(hashes + np.uint64(1))).of(first[start], first[end])
    return text[start], start - of_text[text[start]], end - of_text[text[start]], one, two


def span_table(docs: DataFrame, id_col: str, text_col: str, min_sentences: int, min_words: int) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``s``, ``e`` (sentences of the document), ``h1``, ``h2``, ``again`` (repeats an earlier span of the document)."""
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = read(batch.column(1).to_pylist(), lower=True)
            text, s, e, one, two = spans(parsed, parsed.word_hashes(), min_sentences, min_words)
            order = np.lexsort((s, one, text))
            text, s, e, one, two = (x[order] for x in (text, s, e, one, two))
            again = np.zeros(len(text), dtype=bool)
            again[1:] = (text[1:] == text[:-1]) & (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            ids, keys = (batch.column(k).take(pa.array(text, pa.int64())) for k in (0, 2))
            yield pa.RecordBatch.from_arrays(
                [ids, keys, pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(signed(one)), pa.array((two >> np.uint64(33)).astype(np.int32)), pa.array(again)],
                names=["doc_id", "text_key", "s", "e", "h1", "h2", "again"],
            )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), text_col, F.xxhash64(text_col).alias("text_key"))
    return rows.mapInArrow(work, "doc_id bigint, text_key bigint, s int, e int, h1 bigint, h2 int, again boolean")


def repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``text_key``, ``removed`` (sentences covered by a span that is not the first of its kind, from 0, in order) and
    ``first_docs`` (the documents that hold the first ones), for every text that loses something.

    First is the smallest document id and the earliest place in it. Rows with equal ids are one document: they don't
    repeat one another, but each text has places of its own. Rows with a null id and null or empty texts take no part.
    """
    table = span_table(docs, id_col, text_col, min_sentences, min_words)
    once = table.where(~F.col("again"))
    firsts = once.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last"))
    firsts = firsts.where("first_doc < _last").select("h1", "h2", "first_doc")
    between = once.join(firsts, ["h1", "h2"]).where("doc_id > first_doc").select("doc_id", "text_key", "s", "e", "first_doc")
    inside = table.where("again").select("doc_id", "text_key", "s", "e", F.col("doc_id").alias("first_doc"))
    cover = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("s", F.col("e") - 1)))))
    return between.unionByName(inside).groupBy("doc_id", "text_key").agg(cover.alias("removed"), F.sort_array(F.collect_set("first_doc")).alias("first_docs"))


def drop_repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, only_changed: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` (or the changed rows), the text without the repeated sentences, with ``n_sentences``
    (of changed rows), ``n_removed`` and ``first_docs``.

    A sentence goes with the white space after it; what is left is as it was. Columns of the input with the new names
    are replaced.
    """
    gone = repeated_sentences(docs, id_col, text_col, min_sentences, min_words).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "removed", F.col("first_docs").alias("_firsts"))
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "first_docs")]
    joined = docs.select(F.struct(*names).alias("_doc"), F.col(id_col).cast("bigint").alias("_own"), F.col(text_col).alias("_text"))
    same = (F.col("_own") == F.col("_id")) & (F.xxhash64("_text") == F.col("_key"))
    joined = joined.join(gone, same, "inner" if only_changed else "left").select("_doc", "_text", "removed", "_firsts")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            kept, total = [], []
            for text, places in zip(texts, removed):
                if not places:
                    kept.append(text)
                    total.append(None)
                    continue
                parsed = read([text])
                first, _ = sentences(parsed)
                cuts = np.concatenate((parsed.start[first[:-1]], [len(text)]))
                stay = np.ones(len(first) - 1, dtype=bool)
                stay[places] = False
                parts = [text[: cuts[0]], *[text[cuts[k] : cuts[k + 1]] for k in np.flatnonzero(stay)]]
                kept.append("".join(parts))
                total.append(len(stay))
            sizes = [len(p or ()) for p in removed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(sizes, pa.int64()), batch.column(3)],
                names=["_doc", "_kept", "n_sentences", "n_removed", "first_docs"],
            )

    kind = joined.schema["_doc"].dataType.simpleString()
    out = joined.mapInArrow(work, f"_doc {kind}, _kept string, n_sentences bigint, n_removed bigint, first_docs array<bigint>")
    columns = [F.col("_kept").alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in names]
    return out.select(*columns, "n_sentences", "n_removed", "first_docs")


@query()
def op1_substring_dedup(spark, sf_dir):
    changed = drop_repeated_sentences(documents(spark, sf_dir).select("doc_id", "text"), only_changed=True)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return changed.select("doc_id", "n_sentences", "n_removed", "first_docs", digest)
