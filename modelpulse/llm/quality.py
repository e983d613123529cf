"""Quality rules with n-gram perplexity.

The model is a character n-gram model (order 4) with interpolated modified Kneser-Ney smoothing, one
for each language. Spark counts the n-grams of all texts (combined inside the tasks first), and all
further statistics (continuation counts, counts of counts, discounts, contexts) are groupings and joins
of the counted table. An n-gram of four code points fits into 64 bits, so the hash that keys the sorted
arrays is a bijection and no two n-grams share an entry. Log probabilities are whole micronats: sums
do not depend on the order of summation.

A text is scored by a model that has not counted it: texts fall into two folds by the hash of the text, so
that equal ones stay together, and each fold is scored by the n-grams of the other.

A text's score is its surprise in nats per word that holds a letter or digit, the logarithm of its perplexity
per word. Per n-gram the signs strewn into a text would hide: a run of them is long and, once begun, cheap.
The bands of a language are its median score -/+ a multiple of the spread (scaled median absolute deviation,
found in a histogram of all scores), widened for short texts by the error of a mean over few words.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelpulse.llm.registry import query
from modelpulse.llm.text import Batch, RangeHash, bounded_batches, documents, is_separator, is_space, mix64, read, signed, windows
from modelpulse.operators.ordered import join_totals
from modelpulse.session import pin, scratch_path

ORDER = 4
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Bands: so many spreads from the median, and so many standard errors of a text's own mean.
SPREADS = 6.0
ERRORS = 3.0
# What the surprise of one word in nats deviates by beyond the spread of the texts, for the error of a mean.
DEVIATION = 2.5
MIN_SPREAD = 0.02
BINS_PER_NAT = 200
FINE_BINS = 20_000
MICRO = 1_000_000
# Entries of all models together (at most 24 bytes each) up to which they are sent to the tasks as arrays;
# more than that are joined instead.
MAX_SHIPPED = 4_000_000
# N-grams that a counting task holds before it passes them on.
HELD = 1_500_000

# Folds by which a text's own n-grams are kept out of its model.
FOLDS = 2

_U = np.uint64


def language(docs: DataFrame, lang_col: str | None):
    """The language that a row is scored by; rows without one share a model."""
    return F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")


def model_key(docs: DataFrame, text_col: str, lang_col: str | None, counted: bool):
    """The model of a language that scores a text, or (``counted``) the one that counts it: that of the other fold."""
    fold = F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(FOLDS))
    return F.concat((FOLDS - 1 - fold if counted else fold).cast("string"), F.lit(" "), language(docs, lang_col))


def char_ngrams(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams inside the texts, packed, and the number in each text.

    White space is one class, and so are code points beyond 16 bits.
    """
    p = np.minimum(np.where(is_space(batch.points), 32, batch.points), 0xFFFF).astype(np.uint64)
    n = len(p) - ORDER + 1
    lengths = np.maximum(np.diff(batch.bounds) - ORDER, 0)  # the line feed at the end belongs to no text
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), lengths
    packed = p[:n].copy()
    for k in range(1, ORDER):
        packed = packed << _U(16) | p[k : n + k]
    inside = np.ones(n, dtype=bool)
    for k in range(ORDER):
        at = batch.bounds[1:] - 1 - k
        inside[at[(at >= 0) & (at < n)]] = False
    return packed[inside], lengths


def count_ngrams(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", held_out: bool = False) -> DataFrame:
    """``lang``, ``gram`` (packed), ``c``: how often every n-gram occurs in all texts of a language.

    With ``held_out``, ``lang`` is the fold that the counts are to score and the language.
    """
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merge(parts):
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.zeros(len(keys), dtype=np.int64)
            np.add.at(counts, inverse, np.concatenate([c for _, c in parts]))
            return keys, counts

        def flush():
            for lang, parts in held.items():
                keys, counts = merge(parts)
                for i in range(0, len(keys), 100_000):
                    k = keys[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k), pa.string()), pa.array(signed(k)), pa.array(counts[i : i + 100_000])],
                        names=["lang", "gram", "c"],
                    )
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                grams, _ = char_ngrams(read([t for t, g in zip(texts, langs) if g == lang], lower=True))
                if len(grams):
                    held.setdefault(lang, []).append(np.unique(grams, return_counts=True))
                    size += len(held[lang][-1][0])
            if size > HELD:
                for lang in held:
                    held[lang] = [merge(held[lang])]
                size = sum(len(k) for parts in held.values() for k, _ in parts)
                if size > HELD // 2:
                    yield from flush()
                    size = 0
        yield from flush()

    key = model_key(docs, text_col, lang_col, True) if held_out else language(docs, lang_col)
    rows = docs.select(key.alias("lang"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(work, "lang string, gram bigint, c bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def _all_orders(counts: DataFrame) -> DataFrame:
    """``lang``, ``n``, ``gram``, ``c`` of all orders: counts of the highest, different left neighbours of the others."""
    table = counts.select("lang", F.lit(ORDER).alias("n"), "gram", "c")
    out = table
    for n in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << 16 * n) - 1)
        table = table.groupBy("lang", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        table = table.select("lang", F.lit(n).alias("n"), "gram", "c")
        out = out.unionByName(table)
    return out


def _discounts(grams: DataFrame) -> DataFrame:
    """``lang``, ``n``, ``d1`` to ``d3`` and ``size``, the number of n-grams, from the counts of counts. One row per language and order."""
    counted = grams.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("size"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0))

    def discount(i: int):
        value = i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0))
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{i}") > 0)
        return F.when(usable & (value > 0) & (value < i), value).otherwise(0.5).alias(f"d{i}")

    return counted.select("lang", "n", "size", *[discount(i) for i in (1, 2, 3)])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang``, ``n``, ``gram``, ``cost`` (micronats), ``back`` (micronats of the backoff weight of the
    n-gram as a context, null where it is none) for every n-gram of the orders 1 to 4 that occurs.

    The highest order uses counts, a lower one the number of different left neighbours. Discounts come
    from the counts of counts; where these don't determine one, 0.5 stands for it. All orders are one table, so that
    counts of counts, contexts and discounted shares are one grouping each; only the probabilities are
    joined order after order, each with that of its suffix in the order below.
    """
    grams = pin(_all_orders(counts))
    known = join_totals(grams, _discounts(grams), ["lang", "n"])
    context, c = F.shiftrightunsigned("gram", 16).alias("context"), F.col("c")
    # The discounts are those of the group, hence the same in all its rows.
    contexts = pin(
        known.groupBy("lang", "n", context).agg(
            F.sum("c").alias("total"),
            (F.sum(F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))) / F.sum("c")).alias("gamma"),
        )
    )
    off = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
    cells = known.select("lang", "n", "gram", context, "c", off.alias("off"), "size").join(contexts, ["lang", "n", "context"])
    cells = pin(cells.select("lang", "n", "gram", ((F.col("c") - F.col("off")) / F.col("total")).alias("share"), "gamma", "size"))
    of = lambda n: cells.where(F.col("n") == n)
    p = of(1).select("lang", "n", "gram", (F.col("share") + F.col("gamma") / F.col("size")).alias("p"))
    every = p
    for n in range(2, ORDER + 1):
        below = p.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p_low"))
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))
        met = of(n).withColumn("suffix", suffix).join(below, ["lang", "suffix"])
        p = met.select("lang", "n", "gram", (F.col("share") + F.col("gamma") * F.col("p_low")).alias("p"))
        every = every.unionByName(p)
    micro = lambda x: F.round(-F.log(x) * MICRO).cast("bigint")
    # A context of an order is an n-gram of the order below; that of order 1 is empty. One grouping instead of a full join.
    none = F.lit(None).cast("bigint")
    costs = every.select("lang", "n", "gram", micro(F.col("p")).alias("cost"), none.alias("back"))
    backs = contexts.select("lang", (F.col("n") - 1).alias("n"), F.col("context").alias("gram"), none.alias("cost"), micro(F.col("gamma")).alias("back"))
    return costs.unionByName(backs).groupBy("lang", "n", "gram").agg(F.max("cost").alias("cost"), F.max("back").alias("back"))


@dataclass
class Arrays:
    """The model of one language: per order sorted hashes with costs, and those of contexts with backoff costs."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    contexts: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    # Cost of a code point that never occurred in the language.
    unknown: int = 20 * MICRO

    @classmethod
    def of(cls, orders: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Arrays:
        """From n-grams, costs and backoff costs per order, in which -1 says that there is none."""
        self = cls()
        none = np.zeros(0, dtype=np.int64), *[np.zeros(0, dtype=np.int32)] * 2
        for k in range(1, ORDER + 1):
            gram, cost, back = orders.get(k, none)
            h = mix64(gram.view(np.uint64))
            order = np.argsort(h)
            h, cost, back = h[order], cost[order], back[order]
            self.grams[k], self.contexts[k] = (h[cost >= 0], cost[cost >= 0]), (h[back >= 0], back[back >= 0])
        return self

    @staticmethod
    def _look_up(table: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of every n-gram, 0 where there is none, and whether there is one."""
        keys, values = table
        if not len(keys):
            return np.zeros(len(grams), dtype=np.int64), np.zeros(len(grams), dtype=bool)
        h = mix64(grams)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        found = keys[at] == h
        return np.where(found, values[at], 0), found

    def surprise(self, grams: np.ndarray) -> np.ndarray:
        """Micronats of every n-gram's last code point after the others."""
        cost = np.zeros(len(grams), dtype=np.int64)
        rest = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            here = grams[rest] & _U((1 << 16 * k) - 1)
            value, found = self._look_up(self.grams[k], here)
            cost[rest] += value
            rest, here = rest[~found], here[~found]
            if not len(rest):
                return cost
            if k > 1:
                cost[rest] += self._look_up(self.contexts[k - 1], here >> _U(16))[0]
        cost[rest] += self.unknown
        return cost


def collect_models(model: DataFrame) -> dict[str, Arrays]:
    """The models as sorted arrays. Only called for models of a counted size.

    Tasks pack what they have of an order of a language into arrays of 16 bytes an entry, so the driver sees some
    arrays and never a row.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            which, n = lang.indices.to_numpy(), batch.column(1).to_numpy()
            gram, cost, back = (batch.column(i).to_numpy() for i in (2, 3, 4))
            order = np.lexsort((n, which))
            edges = np.flatnonzero(np.concatenate(([True], (np.diff(which[order]) != 0) | (np.diff(n[order]) != 0), [True]))) if len(order) else [0]
            for a, b in zip(edges, edges[1:]):
                at = order[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang.dictionary[int(which[at[0]])].as_py()]),
                        pa.array([int(n[at[0]])], pa.int32()),
                        *[pa.array([x[at].astype(t).tobytes()], pa.binary()) for x, t in ((gram, np.int64), (cost, np.int32), (back, np.int32))],
                    ],
                    names=["lang", "n", "gram", "cost", "back"],
                )

    none = F.lit(-1).cast("bigint")
    table = model.where(F.col("n") > 0).select("lang", "n", "gram", F.coalesce("cost", none).alias("cost"), F.coalesce("back", none).alias("back"))
    # A batch of the wide session setting, since the rows are small.
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    packed = table.mapInArrow(pack, "lang string, n int, gram binary, cost binary, back binary").toArrow()
    bounded_batches(table.sparkSession)
    parts: dict[str, dict[int, list[tuple[bytes, bytes, bytes]]]] = {}
    for i in range(packed.num_rows):
        lang, n, *arrays = (packed.column(k)[i] for k in range(5))
        parts.setdefault(lang.as_py(), {}).setdefault(n.as_py(), []).append([a.as_buffer() for a in arrays])
    return {lang: Arrays.of({n: [np.concatenate([np.frombuffer(p[k], t) for p in some]) for k, t in enumerate((np.int64, np.int32, np.int32))] for n, some in orders.items()}) for lang, orders in parts.items()}


def base_statistics(batch: Batch) -> dict[str, np.ndarray]:
    """Per text: words, those with a letter or digit, code points in words, symbols, repeated lines, words in repeated windows."""
    n, p = batch.n, batch.points
    doc = batch.doc()
    letters = np.concatenate(([0], np.cumsum(~is_separator(p))))
    lettered = letters[batch.end] > letters[batch.start]
    chars = np.bincount(doc, weights=batch.end - batch.start, minlength=n).astype(np.int64)
    symbol = np.isin(p, np.array([ord(c) for c in SYMBOLS], dtype=p.dtype))
    total = np.concatenate(([0], np.cumsum(symbol)))
    symbols = total[batch.bounds[1:]] - total[batch.bounds[:-1]]
    # Lines that hold a word, by the hash of their code points.
    line_end = np.flatnonzero(p == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1)) if len(line_end) else line_end
    held = np.searchsorted(batch.start, line_end) > np.searchsorted(batch.start, line_start)
    line_start, line_end = line_start[held], line_end[held]
    line_doc = np.searchsorted(batch.bounds, line_start, "right") - 1
    hashes = RangeHash(mix64(p.astype(np.uint64))).of(line_start, line_end)
    repeated = np.bincount(line_doc, minlength=n) - _distinct(line_doc, hashes, n)
    # Words covered by a window that occurs again in the same text.
    window, at = windows(batch, batch.word_hashes(), REPEAT_WINDOW)
    wdoc = doc[at]
    covered = np.zeros(len(doc) + 1, dtype=np.int64)
    if len(window):
        _, inverse, count = np.unique(mix64(window ^ wdoc.astype(np.uint64)), return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WINDOW, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": batch.n_words.astype(np.int64),
        "n_lettered": np.bincount(doc, weights=lettered, minlength=n).astype(np.int64),
        "word_chars": chars,
        "n_symbols": symbols.astype(np.int64),
        "n_dup_lines": repeated.astype(np.int64),
        "n_repeat_words": np.bincount(doc, weights=inside, minlength=n).astype(np.int64),
    }


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Different hashes per text."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return np.bincount(d[new], minlength=n)


BASE = ["n_words", "n_lettered", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCORED = [*BASE, "n_grams", "micronats"]


def held_out_model(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    return kneser_ney(count_ngrams(docs, text_col, lang_col, True))


def score(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", model: DataFrame | None = None, held_out: bool = False) -> DataFrame:
    """Every row with its base statistics, ``n_grams`` and ``micronats``, the summed surprise.

    ``model`` is that of :func:`kneser_ney`; with ``held_out`` its counts were held out. By default it is counted
    from ``docs`` themselves, held out. A null text is empty: no words, no n-grams. Columns of the input with the
    new names are replaced.
    """
    others = [c for c in docs.columns if c not in SCORED and c != text_col]
    return _scored(docs, text_col, lang_col, others, model, held_out)[0].select(*[F.col("_others").getField(c).alias(c) for c in others], *SCORED)


def _scored(docs: DataFrame, text_col: str, lang_col: str | None, others: Sequence[str], model: DataFrame | None = None, held_out: bool = False) -> tuple[DataFrame, Callable]:
    """``_others`` (the columns ``others`` as one, so that none of their names can clash), the scores, and what frees the model
    that was sent to the tasks once they have been read."""
    bounded_batches(docs.sparkSession)
    held_out = held_out or model is None
    model = pin(held_out_model(docs, text_col, lang_col) if model is None else model)
    packed = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(None).cast("int").alias("_none"))
    key = model_key(docs, text_col, lang_col, False) if held_out else language(docs, lang_col)
    rows = docs.select(F.col(text_col).alias("_text"), key.alias("_lang"), packed.alias("_others"))
    if model.count() > MAX_SHIPPED:
        return _score_by_join(rows, model), lambda: None
    shipped = rows.sparkSession.sparkContext.broadcast(collect_models(model))
    return _score_by_arrays(rows, shipped), shipped.destroy


def _score_by_arrays(rows: DataFrame, shipped) -> DataFrame:
    """``_others`` and the scores, by the models of all languages in every task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, empty = shipped.value, Arrays.of({})
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            result = base_statistics(read(texts))
            grams, lengths = char_ngrams(read(texts, lower=True))
            last = np.cumsum(lengths)
            micro = np.zeros(len(texts), dtype=np.int64)
            by_gram = np.repeat(np.arange(len(texts)), lengths)
            known = np.array(langs, dtype=object)
            for lang in set(langs):
                mine = (known == lang)[by_gram]
                cost = np.zeros(len(grams), dtype=np.int64)
                cost[mine] = models.get(lang, empty).surprise(grams[mine])
                total = np.concatenate(([0], np.cumsum(cost)))
                micro += np.where(known == lang, total[last] - total[last - lengths], 0)
            result |= {"n_grams": lengths.astype(np.int64), "micronats": micro}
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *[pa.array(result[c]) for c in SCORED]], names=["_others", *SCORED])

    return rows.mapInArrow(work, T.StructType([rows.schema["_others"], *[T.StructField(c, T.LongType()) for c in SCORED]]))


def gram_costs(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``_lang``, ``g``, ``cost`` of all n-grams of ``grams``: what :meth:`Arrays.surprise` gives, by joins.

    An n-gram that the model lacks costs the backoff of its context and what its last code points cost.
    """
    left, out = grams.select("_lang", "g", F.col("g").alias("_here"), F.lit(0).cast("bigint").alias("_so_far")), None
    for k in range(ORDER, 0, -1):
        table = model.where((F.col("n") == k) & F.col("cost").isNotNull()).select(F.col("lang").alias("_lang"), F.col("gram").alias("_here"), "cost")
        met = pin(left.join(table, ["_lang", "_here"], "left"))
        found = met.where(F.col("cost").isNotNull()).select("_lang", "g", (F.col("_so_far") + F.col("cost")).alias("cost"))
        out = found if out is None else out.unionByName(found)
        left = met.where(F.col("cost").isNull()).drop("cost")
        if k > 1:
            backs = model.where((F.col("n") == k - 1) & F.col("back").isNotNull()).select(F.col("lang").alias("_lang"), F.col("gram").alias("_context"), "back")
            left = left.withColumn("_context", F.shiftrightunsigned("_here", 16)).join(backs, ["_lang", "_context"], "left")
            shorter = F.col("_here").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            left = left.select("_lang", "g", shorter.alias("_here"), (F.col("_so_far") + F.coalesce("back", F.lit(0))).alias("_so_far"))
    return out.unionByName(left.select("_lang", "g", (F.col("_so_far") + Arrays.unknown).alias("cost")))


def _score_by_join(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The same for models too large to send: each text's different n-grams are joined to the costs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            stats = base_statistics(read(texts))
            grams, lengths = char_ngrams(read(texts, lower=True))
            edges = np.concatenate(([0], np.cumsum(lengths)))
            pairs = [np.unique(grams[a:b], return_counts=True) for a, b in zip(edges, edges[1:])]
            lists = [pa.array([list(map(int, signed(k))) for k, _ in pairs], pa.list_(pa.int64())), pa.array([list(map(int, c)) for _, c in pairs], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array(stats[c]) for c in BASE], pa.array(lengths.astype(np.int64)), *lists],
                names=["_lang", "_others", *BASE, "n_grams", "_grams", "_counts"],
            )

    longs = T.ArrayType(T.LongType())
    schema = T.StructType(
        [T.StructField("_lang", T.StringType()), rows.schema["_others"], *[T.StructField(c, T.LongType()) for c in [*BASE, "n_grams"]], T.StructField("_grams", longs), T.StructField("_counts", longs)]
    )
    counted = pin(rows.mapInArrow(work, schema).withColumn("_row", F.monotonically_increasing_id()))
    long = counted.select("_row", "_lang", F.explode(F.arrays_zip("_grams", "_counts")).alias("z"))
    costs = gram_costs(long.select("_lang", F.col("z._grams").alias("g")).distinct(), model)
    sums = (
        long.select("_row", "_lang", F.col("z._grams").alias("g"), F.col("z._counts").alias("c"))
        .join(costs, ["_lang", "g"])
        .groupBy("_row")
        .agg(F.sum(F.col("c") * F.col("cost")).alias("micronats"))
    )
    joined = counted.drop("_grams", "_counts", "_lang").join(sums, "_row", "left")
    return joined.withColumn("micronats", F.coalesce("micronats", F.lit(0))).select("_others", *SCORED)


def per_word():
    """Micronats per word with a letter or digit; all of them where there is no such word."""
    return F.col("micronats") / F.greatest("n_lettered", F.lit(1))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def perplexity_bands(scored: DataFrame, spreads: float = SPREADS) -> DataFrame:
    """``_band_lang``, ``_low``, ``_high``, the bands of log perplexity per word of each language; ``scored`` has ``_band_lang``.

    Median and median absolute deviation are read from a histogram of the scores of all texts that pass
    the base rules, so that no language is gathered in one task. Beyond ``FINE_BINS`` a bin widens with its
    value, which bounds their number by a rule.
    """
    place = per_word() * (BINS_PER_NAT / MICRO)
    wide = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(place / FINE_BINS)) + 1, F.lit(0))).cast("bigint")
    # Some thousand bins per language, a few hundred thousand at most, in one row.
    bins = (
        scored.where(~base_failed() & (F.col("n_grams") > 0))
        .groupBy("_band_lang", (F.floor(place / wide) * wide).alias("b"))
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("_band_lang")
        .agg(F.collect_list(F.struct("b", "c")).alias("bins"), F.sum("c").alias("_all"))
    )

    def median(pairs):
        """The first value up to which half of all rows lie; ``pairs`` of value and count."""
        start = F.struct(F.lit(0).cast("bigint").alias("cum"), F.lit(None).cast("bigint").alias("m"))
        step = lambda acc, x: F.struct(
            (acc["cum"] + x["c"]).alias("cum"), F.coalesce(acc["m"], F.when(2 * (acc["cum"] + x["c"]) >= F.col("_all"), x["b"])).alias("m")
        )
        return F.aggregate(F.array_sort(pairs), start, step, lambda acc: acc["m"])

    middle = bins.select("*", median(F.col("bins")).alias("middle"))
    off = F.transform("bins", lambda x: F.struct(F.abs(x["b"] - F.col("middle")).alias("b"), x["c"].alias("c")))
    spread = middle.select("_band_lang", "middle", median(off).alias("mad"))
    width = spreads * F.greatest(1.4826 * (F.col("mad") + 0.5) / BINS_PER_NAT, F.lit(MIN_SPREAD))
    center = (F.col("middle") + 0.5) / BINS_PER_NAT
    return spread.select("_band_lang", (center - width).alias("_low"), (center + width).alias("_high"))


def _judged(scored: DataFrame, bands: DataFrame) -> DataFrame:
    """Adds ``log_perplexity``, ``base_failed`` and ``kept`` to scored rows with their ``_band_lang``.

    Kept are texts that pass the base rules and lie within the bands of their language; a text without
    n-grams fails the base rules by its few words.
    """
    mean = per_word() / MICRO
    error = ERRORS * DEVIATION / F.sqrt(F.greatest("n_lettered", F.lit(1)))
    # One row per language: sent to the texts if counted few, so that a language is not gathered in one task.
    joined = join_totals(scored, bands, ["_band_lang"], "left")
    joined = joined.withColumn("base_failed", base_failed()).withColumn("log_perplexity", F.when(F.col("n_grams") > 0, mean))
    inside = (F.col("log_perplexity") >= F.col("_low") - error) & (F.col("log_perplexity") <= F.col("_high") + error)
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


VERDICT = [*SCORED, "log_perplexity", "base_failed", "kept"]


def quality_verdicts(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row per row of ``docs``, without the text: statistics, log perplexity, verdict.

    A null text is empty, and fails the base rules by its few words, as an empty one does; rows without a language share
    a model and a band. Every row counts, so repeated ones weigh as often as they occur. An empty table has no
    rows. Columns of the input with the new names are replaced.
    """
    others = [c for c in docs.columns if c not in VERDICT and c != text_col]
    scored, free = _scored(docs, text_col, lang_col, [*others, *([lang_col] if lang_col and lang_col not in others else [])])
    scored = pin(_with_band(scored, lang_col))
    free()
    return _judged(scored, perplexity_bands(scored)).select(*[F.col("_others").getField(c).alias(c) for c in others], *VERDICT)


def _with_band(scored: DataFrame, lang_col: str | None) -> DataFrame:
    return scored.withColumn("_band_lang", F.coalesce(F.col("_others").getField(lang_col).cast("string"), F.lit("")) if lang_col else F.lit(""))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns and values; see :func:`quality_verdicts`.

    Texts are scored once: rows and scores are written to the shared folder, since the bands are known only when all
    have been scored.
    """
    spark = docs.sparkSession
    # The row travels as one column, so that none of its names can clash.
    packed = docs.select(F.struct("*").alias("_doc"), *[F.col(f"`{c}`") for c in dict.fromkeys(c for c in (text_col, lang_col) if c)])
    scored, free = _scored(packed, text_col, lang_col, ["_doc", *([lang_col] if lang_col and lang_col != text_col else [])])
    path = scratch_path(spark, "scored")
    _with_band(scored, lang_col).write.parquet(path)
    free()
    scored = spark.read.parquet(path)
    clean = _judged(scored, perplexity_bands(scored)).where("kept")
    return clean.select(F.col("_others").getField("_doc").alias("_doc")).select("_doc.*")


@query()
def op2_quality_rules(spark, sf_dir):
    verdicts = quality_verdicts(documents(spark, sf_dir).select("doc_id", "lang", "text"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("log_perplexity", 4).alias("log_perplexity")
    )
