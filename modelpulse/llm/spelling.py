"""Spelling variants: words that differ by one code point, found in a dictionary of pairs of trie nodes.

Every prefix of a word is a node of the trie of all words, every suffix one of the trie of the reversed words. Nodes
are numbered from the sorted words: a word adds a node for each prefix longer than what it shares with the word before
it. A range-sorted partition is numbered on its own; what its first words share with the partition before is known
from one row per partition, so no prefix is ever shuffled and a common one is no hot key.

A word is then a pair of integers (prefix node, suffix node) at each of its places; leaving out a code point gives a
pair across the skipped place. Words that meet in a pair are neighbours:

* both skipped: the same word but for the code point replaced there,
* one skipped, the other whole: the one has a code point more.

A pair of a whole word belongs to that word alone, and words that skip a place between the same nodes differ in one
letter, so a pair holds at most as many rows as there are letters. Of equal letters in a row only the last is taken
out, so no neighbour is met twice and they can be counted where they meet; no pairs of words are made.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import bounded_batches, documents
from modelpulse.session import pin

MIN_CHARS = 7
MIN_COUNT = 2
# How much commoner the right form is.
FACTOR = 10
# One occurrence in so many loses a letter.
DAMAGED = 31
# Words that a counting task holds before it passes them on.
HELD = 400_000
# Nodes of a partition are numbered from the partition's number shifted by so many bits.
NODE_BITS = 40

# Lower-cased runs of letters as UTF-8; U+00C0 to U+00FF are 0xC3 and a byte.
_ASCII = re.compile(rb"[a-z]+")
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def damaged_words(text: str | None, key: str, min_chars: int, one_in: int) -> list[bytes]:
    """The runs of letters of a text in lower case (A to Z only), of at least ``min_chars`` code points.

    Where ``one_in`` divides the crc32 of ``key:run``, the code point at the crc32 modulo the length is left out.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    plain = data.isascii()
    start, found = zlib.crc32(f"{key}:".encode()), []
    for word in (_ASCII if plain else _LETTERS).findall(data):
        if len(word) < min_chars:
            continue
        h = zlib.crc32(word, start)
        if h % one_in == 0:
            points = word.decode()
            at = h % len(points)
            word = (points[:at] + points[at + 1 :]).encode()
        if len(word) >= min_chars and (plain or len(word.decode()) >= min_chars):
            found.append(word)
    return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, one_in: int = DAMAGED) -> DataFrame:
    """``word``, ``n``: how often each word occurs in all texts, for words with ``min_count`` occurrences.

    Counted in the tasks before anything moves, so a very frequent word travels once per task.
    """
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush():
            words = list(held)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in part], pa.string()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in damaged_words(text, "" if key is None else key, min_chars, one_in):
                    held[word] = held.get(word, 0) + 1
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equal, a[:high] not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


class Numbering:
    """Numbers for the nodes of the trie of words that come in order."""

    def __init__(self, first: int = 1):
        self.following = first
        self.before = ""
        self.nodes: list[int] = []  # of all prefixes of the last word, the shortest first

    def add(self, word: str) -> list[int]:
        del self.nodes[_shared(self.before, word) :]
        new = len(word) - len(self.nodes)
        self.nodes.extend(range(self.following, self.following + new))
        self.following += new
        self.before = word
        return self.nodes


def in_order(rows: DataFrame, key: str) -> DataFrame:
    """The rows range-partitioned and sorted by ``key``, kept so, with ``part`` and ``row``, their number in this order."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, key).sortWithinPartitions(key)
    return pin(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))


def trie_nodes(ranged: DataFrame, key: str, keep: str, out: str) -> DataFrame:
    """``keep``, ``out`` and ``alike`` of the rows of :func:`in_order`.

    ``out`` are the numbers of the trie nodes of all prefixes of the key from the root, which is 0; ``alike`` says of every
    code point whether the following one is the same.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, first, part = Numbering(), None, None
        for batch in batches:
            for word in batch.column(0).to_pylist():
                if first is None:
                    first, part = word, batch.column(1)[0].as_py()
                numbers.add(word)
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first]), pa.array([numbers.before]), pa.array([numbers.nodes], pa.list_(pa.int64()))],
                names=["part", "first", "last", "nodes"],
            )

    # One row per partition: its first and last word and the numbers of the last one's nodes, counted from 1.
    edges = ranged.select(key, "part").mapInArrow(ends, "part int, first string, last string, nodes array<bigint>").orderBy("part").collect()
    inherited: dict[int, list[int]] = {}
    carried: list[int] = []
    before = ""
    for e in edges:
        mine = inherited[e["part"]] = carried[: _shared(before, e["first"])]
        # A node that the first word made, where that word goes on from the partition before, is the node there.
        carried = [mine[i] if i < len(mine) and n == i + 1 else n + (e["part"] << NODE_BITS) for i, n in enumerate(e["nodes"])]
        before = e["last"]
    sent = ranged.sparkSession.sparkContext.broadcast(inherited)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if numbers is None:
                part = batch.column(1)[0].as_py()
                base, mine = part << NODE_BITS, sent.value.get(part, [])
                numbers = Numbering(base + 1)
            found, alike = [], []
            for word in batch.column(0).to_pylist():
                nodes = [0, *numbers.add(word)]
                for i, n in enumerate(mine, 1):
                    if i == len(nodes) or nodes[i] != base + i:
                        break
                    nodes[i] = n
                found.append(nodes)
                alike.append([x == y for x, y in zip(word, word[1:])] + [False] * bool(word))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.int64())), pa.array(alike, pa.list_(pa.bool_()))], names=[keep, out, "alike"])

    return ranged.select(key, "part", keep).mapInArrow(number, f"{keep} bigint, {out} array<bigint>, alike array<boolean>")


def node_pairs(words: DataFrame) -> DataFrame:
    """``p``, ``s`` (prefix and suffix node), ``id``, ``n`` and ``skip``: 0 for a whole word, 1 for a word across a skipped code point,
    2 if that may also be taken out (it is the last of its kind in a row).

    ``words`` has ``id``, ``n``, ``heads`` and ``tails`` (nodes of all prefixes and suffixes) and ``alike`` (whether the following
    code point is the same).
    """
    size = F.size("heads") - 1
    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(F.element_at("heads", i + 1).alias("p"), F.element_at("tails", size - i + 1).alias("s"), F.lit(0).cast("tinyint").alias("skip")),
    )
    skipped = F.transform(
        F.filter(F.sequence(F.lit(0), size), lambda i: i < size),
        lambda i: F.struct(
            F.element_at("heads", i + 1).alias("p"),
            F.element_at("tails", size - i).alias("s"),
            F.when(F.element_at("alike", i + 1), 1).otherwise(2).cast("tinyint").alias("skip"),
        ),
    )
    return words.select("id", "n", F.inline(F.concat(whole, skipped)))


def near_words(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near``, ``near`` (``n``, ``-id`` of the commonest neighbour, of equal ones the first in order), for words that have one."""
    met = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("n", (-F.col("id")).alias("down"), "skip")).alias("m"))
    # At most a row per letter and one for the whole word.
    met = met.where(F.size("m") > 1).select(F.reverse(F.array_sort("m")).alias("m"))
    # The two commonest that skip, the commonest that may take out, and the whole word; each twice, as a member is not its own neighbour.
    met = met.select(
        "m",
        F.size(F.filter("m", lambda x: x["skip"] > 0)).alias("skips"),
        F.size(F.filter("m", lambda x: x["skip"] == 2)).alias("outs"),
        F.slice(F.filter("m", lambda x: x["skip"] > 0), 1, 2).alias("best"),
        F.get(F.filter("m", lambda x: x["skip"] == 2), F.lit(0)).alias("out"),
        F.get(F.filter("m", lambda x: x["skip"] == 0), F.lit(0)).alias("word"),
    )
    member = met.select(F.explode("m").alias("x"), "skips", "outs", "best", "out", "word")
    own, first, second = F.col("x.down"), F.get("best", F.lit(0)), F.get("best", F.lit(1))
    pick = lambda s: F.when(s.isNotNull(), F.struct(s["n"].alias("n"), s["down"].alias("down")))
    other = F.when(first["down"] != own, pick(first)).otherwise(pick(second))
    longer = F.when(F.col("x.skip") == 0, pick(F.col("out")))
    shorter = F.when(F.col("x.skip") == 2, pick(F.col("word")))
    count = (
        F.when(F.col("x.skip") == 0, F.col("outs"))
        .when(F.col("x.skip") == 2, F.col("skips") - 1 + F.col("word").isNotNull().cast("int"))
        .otherwise(F.col("skips") - 1)
    )
    near = F.greatest(F.when(F.col("x.skip") > 0, other), longer, shorter)
    each = member.select((-own).alias("id"), count.cast("bigint").alias("count"), near.alias("near")).where("count > 0")
    # Sums and maxima of numbers are combined before they move.
    return each.groupBy("id").agg(F.sum("count").alias("n_near"), F.max("near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``id``, ``root``: the last form that the forms of a word lead to. ``forms`` has ``id`` and ``form``.

    A form is commoner than its word, so there are no circles. Each round doubles the steps made, so rounds are the
    logarithm of the longest way, which is itself at most the logarithm of the counts.
    """
    steps = pin(forms.select("id", F.col("form").alias("root")))
    while True:
        onwards = steps.select(F.col("id").alias("root"), F.col("root").alias("_on"))
        moved = pin(steps.join(onwards, "root", "left").select("id", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("_moved")))
        steps = moved.select("id", "root")
        if moved.where("_moved").isEmpty():
            return steps


def spelling_groups(counts: DataFrame, factor: int = FACTOR) -> DataFrame:
    """One row per word of ``counts`` (``word``, ``n``; words are distinct): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its commonest near word (of
    equally common ones the first in the order of code points) if that is at least ``factor`` times as common, its root
    the end of the forms' chain, or itself.
    """
    order = in_order(counts.select("word", "n"), "word").withColumnRenamed("row", "id")
    heads = trie_nodes(order, "word", "id", "heads")
    backwards = in_order(order.select(F.reverse("word").alias("key"), "id"), "key")
    tails = trie_nodes(backwards, "key", "id", "tails").select("id", "tails")
    words = order.select("id", "n").join(heads, "id").join(tails, "id")
    near = near_words(node_pairs(words))
    found = pin(order.select("id", "word", "n").join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "near"))
    right = F.col("near.n") >= factor * F.col("n")
    forms = pin(found.where(right).select("id", (-F.col("near.down")).alias("form"), F.col("near.n").alias("form_n")))
    ends = forms.join(roots(forms), "id")
    name = lambda c: found.select(F.col("id").alias(c), F.col("word").alias(f"_{c}"))
    named = ends.join(name("form"), "form").join(name("root"), "root").select("id", "_form", "_root", "form_n")
    out = found.join(named, "id", "left")
    return out.select("word", F.col("_form").alias("form"), F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, factor: int = FACTOR, one_in: int = DAMAGED) -> DataFrame:
    """The spelling groups of the words of all texts: see :func:`word_counts` and :func:`spelling_groups`.

    A null text has no words. A null id is written as nothing where it takes part in the crc32. Rows that repeat count
    as often as they occur. Other columns are not read. Without words the result is empty.
    """
    return spelling_groups(word_counts(docs, id_col, text_col, min_chars, min_count, one_in), factor)


@query()
def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir).select("doc_id", "text"))
