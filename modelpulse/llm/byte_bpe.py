"""Byte-level BPE encoding and decoding with two tiers.

A pre-token that is in the vocabulary is resolved whole by a minimal perfect hash over the vocabulary;
any other one is merged from its bytes with a heap over a linked list, O(n log n) for any length. A
bounded memory of resolved pre-tokens per task keeps the common ones from being resolved again.
The tables are as large as the vocabulary file, which bounds the broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from modelpulse.llm.registry import query
from modelpulse.llm.text import bounded_batches, documents

# Pre-tokens that a task remembers, and the length up to which it does so.
REMEMBERED = 500_000
REMEMBERED_CHARS = 48


class PerfectHash:
    """A minimal perfect hash of byte strings: hash, displace, and compare with the key kept in the slot.

    Keys are dealt into buckets; each bucket gets the smallest displacement under which all its keys
    fall into free slots, the largest buckets first.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, len(keys) // 3)
        self.keys: list[bytes | None] = [None] * n
        self.shift = [0] * self.buckets
        dealt: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            dealt[h % self.buckets].append((h >> 16, key))
        open_slots: list[int] = []
        for bucket in sorted(range(self.buckets), key=lambda b: -len(dealt[b])):
            members = dealt[bucket]
            if not members:
                break
            if len(members) == 1:
                # The last buckets have one key each: any free slot will do, named directly.
                if not open_slots:
                    open_slots = [i for i in range(n) if self.keys[i] is None]
                slot = open_slots.pop()
                self.shift[bucket] = -slot - 1
                self.keys[slot] = members[0][1]
                continue
            d = 0
            while True:
                slots = [(h * (2 * d + 1) >> 20) % n for h, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
                if d > 1000 * n:
                    raise ValueError("no perfect hash: keys repeat")
            self.shift[bucket] = d
            for s, (_, key) in zip(slots, members):
                self.keys[s] = key

    def slot(self, key: bytes) -> int:
        """The key's own slot, or -1 for a string that is no key."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -d - 1 if d < 0 else ((h >> 16) * (2 * d + 1) >> 20) % self.n
        return s if self.keys[s] == key else -1


class Vocabulary:
    """Ranks of byte strings: the rank is the id, and of two merges the lower rank goes first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = ranks
        self.table = PerfectHash(list(ranks))
        self.ids = [ranks.get(key, -1) for key in self.table.keys]
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}, pattern)

    def rank(self, piece: bytes) -> int | None:
        s = self.table.slot(piece)
        return None if s < 0 else self.ids[s]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a string that is no token itself."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it has been merged away
        before = list(range(-1, n))
        # Two neighbours that may become one, as rank, start and end in one number.
        heap = [
            rank << 64 | i << 32 | i + 2 for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            offer = heapq.heappop(heap)
            left, stop = offer >> 32 & 0xFFFFFFFF, offer & 0xFFFFFFFF
            right = end[left]
            # Offers of parts that have changed since are stale.
            if not right or right >= stop or end[right] != stop:
                continue
            end[left], end[right], before[stop] = stop, 0, left
            if stop < n and (rank := ranks.get(piece[left : end[stop]])) is not None:
                heapq.heappush(heap, rank << 64 | left << 32 | end[stop])
            if left and (rank := ranks.get(piece[before[left] : stop])) is not None:
                heapq.heappush(heap, rank << 64 | before[left] << 32 | stop)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.rank(piece)
        return (whole,) if whole is not None else tuple(self.merge(piece))


class _Memory(dict):
    """Ids of pre-tokens, resolved when first asked for; emptied when full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.vocabulary.encode_piece(word.encode())
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Coder:
    """Encodes and decodes texts by a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.split = regex.compile(vocabulary.pattern).findall
        self.memory = _Memory(vocabulary)
        self.tokens = vocabulary.tokens

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per row: its id, ``n_tokens``, and ``ids`` with the ``decoded`` bytes, or the digests of both.

    A null text is an empty one without tokens; rows with null or repeated ids are encoded each on
    their own. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shipped.value)
        decimal = {i: str(i) for i in coder.tokens}
        for batch in batches:
            counts, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text or "")
                decoded = coder.decode(ids)
                counts.append(len(ids))
                if digests:
                    first.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    second.append(hashlib.sha256(decoded).hexdigest())
                else:
                    first.append(ids)
                    second.append(decoded)
            kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])],
                names=[id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))],
            )

    return docs.select(id_col, text_col).mapInArrow(work, schema)


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> Vocabulary:
    """The vocabulary of an installed public tokenizer."""
    import public_tokenizers

    return Vocabulary.from_file(public_tokenizers.path(name), public_tokenizers.PATTERN)


@query()
def op4_byte_bpe(spark, sf_dir):
    return encode_texts(documents(spark, sf_dir), public_vocabulary(), digests=True)
