"""Byte-level BPE: texts to token ids and back.

A pre-token is merged with a queue of merge ranks. Each rank that is waiting
has a bucket of linked-list positions; which ranks wait is kept in a bitmap of
two levels of wide words, and finding the first set bit on each level gives the
lowest rank. Only a pair that comes before both of its neighbours (lower rank,
or the left one of equals) waits, since any other is merged after one of them;
a merge lets those wait whose neighbours it has changed. An entry whose pair
has changed since is stale and skipped. A merge thus costs about the same in a pre-token of ten bytes and in one of ten
million.

Ids of pre-tokens seen before are remembered, in two generations of bounded
size, by each Python worker for as long as it lives.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from freightloom.llm.common import field_of, slices, text_of

#: Pre-tokens of a generation that a worker remembers.
REMEMBERED = 400_000
#: Longer pre-tokens are merged anew each time, to bound what is remembered.
LONGEST_REMEMBERED = 64
#: Bits of a word of the bitmap, as a power of two.
BITS = 8
MASK = (1 << BITS) - 1
ID = np.dtype("<i4")
#: Rank of a pair that is no token, above all others.
NONE = 1 << 62
BYTES = [bytes([b]) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder(dict):
    """Ids of texts by a table of ranks; the pattern splits the text, each match is merged by itself.

    The dictionary holds the ids of pre-tokens as bytes of 32-bit numbers.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, pattern
        self.bit_of = [1 << bit for bit in range(MASK + 1)] * ((max(ranks.values(), default=0) >> BITS) + 1)
        self.low = [0] * (len(self.bit_of) >> BITS)
        self.older: dict[str, bytes] = {}

    def __reduce__(self):
        return Encoder, (self.ranks, self.pattern)  # what is remembered does not travel

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            merged = self.merge(piece.encode())
            ids = pack(f"<{len(merged)}i", *merged)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the pair of lowest rank is merged, of several the leftmost.

        ``low`` has a bit for each waiting rank and ``top`` one for each word of
        ``low`` that is not zero; ``buckets`` holds the positions of each
        waiting rank as a heap. All three are empty again at the end. The queue
        is written out here, since a call for each step would double the time.
        """
        rank_of, low, bit_of = self.ranks.get, self.low, self.bit_of
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        tokens = [BYTES[b] for b in piece]
        pair = [rank_of(piece[i : i + 2], NONE) for i in range(n - 1)]  # rank of a node with the next one
        pair += (NONE, NONE)  # of the last node, and of what lies outside (-1 and n)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, list[int]] = {}
        top = 0
        waiting = [i for i in range(n - 1) if pair[i - 1] > pair[i] <= pair[i + 1]]
        while True:
            for i in waiting:
                rank = pair[i]
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    word = rank >> BITS
                    low[word] |= bit_of[rank]
                    top |= bit_of[word]
            if not top:
                break
            waiting = []
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << BITS) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j, h = after[i], before[i]
            was_right, was_left = pair[j], pair[h]
            token = tokens[i] = tokens[i] + tokens[j]
            tokens[j], pair[j] = None, NONE
            after[i] = k = after[j]
            right = left = NONE
            if k < n:
                before[k] = i
                right = rank_of(token + tokens[k], NONE)
            pair[i] = right
            if h >= 0:
                pair[h] = left = rank_of(tokens[h] + token, NONE)
                g = before[h]
                if was_left < pair[g] <= left and pair[g] < pair[before[g]]:
                    waiting.append(g)
            if right < left:
                if right <= pair[k]:
                    waiting.append(i)
            elif left < pair[before[h]]:
                waiting.append(h)
            if was_right <= pair[k] < right and pair[k] <= pair[after[k]]:
                waiting.append(k)
        return [self.ranks[token] for token in tokens if token is not None]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, in order."""
        pieces = regex.findall(self.pattern, text)
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), dtype=ID)


def lists_of_ints(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate(lists) if lists else np.array([], dtype=ID)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _map(df: DataFrame, inner: str, kind, work: Callable[[], Callable[[list], pa.Array]]) -> DataFrame:
    """The id column beside the array that ``work()``, made once a task, gives for the second column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = work()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), of(part.column(1).to_pylist())], ["id", inner])

    return df.mapInArrow(run, StructType([field_of(df, "id"), StructField(inner, kind)]))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, ids``: the token ids of each whole text, in order.

    Null counts as the empty text, which has no ids. No special tokens: their
    strings are ordinary text. Rows are independent, so repeated rows repeat
    their result; other columns are ignored. The rank table (about a
    megabyte, fixed by the vocabulary) is read on the driver and broadcast.
    """
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern))

    def work():
        return lambda texts: lists_of_ints([encoder.value.encode(text) for text in texts])

    return _map(docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text")), "ids", ArrayType(IntegerType()), work)


def decode(encoded: DataFrame, ranks_path: str, id_column: str = "id", ids_column: str = "ids") -> DataFrame:
    """``id, bytes``: the bytes that the ids stand for; null counts as no ids, an id outside the vocabulary is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def work():
        token = {rank: token for token, rank in ranks.value.items()}.__getitem__
        return lambda lists: pa.array([b"".join(map(token, ids or ())) for ids in lists], pa.binary())

    return _map(encoded.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids")), "bytes", BinaryType(), work)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, ids, bytes``: texts encoded, and the ids decoded again."""
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(ranks_path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder.value.encode
        token = {rank: token for token, rank in encoder.value.ranks.items()}.__getitem__
        for batch in batches:
            for part in slices(batch):
                lists = [encode(text) for text in part.column(1).to_pylist()]
                decoded = [b"".join(map(token, ids.tolist())) for ids in lists]
                yield pa.RecordBatch.from_arrays([part.column(0), lists_of_ints(lists), pa.array(decoded, pa.binary())], ["id", "ids", "bytes"])

    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    return source.mapInArrow(run, StructType([field_of(source, "id"), StructField("ids", ArrayType(IntegerType())), StructField("bytes", BinaryType())]))
