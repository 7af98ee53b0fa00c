"""Benchmark items in training texts: BM25 with block-max WAND, then a check of what overlaps.

The items are indexed, not the texts. Every passage of every text is a query
for all items whose BM25 score reaches a share of the score that the item
gives itself, so one threshold suits short and long items. Passages overlap
by half and are twice as long as the longest piece may be, so each run of words
of that length lies whole within one, whatever other items an index holds.

A passage is first bounded for all items at once, by the block maxima of its
terms summed in numpy, first over few wide blocks of items, then over narrow
ones; only passages in whose bounds some block reaches the threshold both times
are searched, by block-max WAND with exact scores. What is retrieved
is then verified: shared shingles of five words, and, of items that have a
question and an answer, the words of each that such shingles cover.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from freightloom.llm.common import field_of, slices, text_of

WORDS = re.compile(r"[^\W_]+")
#: End of a question that something follows; a question mark within a word or address ends none.
QUESTION_END = re.compile(r"""[?؟][?!؟"')\]»”’]*\s|？""")
K1, B = 1.2, 0.75
#: Share of an item's own score at which a passage is retrieved.
THRESHOLD = 0.6
SHINGLE = 5
#: Least share of the item's shingles, and of the words of question and of answer.
SIMILARITY, PART_OVERLAP = 0.8, 0.5
#: Longer items are indexed in pieces of so many words.
LONGEST_PIECE = 128
#: Postings of a block, and bytes of the table of bounds at most.
BLOCK, BOUND_BYTES = 16, 16 << 20
#: Bytes of item texts in one index; more items are searched in several rounds.
INDEX_BYTES = 64 << 20


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def parts_of(text: str) -> int:
    """Number of words of the question if the item has a question and an answer after it, else 0: it is checked as a whole."""
    body = text.rstrip()
    ends = [m.end() for m in QUESTION_END.finditer(body)]
    return len(words_of(body[: ends[-1]])) if ends else 0


class Index:
    """Inverted index of pieces of items; impacts are shares of a piece's own score."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, frequency: dict[str, int], mean_length: float):
        """``items``: row and text; frequency and mean length are those of all items."""
        self.items = {row: (words_of(text), parts_of(text)) for row, text in items}
        self.owner: list[int] = []
        postings: dict[str, list[tuple[int, float]]] = {}
        for row, (words, _) in self.items.items():
            for start in range(0, len(words), LONGEST_PIECE):
                piece = words[start : start + LONGEST_PIECE]
                norm = K1 * (1 - B + B * len(words) / mean_length)
                impact = {}
                for word, tf in Counter(piece).items():
                    idf = math.log(1 + (n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
                    impact[word] = idf * tf * (K1 + 1) / (tf + norm)
                total = sum(impact.values())
                for word, value in impact.items():
                    postings.setdefault(word, []).append((len(self.owner), value / total))
                self.owner.append(row)
        self.stride = LONGEST_PIECE
        self.terms = {word: t for t, word in enumerate(sorted(postings))}
        self.ids = [[p for p, _ in postings[word]] for word in self.terms]
        self.impacts = [[v for _, v in postings[word]] for word in self.terms]
        self.most = [max(values) for values in self.impacts]
        self.block_last = [ids[BLOCK - 1 :: BLOCK] + ([ids[-1]] if len(ids) % BLOCK else []) for ids in self.ids]
        self.block_most = [[max(values[i : i + BLOCK]) for i in range(0, len(values), BLOCK)] for values in self.impacts]
        self.bounds, self.finer = self.block_bounds(64), self.block_bounds(len(self.owner))

    def block_bounds(self, most: int) -> np.ndarray:
        """Highest impact of each term in each of up to ``most`` blocks of pieces, as far as the bytes go."""
        groups = max(1, min(len(self.owner), BOUND_BYTES // (4 * (len(self.terms) + 1)), most))
        bounds = np.zeros((len(self.terms), groups), dtype=np.float32)
        for t, (ids, values) in enumerate(zip(self.ids, self.impacts)):
            np.maximum.at(bounds[t], np.array(ids) * groups // len(self.owner), np.array(values, dtype=np.float32))
        return bounds

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All pieces whose score reaches the threshold, by block-max WAND: ``(piece, score)``."""
        end = len(self.owner)
        ids, most, found = self.ids, self.most, []
        at = {t: 0 for t in terms}
        lists = sorted(terms, key=lambda t: ids[t][0])

        def here(t: int) -> int:
            return ids[t][at[t]] if at[t] < len(ids[t]) else end

        while lists:
            bound, pivot = 0.0, -1
            for i, t in enumerate(lists):
                bound += most[t]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            target = here(lists[pivot])
            while pivot + 1 < len(lists) and here(lists[pivot + 1]) == target:
                pivot += 1
            bound, border = 0.0, end
            for t in lists[: pivot + 1]:
                block = bisect_left(self.block_last[t], target)
                if block < len(self.block_last[t]):
                    bound += self.block_most[t][block]
                    border = min(border, self.block_last[t][block])
            if bound >= threshold:
                if here(lists[0]) == target:
                    score = sum(self.impacts[t][at[t]] for t in sorted(lists[: pivot + 1]))
                    if score >= threshold:
                        found.append((target, score))
                    for t in lists[: pivot + 1]:
                        at[t] += 1
                else:
                    for t in lists[:pivot]:
                        at[t] = bisect_left(ids[t], target, at[t])
            else:
                goal = border + 1
                if pivot + 1 < len(lists):
                    goal = min(goal, here(lists[pivot + 1]))
                goal = max(goal, target + 1) if goal <= target else goal
                for t in lists[: pivot + 1]:
                    at[t] = bisect_left(ids[t], goal, at[t])
            lists = sorted((t for t in lists if at[t] < len(ids[t])), key=here)
        return found

    def passages(self, words: list[str]) -> Iterator[list[int]]:
        """Different terms of each passage in whose bound some block of items reaches the threshold."""
        get = self.terms.get
        terms = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        place = np.flatnonzero(terms >= 0)
        if not len(place):
            return
        terms, half, size = terms[place], place // self.stride, len(self.terms)
        first = half > 0
        keys = np.unique(np.concatenate([half * size + terms, (half[first] - 1) * size + terms[first]]))
        window, terms = keys // size, keys % size
        starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        reach = np.add.reduceat(self.bounds[terms], starts, axis=0).max(axis=1) >= self.threshold - 1e-4
        ends = np.append(starts[1:], len(terms))
        for i in np.flatnonzero(reach):
            found = terms[starts[i] : ends[i]]
            if self.finer[found].sum(axis=0).max() >= self.threshold - 1e-4:
                yield found.tolist()

    threshold = THRESHOLD

    def leaks(self, text: str) -> list[tuple[int, float, float, float, float]]:
        """``(item row, score, similarity, question overlap, answer overlap)`` of the items found in a text."""
        words = words_of(text)
        best: dict[int, float] = {}
        for terms in self.passages(words):
            for piece, score in self.search(terms, self.threshold):
                best[self.owner[piece]] = max(best.get(self.owner[piece], 0.0), score)
        if not best:
            return []
        shingles = {size: set(zip(*(words[i:] for i in range(size)))) for size in {min(SHINGLE, len(self.items[row][0])) for row in best}}
        found = []
        for row, score in sorted(best.items()):
            own, cut = self.items[row]
            size = min(SHINGLE, len(own))
            shared = [tuple(own[i : i + size]) in shingles[size] for i in range(len(own) - size + 1)]
            covered = [any(shared[max(0, i - size + 1) : i + 1]) for i in range(len(own))]
            question, answer = covered[:cut] or covered, covered[cut:] or covered
            result = (sum(shared) / len(shared), sum(question) / len(question), sum(answer) / len(answer))
            if result[0] >= SIMILARITY and min(result[1:]) >= PART_OVERLAP:
                found.append((row, score, *result))
        return found


def indexes(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", index_bytes: int = INDEX_BYTES) -> Iterator[tuple[Index, list]]:
    """Indexes of bounded size over the items, each with the ids of its rows; one in the usual case.

    Null texts and texts without words are no items. Document frequency and
    mean length are counted over all items.
    """
    items = benchmark.select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).filter(F.regexp_count("text", F.lit("[\\p{L}\\p{N}]")) > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = -(-total // index_bytes)
    if rounds <= 1:
        shares = [items.collect()] if total else []
        everything = Counter(w for row in shares[0] for w in set(words_of(row["text"]))) if shares else Counter()
        lengths = [len(words_of(row["text"])) for share in shares for row in share]
    else:
        share = F.pmod(F.xxhash64("text"), F.lit(rounds))
        everything, lengths = Counter(), []
        for r in range(rounds):
            for row in items.filter(share == r).toLocalIterator():
                words = words_of(row["text"])
                lengths.append(len(words))
                everything.update(set(words))
        shares = (items.filter(share == r).collect() for r in range(rounds))
    for rows in shares:
        if rows:
            kept = [(i, row["text"]) for i, row in enumerate(rows) if words_of(row["text"])]
            if kept:
                yield Index(kept, len(lengths), everything, sum(lengths) / len(lengths)), [row["id"] for row in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item found in it: ``id, item_id, score, similarity, question_overlap, answer_overlap``.

    Clean documents have no row. Null and empty texts hold no item, an empty
    benchmark is found nowhere; repeated documents and repeated items give
    rows of their own. Other columns are ignored.
    """
    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    numbers = ("score", "similarity", "question_overlap", "answer_overlap")
    schema = StructType([field_of(source, "id"), field_of(benchmark, item_column, "item_id"), *(StructField(n, DoubleType()) for n in numbers)])
    rounds: list[DataFrame] = []
    for index, ids in indexes(benchmark, item_column, item_text):
        shared = docs.sparkSession.sparkContext.broadcast((index, ids))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, ids = shared.value
            item_ids = pa.array(ids)
            for batch in batches:
                for part in slices(batch):
                    rows = [(i, hit) for i, text in enumerate(part.column(1).to_pylist()) for hit in index.leaks(text)]
                    if rows:
                        at = pa.array([i for i, _ in rows])
                        values = [pa.array([round(hit[k], 6) for _, hit in rows], pa.float64()) for k in range(1, 5)]
                        yield pa.RecordBatch.from_arrays([part.column(0).take(at), item_ids.take(pa.array([hit[0] for _, hit in rows])), *values], ["id", "item_id", *numbers])

        rounds.append(source.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, rounds) if rounds else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no item is found, whole and where they lie."""
    at = docs.columns.index(text_column)
    for index, _ in indexes(benchmark, item_column, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    yield part.filter(pa.array([not text or not shared.value.leaks(text) for text in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
