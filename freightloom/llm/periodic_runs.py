"""Periodic runs of words: stretches that repeat a shorter stretch at least four times.

A run is a maximal stretch of words with smallest period ``q``: words ``q``
apart are equal all through it, and neither neighbouring word keeps that up.
By the runs theorem, each run has a Lyndon root: a position inside it where the
longest Lyndon word, under the order of the words or under its reverse, is one
period long. So the Lyndon arrays under both orders give at most ``2n``
candidates (position, period); a candidate whose first period does not repeat
is dismissed by one comparison, the others are extended by longest common
extensions to both sides into their run.

The Lyndon arrays come from the suffix order of the words: the longest Lyndon
word at ``i`` ends where the next suffix ranked below suffix ``i`` begins. The
suffix ranks are found by prefix doubling in numpy (the grouping of suffixes by
ever longer prefixes). This takes ``O(n log n)``; a run of a whole text (one
word repeated a million times) is found at its first candidate, the other
candidates inside it are skipped without a comparison.

Edge cases, all defined: a null or empty text has no words and no runs, its
kept text is empty. Texts of any length are worked on whole. Repeated rows and
equal texts give equal results; rows keep every column they came with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from freightloom.llm.common import slices

#: Words of a run of period q: at least max(LEAST_LENGTH, LEAST_REPEATS * q).
LEAST_LENGTH = 6
LEAST_REPEATS = 4
#: Words compared at once when a candidate is extended.
STEP = 64

RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """Rank of each suffix in lexicographic order (a proper prefix ranks below), by prefix doubling."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.full(n, -1, dtype=np.int64)
        if width < n:
            after[: n - width] = rank[width:]
        order = np.lexsort((after, rank))
        pairs_r, pairs_a = rank[order], after[order]
        new = np.empty(n, dtype=np.bool_)
        new[0] = True
        new[1:] = (pairs_r[1:] != pairs_r[:-1]) | (pairs_a[1:] != pairs_a[:-1])
        grouped = np.cumsum(new) - 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = grouped
        if grouped[-1] == n - 1:
            return rank
        width *= 2


def lyndon_array(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position: distance to the next smaller suffix rank."""
    n = len(ranks)
    ends = [n] * n
    stack: list[int] = []
    values = ranks.tolist()
    for j in range(n):
        v = values[j]
        while stack and values[stack[-1]] > v:
            ends[stack.pop()] = j
        stack.append(j)
    return np.asarray(ends, dtype=np.int64) - np.arange(n, dtype=np.int64)


def _extend_right(codes: np.ndarray, i: int, j: int) -> int:
    """Number of equal words at ``i`` and ``j`` onwards (``i < j``)."""
    n, done = len(codes), 0
    while j + done < n:
        k = min(STEP, n - j - done)
        same = codes[i + done : i + done + k] == codes[j + done : j + done + k]
        if not same.all():
            return done + int(np.argmin(same))
        done += k
        k = min(k * 2, 1 << 20)
    return done


def _extend_left(codes: np.ndarray, i: int, j: int) -> int:
    """Number of equal words ending just before ``i`` and ``j`` (``i < j``)."""
    done = 0
    while i - done > 0:
        k = min(STEP, i - done)
        same = codes[i - done - k : i - done][::-1] == codes[j - done - k : j - done][::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += k
    return done


def runs_of(codes: np.ndarray, least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` with length at least max(least_length, least_repeats * period).

    Sorted by start, then period. ``codes`` are the words as integers.
    """
    n = len(codes)
    if n < 2:
        return []
    codes = np.asarray(codes, dtype=np.int64)
    found: dict[tuple[int, int], int] = {}
    reach: dict[int, int] = {}  # period -> end of the last run found with it
    positions = np.arange(n, dtype=np.int64)
    candidates = []
    for order in (codes, -codes):
        lengths = lyndon_array(suffix_ranks(order))
        fits = positions + 2 * lengths <= n
        i, p = positions[fits], lengths[fits]
        first = codes[i] == codes[i + p]
        candidates.append(np.stack([i[first], p[first]], axis=1))
    if not candidates:
        return []
    both = np.concatenate(candidates)
    both = both[np.lexsort((both[:, 1], both[:, 0]))]
    for i, p in both.tolist():
        if i + 2 * p <= reach.get(p, -1):
            continue  # inside a run of this period already found
        right = _extend_right(codes, i, i + p)
        if right < p:
            continue
        left = _extend_left(codes, i, i + p)
        start, end = i - left, i + p + right
        reach[p] = max(reach.get(p, -1), end)
        span = (start, end)
        if span not in found or p < found[span]:
            found[span] = p
    runs = [(s, e - s, p) for (s, e), p in found.items() if e - s >= max(least_length, least_repeats * p)]
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def kept_mask(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that no run holds after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


def collapse(words: list[str], least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS) -> tuple[list[tuple[int, int, int]], str]:
    """The runs of a list of words and the words that stay, joined by one blank."""
    if not words:
        return [], ""
    codes = np.unique(np.asarray(words, dtype=object), return_inverse=True)[1].astype(np.int64)
    runs = runs_of(codes, least_length, least_repeats)
    if not runs:
        return runs, " ".join(words)
    keep = kept_mask(len(words), runs)
    return runs, " ".join(w for w, k in zip(words, keep.tolist()) if k)


def words_column(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: F.length(w) > 0)


def periodic_runs(
    docs: DataFrame,
    words: str | Column | None = None,
    least_length: int = LEAST_LENGTH,
    least_repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """Every row of ``docs`` with ``runs`` (start, length, period) and ``collapsed``, the words that stay.

    ``words`` is an array of strings per row: the name of such a column (it
    is used up, not passed on) or an expression; by default the words of
    ``text``. Input columns named ``runs``, ``collapsed`` or ``__words`` are
    replaced; any other name is kept as it is.
    """
    used = {"runs", "collapsed", "__words"} | ({words} if isinstance(words, str) else set())
    words = F.col(words) if isinstance(words, str) else words if words is not None else words_column(F.col("text"))
    base = [c for c in docs.columns if c not in used]
    source = docs.select(*[F.col("`" + c.replace("`", "``") + "`") for c in base], words.alias("__words"))
    fields = [f for f in source.schema.fields if f.name != "__words"]
    schema = StructType(fields + [StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType())])
    lengths = (least_length, least_repeats)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, kept = [], []
                for ws in part.column("__words").to_pylist():
                    runs, text = collapse(ws or [], *lengths)
                    found.append([{"start": s, "length": l, "period": p} for s, l, p in runs])
                    kept.append(text)
                keep = part.drop_columns(["__words"])
                yield pa.RecordBatch.from_arrays(
                    list(keep.columns) + [pa.array(found, type=run_type), pa.array(kept, type=pa.string())],
                    names=keep.schema.names + ["runs", "collapsed"],
                )

    return source.mapInArrow(work, schema)
