"""Phrase collocations: phrases of a few words that occur together far more often than their parts would say.

Per language, ``n`` counts all word occurrences and ``f(p)`` the contiguous
occurrences of a phrase within pieces (a text is cut into pieces at
punctuation and line ends). A candidate has 2 to ``longest`` words and
``a = f >= least``. Each cut after the first ``k`` words gives ``l`` (count
of the first part), ``r`` (count of the rest) and the score
``floor(1000 * a * n / (l * r))``; the weakest cut counts, ties to the
smallest ``k``. A candidate lying inside a longer candidate with as many
occurrences is dropped: the longer one says the same.

How it runs, and how it departs from a best-first growth:

* Phrases grow a word a level, each level from the frequent phrases of the
  level below (a phrase is formed at a position only where its first and its
  last ``m - 1`` words are frequent), counted over all positions and
  combined before the shuffle. See :func:`phrase_counts`.
* The admissible bound of every phrase grown from a prefix ``P`` is
  ``1000 * n / f(P)`` (cut after ``P``, ``r >= a``), tightest for the first
  word. A best-first growth by that bound would stop once the 2,000th score
  is settled, but scoring and dropping need the counts of the later parts
  and of the neighbours of each candidate, which start with other words; so
  all frequent phrases are grown level by level instead, and the first
  ``top`` of each language are kept by a window whose limit Spark applies in
  each task before the shuffle.
* Arithmetic is exact: products are 38-digit decimals, the quotient is an
  integral division.

Edge cases: null texts are empty, null languages are ``und``; a language
without candidates has no rows; ties in score and count are ordered by the
phrase in UTF-8 byte order, so ranks are total. Repeated rows count as often
as they occur.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightloom.llm.common import slices, staged, text_of

# Fixed values of the contract.
#: Characters that end a piece.
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
#: Characters between words.
WORD_GAPS = r"[\x20\x09]+"
ID = np.dtype("<i4")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_COUNT = 100
LONGEST = 5
TOP = 2000

EXACT = "decimal(38,0)"


def _lang(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("und"))


def pieces(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``lang`` and ``words`` of every piece of every text."""
    text = F.translate(text_of(text_column), UPPER, LOWER)
    parts = docs.select(_lang(lang_column).alias("lang"), F.explode(F.split(text, PIECE_ENDS)).alias("piece"))
    return parts.select("lang", F.filter(F.split("piece", WORD_GAPS), lambda w: w != "").alias("words")).where(F.size("words") > 0)


#: Bytes of a text as words see them: A-Z lower-cased, and a full stop for whatever ends a piece.
AS_READ = bytes.maketrans(UPPER.encode() + b",;:!?\n\v\f\r", LOWER.encode() + b"." * 9)
#: Different words, and codes of phrases, that a task counts before it passes their counts on.
WORDS_HELD, CODES_HELD = 400_000, 2_000_000
#: Frequent words, and frequent phrases of a level, up to which they are numbered and broadcast.
MOST_WORDS, MOST_PHRASES = 1_000_000, 4_000_000


def _words(text: bytes) -> list[bytes]:
    """The words of a text; a full stop, which is in no word, after each piece."""
    return (text.translate(AS_READ) + b".").replace(b".", b" . ").split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of every word; the row of a language without phrase counts all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: defaultdict[str, Counter] = defaultdict(Counter)

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, found in seen.items():
                found.pop(b".", None)
                words, f = pa.array([*found, None], pa.binary()), pa.array([*found.values(), sum(found.values())], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), words, f], ["lang", "phrase", "f"])
            seen.clear()

        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    seen[lang].update(_words(text))
                if sum(map(len, seen.values())) >= WORDS_HELD:
                    yield from passed_on()
        yield from passed_on()

    found = docs.mapInArrow(run, "lang string, phrase binary, f long")
    return found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f"))


def numbered(docs: DataFrame, numbers: Broadcast) -> DataFrame:
    """``ids``: the numbers of the words of some texts, 32 bits each, one -1 for whatever ends a phrase (no frequent word, end of a piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = numbers.value
        for batch in batches:
            for part in slices(batch):
                found = []
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = _words(text)
                    found.append(np.fromiter(map(of.get(lang, {}).get, words, repeat(-1)), dtype=ID, count=len(words)))
                ids = np.concatenate(found)
                kept = ids >= 0
                kept[1:] |= kept[:-1].copy()
                yield pa.RecordBatch.from_arrays([pa.array([ids[kept].tobytes()], pa.binary())], ["ids"])

    return docs.mapInArrow(run, "ids binary")


def _codes(ids: np.ndarray, known: list[np.ndarray], n: int) -> np.ndarray:
    """Codes of the phrases, a word longer than the last ``known`` ones, whose first and last words are frequent phrases, by position.

    The code of a phrase is the number of the phrase without its last word,
    times ``n``, plus the number of that word. Phrases of a level are
    numbered by the order of their codes, which ``known`` has for the levels
    from 2 up; the number of a single word is its id.
    """
    at = ids  # number of the frequent phrase that starts here, or -1
    for size, level in enumerate([*known, None], 2):
        codes = np.where((at[:-1] >= 0) & (at[1:] >= 0), at[:-1] * n + ids[size - 1 :], -1)
        if level is None or not len(level):
            return codes[codes >= 0]
        place = np.flatnonzero(codes >= 0)
        wanted = codes[place]
        number = np.minimum(np.searchsorted(level, wanted), len(level) - 1)
        at = np.full(len(codes), -1)
        at[place] = np.where(level[number] == wanted, number, -1)
    raise AssertionError


def code_counts(ids: DataFrame, known: Broadcast, n: int) -> DataFrame:
    """``code, f`` of every phrase of the next level at positions where its parts are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def passed_on() -> pa.RecordBatch:
            code, f = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(f, pa.int64())], ["code", "f"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = np.frombuffer(text, dtype=ID).astype(np.int64)
                if len(words) > len(known.value) + 1:
                    held.append(_codes(words, known.value, n))
                if sum(map(len, held)) >= CODES_HELD:
                    yield passed_on()
        if held:
            yield passed_on()

    return ids.mapInArrow(run, "code long, f long").groupBy("code").agg(F.sum("f").alias("f"))


def spelled(counted: DataFrame, words: Broadcast, known: Broadcast) -> DataFrame:
    """``lang, phrase, f, code`` of counted codes, the phrase spelled out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, names = words.value
        for batch in batches:
            code = number = batch.column(0).to_numpy()
            parts = []
            for level in [*reversed(known.value), None]:
                parts.append((number % len(names)).tolist())
                number = number // len(names) if level is None else level[number // len(names)]
            parts.append(number.tolist())
            phrases = [b" ".join(map(names.__getitem__, ids)) for ids in zip(*reversed(parts))]
            lang = pa.array([langs[i] for i in parts[-1]], pa.string())
            yield pa.RecordBatch.from_arrays([lang, pa.array(phrases, pa.binary()), batch.column(1), pa.array(code)], ["lang", "phrase", "f", "code"])

    found = counted.mapInArrow(run, "lang string, phrase binary, f long, code long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def _phrase(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


#: Frequent phrases of a level up to which their set is broadcast to prune positions before the shuffle.
BROADCAST_PHRASES = 1_000_000


def _known(rows: DataFrame, frequent: DataFrame, column: str, small: bool) -> DataFrame:
    """Rows whose ``column`` is a frequent phrase of the level below."""
    right = frequent.select("lang", F.col("phrase").alias(column))
    return rows.join(F.broadcast(right) if small else right, ["lang", column], "left_semi")


def _longer(positions: DataFrame, level: DataFrame, m: int, small: bool) -> DataFrame:
    """``lang, phrase, f`` of the phrases of ``m`` words, from texts and frequent phrases joined by their spelling."""
    grams = positions.where(F.size("next") >= m).select(
        "lang",
        _phrase(F.col("next"), F.lit(0), F.lit(m - 1)).alias("head"),
        _phrase(F.col("next"), F.lit(1), F.lit(m - 1)).alias("tail"),
        _phrase(F.col("next"), F.lit(0), F.lit(m)).alias("phrase"),
    )
    grams = _known(_known(grams, level, "head", small), level, "tail", small)
    return grams.groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("f"))


def phrase_counts(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST_COUNT, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """Word totals per language, and every phrase of 1 to ``longest`` words with at least ``least`` occurrences.

    The first table has ``lang, n``; the second ``lang, phrase, size, f``.
    Phrases grow a word a level: a phrase of ``m`` words is formed at a
    position only where its first and its last ``m - 1`` words are frequent
    phrases of the level below, since a phrase is never more frequent than
    its parts. Each level is counted (combined before the shuffle) and
    written to the shared folder. The texts are read twice: for the words,
    and to write them out as numbers of frequent words. A longer phrase is
    then a code of 64 bits, its counts are sums by code, and only frequent
    codes are spelled out. More than ``MOST_WORDS`` frequent words or
    ``MOST_PHRASES`` frequent phrases of a level (counted) are not numbered:
    from there on texts and frequent phrases are joined by their spelling.
    Both give the same counts.
    """
    spark = docs.sparkSession
    texts = docs.select(_lang(lang_column).alias("lang"), text_of(text_column).cast("binary").alias("text"))
    every = staged(word_counts(texts).where(F.col("phrase").isNull() | (F.col("f") >= least)), "words")
    totals = every.where(F.col("phrase").isNull() & (F.col("f") > 0)).select("lang", F.col("f").alias("n"))
    level = every.where(F.col("phrase").isNotNull())
    levels = [level.withColumn("size", F.lit(1))]
    n, known, positions, pruned = level.count(), [], None, False
    by_number = n <= MOST_WORDS
    if by_number and n:
        found = level.select("lang", F.col("phrase").cast("binary").alias("phrase")).toArrow().sort_by([("lang", "ascending"), ("phrase", "ascending")])
        langs, names = found.column(0).to_pylist(), found.column(1).to_pylist()
        numbers: defaultdict[str, dict[bytes, int]] = defaultdict(dict)
        for i, (lang, name) in enumerate(zip(langs, names)):
            numbers[lang][name] = i
        words = spark.sparkContext.broadcast((langs, names))
        ids = staged(numbered(texts, spark.sparkContext.broadcast(dict(numbers))), "ids")
    for m in range(2, longest + 1):
        count = level.count()
        if not count:
            break
        by_number = by_number and count <= (MOST_PHRASES if m > 2 else MOST_WORDS)
        if by_number:
            if m > 2:
                known = [*known, np.sort(level.select("code").toArrow().column(0).to_numpy())]
            shared = spark.sparkContext.broadcast(known)
            counted = spelled(code_counts(ids, shared, n).where(F.col("f") >= least), words, shared)
        else:
            small = count <= BROADCAST_PHRASES
            if positions is None:
                positions = pieces(docs, text_column, lang_column).select("lang", F.posexplode("words").alias("i", "word"), "words")
                positions = positions.select("lang", F.slice("words", F.col("i") + 1, longest).alias("next"))
            if m > 2 and not pruned:  # longer phrases start with a frequent phrase: keep those positions only
                starts = positions.where(F.size("next") >= m).select("lang", "next", _phrase(F.col("next"), F.lit(0), F.lit(m - 1)).alias("head"))
                positions, pruned = staged(_known(starts, level, "head", small).select("lang", "next"), "positions"), True
            counted = _longer(positions, level, m, small).where(F.col("f") >= least)
        level = staged(counted, f"phrases-{m}")
        levels.append(level.withColumn("size", F.lit(m)))
    counts = levels[0].select("lang", "phrase", "size", "f")
    for more in levels[1:]:
        counts = counts.unionByName(more.select("lang", "phrase", "size", "f"))
    return totals, counts


def scored(totals: DataFrame, counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Every candidate that is not dropped, with the weakest cut: ``lang, phrase, a, l, r, n, score``."""
    cands = counts.where(F.col("size") >= 2).select("lang", "phrase", "size", F.col("f").alias("a"))
    parts = F.split("phrase", " ")
    cuts = cands.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), parts.alias("w")).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    valued = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    score = F.expr(f"(cast(a as {EXACT}) * cast(n as {EXACT}) * 1000) div (cast(l as {EXACT}) * cast(r as {EXACT}))").cast("long")
    weakest = valued.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    longer = counts.where(F.col("size") >= 3).select("lang", F.split("phrase", " ").alias("w"), F.col("f").alias("g"))
    inner = longer.select(
        "lang", "g", F.explode(F.array(F.array_join(F.slice("w", 2, F.size("w")), " "), F.array_join(F.slice("w", 1, F.size("w") - 1), " "))).alias("phrase")
    )
    said = inner.groupBy("lang", "phrase").agg(F.max("g").alias("g"))
    kept = weakest.join(said, ["lang", "phrase"], "left").where(F.col("g").isNull() | (F.col("g") < F.col("a")))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
) -> DataFrame:
    """The first ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    totals, counts = phrase_counts(docs, text_column, lang_column, least, longest)
    found = scored(totals, counts, longest)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")],
    )
