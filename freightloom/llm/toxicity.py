"""Toxicity by a chain of classifiers.

The categories are predicted one after the other by linear models over the
different words of a text and their beginnings, which inflected forms share.
Each model after the first also sees the probabilities of the categories before
it. For training these are predicted out of fold: each labelled row gets them
from models that were fitted without its fold, so a later model does not learn
to trust an earlier one more than it deserves.

The models are fitted on a sample of the labelled rows whose size is bounded by
a parameter, so the sample's word numbers fit the driver, where numpy fits the
models: on a cluster, the many short rounds would cost more in scheduling than
in arithmetic. Every text is scored, by Spark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from freightloom.llm.common import slices, staged, text_of

#: Labelled rows the models are fitted on, at most.
MOST_LABELLED = 6_000
FOLDS = 2
#: Words known to the models at most, and the share of labelled texts a word must occur in.
MOST_WORDS, LEAST_SHARE = 1 << 16, 0.001
#: Letters of the beginnings that count as features besides the whole word.
STEMS = (4, 5)
PENALTY, ROUNDS = 0.0005, 120
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """Different words of a text in lower case, and their beginnings marked by a hyphen."""
    whole = set(WORD.findall(text.lower()))
    return whole.union(*({w[:n] + "-" for w in whole if len(w) >= n} for n in STEMS))


class Rows:
    """Numbers of the words of texts, one text after the other."""

    def __init__(self, lists: list[np.ndarray]):
        self.n = len(lists)
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.words = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int32)
        self.owner = np.repeat(np.arange(self.n), self.sizes)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.words], minlength=self.n)

    def back(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.words, weights=values[self.owner], minlength=size)

    def pick(self, chosen: np.ndarray) -> Rows:
        ends = np.cumsum(self.sizes)
        return Rows([self.words[ends[i] - self.sizes[i] : ends[i]] for i in np.flatnonzero(chosen)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Linear:
    """Weights of the words, of the probabilities before, and a constant."""

    words: np.ndarray
    before: np.ndarray
    constant: float

    def predict(self, dots: np.ndarray, before: np.ndarray) -> np.ndarray:
        return sigmoid(dots + before @ self.before + self.constant)


def fit(rows: Rows, before: np.ndarray, truth: np.ndarray, size: int, penalty: float = PENALTY, rounds: int = ROUNDS) -> Linear:
    """Logistic regression by accelerated proximal gradient; the absolute weights of the words are penalised.

    Where the truth has one class only, or there is no row, the model is its constant.
    """
    n, k = rows.n, before.shape[1]
    if not n or truth.min() == truth.max():
        return Linear(np.zeros(size), np.zeros(k), 30.0 if n and truth[0] else -30.0)
    probe = np.ones(size)
    for _ in range(8):  # largest eigenvalue of the words' second moments
        probe /= np.linalg.norm(probe)
        probe = rows.back(rows.dot(probe), size) / n
    pace = 1 / (0.25 * (1.05 * np.linalg.norm(probe) + 1 + k))
    share = truth.mean()
    w, v = np.zeros(size), np.zeros(k + 1)
    v[k] = np.log(share / (1 - share))
    ahead_w, ahead_v, t = w, v, 1.0
    for _ in range(rounds):
        gap = (sigmoid(rows.dot(ahead_w) + before @ ahead_v[:k] + ahead_v[k]) - truth) / n
        new_w = ahead_w - pace * rows.back(gap, size)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - pace * penalty, 0)
        new_v = ahead_v - pace * np.append(gap @ before, gap.sum())
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_v = new_w + (t - 1) / new_t * (new_w - w), new_v + (t - 1) / new_t * (new_v - v)
        w, v, t = new_w, new_v, new_t
    return Linear(w, v[:k], float(v[k]))


@dataclass
class Chain:
    """One model per category, in order, over a common vocabulary."""

    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    models: list[Linear] = field(default_factory=list)

    def numbers(self, text: str) -> np.ndarray:
        known = self.vocabulary
        return np.array([known[w] for w in words_of(text) if w in known], dtype=np.int32)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probabilities of the categories, one row a text."""
        rows = Rows([self.numbers(text) for text in texts])
        result = np.zeros((len(texts), 0))
        for model in self.models:
            result = np.column_stack([result, model.predict(rows.dot(model.words), result)])
        return result


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            counts = Counter(w for text in part.column(0).to_pylist() for w in words_of(text))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "texts"])


def train(
    docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], id_column: str = "doc_id", text_column: str = "text",
    most: int = MOST_LABELLED, folds: int = FOLDS,
) -> Chain:
    """Fit the chain on labelled documents.

    ``labels`` has the id and a column of 0 and 1 for each category; rows with
    a null among them are left out. The sample is the ``most`` rows with the
    lowest hash of their id, so it does not depend on the order of the rows; it
    is small enough to be broadcast by this bound. A document with several
    label rows counts for each. Without labels the chain calls nothing toxic.
    """
    truths = [F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.select(F.col(id_column).alias("id"), *truths).dropna()
    sample = known.orderBy(F.xxhash64("id"), *known.columns).limit(most)
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).join(F.broadcast(sample), "id")
    rows = staged(rows, "labelled")
    least = max(2.0, LEAST_SHARE * rows.count())
    counts = rows.select("text").mapInArrow(_counted, "word string, texts long").groupBy("word").agg(F.sum("texts").alias("texts"))
    found = counts.filter(F.col("texts") >= least).orderBy(F.desc("texts"), "word").limit(MOST_WORDS).select("word").collect()
    chain = Chain(tuple(categories), {r["word"]: i for i, r in enumerate(found)})

    # at most ``most`` rows of word numbers; ordered, so that sums do not depend on how the rows were dealt
    drawn = rows.select("id", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(folds)).alias("fold"), *[f"y{i}" for i in range(len(categories))], "text")
    columns = drawn.columns[1:-1]
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lists = pa.array([np.sort(shared.value.numbers(t)) for t in part.column(part.num_columns - 1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:-1], lists], [*columns, "words"])

    got = drawn.mapInArrow(numbered, "fold long, " + ", ".join(f"{c} int" for c in columns[1:]) + ", words array<int>").orderBy("words", *columns).toArrow()
    samples = Rows([np.asarray(x.values, dtype=np.int32) for x in got["words"]])
    fold, size = got["fold"].to_numpy(), len(chain.vocabulary)
    before = np.zeros((samples.n, 0))
    for i in range(len(categories)):
        truth = got[f"y{i}"].to_numpy().astype(float)
        chain.models.append(fit(samples, before, truth, size))
        if i + 1 < len(categories):
            unseen = np.zeros(samples.n)
            for f in range(folds):
                out = fold == f
                model = fit(samples.pick(~out), before[~out], truth[~out], size)
                unseen[out] = model.predict(samples.pick(out).dot(model.words), before[out])
            before = np.column_stack([before, unseen])
    return chain


def judge(docs: DataFrame, chain: Chain, category: str = "toxic", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its columns, ``p_<category>`` for all categories, and ``toxic``.

    Null and empty texts have no words and are judged by the models' constants.
    Rows are independent; repeated rows repeat their result. Names that clash
    with those of the new columns are the caller's to resolve.
    """
    at, mark = docs.columns.index(text_column), chain.categories.index(category)
    added = [*(StructField(f"p_{c}", DoubleType()) for c in chain.categories), StructField("toxic", BooleanType())]
    schema = StructType([*docs.schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                scores = shared.value.score([t or "" for t in part.column(at).to_pylist()])
                values = [pa.array(scores[:, i]) for i in range(scores.shape[1])]
                yield pa.RecordBatch.from_arrays([*part.columns, *values, pa.array(scores[:, mark] >= threshold)], schema.names)

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, chain: Chain, category: str = "toxic", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the chain does not call toxic, whole and where they lie."""
    at, mark = docs.columns.index(text_column), chain.categories.index(category)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                scores = shared.value.score([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(scores[:, mark] < threshold))

    return docs.mapInArrow(run, docs.schema)
