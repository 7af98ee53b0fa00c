"""Personal data in texts: fixed patterns, and a linear-chain CRF over word shapes.

The CRF is trained by gradient ascent on the log-likelihood of a small labelled
table (on the driver; the number of its rows is bounded by a parameter). Texts
are decoded by Viterbi in numpy batches. A token over which no stretch of other
tags can win against "outside" is outside in every best path; the chain is cut
there, and only the stretches between are decoded. That shortens the work and
changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from freightloom.llm.secret_scan import Span, map_spans

KINDS = ("email", "ip", "card", "phone", "email_like", "ip_like", "card_like", "phone_like")
TAGGED = ("email", "ip", "card", "phone")
#: Outside, then beginning and inside of each kind.
TAGS = ("O", *(f"{p}-{k}" for k in TAGGED for p in "BI"))
#: Rows of the labelled table that are read at most.
MOST_LABELLED = 2_000
#: Words whose shape a task remembers before it starts afresh.
REMEMBERED = 200_000

# --- fixed patterns --------------------------------------------------------------------
# Each is the stated pattern, in a form that takes linear time on any text.

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each @ to both sides."""
    free, at = 0, text.find("@")
    while at >= 0:
        if at >= free:
            left = text[free:at]
            own = len(left) - len(left.rstrip(LOCAL))
            domain = DOMAIN.match(text, at + 1)
            free = at + 1
            if own and domain:
                yield at - own, domain.end(), "email"
                free = domain.end()
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _card(value: str) -> bool:
    digits = NOT_DIGIT.sub("", value)
    return 14 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; a failing match is dropped and not tried again."""
    spans = list(emails(text))
    spans += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    spans += [(*m.span(), "card") for m in CARD.finditer(text) if m.end() - m.start() >= 14 and _card(m[0])]
    spans += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# --- word shapes -----------------------------------------------------------------------

#: A word, a run of digits or a sign, with the white space before it; such tokens tile the text.
TOKEN = re.compile(r"\s*(?:[^\W\d_]+|\d+|[^\w\s]|_)")
SIGNS = "+()-.@:/_#,"
#: Shapes of a token that stands after a letter or sign, a blank, or a line end.
PER_GLUE = 8 + 6 + len(SIGNS) + 1
SHAPES = 3 * PER_GLUE
#: Beyond the ends of the text.
EDGE = SHAPES
WINDOW = (-2, -1, 0, 1, 2)


def shape_of(token: str) -> int:
    """Number of the shape: what stands before, digits by length, letters by case and whether alone, or the sign."""
    word = token.lstrip()
    before = token[: len(token) - len(word)]
    glue = 0 if not before else 2 if "\n" in before else 1
    n = len(word)
    if word[0].isdecimal():
        shape = min(n, 8) - 1
    elif word[0].isalpha() or n > 1:
        case = 0 if word.islower() else 1 if word[1:].islower() or n == 1 else 2
        shape = 8 + 2 * case + (n > 1)
    else:
        shape = 14 + (SIGNS.index(word) if word in SIGNS else len(SIGNS))
    return glue * PER_GLUE + shape


class Shapes(dict):
    """Shape by token; bounded."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = self[token] = shape_of(token)
        return shape


# --- the chain -------------------------------------------------------------------------


class Chain:
    """Weights: ``emit[w, shape, tag]`` for each place of the window, ``step[tag, next tag]``."""

    def __init__(self, emit: np.ndarray, step: np.ndarray):
        self.emit, self.step = emit, step
        self.enter = step[0, 1:] - step[0, 0]
        self.stay = step[1:, 1:].max(axis=0) - step[0, 0]
        self.leave = max(0.0, float((step[1:, 0] - step[0, 0]).max()))

    def open_tokens(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Tokens that some stretch of other tags could cover without losing against "outside" throughout.

        Against that path, a stretch gains at most what its first token brings
        on entry, the others on staying, and the exit; the best stretch over
        each token follows from running sums and running maxima.
        """
        margin = (scores[:, 1:] - scores[:, :1]).astype(np.float64)
        enter = (margin + self.enter).max(axis=1)
        enter[first] = margin[first].max(axis=1)
        total = np.cumsum((margin + self.stay).max(axis=1))
        before = np.maximum.accumulate(enter - total) + total
        after = np.maximum.accumulate(total[::-1])[::-1] - total + self.leave
        return before + after >= -1e-3

    def scores(self, shapes: np.ndarray) -> np.ndarray:
        """Score of each tag for each token of one text."""
        n = len(shapes)
        padded = np.full(n + 4, EDGE, dtype=np.int64)
        padded[2 : n + 2] = shapes
        total = self.emit[0][padded[:n]]
        for w in range(1, len(WINDOW)):
            total = total + self.emit[w][padded[w : w + n]]
        return total

    def decode(self, texts_shapes: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of each text."""
        sizes = [len(s) for s in texts_shapes]
        if not sum(sizes):
            return [np.zeros(0, dtype=np.int8) for _ in sizes]
        scores = np.concatenate([self.scores(s) for s in texts_shapes])
        ends = np.cumsum(sizes)
        tags = np.zeros(len(scores), dtype=np.int8)
        first = np.zeros(len(scores), dtype=bool)
        first[np.concatenate([[0], ends[:-1]])[np.array(sizes) > 0]] = True
        open_ = self.open_tokens(scores, first)
        starts = np.flatnonzero(open_ & (first | ~np.concatenate([[False], open_[:-1]])))
        if len(starts):
            closed = np.flatnonzero(~open_ | first)
            after = np.searchsorted(closed, starts, side="right")
            stops = np.append(closed, len(scores))[after]
            heads, tails = ~first[starts], ~np.append(first, True)[stops]
            order = np.argsort(stops - starts, kind="stable")
            for group in np.array_split(order, max(1, len(order) // 512)):
                best = self._viterbi(scores, starts[group], stops[group], heads[group], tails[group])
                for row, (a, b) in zip(best, zip(starts[group], stops[group])):
                    tags[a:b] = row[: b - a]
        return np.split(tags, ends[:-1])

    def _viterbi(self, scores, starts, stops, heads, tails) -> np.ndarray:
        """Best tags of stretches; where ``heads`` or ``tails`` is set an outside token stands next to them."""
        lengths = stops - starts
        longest, n, k = int(lengths.max()), len(starts), len(TAGS)
        from_ = np.zeros((longest, n, k), dtype=np.int8)
        value = scores[starts] + heads[:, None] * self.step[0]
        final = np.array(value)
        for t in range(1, longest):
            way = value[:, :, None] + self.step
            from_[t] = way.argmax(axis=1)
            live = t < lengths
            value = np.where(live[:, None], way.max(axis=1) + scores[np.minimum(starts + t, stops - 1)], value)
            final = value
        last = (final + tails[:, None] * self.step[:, 0]).argmax(axis=1)
        best = np.zeros((n, longest), dtype=np.int8)
        tag = last
        for t in range(longest - 1, -1, -1):
            live = t < lengths
            best[live, t] = tag[live]
            tag = np.where(live, from_[t][np.arange(n), tag], tag) if t else tag
        return best


def train(sentences: list[tuple[list[int], list[int]]], rounds: int = 150, rate: float = 0.1, ridge: float = 0.02) -> Chain:
    """Weights by gradient ascent (Adam) on the penalised log-likelihood of ``(shapes, tags)``; deterministic."""
    k, n = len(TAGS), len(sentences)
    sizes = np.array([len(s) for s, _ in sentences])
    longest = int(sizes.max())
    window = np.full((n, longest + 4), EDGE)
    gold = np.zeros((n, longest), dtype=np.int64)
    for i, (shapes, tags) in enumerate(sentences):
        window[i, 2 : len(shapes) + 2] = shapes
        gold[i, : len(tags)] = tags
    live = np.arange(longest)[None, :] < sizes[:, None]
    emit, step = np.zeros((len(WINDOW), SHAPES + 1, k)), np.zeros((k, k))
    seen_emit, seen_step = np.zeros_like(emit), np.zeros_like(step)
    hot = np.eye(k)[gold] * live[:, :, None]
    pair_live = live[:, 1:]
    np.add.at(seen_step, (gold[:, :-1][pair_live], gold[:, 1:][pair_live]), 1)
    for w in range(len(WINDOW)):
        np.add.at(seen_emit[w], window[:, w : w + longest], hot)
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(step), np.zeros_like(step)]

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for r in range(1, rounds + 1):
        score = sum(emit[w][window[:, w : w + longest]] for w in range(len(WINDOW)))
        alpha, beta = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        alpha[:, 0] = score[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.where(live[:, t, None], lse(alpha[:, t - 1, :, None] + step, 1) + score[:, t], alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            beta[:, t] = np.where(live[:, t + 1, None], lse(step[None] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        total = lse(alpha[:, -1], 1)
        node = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
        edge = alpha[:, :-1, :, None] + step + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
        grad_step = seen_step - (np.exp(np.minimum(edge, 0)) * pair_live[:, :, None, None]).sum(axis=(0, 1)) - ridge * step
        grad_emit = np.array(seen_emit)
        for w in range(len(WINDOW)):
            np.subtract.at(grad_emit[w], window[:, w : w + longest], node)
        grad_emit -= ridge * emit
        for x, g, m, v in ((emit, grad_emit, *moments[:2]), (step, grad_step, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-8)
    return Chain(emit.astype(np.float32), step.astype(np.float32))


MARK = re.compile(r"\[\[(\w+)\|(.*?)\]\]")


def labelled(marked: str) -> tuple[list[int], list[int]]:
    """Shapes and tags of a sentence in which ``[[kind|value]]`` marks what is personal."""
    text, spans, end = "", [], 0
    for m in MARK.finditer(marked):
        text += marked[end : m.start()]
        spans.append((len(text), len(text) + len(m[2]), m[1]))
        text += m[2]
        end = m.end()
    text += marked[end:]
    shapes, tags = [], []
    for m in TOKEN.finditer(text):
        at = m.start() + len(m[0]) - len(m[0].lstrip())
        span = next((s for s in spans if s[0] <= at < s[1]), None)
        shapes.append(shape_of(m[0]))
        tags.append(TAGS.index(f"{'B' if at == span[0] else 'I'}-{span[2]}") if span else 0)
    return shapes, tags


def train_on(table: DataFrame, text_column: str = "marked", most: int = MOST_LABELLED) -> Chain:
    """The chain of a labelled table of marked sentences; reads ``most`` rows at most, in the order of their text."""
    rows = table.filter(f"{text_column} IS NOT NULL").select(text_column).distinct().orderBy(text_column).limit(most).collect()
    sentences = [s for s in (labelled(r[0]) for r in rows) if s[0]]
    if not sentences:
        raise ValueError("the labelled table has no sentence")
    return train(sentences)


def chain_spans(chain: Chain, texts: list[str], shapes: Shapes) -> Iterable[list[Span]]:
    """Spans that the chain finds in each text, with ``_like`` after the kind."""
    tokens = [TOKEN.findall(text) for text in texts]
    numbers = [np.fromiter(map(shapes.__getitem__, t), dtype=np.int64, count=len(t)) for t in tokens]
    for words, tags in zip(tokens, chain.decode(numbers)):
        spans: list[Span] = []
        inside = np.flatnonzero(tags)
        if len(inside):
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
            kind, last = None, -2
            for i in inside.tolist():
                name = TAGS[tags[i]]
                end = int(ends[i])
                if i == last + 1 and name == f"I-{kind}":
                    spans[-1] = (spans[-1][0], end, spans[-1][2])
                else:
                    kind = name[2:]
                    spans.append((end - len(words[i].lstrip()), end, f"{kind}_like"))
                last = i
        yield spans


def find_personal_data(docs: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, spans``: per document the spans ``(start, end, kind)`` in code points, end exclusive, by start and kind.

    Base kinds are ``email``, ``ip``, ``card`` and ``phone``. What the chain
    finds beside them, without overlap, has the kind with ``_like`` after it.
    Null counts as the empty text, which has no spans. Rows are independent:
    repeated rows repeat their result, and other columns are ignored.
    """

    shapes = Shapes()

    def of(texts: list[str]) -> Iterable[list[Span]]:
        for text, more in zip(texts, chain_spans(chain, texts, shapes)):
            base = base_spans(text)
            more = [m for m in more if all(m[1] <= b[0] or b[1] <= m[0] for b in base)]
            yield sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))

    return map_spans(docs, id_column, text_column, of)

