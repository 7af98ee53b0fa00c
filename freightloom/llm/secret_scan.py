"""Secrets in texts, with the parts of one credential linked.

Strong candidates (assignments, access identifiers, long hexadecimal runs) are
reported by themselves. Weak candidates are reported only where complementary
parts of a credential meet: an identifier, a secret and an endpoint that lie in
one scope, however far apart and however long. A scope is a block of text
between blank lines; a narrower window can be asked for. The join of the three interval lists is a sweep in order of their
starts, so a text costs time in proportion to its candidates.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from freightloom.llm.common import field_of, slices, text_of

# The patterns and least lengths of the strong kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")

# Weak candidates: what may be a part of a credential, if the other parts are near.
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9])(?:client|user|account|access|tenant|app)(?:[_-]?(?:id|name|key[_-]?id))\b[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]{4,})", re.I | re.A)
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqps?|mongodb(?:\+srv)?|s3a?|ftps?)://[^\s\"'<>]{3,}", re.I | re.A)
BLANK = re.compile(r"\n[\x20\t\r]*\n")
#: Code points between two parts of one credential at most, where ``weak_spans`` is called by itself; ``find_secrets`` has no such limit.
WINDOW = 400
#: Bits a character of a weak key must carry.
LEAST_ENTROPY = 3.5

Span = tuple[int, int, str]


def strong_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; a failing match is dropped and not tried again."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def entropy(value: str) -> float:
    """Bits a character by the value's own letter counts."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _free(taken: list[Span], found: Iterator[Span]) -> list[Span]:
    """Of the spans found, in order, those that overlap none of the sorted ``taken``."""
    free, i, reach = [], 0, -1
    for start, end, kind in found:
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            free.append((start, end, kind))
    return free


def weak_spans(text: str, strong: list[Span], window: float = WINDOW) -> list[Span]:
    """Weak parts in whose scope and window a complementary part lies.

    An identifier needs a secret, a key needs an identifier or an access
    identifier, an endpoint needs both an identifier and a secret. Strong
    spans serve as parts: access as identifier, assign and hex as secret. An
    endpoint is whole also where strong spans lie in it, as in signed URLs.
    """
    keys = _free(strong, ((*m.span(), "key") for m in KEY.finditer(text) if entropy(m[0]) >= LEAST_ENTROPY))
    names = _free(strong, ((*m.span(1), "identifier") for m in IDENTIFIER.finditer(text)))
    if not keys and not names and not strong:
        return []
    places = [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    if not keys and not names and not places:
        return []
    keys = _free(sorted(names + places), iter(keys))
    part = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
    needs = {"identifier": ("secret",), "key": ("identifier",), "endpoint": ("identifier", "secret")}
    borders = [m.start() for m in BLANK.finditer(text)]
    spans = sorted(strong + keys + names + places)

    scope, scopes = 0, []
    for start, _, _ in spans:
        while scope < len(borders) and borders[scope] < start:
            scope += 1
        scopes.append(scope)

    met: list[set[str]] = [set() for _ in spans]
    reach: dict[str, tuple[int, int]] = {}  # scope and furthest end of each sort of part so far
    for i, (start, end, kind) in enumerate(spans):
        met[i] |= {other for other, (s, last) in reach.items() if s == scopes[i] and start - last <= window}
        s, last = reach.get(part[kind], (-1, 0))
        reach[part[kind]] = (scopes[i], max(end, last) if s == scopes[i] else end)
    ahead: dict[str, tuple[int, int]] = {}  # scope and nearest start of each sort, from the end of the text
    for i in range(len(spans) - 1, -1, -1):
        start, end, kind = spans[i]
        met[i] |= {other for other, (s, first) in ahead.items() if s == scopes[i] and first - end <= window}
        ahead[part[kind]] = (scopes[i], start)
    return [s for s, parts in zip(spans, met) if s[2] in needs and parts.issuperset(needs[s[2]])]


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: float = math.inf) -> DataFrame:
    """``id, spans``: per document the spans ``(start, end, kind)`` in code points, end exclusive, by start and kind.

    Kinds are ``assign``, ``access``, ``hex`` (strong) and ``identifier``,
    ``key``, ``endpoint`` (weak, linked within their whole scope unless a
    ``window`` of code points is given). Null counts as the empty text, which
    has no spans. Rows are independent: repeated rows repeat their result, and
    other columns are ignored.
    """

    def of(text: str) -> list[Span]:
        strong = strong_spans(text)
        return sorted(strong + weak_spans(text, strong, window), key=lambda s: (s[0], KINDS.index(s[2])))

    return map_spans(docs, id_column, text_column, lambda texts: map(of, texts))


SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))


def map_spans(docs: DataFrame, id_column: str, text_column: str, of) -> DataFrame:
    """``id, spans`` with the spans that ``of`` gives for a list of texts."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [[{"start": a, "end": b, "kind": k} for a, b, k in spans] for spans in of(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["id", "spans"])

    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    return source.mapInArrow(run, StructType([field_of(source, "id"), StructField("spans", SPANS)]))
