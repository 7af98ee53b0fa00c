"""Byte-level BPE against the tiktoken library, and the way back."""

import random

import public_tokenizers
import pytest
import tiktoken

from freightloom.llm import byte_bpe as bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def samples():
    dice = random.Random(2)
    letters = "abcdeABC  \n\t.,'s!?0123äßéñ漢字👍🏽́<|endoftext|>"
    yield from ("", " ", "\n\n  \n", "a", "I'll we've 's", "<|endoftext|>", "x" * 3000, "ab" * 2000, "!?" * 1500, " " * 4000, "é" * 2000)
    for n in (3, 10, 80, 1000):
        for _ in range(60):
            yield "".join(dice.choices(letters, k=n))
    yield "".join(dice.choices("abcdefgh", k=20_000))  # one very long pre-token


def test_ids_are_those_of_the_library(ranks, library):
    encoder = bpe.Encoder(ranks, PATTERN)
    for text in samples():
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_what_is_remembered_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.Encoder(ranks, PATTERN)
    for text in samples():
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)
        assert len(encoder) <= 50 >= len(encoder.older)


def test_round_trip_over_rows(spark, library):
    rows = [(i, t, i) for i, t in enumerate(samples())] + [(None, None, 0), (1, " ", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    both = bpe.round_trip(docs, PATH, PATTERN).collect()
    assert len(both) == len(rows)
    by_id = {i: t or "" for i, t, _ in rows}
    for r in both:
        assert r["ids"] == library.encode_ordinary(by_id[r["id"]]) and bytes(r["bytes"]).decode() == by_id[r["id"]]
    encoded = bpe.encode(docs, PATH, PATTERN)
    decoded = {r["id"]: bytes(r["bytes"]).decode() for r in bpe.decode(encoded, PATH).collect()}
    assert decoded == by_id
    assert bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0


def test_only_pairs_before_their_neighbours_wait(ranks, library):
    """Each change of the bitmap is one word set."""

    class Counted(list):
        changes = 0

        def __setitem__(self, at, value):
            self.changes += 1
            super().__setitem__(at, value)

    encoder = bpe.Encoder(ranks, PATTERN)
    dice = random.Random(4)
    merges = pairs = 0
    encoder.low = Counted(encoder.low)
    for _ in range(200):
        piece = "".join(dice.choices("abdefghilmnorstu", k=12))
        found = encoder.merge(piece.encode())
        assert found == library.encode_ordinary(piece)
        merges, pairs = merges + len(piece) - len(found), pairs + len(piece) - 1
    assert not any(encoder.low) and encoder.low.changes < 2.5 * merges < 2 * pairs
