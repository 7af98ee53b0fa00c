"""Search over the benchmark index against scoring everything, and planted items."""

import math
import random
from collections import Counter

from freightloom.llm import decontaminate as dc

DICE = random.Random(8)
VOCABULARY = [f"w{i}" for i in range(60)] + [f"rare{i}" for i in range(3000)]
ITEMS = [" ".join(DICE.choices(VOCABULARY[:60], k=12) + DICE.choices(VOCABULARY, k=10)) + "? " + " ".join(DICE.choices(VOCABULARY, k=6)) for _ in range(90)]
ITEMS += ["short one", ITEMS[3], " ".join(DICE.choices(VOCABULARY, k=300)) + ". the end"]


def index_of(items):
    words = [dc.words_of(t) for t in items]
    return dc.Index(list(enumerate(items)), len(items), Counter(w for ws in words for w in set(ws)), sum(map(len, words)) / len(words))


def brute(items, terms, threshold):
    """Score of every piece for a set of terms."""
    words = [dc.words_of(t) for t in items]
    df, mean = Counter(w for ws in words for w in set(ws)), sum(map(len, words)) / len(words)
    found, piece = {}, 0
    for ws in words:
        for start in range(0, len(ws), dc.LONGEST_PIECE):
            tf = Counter(ws[start : start + dc.LONGEST_PIECE])
            norm = dc.K1 * (1 - dc.B + dc.B * len(ws) / mean)
            gain = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * (dc.K1 + 1) / (n + norm) for w, n in tf.items()}
            score = sum(g for w, g in gain.items() if w in terms) / sum(gain.values())
            if score >= threshold:
                found[piece] = score
            piece += 1
    return found


def passage():
    words = DICE.choices(VOCABULARY, k=40)
    for _ in range(DICE.randrange(3)):
        own = dc.words_of(DICE.choice(ITEMS))
        words += DICE.sample(own, DICE.randrange(len(own) + 1))
    return words


def test_search_finds_all_above_the_threshold():
    index = index_of(ITEMS)
    for _ in range(400):
        words = set(passage())
        terms = [index.terms[w] for w in words if w in index.terms]
        for threshold in (0.3, 0.6, 0.9):
            got, want = dict(index.search(terms, threshold)), brute(ITEMS, words, threshold)
            edge = {p for p in set(got) ^ set(want) if abs((got | want)[p] - threshold) < 1e-9}
            assert set(got) - edge == set(want) - edge
            assert all(math.isclose(got[p], want[p], rel_tol=1e-9) for p in set(got) & set(want))


def test_bounds_pass_every_passage_that_holds_something():
    index = index_of(ITEMS)
    for _ in range(100):
        words = [w for _ in range(6) for w in passage()]
        passed = {frozenset(p) for p in index.passages(words)}
        for start in range(0, len(words), index.stride):
            terms = {index.terms[w] for w in words[start : start + 2 * index.stride] if w in index.terms}
            if index.search(sorted(terms), index.threshold):
                assert frozenset(terms) in passed


def test_planted_items(spark):
    filler = lambda n: " ".join(DICE.choices(VOCABULARY, k=n))
    last = len(ITEMS) - 1
    rows = [(i, f"{filler(50)} {ITEMS[i]} {filler(300)}") for i in range(40)] + [(200, f"{filler(9)} {ITEMS[last].upper()} {filler(9)}")]
    rows += [(300 + i, filler(400)) for i in range(40)] + [(400, None), (401, ""), (402, ITEMS[5].split("?")[0]), (7, rows[7][1]), (None, ITEMS[2])]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, item_id int, score string").repartition(3)
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ITEMS)] + [(998, None, "x"), (999, " ?! ", "x")], "item_id long, text string, doc_id string")
    found = Counter((r["id"], r["item_id"]) for r in dc.find_leaks(docs, bench).collect())
    want = Counter({(i, i): 1 for i in range(40)}) + Counter({(3, 91): 1, (200, last): 1, (None, 2): 1, (7, 7): 1})
    assert found == want
    left = dc.drop_leaks(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {300 + i for i in range(40)} | {400, 401, 402}
    assert dc.find_leaks(docs.limit(0), bench).count() == dc.find_leaks(docs, bench.limit(0)).count() == 0
    assert dc.drop_leaks(docs, bench.limit(0)).count() == len(rows)


def test_several_indexes_find_the_same(spark):
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    whole, parts = list(dc.indexes(bench)), list(dc.indexes(bench, index_bytes=4000))
    assert len(whole) == 1 < len(parts) and sum(len(ids) for _, ids in parts) == len(ITEMS)
    text = "x " * 30 + ITEMS[11] + " y" * 30
    found = [(ids[hit[0]], [round(v, 9) for v in hit[1:]]) for index, ids in parts for hit in index.leaks(text)]
    assert found == [(whole[0][1][hit[0]], [round(v, 9) for v in hit[1:]]) for hit in whole[0][0].leaks(text)] != []


def test_item_without_its_last_sentence():
    """Only an item with a question and an answer is checked by parts; any other leaks at 0.8 of its shingles."""
    body = " ".join(DICE.choices(VOCABULARY, k=60))
    plain, asked, address = f"{body}. rareend 17.", f"{body}? rareend 17.", f"{body} https://w1.org/a?w2=w3. rareend 17."
    assert [dc.parts_of(t) > 0 for t in (plain, asked, address, f"{body}?")] == [False, True, False, False]
    index = index_of([*ITEMS, plain, asked + " rareother", address])
    found = {hit[0]: hit[2:] for hit in index.leaks(f"w1 w2 {body} w3")}
    at = len(ITEMS)
    assert at + 1 not in found
    assert all(found[i][0] >= dc.SIMILARITY and found[i][1:] == (found[i][1],) * 2 for i in (at, at + 2))


def test_several_indexes_find_the_same_scattered_items(spark):
    """Question, filler and answer: what a passage holds must not depend on the other items of its index."""
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    whole, parts = list(dc.indexes(bench)), list(dc.indexes(bench, index_bytes=4000))
    assert len(whole) == 1 < len(parts)

    def found(indexes, text):
        return sorted((ids[hit[0]], *(round(v, 9) for v in hit[1:])) for index, ids in indexes for hit in index.leaks(text))

    hits = 0
    for i in range(90):
        words = dc.words_of(ITEMS[i])
        text = " ".join(["x"] * (i % 7) + words[:22] + ["y"] * 90 + words[17:])
        assert found(parts, text) == found(whole, text)
        hits += any(hit[0] == i for hit in found(whole, text))
    assert hits == 90


def test_no_passage_is_searched_in_vain():
    """Where the bounds have a block for each piece, only passages that hold something are searched."""
    index = index_of(ITEMS)
    assert index.finer.shape[1] == len(index.owner) > 64
    dice = random.Random(5)
    searched = 0
    for _ in range(300):
        at = dice.randrange(len(ITEMS) - 2)
        near = [w for t in ITEMS[at : at + 2] for w in dc.words_of(t)]
        for terms in index.passages(dice.sample(near, dice.randrange(len(near)))):
            searched += 1
            assert index.search(terms, index.threshold - 1e-3)
    assert searched > 20
