"""Exact and near duplicates against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from freightloom.llm import simhash as near
from freightloom.llm.exact_dedup import add_counts, drop_exact_duplicates, exact_duplicates

ROWS = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (None, "b"), (5, "b"), (9, "long " * 9000), (8, "long " * 9000), (7, "ä"), (6, "ä")]
ROWS += [(100 + i, "hot") for i in range(60)] + [(300 + i, f"single {i}") for i in range(30)]
SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("k", [1, 2, 1024])
def test_exact_groups(spark, k):
    found = exact_duplicates(frame(spark, ROWS).repartition(5), k=k).collect()
    groups = defaultdict(list)
    for i, text in ROWS:
        groups[hashlib.sha256((text or "").encode()).digest()].append(i)
    assert len(found) == len(ROWS)
    for r in found:
        ids = groups[bytes(r["digest"])]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = Counter(bytes(r["digest"]) for r in found if r["kept"])
    assert kept == Counter(dict.fromkeys(groups, 1))
    assert all(r["id"] == r["keep_id"] for r in found if r["kept"])


def test_exact_drop_keeps_columns_of_any_name(spark):
    docs = frame(spark, [(i, t, i, b"x", "z") for i, t in ROWS], "doc_id long, text string, id long, digest binary, `a.kept` string")
    left = drop_exact_duplicates(docs, k=2)
    assert left.columns == docs.columns
    got = Counter((r["text"] or "") for r in left.collect())
    assert got == Counter(dict.fromkeys({t or "" for _, t in ROWS}, 1))
    assert {r["doc_id"] for r in left.collect() if r["text"] == "hot"} == {159}


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert exact_duplicates(empty).count() == drop_exact_duplicates(empty).count() == 0
    assert near.near_duplicates(empty).count() == near.drop_near_duplicates(empty).count() == 0


def test_summaries_name_all_frequent_keys():
    dice = random.Random(1)
    for k in (1, 3, 10):
        parts = [[dice.choice("aaaabbbcdefghijklmnop").encode() for _ in range(dice.randrange(200))] for _ in range(6)]
        merged = Counter()
        for part in parts:
            counters = {}
            for i in range(0, len(part), 7):
                counters = add_counts(counters, Counter(part[i : i + 7]).items(), k)
            assert len(counters) <= k
            merged.update(counters)
        truth, n = Counter(x for p in parts for x in p), sum(map(len, parts))
        assert all(truth[x] - n / (k + 1) <= merged[x] <= truth[x] for x in truth)


def brute_fingerprint(text):
    words, word = [], ""
    for ch in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) + " ":
        if ch in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += ch
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def texts():
    dice = random.Random(3)
    vocabulary = [f"W{i}" if i % 3 else f"é{i}" for i in range(400)]
    rows = [(i, " ".join(dice.choices(vocabulary, k=dice.choice((1, 2, 3, 40, 200))))) for i in range(150)]
    for i in range(150, 400):
        words = dice.choice(rows)[1].split(" ")
        if len(words) > 20:
            words[dice.randrange(len(words))] = "changed"
        rows.append((i, dice.choice((" ", "\t", " \n")).join(words)))
    return rows + [(400, None), (401, ""), (402, "   "), (403, "\x1c"), (12, rows[12][1]), (None, rows[30][1]), (30, rows[31][1])]


def test_fingerprints():
    for _, text in texts():
        assert near.fingerprint((text or "").encode()) % (1 << 64) == brute_fingerprint(text or "")
    assert near.fingerprint(b"one two " * 100_000) % (1 << 64) == brute_fingerprint("one two " * 100_000)


def test_near_components(spark):
    rows = texts()
    prints = [brute_fingerprint(t or "") for _, t in rows]
    up = roots(set(prints), [(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[up[p]].append(i)
    want = Counter((i, p, min(least[up[p]], default=None)) for (i, _), p in zip(rows, prints))
    docs = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], "doc_id long, text string, fp int, root int, component_id string").repartition(3)
    found = near.near_duplicates(docs).collect()
    assert Counter((r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == want
    left = near.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(min(v) for v in least.values())


def test_links_are_complete(spark):
    dice = random.Random(5)
    nodes = set()
    for _ in range(20):
        base = dice.getrandbits(64)
        for _ in range(25):
            nodes.add(base ^ sum(1 << b for b in dice.sample(range(64), dice.randrange(6))))
    signed = {n: n - (1 << 64) if n >> 63 else n for n in nodes}
    for bits in range(4):
        want = {tuple(sorted((signed[a], signed[b]))) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= bits}
        found = near.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), bits)
        assert {tuple(r) for r in found.collect()} == want


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    ring = [(2000 + i, 2000 + (i + 7) % 50) for i in range(50)]
    pairs = [tuple(sorted(p)) for p in path + star + ring] + [(5, 6)]
    found = {r["node"]: r["root"] for r in near.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == roots({n for p in pairs for n in p}, pairs)
