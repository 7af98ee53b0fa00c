"""WARC round trip and periodic runs: the registered queries against plain forms of their contracts."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freightloom.llm.periodic_runs import collapse, runs_of


def brute_runs(c, least_length=6, least_repeats=4):
    """Every maximal stretch with its smallest period, by trying all periods."""
    n, spans = len(c), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if c[i] == c[i + q]:
                j = i
                while j + q < n and c[j] == c[j + q]:
                    j += 1
                s, e = i, j + q
                if e - s >= 2 * q and ((s, e) not in spans or q < spans[(s, e)]):
                    spans[(s, e)] = q
                i = j
            else:
                i += 1
    runs = [(s, e - s, q) for (s, e), q in spans.items() if e - s >= max(least_length, least_repeats * q)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(0, 59), st.integers(1, 6))
def test_runs_equal_brute_force(codes, a, p):
    if codes and a < len(codes):
        codes = codes[:a] + [codes[a + (i - a) % p] for i in range(a, len(codes))]
    assert runs_of(np.array(codes, dtype=np.int64)) == brute_runs(codes)


def test_long_repetitions_are_linear():
    assert runs_of(np.zeros(300_000, dtype=np.int64)) == [(0, 300_000, 1)]
    words = ["a", "b", "c"] * 100_000
    runs, kept = collapse(words)
    assert runs == [(0, 300_000, 3)] and kept == "a b c"


def test_collapse_edges():
    assert collapse([]) == ([], "")
    assert collapse(["x"] * 5) == ([], "x x x x x")  # shorter than six words
    assert collapse(["x"] * 6) == ([(0, 6, 1)], "x")
    assert collapse(["a", "b"] * 3) == ([], "a b a b a b")  # three repeats only


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def contract_row(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0d]+", text or ""))
    runs = brute_runs(words)
    dropped = set()
    for s, length, q in runs:
        dropped |= set(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *head, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.fixture(scope="module")
def fixture_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("runs")
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    ids, texts = [], []
    for i, t in zip(docs["doc_id"], docs["text"]):
        ids.append(i)
        texts.append(" ".join((t or "").split(" ")[:200]))
    ids += [9001, 9002, 9003, 9003, 9004]
    texts += [None, "", "w " * 50, "w " * 50, "a\tb\nc " * 40]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": ["en"] * len(ids)}), folder / "documents.parquet")
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pydict()
    pid = pages["page_id"] + [9001, 9002, 9003, 9004]
    urls = pages["url"] + [None, "http://x/", "http://y/", None]
    html = pages["html"] + [None, "", pages["html"][0], None]
    pq.write_table(pa.table({"page_id": pa.array(pid, pa.int64()), "url": urls, "html": html}), folder / "pages.parquet")
    return str(folder)


def test_periodic_runs_query(spark, fixture_dir):
    from freightloom.llm.queries import QUERIES

    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, fixture_dir).collect())
    docs = pq.read_table(f"{fixture_dir}/documents.parquet").to_pydict()
    want = sorted(contract_row(i, t) for i, t in zip(docs["doc_id"], docs["text"]))
    assert got == want
    assert any(r[1] > 0 for r in got)


def test_warc_query(spark, fixture_dir):
    from freightloom.llm.queries import QUERIES

    got = sorted(tuple(r) for r in QUERIES["op11_warc"](spark, fixture_dir).collect())
    pages = pq.read_table(f"{fixture_dir}/pages.parquet").to_pydict()
    first = {}
    for i, h in zip(pages["page_id"], pages["html"]):
        first[(h or "").encode()] = min(first.get((h or "").encode(), i), i)
    want = []
    for i, h in zip(pages["page_id"], pages["html"]):
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "response" if first[data] == i else "revisit"
        want.append((i, len(data), digest, kind, None if kind == "response" else first[data]))
    assert got == sorted(want)
    assert any(r[3] == "revisit" for r in got)


def test_warc_pushdown_and_empty(spark, tmp_path):
    from freightloom.llm.warc import read_archive, write_pages

    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/c", None)], "page_id long, url string, html string")
    write_pages(pages, str(tmp_path / "a"))
    revisits = read_archive(spark, str(tmp_path / "a"), "page_id long, record_type string, refers_to long, payload binary")
    assert [tuple(r) for r in revisits.where("record_type = 'revisit'").collect()] == [(2, "revisit", 1, None)]
    assert sorted(r.page_id for r in revisits.where("page_id IN (1, 3)").collect()) == [1, 3]
    write_pages(pages.limit(0), str(tmp_path / "b"))
    assert read_archive(spark, str(tmp_path / "b")).count() == 0


def test_archives_are_plain_gzip(spark, tmp_path):
    import glob
    import gzip

    from freightloom.llm.warc import write_pages

    pages = spark.createDataFrame([(i, f"http://h/{i}", "p" * (i % 3)) for i in range(50)], "page_id long, url string, html string")
    write_pages(pages, str(tmp_path / "g"))
    data = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(str(tmp_path / "g" / "*.warc.gz")))
    assert data.count(b"WARC/1.1\r\n") == 50 and data.count(b"WARC-Type: revisit") == 47
