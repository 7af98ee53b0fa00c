"""Collocations against their SQL in DuckDB, on a table with nulls, ties and a clashing column."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq


def test_collocations_equal_sql(spark, tmp_path):
    from freightloom.llm.queries import ORACLES, QUERIES

    base = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    ids, texts, langs = list(base["doc_id"]), list(base["text"]), list(base["lang"])
    extra = ["New York City. new york city; NEW\tYORK  city!", "x y z x y z", None, "", "A b. A b, a B"]
    for k in range(1500):
        ids.append(10_000 + k)
        texts.append(extra[k % len(extra)])
        langs.append(None if k % 2 else "xx")
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": langs, "rank": [1] * len(ids)})
    pq.write_table(table, tmp_path / "documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op12_collocations"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    want = sorted(tuple(r) for r in con.execute(ORACLES["op12_collocations"]).fetchall())
    assert got == want
    assert {r[0] for r in got} >= {"und", "xx"}
    assert any(r[2] == "new york city" for r in got) and not any(r[2] == "new york" and r[0] == "xx" for r in got)


def test_collocations_of_nothing(spark):
    from freightloom.llm.collocations import collocations

    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(empty).count() == 0


def some_texts(spark):
    texts = ["a b c d e f. a b c d e", "A b, c  d\te f", "b c d; b c d", None, "x.y!z", "é è é è é"]
    return [(t, lang) for t in texts for lang in ("l", "m", None) for _ in range(2 if lang else 1)]


def test_texts_are_read_twice(spark):
    from pyspark.sql import functions as F

    from freightloom.llm.collocations import phrase_counts

    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    rows = some_texts(spark)
    docs = spark.createDataFrame(rows, "text string, lang string").select(F.udf(seen).asNondeterministic()("text").alias("text"), "lang")
    phrase_counts(docs, least=2)[1].count()
    assert read.value == 2 * len(rows)


def test_numbered_and_spelled_phrases_count_the_same(spark, monkeypatch):
    from freightloom.llm import collocations as c

    docs = spark.createDataFrame(some_texts(spark), "text string, lang string")
    monkeypatch.setattr(c, "WORDS_HELD", 3)
    monkeypatch.setattr(c, "CODES_HELD", 3)
    results = []
    for words, phrases in ((100, 100), (0, 100), (100, 0), (100, 12)):
        monkeypatch.setattr(c, "MOST_WORDS", words)
        monkeypatch.setattr(c, "MOST_PHRASES", phrases)
        totals, counts = c.phrase_counts(docs, least=4)
        results.append((sorted(map(tuple, totals.collect())), sorted(map(tuple, counts.collect()))))
    assert results[0] == results[1] == results[2] == results[3]
    assert ("l", 62) in results[0][0] and ("l", "b c d", 3, 8) in results[0][1] and ("und", "b c d", 3, 4) in results[0][1]
    assert ("m", "a b c d e", 5, 4) in results[0][1]
