"""The corpus operators over their whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def hex_of(column: str):
    return F.lower(F.hex(F.col(column)))


@query(
    "op1_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256 FROM documents WINDOW same AS (PARTITION BY sha256(coalesce(text, '')))""",
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.exact_dedup import exact_duplicates

    found = exact_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", hex_of("digest").alias("text_sha256"))


@query("op10_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(hex_of("fp"), 16, "0").alias("fingerprint"), "component_id")


def spans_text(spans):
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def span_digests(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts and digest of the base kinds, and all spans as a text."""
    spans = F.col("spans")
    of_base = F.filter(spans, lambda s: s["kind"].isin(*base))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), *map(count, base), F.sha2(spans_text(of_base), 256).alias("base_sha256"), spans_text(spans).alias("spans")
    )


@query("op3_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.secret_scan import find_secrets

    return span_digests(find_secrets(table(spark, folder, "documents")), ("assign", "access", "hex"))


def token_digests(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def byte_bpe_of(docs: DataFrame) -> DataFrame:
    """Counts and digests of the 50k byte-level vocabulary, encoded and decoded again."""
    import public_tokenizers

    from freightloom.llm.byte_bpe import round_trip

    return token_digests(round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


@query("op5_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe_of(table(spark, folder, "documents"))


@query("op8_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.personal_data import TAGGED, find_personal_data, train_on
    from freightloom.llm.personal_examples import SENTENCES

    chain = train_on(spark.createDataFrame([(s,) for s in SENTENCES], "marked string"))
    return span_digests(find_personal_data(table(spark, folder, "documents"), chain), TAGGED)


@query("op6_html_text")
def html_text(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.html_text import extract

    found = extract(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def url_sql() -> str:
    """The rules as prefix and LIKE conditions."""
    from freightloom.llm.url_filter import HOSTED, LOWER, PATTERNS, UPPER

    hosted = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOSTED)
    patterns = ", ".join("('{}', '{}', '{}')".format(p, "%" + p.replace("_", "!_").replace("*", "%") + "%", v) for p, v in PATTERNS)
    return f"""
        WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages),
        whole AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, rest FROM cut),
        hosted(h, p, v) AS (VALUES {hosted}),
        patterns(pattern, likes, v) AS (VALUES {patterns}),
        ruled AS (SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict FROM whole, hosted
                  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n),
        matched AS (SELECT n, arg_max(pattern, (length(pattern), pattern)) AS pattern, arg_max(v, (length(pattern), pattern)) AS verdict FROM whole, patterns
                    WHERE lower(host || regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1)) LIKE likes ESCAPE '!' GROUP BY n)
        SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN pattern END AS pattern, coalesce(ruled.verdict, matched.verdict, 'allow') AS verdict
        FROM whole LEFT JOIN ruled USING (n) LEFT JOIN matched USING (n)"""


@query("op2_url_filter", url_sql())
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.url_filter import judge, rule_table

    return judge(table(spark, folder, "pages"), rule_table(spark)).withColumnRenamed("id", "page_id")


@query("op7_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.decontaminate import find_leaks

    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


CATEGORIES = ("low_quality", "toxic")


def toxicity_chain(docs: DataFrame, labels: DataFrame):
    """The chain over the two judgements that the labels hold: poor quality first, then toxicity."""
    from freightloom.llm.toxicity import train

    return train(docs, labels.withColumn("low_quality", 1 - F.col("quality")), CATEGORIES)


@query("op4_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from freightloom.llm.toxicity import judge

    docs = table(spark, folder, "documents")
    chain = toxicity_chain(docs, table(spark, folder, "labels"))
    found = judge(docs.select("doc_id", "text"), chain)
    return found.select("doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"), "toxic")


SPACE_WORDS = "[^\\x20\\x09-\\x0D]+"
PIECES = "[A-Za-z]+|[0-9]|[^\\x00-\\x7F]+"
SIGNS = "|[!-/:-@\\[-`{-~]"
LEAST_WORDS = 5


def counts_sql() -> str:
    def n(pattern: str) -> str:
        return f"len(regexp_extract_all(coalesce(text, ''), '{pattern}'))"

    return f"""
        WITH counted AS (SELECT source, lang, {n(SPACE_WORDS)} AS words, {n(PIECES + SIGNS)} AS pieces FROM documents)
        SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
            SELECT source, lang, 'words-1' AS tokenizer, words AS n FROM counted WHERE words >= {LEAST_WORDS}
            UNION ALL SELECT source, lang, 'pieces-1', pieces FROM counted WHERE words >= {LEAST_WORDS}) GROUP BY ALL"""


@query("op9_token_counts", counts_sql())
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after four batches: two loads, a correction that also counts signs, and the withdrawal of very short texts.

    Each batch is committed twice, as after a failure; the second time changes nothing.
    """
    import uuid

    from freightloom.llm.common import shared_dir, staged, text_of
    from freightloom.llm.token_counts import Rollup

    def n(pattern: str):
        return F.regexp_count(text_of("text"), F.lit(pattern)).cast("long")

    docs = table(spark, folder, "documents")
    counted = docs.select("source", "lang", n(SPACE_WORDS).alias("words"), n(PIECES).alias("first"), n(PIECES + SIGNS).alias("pieces"))
    counted = staged(counted, "counted")

    def change(op: str, tokenizer: str, now: str, old: str | None = None, rows: DataFrame = counted) -> DataFrame:
        before = F.col(old) if old else F.lit(None).cast("long")
        return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"), F.col(now).alias("n_tokens"), before.alias("old_tokens"))

    short = counted.filter(F.col("words") < LEAST_WORDS)
    withdrawn = change("delete", "words-1", "words", rows=short).unionByName(change("delete", "pieces-1", "pieces", rows=short))
    batches = {
        "load words": change("insert", "words-1", "words"),
        "load pieces": change("insert", "pieces-1", "first"),
        "count signs": change("revise", "pieces-1", "pieces", "first"),
        "withdraw short": withdrawn,
    }
    rollup = Rollup(spark, f"{shared_dir(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    for _ in range(2):
        for name, changes in batches.items():
            rollup.commit(name, changes)
    return rollup.totals()


@query("op11_warc")
def warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record to the shared folder, then read back from the archives."""
    import uuid

    from freightloom.llm.warc import read_archive, write_pages
    from freightloom.session import shared_dir

    path = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_pages(table(spark, folder, "pages"), path)
    return read_archive(spark, path, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every whole text, after the planted repetitions of one document in ten."""
    from freightloom.llm.periodic_runs import periodic_runs as runs_in
    from freightloom.llm.periodic_runs import words_column

    docs = table(spark, folder, "documents").select("doc_id", words_column(F.col("text")).alias("words"))
    words = F.col("words")
    n, h = F.size(words), F.crc32(F.col("doc_id").cast("string"))
    g = F.expr("crc32(cast(doc_id as string)) div 10")
    a = F.when(n > 0, g % n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    planted = F.when(
        (h % 10 == 0) & (n > 0),
        F.transform(words, lambda w, i: F.when(i >= a, F.get(words, a + (i - a) % p)).otherwise(w)),
    ).otherwise(words)
    found = runs_in(docs.select("doc_id", planted.alias("words")), "words")

    def better(x, y):
        gain = x["length"] * y["period"] - y["length"] * x["period"]
        return (
            F.when(gain > 0, -1)
            .when(gain < 0, 1)
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .when(x["period"] != y["period"], F.when(x["period"] < y["period"], -1).otherwise(1))
            .otherwise(0)
        )

    best = F.get(F.array_sort("runs", better), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        ((best["length"] * 1000 - best["length"] * 1000 % best["period"]) / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def collocations_sql() -> str:
    """The contract of op12 in DuckDB: phrases counted by position, exact products in 128 bits."""
    return r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
grams AS (SELECT lang, i, w, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM pos),
counts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m AS size, count(*) AS f
  FROM grams GROUP BY ALL HAVING count(*) >= 100
),
cands AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:size], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cands) c
),
valued AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.k, l.f AS l, r.f AS r, t.n,
         (cuts.a::HUGEINT * t.n * 1000) // (l.f::HUGEINT * r.f) AS score
  FROM cuts JOIN counts l ON l.lang = cuts.lang AND l.phrase = cuts.lp
            JOIN counts r ON r.lang = cuts.lang AND r.phrase = cuts.rp
            JOIN totals t ON t.lang = cuts.lang
),
weakest AS (
  SELECT lang, phrase, a, l, r, n, score FROM valued
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inner_parts AS (
  SELECT lang, f AS g, array_to_string(string_split(phrase, ' ')[2:], ' ') AS phrase FROM counts WHERE size >= 3
  UNION ALL
  SELECT lang, f AS g, array_to_string(string_split(phrase, ' ')[1:size - 1], ' ') AS phrase FROM counts WHERE size >= 3
),
kept AS (
  SELECT * FROM weakest x
  WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = x.lang AND p.phrase = x.phrase AND p.g >= x.a)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept)
WHERE rank <= 2000
"""


@query("op12_collocations", collocations_sql())
def collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 collocations of each language over all documents."""
    from freightloom.llm.collocations import collocations as mined

    return mined(table(spark, folder, "documents"))
