"""URL verdicts from pattern rules, found through their rarest literal token.

Two sorts of rules share one table. A hosted rule fits a host with all its
subdomains and the paths that start with its own. A pattern has wildcards and
fits anywhere in host, path and query. Every rule is entered under the rarest
of its literal tokens, by the counts of these tokens over all URLs; a URL looks
up its own tokens, and only the rules so fetched run their regular expression.
A rule without such a token is a candidate for every URL.

Built-in functions only. The table of rules is small beside the URLs; whether
it is broadcast is left to Spark, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightloom.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The hosted rules of the contract.
HOSTED = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Patterns for URLs that no hosted rule fits.
PATTERNS = (
    ("/ads/", "block"), ("/adserver/", "block"), ("/banner/*.gif", "block"), (".doubleclick.net/", "block"), ("/wp-login.php", "block"),
    ("/cart/checkout", "block"), ("/login?*return=", "block"), ("/casino/", "block"), ("/porn/", "block"), ("?sessionid=*&cart=", "block"),
    ("/malware/*.exe", "block"), ("/track/*/click", "block"),
)
DEFAULT = "allow"


def rule_table(spark: SparkSession, hosted=HOSTED, patterns=PATTERNS) -> DataFrame:
    """``host, path, pattern, verdict``; a row has a host and a path, or a pattern."""
    rows = [(h, p, None, v) for h, p, v in hosted] + [(None, None, p, v) for p, v in patterns]
    return spark.createDataFrame(rows, "host string, path string, pattern string, verdict string")


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def quoted(column: Column) -> Column:
    """The text as a literal of a regular expression."""
    return F.concat(F.lit("\\Q"), F.replace(column, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def tokens(column: Column) -> Column:
    """Different runs of ASCII letters and digits, in lower case; an empty one stands for rules without a token."""
    found = F.split(ascii_lower(column), "[^a-z0-9]+")
    return F.array_distinct(F.array_append(found, F.lit("")))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with ``rank`` (a higher one wins), ``regex`` and ``literals``.

    Hosted rules win over patterns, longer ones over shorter ones; ties go to
    the longer host, then to the later text, then to "block". Repeated rules
    and rules with neither host nor pattern count for nothing. A literal token
    must end at both sides within the rule: "1" in "/en/1" does not, since the
    path of a URL may go on.
    """
    hosted = F.col("host").isNotNull()
    host, path = ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))
    bare = path == ""
    rule = F.when(hosted, F.concat(host, path)).otherwise(F.col("pattern"))
    regex = F.when(
        hosted,
        F.concat(F.lit("^(?:[^/?#]*\\.)?"), quoted(host), F.when(bare, F.lit("(?=[/?#]|$)")).otherwise(quoted(path))),
    ).otherwise(F.concat(F.lit("(?is)"), F.array_join(F.transform(F.split("pattern", "\\*"), quoted), ".*")))
    marked = F.when(hosted, F.concat(F.lit("."), host, F.when(bare, F.lit("/")).otherwise(F.concat(path, F.lit("*"))))).otherwise(
        F.concat(F.lit("*"), F.col("pattern"), F.lit("*"))
    )
    literals = F.regexp_extract_all(ascii_lower(marked), F.lit("(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"))
    known = rules.filter("host IS NOT NULL OR pattern IS NOT NULL").select(
        hosted.alias("hosted"), rule.alias("rule"), "verdict", F.length(F.when(hosted, host)).alias("own"), regex.alias("regex"), literals.alias("literals")
    )
    order = Window.orderBy("hosted", F.length("rule"), "own", "rule", F.desc("verdict"))
    return known.distinct().withColumn("rank", F.row_number().over(order))


def parsed(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and host with all that follows; empty without ``://``."""
    mark = F.instr(url, "://")
    after = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = ascii_lower(F.regexp_extract(after, "^([^/?#]*)", 1))
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1), F.concat(host, F.regexp_extract(after, "(?s)^[^/?#]*(.*)$", 1))


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page: ``id, host, path, rule, pattern, verdict``.

    ``rule`` is the hosted rule that fits and wins, ``pattern`` the pattern
    where no hosted rule fits; where neither does, the verdict is ``default``.
    A null url, or one without ``://``, has an empty host and path and is
    judged by the patterns that fit the empty text, usually none. Repeated
    rows stay rows of their own; other columns are ignored.
    """
    host, path, whole = parsed(F.col(url_column).cast("string"))
    urls = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"), whole.alias("whole"))
    rules = staged(compiled(rules), "compiled")  # so that Spark knows how small they are

    literals = rules.select("rank", F.explode_outer("literals").alias("token")).withColumn("token", F.coalesce("token", F.lit("")))
    wanted = literals.select("token").distinct()
    counts = urls.select(F.explode(tokens(F.col("whole"))).alias("token")).join(wanted, "token").groupBy("token").count()
    rarest = literals.join(counts, "token", "left").groupBy("rank").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), F.col("token"))).getField("token").alias("token")
    )
    index = staged(rarest.join(rules.drop("literals"), "rank"), "rules")

    looked = urls.withColumn("row", F.monotonically_increasing_id()).withColumn("token", F.explode(tokens(F.col("whole"))))
    met = looked.join(index.select("token", "rank", "regex"), "token", "left")
    fits = F.when(F.rlike("whole", F.col("regex")), F.col("rank"))
    best = met.groupBy("row", "id", "host", "path").agg(F.max(fits).alias("rank"))
    named = best.join(index.select("rank", "hosted", F.col("rule").alias("text"), "verdict"), "rank", "left")
    return named.select(
        "id", "host", "path", F.expr("CASE WHEN hosted THEN text END").alias("rule"), F.expr("CASE WHEN NOT hosted THEN text END").alias("pattern"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
