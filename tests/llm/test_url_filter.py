"""URL verdicts against a plain reading of the rules."""

import random
import re

from freightloom.llm import url_filter as uf


def plain(url, hosted=uf.HOSTED, patterns=uf.PATTERNS):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [(len(h + p), h + p, v) for h, p, v in hosted if (low == h or low.endswith("." + h)) and path.startswith(p)]
    if fits:
        return low, path, max(fits)[1], None, max(fits)[2]
    whole = low + rest[len(host) :]
    hits = [(len(p), p, v) for p, v in patterns if re.search(".*".join(map(re.escape, p.split("*"))), whole, re.I | re.S)]
    return (low, path, None, *(max(hits)[1:] if hits else (None, "allow")))


def urls():
    dice = random.Random(6)
    hosts = ["example.org", "a.example.org", "notexample.org", "EXAMPLE.Org", "x.com", "com", "fr.com:80", "example.net", "org", "ad.doubleclick.net", "", "u@a.b.org"]
    tails = ["", "/", "/es/", "/es", "/en/1", "/en/12?x", "/EN/1", "/fr/1", "/de/x#y", "?q=/fr/", "#/de/", "/ads/1", "/Ads/", "/banner/a/b.gif", "/x?sessionid=1&cart=2", "/login?return=1", "/malware/a.exe\n", "/casino"]
    for _ in range(400):
        yield dice.choice(["http://", "https://", "x://y://", "", "//", "://"]) + dice.choice(hosts) + dice.choice(tails)
    yield from (None, "", "://", "http://", "no url", "http://" + "a." * 20_000 + "org/" + "b/" * 20_000)


def test_verdicts(spark):
    rows = [(i % 350, u, "h", "p") for i, u in enumerate(urls())] + [(None, "http://example.org/es/", "h", "p")] * 2
    pages = spark.createDataFrame(rows, "page_id int, url string, host string, rule string").repartition(3)
    found = sorted((tuple(r) for r in uf.judge(pages, uf.rule_table(spark)).collect()), key=repr)
    assert found == sorted(((i, *plain(u)) for i, u, _, _ in rows), key=repr)


def test_other_rules_and_empty_tables(spark):
    hosted = (("a.b", "", "block"), ("a.b", "/x", "allow"), ("a.b", "/x", "allow"), ("q+\\E.z", "/(", "block"))
    patterns = (("*", "block"), ("ab*cd", "allow"), ("xyz", "allow"))
    rules = uf.rule_table(spark, hosted, patterns)
    seen = ["http://a.b", "http://a.b/x", "http://c.a.b?x", "http://xa.b/", "http://k.q+\\e.z/(1", "http://k/ab/1/cd", "http://k/xyzzy", None]
    hosted = tuple((h.lower(), p, v) for h, p, v in hosted)
    got = {r["id"]: tuple(r)[1:] for r in uf.judge(spark.createDataFrame(list(enumerate(seen)), "page_id int, url string"), rules).collect()}
    assert got == {i: plain(u, hosted, patterns) for i, u in enumerate(seen)}
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id int, url string")
    assert uf.judge(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in uf.judge(pages, rules.limit(0)).collect()] == [(1, "a.b", "/", None, None, "allow")]


def test_rules_are_found_through_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://common.org/{'rare/' if i == 7 else ''}x") for i in range(20)], "page_id int, url string")
    literals = {r["rule"]: set(r["literals"]) for r in uf.compiled(uf.rule_table(spark, (("common.org", "/rare/1", "block"),), (("/x*y/z/", "block"),))).collect()}
    assert literals == {"common.org/rare/1": {"common", "org", "rare"}, "/x*y/z/": {"z"}}
    assert uf.judge(pages, uf.rule_table(spark, (("common.org", "/rare/", "block"),), ())).filter("verdict = 'block'").count() == 1
    plan = uf.judge(pages, uf.rule_table(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
