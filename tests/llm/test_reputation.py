import pytest
from pyspark.sql import functions as F

from shopstream.llm import reputation

URLS = {
    "https://WWW.Example.com/en/x?q=1#t": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
    "http://a.example.com/fr/": ("a.example.com", "/fr/", "com/", "allow"),
    "http://a.example.com": ("a.example.com", "", None, "allow"),
    "http://a.example.com?x=/en/": ("a.example.com", "", None, "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "x://y://z/": ("y:", "//z/", None, "allow"),
    "http://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"),
    "http://b.net/es": ("b.net", "/es", None, "allow"),
    "http://É.NET/fr/": ("É.net", "/fr/", "net/fr/", "block"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "://": ("", "", None, "allow"),
}


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)], "page_id INT, url STRING, host STRING, verdict STRING")
    outcomes = spark.createDataFrame([("z.org", True)], "host STRING, bad BOOLEAN")
    rows = reputation.judge(pages, outcomes).collect()
    assert {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == URLS
    assert reputation.judge(pages.where("false"), outcomes.where("false")).count() == 0


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.com", "example.com", "com"), ("b.co.uk", "b.co.uk", "co.uk"), ("x.b.co.uk", "b.co.uk", "co.uk"), ("localhost", "localhost", "localhost"),
])
def test_levels(spark, host, domain, suffix):
    row = spark.range(1).select(reputation.domain_of(F.lit(host)), reputation.suffix_of(F.lit(host))).first()
    assert tuple(row) == (domain, suffix)


def test_few_outcomes_shrink_and_many_decide(spark):
    rows = [("bad.a.com", True)] * 80 + [("bad.a.com", False)] * 5 + [("good.a.com", False)] * 90 + [("new.a.com", True)] * 2
    rows += [(f"h{i}.b.org", i % 7 == 0) for i in range(70)] + [("none.c.net", None), (None, None)]
    found, overall = reputation.reputations(spark.createDataFrame(rows, "host STRING, bad BOOLEAN"))
    known = {r["host"]: r for r in found.collect()}
    assert known["bad.a.com"]["lower"] > 0.8 > known["new.a.com"]["lower"] and known["good.a.com"]["lower"] < 0.1
    assert known["none.c.net"]["n"] == 0 and abs(known["none.c.net"]["share"] - overall) < 0.2 and "" in known


def test_outcomes_by_document(spark):
    pages = spark.createDataFrame([("http://a.com/en/1",), ("http://a.com/en/2.html",), ("http://a.com/en/3x",), (None,)], "url STRING")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (3, 0), (None, 0)], "doc_id BIGINT, quality INT")
    rows = sorted(map(str, map(tuple, reputation.page_outcomes(pages, labels).collect())))
    assert rows == sorted(map(str, [("a.com", True), ("a.com", False), ("a.com", None), ("a.com", None), ("", None)]))
