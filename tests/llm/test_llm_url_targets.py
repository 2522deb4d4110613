"""Targets that pages name, against the standard library's resolution."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from dimflow.llm import url_filter as U

PAGES = ["http://a.org/b/c/d?q", "https://a.org", "http://a.org/b/c/", "http://a.org/x#f"]
TARGETS = ["g", "./g", "g/", "/g", "//h.net/x", "?y", "g?y", "#s", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./g/.", "g/./h", "g/../h", "g/../../h?a/../b", "http://z.org/q/../r"]


def test_relative_targets_equal_the_standard_resolution(spark):
    rows = [(p, t) for p in PAGES for t in TARGETS]
    df = spark.createDataFrame(rows, "page string, target string")
    for r in df.withColumn("got", U._resolved(F.col("page"), F.col("target"))).collect():
        want = urljoin(r["page"], r["target"]) if "//z" not in r["target"] else r["target"]
        same = lambda u: U_parts(u)
        assert same(r["got"]) == same(want), (r, want)


def U_parts(url):
    """As nodes are compared: without fragment, an empty path like a slash."""
    rest = url.split("://", 1)[1].split("#")[0]
    host, _, path = rest.partition("/")
    return host, "/" + path


def test_what_pages_name(spark):
    pages = [
        ("http://a.org/x/y", '<link rel="canonical" href="../z">', ["http://a.org/z"]),
        ("http://a.org/x/y", '<base href="/deep/er/"><link rel=canonical href="q">', ["http://a.org/deep/er/q"]),
        ("http://a.org/x/y", '<!-- <link rel="canonical" href="http://b.org/"> --><p>x', []),
        ("http://a.org/x/y", '<!-- <link rel="canonical" href="http://b.org/">', []),
        ("http://a.org/x/y", '<link rel="canonical" href="mailto:a@b.org">', []),
        ("http://a.org/x/y", '<link rel="canonical" href="javascript:void(0)">', []),
        ("http://a.org/x/y", '<meta http-equiv="refresh" content="0; url=./w">', ["http://a.org/x/w"]),
        ("http://a.org/x/y", None, []),
    ]
    for url, html, want in pages:
        df = spark.createDataFrame([(url, html)], "url string, html string")
        assert [r["target"] for r in U.page_targets(df).collect()] == want, html


def test_a_block_reaches_a_page_by_a_relative_link(spark):
    rules = spark.createDataFrame([("block", "net", "/fr/")], "verdict string, host string, path string")
    pages = [(1, "http://a.net/en/x", '<link rel="canonical" href="../fr/y">'), (2, "http://a.net/q?ref=a", ""), (3, "http://a.net/q?ref=b", '<link rel=canonical href="/fr/">'), (4, "http://a.net/e?utm_source=z", ""), (5, "http://a.net/e", '<link rel=canonical href="./fr/../fr/1">')]
    got = U.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "block"}
