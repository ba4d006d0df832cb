import re
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tablewire.operators.urls import canonical_url, label_counts

CASES = {
    "https://h/api/x": ("/api/x", "", "/api/x"),
    "https://h/x?b=2&a=1": ("/x", "a=1&b=2", "/x?a=1&b=2"),
    "https://h/x?a=1&a=2&a=": ("/x", "a", "/x?a"),
    "https://h/x?data&arrow&rowrange=(0,4)": ("/x", "arrow&data&rowrange=(0,4)", "/x?arrow&data&rowrange=(0,4)"),
    "https://h/x?#frag": ("/x", "", "/x"),
    "https://h?q=1": ("/", "q=1", "/?q=1"),
    "https://h/x?k=a+b%20c": ("/x", "k=a%20b%20c", "/x?k=a%20b%20c"),
    "https://h/x?k=%E4%B8%AD": ("/x", "k=%E4%B8%AD", "/x?k=%E4%B8%AD"),
    "https://h/x?k=100%&j=%zz": ("/x", "j=%zz&k=100%", "/x?j=%zz&k=100%"),
    "https://h/x?B=1&a=2&&_=3": ("/x", "B=1&_=3&a=2", "/x?B=1&_=3&a=2"),
    "https://h/x?k=a=b": ("/x", "k=a=b", "/x?k=a=b"),
    "https://h/x?k=%3C'%22%3E": ("/x", "k=%3C%27%22%3E", "/x?k=%3C%27%22%3E"),
    "  https://h/a b\t\n/c ": ("/a%20b/c", "", "/a%20b/c"),
    "https://h/a/./b/../c": ("/a/c", "", "/a/c"),
    "https://h/a/b/..": ("/a/", "", "/a/"),
    "https://h/a/b/.": ("/a/b/", "", "/a/b/"),
    "https://h/../../x": ("/x", "", "/x"),
    "https://h/a/%2E%2e/b/%2e/c": ("/b/c", "", "/b/c"),
    "https://h/a//../b": ("/a/b", "", "/a/b"),
    "https://h/..a/.b/...": ("/..a/.b/...", "", "/..a/.b/..."),
    "https:\\\\h\\a\\..\\b?x=\\": ("/b", "x=\\", "/b?x=\\"),
    "https://h/é{`}%c3%a9": ("/%C3%A9%7B%60%7D%c3%a9", "", "/%C3%A9%7B%60%7D%c3%a9"),
    "https://h:99999/x": (None, None, None),
    "https://h:8x/x": (None, None, None),
    "https:///x": (None, None, None),
    "https://h/" + "d/../" * 300 + "e": ("/e", "", "/e"),
    "no url": (None, None, None),
    None: (None, None, None),
}


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([(u,) for u in CASES], "url string")
    return {r["url"]: r for r in canonical_url(df, "url").collect()}


@pytest.mark.parametrize("url", list(CASES))
def test_canonical(found, url):
    row = found[url]
    assert (row["path"], row["canonical_query"], row["canonical"]) == CASES[url]


SITES = {
    "HTTP://WWW.Example.COM:80/": "www.example.com",
    "https://h:443": "h",
    "https://h:0443/": "h",
    "https://h:/": "h",
    "https://h:80/": "h:80",
    "wss://H:443/": "h",
    "https://User:pw@H:8080/": "User:pw@h:8080",
    "https://@h/": "h",
    "https://[2001:DB8::1]:443/": "[2001:db8::1]",
    "custom://Host:80/": "Host:80",
    "https://h:65535/": "h:65535",
}


def test_sites(spark):
    found = canonical_url(spark.createDataFrame([(u,) for u in SITES], "url string"), "url").collect()
    assert {r["url"]: r["site"] for r in found} == SITES


def test_escape_case(spark):
    df = spark.createDataFrame([("http://h/%7e%C3%a9%zz%4",)], "url string")
    assert canonical_url(df, "url", upper_escapes=True).first()["path"] == "/%7E%C3%A9%zz%4"
    assert canonical_url(df, "url").first()["path"] == "/%7e%C3%a9%zz%4"


def test_pages_against_an_independent_parser(spark, table):
    for row in canonical_url(table("pages"), "url").collect():
        parts = urllib.parse.urlsplit(row["url"])
        pairs = dict(urllib.parse.parse_qsl(parts.query, keep_blank_values=True))
        query = "&".join(f"{k}={v}" if v else k for k, v in sorted(pairs.items()))
        assert (row["site"], row["path"], row["canonical_query"]) == (parts.netloc, parts.path or "/", query)


def test_dedupe_keeps_sites_and_bad_rows(spark):
    df = spark.createDataFrame(
        [(3, "http://a/x?p=1&q"), (1, "http://a/x?q&p=1"), (2, "http://b/x?q&p=1"), (4, "bad"), (5, "bad")],
        "id long, url string",
    )
    assert sorted(r["id"] for r in canonical_url(df, "url", "id").collect()) == [1, 2, 4, 5]


def test_dedupe_collapses_copies_before_the_shuffle(spark, plan):
    df = spark.createDataFrame([(1, "http://a/x")], "id long, url string")
    assert "partial_min_by" in plan(canonical_url(df, "url", "id"))


def test_region_labels(spark):
    hosts = ["https://service.north-1.cloudname.abcdef.com/api", "https://service.south.cloudname.abcdef-inc.com/api"]
    df = spark.createDataFrame([(h,) for h in [*hosts, hosts[0], "https://x.com", None]], "u string")
    got = {r["label"]: (r["n"], r["n_unmatched"]) for r in label_counts(df, "u").collect()}
    assert got == {"north-1": (2, 0), "south": (1, 0), None: (0, 2)}


def test_labels_equal_a_plain_regex(spark, table):
    pattern = r"^https?://(www|blog|m)\."
    expected = {}
    for row in table("pages").select("url").collect():
        hit = re.search(pattern, row["url"])
        expected[hit and hit.group(1)] = expected.get(hit and hit.group(1), 0) + 1
    got = {r["label"]: r["n"] + r["n_unmatched"] for r in label_counts(table("pages"), "url", pattern).collect()}
    assert got == expected


def test_no_shuffle(spark, plan, table):
    assert "Exchange" not in plan(canonical_url(table("pages").select(F.col("url")), "url"))
