import re

import pytest

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES

LOW = str.maketrans(url_filter.UPPER, url_filter.LOWER)
RULES = [*URL_RULES, ("a.b.c.d", "/x", "block"), ("c.d", "/xyz/", "allow"), ("d", "", "block"), ("Ü.net", "/", "block")]


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = host.translate(LOW)
    fits = [
        (len(h + p), v, h + p)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


URLS = [
    None, "", "no scheme", "http://", "http:///path", "HTTP://WWW.Example.COM/en/a?b#c", "http://example.com/en/",
    "http://www.example.com/en/x", "http://xexample.com/en/", "http://a.net/fr/1", "http://net/es/", "http://a.net/de/",
    "http://h?x=a://b.net/fr/", "http://z.a.b.c.d/xyz/1", "http://a.b.c.d/xy", "http://q.d", "http://d?x", "x://y://com/",
    "http://ü.net/", "http://Ü.net/", "http://" + "a." * 3000 + "com/" + "p/" * 5000, "http://com/\n/en/", "http://user@example.com/en/",
    "http://example.com:80/en/",
]


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def test_rules(spark, rules, monkeypatch):
    pages = spark.createDataFrame([(i, u, "h", "w") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, rule string")
    for most in (url_filter._RULES_TO_BROADCAST, 0):
        monkeypatch.setattr(url_filter, "_RULES_TO_BROADCAST", most)
        found = url_filter.judge_urls(pages, rules).orderBy("page_id").collect()
        got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in found]
        assert got == [brute(u, RULES) for u in [*URLS, *URLS]]


def test_corpus(spark, sf_dir, rules):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in url_filter.judge_urls(pages, rules, default="block").collect():
        want = brute(r["url"], RULES)
        assert (r["host"], r["path"], r["rule"]) == want[:3]
        assert r["verdict"] == (want[3] if want[2] else "block")


def test_empty_tables(spark, rules):
    pages = spark.createDataFrame([(1, "http://com/")], "page_id long, url string")
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert url_filter.judge_urls(pages, rules.limit(0)).first()["verdict"] == "allow"
