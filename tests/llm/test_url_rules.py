"""URL rules against a check of every rule."""

from __future__ import annotations

import random
import re

from shopstream.llm import queries
from shopstream.llm.url_rules import RULES_SCHEMA, judge

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = re.split("[?#]", url.split("://", 1)[1])[0]
        host, slash, path = rest.partition("/")
        host, path = host.translate(ASCII), slash + path
    hits = [
        (len(h), len(p), h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(hits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def check(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in urls], "page_id int, url string, host string, path string, verdict string")
    found = judge(pages, spark.createDataFrame(rules, RULES_SCHEMA), **kw).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(i, *brute(u, rules, **kw)) for i, u in urls], key=str)


URLS = [
    None, "", "no scheme", "://", "http://", "http:///x", "http://EXAMPLE.org", "http://example.org/", "http://a.b.example.org/es/x?y/en/1",
    "http://example.org/es", "http://example.org/en/12", "http://notexample.org/es/", "http://org/es/", "http://x.com/fr/1", "http://x.com/de/#/fr/",
    "http://x.com/DE/", "ftp://x.com/de/://y.org/", "http://user@x.com:80/de/", "http://x.com:80/de/", "http://x..org/a", "http://.org/", "http://org./a",
    "HTTP://Ünï.ORG/é\n/z", "http://example.org?x", "http://example.org#x", "http://example.org/en/1", "http://" + "a." * 60 + "org/" + "p" * 5000,
]


def test_contract_rules(spark):
    urls = list(enumerate(URLS)) + [(3, URLS[8]), (None, URLS[8])]
    check(spark, urls, queries.URL_RULES)
    check(spark, urls, queries.URL_RULES, default="block")


def test_nested_rules(spark):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "ab", "org"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: "".join(rng.choice(["/", "/a", "b", "/ab"]) for _ in range(rng.randrange(4)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(3), path()) for _ in range(60))}.values())
    check(spark, [(i, f"s://{host(5)}{path()}") for i in range(500)], rules)


def test_empty_tables(spark):
    check(spark, [], queries.URL_RULES)
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id int, url string")
    found = judge(pages, spark.createDataFrame([], RULES_SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(1, "x.org", "/a", None, "allow")]
    none = spark.createDataFrame([(None, "/", "block"), ("org", None, "block")], RULES_SCHEMA)
    assert judge(pages, none).first().rule is None


def test_hot_host_is_spread(spark):
    urls = [(i, f"http://hot.org/es/{i}") for i in range(9000)]
    check(spark, urls, queries.URL_RULES)
