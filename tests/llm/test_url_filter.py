import random

import pytest

from sealframe.llm import url_filter
from sealframe.llm.url_filter import filter_urls, rule_table

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"), ("allow", "b.com/de/x"),
         ("block", "net"), ("allow", "net/a"), ("block", "both.net/a"), ("allow", "both.net/a")]
URLS = [None, "", "no scheme", "http://", "HTTP://Sub.Example.ORG/es/x?q#f", "http://example.org/en/123", "http://example.org/en/2", "http://notexample.org/es/",
        "http://example.org", "https://a.b.com/de/xy", "https://com/de/", "x://y.net?a", "x://y.net/ab", "x://z.both.net/abc", "a://b://c.org/", "http://..org/",
        "http://user:pw@a.org:80/", "http://ÄB.org/é/1", "http://e.com/fr/" + "l" * 5000, "http://a.org/x\ny"]


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    hits = []
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        p = "/" + p if "/" in rule else ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            hits.append((len(rule), len(h), verdict == "block", rule, verdict))
    best = max(hits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


@pytest.mark.parametrize("few", [True, False])
def test_against_plain_rules(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", 2)
    draw = random.Random(5)
    urls = URLS + [f"http://{draw.choice(['', 'a.', 'b.', 'example.'])}{draw.choice(['org', 'com', 'net', 'b.com', 'both.net'])}{draw.choice(['', '/', '/de/x', '/en/1', '/a', '?/de/'])}"
                   for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, URLS[5], "clash")] * 2, "page_id bigint, url string, rule string")
    rows = filter_urls(pages, rule_table(spark, RULES)).collect()
    assert len(rows) == len(urls) + 2
    want = {i: plain(u) for i, u in enumerate(urls)}
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows if r["page_id"]}
    assert got == {i: w for i, w in want.items() if i}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    some = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert filter_urls(none, rule_table(spark, RULES)).count() == 0
    assert filter_urls(some, rule_table(spark, RULES).where("false")).first()["verdict"] == "allow"


def test_a_long_rule(spark):
    """A path of any length is a rule."""
    long = "x" * 600
    pages = spark.createDataFrame([(1, f"http://c.a.b/{long}y"), (2, f"http://a.b/{long[1:]}"), (3, None)], "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, rule_table(spark, [("block", f"a.b/{long}"), ("allow", "b/x")])).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


@pytest.mark.parametrize("hot", [0.0, 0.001, 0.3, 1.0])
def test_common_urls(spark, monkeypatch, hot):
    """Whichever URLs count as hot, those without a host among them."""
    monkeypatch.setattr(url_filter, "HOT", hot)
    urls = [None] * 200 + ["http://example.org/es/"] * 150 + ["http://a.com/x"] * 80 + URLS
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(4)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, rule_table(spark, RULES)).collect()}
    assert got == {i: plain(u) for i, u in enumerate(urls)}
