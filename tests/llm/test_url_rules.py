from access_spark.llm.queries import URL_RULES
from access_spark.llm.url_rules import filter_urls

URLS = [
    "http://a.net/x", "http://NET/", "http://net", "https://example.net/en/1", "https://b.example.net/en/", "https://example.net/en",
    "https://badexample.net/en/1", "http://example.com/de/1", "http://www.example.com/DE/1", "http://example.com/", "http://x.org/fr/q?x=/de/",
    "http://org/fr/", "http://org.com/fr/", "no scheme", "", None, "://", "http://", "http:///en/", "ftp://h.net?x", "http://u@example.net/en/",
    "http://example.net:80/en/", "http://é.NET/en/#x", "a://b://c.net/", "http://a..net/", "http://.net/", "http://example.net//en/", "http://x.net/\n/y",
]


def by_hand(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, verdict string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, rules).collect()}
    assert out == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_rules_of_the_query(spark):
    check(spark, URLS, URL_RULES)


def test_nested_rules_and_many_equal_urls(spark):
    rules = [("block", "com", ""), ("allow", "a.com", ""), ("block", "a.com", "/x"), ("allow", "a.com", "/x/y/"), ("block", "b.a.com", "/x"), ("allow", "com", "/x/y/z/longest/"), ("block", "é.com", "/")]
    urls = [f"http://{h}{p}" for h in ("com", "a.com", "b.a.com", "c.b.a.com", "aa.com", "é.com", "x.é.com") for p in ("", "/", "/x", "/x/", "/x/y/", "/x/y/z/longest/", "/xé")]
    check(spark, urls * 3 + ["http://b.a.com/x/1"] * 500, rules)


def test_no_rows_no_rules_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/")], "page_id long, url string")
    assert filter_urls(pages.limit(0), URL_RULES).collect() == []
    assert sorted(str(r.page_id) + r.verdict for r in filter_urls(pages, URL_RULES).collect()) == ["1block", "1block", "Noneblock"]
    assert {r.verdict for r in filter_urls(pages, [("block", "org", "/")]).collect()} == {"allow"}
