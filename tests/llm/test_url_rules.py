import re

from tallyfold.llm.url_rules import PATTERN_RULES, SITE_RULES, judge_urls

SCHEMA = "page_id long, url string, host string, tokens int"
URLS = ["http://a.net/", "http://net/", "http://net", "http://a.net", "http://xnet/", "https://EXAMPLE.net/en/1?x=/fr/", "http://a.b.example.net/de/",
        "http://example.com/de/", "http://example.com/de", "http://notexample.com/de/", "http://x.org/fr/", "http://x.org/en/fr/",
        "http://a.org:80/fr/", "no scheme", "", None, "http://", "http:///path", "ftp://u@h.net/#net/", "http://a.net?q=/", "http://casino-x.y.z/",
        "https://free-bets.q.org/a", "http://cheap-pills.com/fr/", "http://m.cheap-pills.org/fr/1", "http://a/b?c://d.net/", "http://a.NET/EN/",
        "http://example.net/EN/", "http://x\n.net/"]


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for action, rule in SITE_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    own = next((p for a, p, _ in PATTERN_RULES if a == "block" and re.search(p, host + path)), None)
    return host, path, best and best[1], best[0] if best else "block" if own else "allow", own


def test_equals_plain_rules(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], "x", 1), (0, URLS[0], "x", 1)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r)[:6] for r in judge_urls(pages).collect()]
    assert got == [(i, *judge(u)) for i, u, _, _ in rows]
    assert judge_urls(pages.limit(0)).count() == 0


def test_only_fetched_rules_are_tested(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.example.com/en/{i}", "x", 1) for i in range(20)] + [(99, "http://a.net/", "x", 1)], SCHEMA)
    tested = {r.page_id: r.n_tested for r in judge_urls(pages).collect()}
    assert tested[99] >= 1 and tested[0] <= 2


def test_every_alternative_of_a_rule_fires(spark):
    urls = ["http://x.com/adserver/1", "http://x.com/popunder/1", "http://x.com/a/popunder/adserver/", "http://x.com/adserver", "http://adserver/x",
            "http://x.com/ADSERVER/1", "http://x.com/popunder/adserver/?"] + ["http://h.com/popunder"] * 5
    for own in (urls, urls[:1], urls[1:2]):
        pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(own)], SCHEMA)
        got = judge_urls(pages).collect()
        assert [tuple(r)[:6] for r in got] == [(i, *judge(u)) for i, u in enumerate(own)]
        assert all(r.n_tested <= 2 for r in got)
