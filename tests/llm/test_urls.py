import random
import re

from docmill.llm import urls
from docmill.llm.workspace import Workspace

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute(url, rules, listed=()):
    host, path = split(url)
    for own, named in ((rules, True), ([(h, p, "block") for h, p in listed], False)):
        hits = [(len(h + p), h + p, v) for h, p, v in own if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if hits:
            return host, path, max(hits)[1] if named else None, max(hits)[2]
    return host, path, None, "allow"


def check(spark, found, rules, listed):
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), spark.createDataFrame(listed, "host string, path string"))
    assert {r.page_id: tuple(r)[1:] for r in got.collect()} == {i: brute(u, rules, listed) for i, u in enumerate(found)}


def test_rules_and_list(spark):
    found = ["http://a.com/x", "https://www.EXAMPLE.com/en/1?q", "http://m.example.com/en/", "http://example.com/en", "http://x.net/es/1#f", "http://net/fr/", "http://xnet/fr/", "http://com", "http://com?x",
             "mailto:a@b.com", None, "", "://", "http:///p", "ftp://bad.org/a b/c", "http://bad.org/a", "x://y://bad.org/z", "http://bad.org\n/a", "http://a.bad.org/aÉ/"]
    check(spark, found, RULES, [("bad.org", "/a"), ("a.bad.org", "/aÉ"), ("example.com", "/en/")])


def test_long_list_against_brute_force(spark, monkeypatch):
    r = random.Random(3)
    name = lambda: ".".join(r.choice("abcd") * r.randrange(1, 3) for _ in range(r.randrange(1, 4)))
    path = lambda: "/" + "".join(r.choice("xy/") for _ in range(r.randrange(0, 5)))
    listed = sorted({(name(), path()) for _ in range(300)})
    found = [f"http://{name()}{path()}" for _ in range(500)] * 2
    monkeypatch.setattr(urls, "MAX_BLOCKS", 2)  # many false positives
    monkeypatch.setattr(urls, "BROADCAST_ROWS", 20)  # joins by shuffles
    check(spark, found, RULES, listed)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    work = Workspace(spark, "test")
    keys = spark.range(20_000).selectExpr("concat('h', id) AS host", "'/' AS path")
    bloom = urls.BlockedBloom(keys, 20_000, work)
    assert bloom.possible(keys).count() == 20_000
    assert bloom.possible(spark.range(50_000, 70_000).selectExpr("concat('h', id) AS host", "'/' AS path")).count() < 400


def test_repeated_null_and_empty(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (None, "http://a.com/", "y"), (2, None, None)], "page_id long, url string, host string").selectExpr("*", "1 AS salt", "2 AS block", "'z' AS verdict")
    got = urls.judge(pages, rules).collect()
    assert sorted((r.page_id or 0, r.rule or "") for r in got) == [(0, "com/"), (1, "com/"), (1, "com/"), (2, "")]
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}
