"""Host, path and rules against plain Python, and the regression on urls it was not trained on."""

from __future__ import annotations

import random

from clickscope.llm import urls as U
from tests.conftest import sf_dir


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = ""
    while rest and rest[0] not in "/?#":
        host, rest = host + rest[0], rest[1:]
    path = ""
    while rest and rest[0] not in "?#":
        path, rest = path + rest[0], rest[1:]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules=U.RULES):
    fits = [
        (len(h) + len(p), len(h), h + p, v) for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else None


ODD = [
    None, "", "no scheme", "://", "http://", "http:///en/x", "https://Example.COM/en/a?b#c", "http://www.example.com/en/",
    "http://www.example.com/EN/", "http://a.www.example.com/en/x", "http://xexample.com/en/x", "http://com/x", "http://com",
    "x://net/es/", "x://net/es", "x://a.net?/es/", "x://a.net#/es/", "x://a.net/fr/#", "http://ÄÉ.net/fr/é", "a://b://c/d",
    "http://.com/", "http://com./", "http://a..com/x", "http://user@example.com:80/en/", "https://example.com/en/\nx",
    "http://example.com//en/", "http://net/es/" + "long/" * 40_000, "http://" + "sub." * 5_000 + "net/fr/x", "http://x.io",
]


def test_parts_rules_and_repeats(spark):
    r = random.Random(4)
    hosts = ["example.com", "www.example.com", "M.Example.com", "net", "a.net", "org", "com", "b.org", ""]
    urls = ODD + [
        r.choice(["http://", "https://", "", "ftp://"]) + r.choice(hosts) + r.choice(["", "/", "/en/", "/es/1", "/fr/", "/en"])
        + r.choice(["", "?q=/en/", "#/fr/", "?a#b"]) for _ in range(300)
    ]
    rows = [(k, u, "html", "host", 1.0) for k, u in enumerate(urls)] + [(None, ODD[6], None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, score double").repartition(4)
    got = {x.page_id: x for x in U.judge_urls(df).collect()}
    judge = U.fit()
    assert len(got) == len(rows)
    for page, url, *_ in rows:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        x = got[page]
        assert (x.host, x.path) == (host, path) == U.split_url(url)
        assert (x.rule, x.score is None) == (rule[0] if rule else None, rule is not None), url[:80]
        if rule:
            assert x.verdict == rule[1]
        else:
            assert x.score == judge.score(host, path) and x.verdict == (U.BLOCK if x.score >= U.THRESHOLD else U.ALLOW)
    assert got[0].verdict == U.ALLOW and got[0].score == 0


def test_rules_of_equal_length_and_many():
    rules = [("block", "b.a.com", "/"), ("allow", "a.com", "/xx"), ("allow", "com", "/xx/y"), ("block", "com", "")]
    book = U.RuleBook(rules + [("allow", f"h{k}.org", "/") for k in range(5000)])
    assert book.find("b.a.com", "/xx") == ("b.a.com/", "block")
    assert book.find("c.b.a.com", "/xx/y") == ("b.a.com/", "block")
    assert book.find("a.com", "") == ("com", "block")
    assert book.find("z.h4999.org", "/q") == ("h4999.org/", "allow")
    assert book.find("xh7.org", "/q") is None and book.find("", "/") is None


def test_small_table_and_none():
    assert U.fit([]).score("a.org", "/x") < U.THRESHOLD
    judge = U.fit([("http://bad.org/x", 1), ("http://good.org/x", 0)])
    assert judge.score("bad.org", "/x") > 0.5 > judge.score("good.org", "/x")


def test_urls_it_was_not_trained_on():
    judge = U.fit()
    left_out = [
        "http://www.mega-casino.example.org/en/3", "https://casino-win.example.net/de/9", "http://new-bets.example.org/es/1/",
        "https://pills-cheap.example.net/en/", "http://spam-farm.example.net/de/12", "https://adult-x.example.net/fr/77.html",
        "http://blog.ads-track.example.net/en/5", "https://free-bets.example.net/de/40?x=1",
    ]
    kept = [
        "http://www.bridges.example.org/en/3", "https://poetry.example.net/de/9", "http://m.chemistry.example.org/es/1/",
        "https://ththin.example.net/en/210", "http://blog.therly.example.org/fr/1175", "https://village.example.net/en/5.html",
        "http://tionble.example.org/en/482/", "https://www.opera.example.net/de/40?x=1",
        "http://python.org/", "https://en.wikipedia.org/wiki/Spark", "http://x.io",
    ]
    assert all(judge.score(*U.split_url(u)) >= U.THRESHOLD for u in left_out)
    assert all(judge.score(*U.split_url(u)) < U.THRESHOLD for u in kept)


def test_hyphenated_hosts_of_the_pages(spark):
    """The invented hosts of the pages are plain syllables; the junk ones are two English words."""
    rows = U.judge_urls(spark.read.parquet(f"{sf_dir('0.1')}/pages.parquet")).where("rule is null").collect()
    junk = [r.verdict == U.BLOCK for r in rows if "-" in r.host]
    fine = [r.verdict == U.ALLOW for r in rows if "-" not in r.host]
    assert len(fine) > 1000 and all(fine) and all(junk)


def test_empty_table(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
