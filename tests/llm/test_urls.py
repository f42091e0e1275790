from __future__ import annotations

from courierlens.llm.queries import URL_RULES
from courierlens.llm.urls import Rule, judge_urls

SCHEMA = "page_id long, url string, html string, host string, copies long"


def judged(spark, urls, rules=URL_RULES):
    rows = [(i, u, None, "clash", 7) for i, u in enumerate(urls)]
    found = judge_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.action), default=None)
    return host, path, best and best.host + best.path, best.action if best else "allow"


URLS = [
    None,
    "",
    "no scheme",
    "http://example.com/en/1",
    "http://WWW.Example.COM/en/1?x=/fr/",
    "http://www.example.com/EN/1",
    "http://m.www.example.com/en/#top",
    "http://notexample.com/en/",
    "http://example.com",
    "http://example.com?/en/",
    "http://net/es/",
    "http://a.net/es",
    "http://a.net/fr/x\ny",
    "http://É.net/fr/",
    "x://y://a.net/es/",
    "http:///en/",
    "http://.com/",
    "http://a.com/" + "p/" * 40000,
    "http://" + "a." * 5000 + "net/fr/",
]


def test_verdicts_equal_brute_force(spark):
    assert judged(spark, URLS) == {i: brute(u, URL_RULES) for i, u in enumerate(URLS)}


def test_general_rules_and_ties(spark):
    rules = [Rule("block", "b.com", "/a"), Rule("allow", "com", "/abc"), Rule("block", "a.b.com", "/")]
    urls = ["s://b.com/abc", "s://a.b.com/abc", "s://a.b.com/", "s://a.b.com/a", "s://com/abcd"]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(1, "http://a.com/")] * 5 + [(None, "http://a.net/es/")] * 3
    table = spark.createDataFrame(rows, "page_id long, url string")
    found = sorted((r.page_id or 0, r.verdict) for r in judge_urls(table, URL_RULES).collect())
    assert found == [(0, "block")] * 3 + [(1, "allow")] * 5
    assert judge_urls(table.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in judge_urls(table, []).collect()} == {"allow"}


def test_no_python_in_the_plan(spark):
    table = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = judge_urls(table, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
