"""URL filters against a union-find over the same links, and against their SQL."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from tillflow.llm import queries
from tillflow.llm.oracle import ORACLES
from tillflow.llm.url_filter import ALLOW, BLOCK, Rule, alias_links, judge_urls

RULES = queries.URL_RULES


def canonical(url: str) -> str:
    return f'<head><link rel="canonical" href="{url}"></head>'


PAGES = [
    (1, "http://a.example.net/fr/1", "<p>blocked by its host</p>"),
    (2, "https://X.Example.NET/en/1?q#top", "<p>allowed by the longer rule</p>"),
    (3, "http://shop.example.org/de/1", canonical("http://a.example.net/fr/1?from=shop")),
    (4, "http://shop.example.org/de/2", canonical("https://spam.example.com/de/x")),
    # A chain: 5 to 6 to a blocked address that is no page.
    (5, "http://one.example.org/a/b?x=1", '<meta http-equiv="refresh" content="0; url=/c?x=1&amp;y=2">'),
    (6, "https://one.example.org/c?x=1&y=2#part", "<LINK\nHREF='//spam.example.com/de/y' REL='alternate canonical'>"),
    # Blocked and allowed aliases: the allowed one speaks for the class.
    (7, "http://two.example.org/1", canonical("http://spam.example.com/de/z")),
    (8, "http://two.example.org/2", canonical("http://two.example.org/1")),
    (9, "http://two.example.org/fr/3", canonical("http://two.example.org/2")),
    (10, "http://spam.example.com/de/z", None),
    # No links: in comments, scripts, other tags and to no address.
    (11, "http://three.example.org/1", f'<!-- {canonical("http://a.net/")} --><a href="http://a.net/">'),
    (12, "http://three.example.org/2", f'<script>"{canonical("http://a.net/")}"</script>'),
    (13, "http://three.example.org/3", canonical("mailto:me@a.net") + canonical("") + canonical("#x")),
    (14, "http://three.example.org/4", '<link rel="canonical-not" href="http://a.net/"><link rel=icon href=http://a.net/>'),
    (15, "http://three.example.org/5", '<link data-href="http://a.net/" rel=canonical>'),
    (16, None, canonical("http://a.net/")),
    (17, "no address/at all", canonical("http://a.net/")),
    (18, "http://net", "path is empty, so the rule of the host does not fit"),
    (18, "http://net", "path is empty, so the rule of the host does not fit"),
    (None, "http://one.example.org/x/y", canonical("z")),
    (20, "http://one.example.org/x/z", canonical("?a=1")),
    (21, "http://one.example.org/x/z?a=1", "<link rel=canonical href=http://q.net/ >"),
    (22, "ftp://ünï.example.org:80/ſ?x://y", "<!-- never closed " + canonical("http://a.net/")),
    (23, "http://.net/", ""),
    (24, "http://" + "long." * 2000 + "net/" + "p/" * 5000, "x" * 100_000),
]
BY_RULE = {
    1: ("net/", BLOCK), 2: ("example.net/en/", ALLOW), 9: ("org/fr/", ALLOW),
    10: ("example.com/de/", BLOCK), 24: ("net/", BLOCK), 23: ("net/", BLOCK),
}
BY_ALIAS = {3: None, 4: BLOCK, 5: BLOCK, 6: BLOCK, 7: ALLOW, 8: ALLOW, None: BLOCK, 20: BLOCK, 21: BLOCK}


def pages_of(spark, rows=PAGES):
    rows = [(*r, "x", "y") for r in rows]
    return spark.createDataFrame(
        rows, "page_id bigint, url string, html string, node string, rule string"
    )


def test_rules_and_aliases(spark):
    # The canonical address of 3 is itself under a rule.
    found = judge_urls(pages_of(spark), RULES).collect()
    assert len(found) == len(PAGES)
    for r in found:
        key = r["page_id"]
        if key in BY_RULE:
            assert (r["rule"], r["verdict"]) == BY_RULE[key], key
        else:
            expected = BLOCK if key == 3 else BY_ALIAS.get(key)
            assert (r["rule"], r["passed"]) == (None, expected), key
            assert r["verdict"] == (expected or ALLOW)
    hosts = {r["page_id"]: (r["host"], r["path"]) for r in found}
    assert hosts[2] == ("x.example.net", "/en/1") and hosts[16] == hosts[17] == ("", "")
    assert hosts[18] == ("net", "") and hosts[22] == ("ünï.example.org:80", "/ſ")


def test_empty_tables(spark):
    nothing = pages_of(spark).limit(0)
    assert judge_urls(nothing, RULES).count() == 0
    assert alias_links(nothing).count() == 0
    no_rules = spark.createDataFrame([], "action string, host string, path string")
    for rules in ([], no_rules):
        verdicts = {r["verdict"] for r in judge_urls(pages_of(spark), rules).collect()}
        assert verdicts == {ALLOW}


def test_a_table_of_rules_is_the_same_as_a_list(spark):
    more = [*RULES, Rule(ALLOW, "example.com", "/de/z"), Rule(BLOCK, "two.example.org", ""),
            Rule(ALLOW, "com", "/de/x/"), Rule(BLOCK, "org", "/fr/")]
    table = spark.createDataFrame(more, "action string, host string, path string")
    columns = ("page_id", "host", "path", "rule", "verdict", "passed")

    def rows(rules):
        return Counter(tuple(r) for r in judge_urls(pages_of(spark), rules).select(*columns).collect())

    assert rows(table) == rows(more)
    with pytest.raises(ValueError, match="table"):
        judge_urls(pages_of(spark), more * 100)


def test_the_sql_says_the_same(spark, tmp_path):
    folder = str(tmp_path)
    pages_of(spark).write.parquet(f"{folder}/pages.parquet")
    found = queries.op13_url_filter(spark, folder)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{folder}/pages.parquet/*.parquet')")
    expected = con.execute(ORACLES["op13_url_filter"])
    names = [d[0] for d in expected.description]
    assert Counter(tuple(r) for r in found.select(*names).collect()) == Counter(expected.fetchall())


def test_given_redirects_by_force(spark):
    rng = random.Random(3)
    urls = [f"http://h{i}.example.{rng.choice(['org', 'com'])}/{rng.choice(['de', 'fr', 'it'])}/{i}" for i in range(300)]
    # One address has a third of all links, the rest are chains and pairs.
    links = [(rng.choice(urls), urls[0]) for _ in range(60)] + [
        (rng.choice(urls), rng.choice(urls)) for _ in range(80)
    ]
    parent = {u: u for u in urls}

    def find(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for a, b in links:
        parent[find(a)] = find(b)

    def ruled(url):
        if ".com/de/" in url:
            return BLOCK
        return ALLOW if ".org/fr/" in url else None

    said = {}
    for u in {x for link in links for x in link}:
        if ruled(u):
            said[find(u)] = min(said.get(find(u), BLOCK), ruled(u))
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    table = spark.createDataFrame(links, "source string, target string")
    found = judge_urls(pages, RULES, table, html_col=None).collect()
    touched = {x for link in links for x in link}
    for r in found:
        passed = said.get(find(r["url"])) if r["url"] in touched else None
        assert r["verdict"] == (ruled(r["url"]) or passed or ALLOW)
    assert len(found) == 300
