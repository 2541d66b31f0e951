"""Mined URL rules against a miner that tries every combination."""

from __future__ import annotations

import random
import time
from itertools import combinations

import pytest

from seatplan.llm import queries, url_rules

SCHEMA = "page_id long, url string, host string, path string, mined string, _url string, item string"


def brute(urls, labels, settings):
    """Blocked URLs by every combination of tokens with enough bad rows and confidence."""
    tokens = {u: _tokens(u) for _, u in urls}
    rows = [(tokens[u], 1 - labels[k]) for k, u in urls if k in labels]
    seen, rules = set(), []
    for held, bad in rows:
        if bad:
            for n in range(1, len(held) + 1):
                for c in combinations(sorted(held), n):
                    if c not in seen:
                        seen.add(c)
                        hits = [b for t, b in rows if t >= set(c)]
                        if sum(hits) >= settings.rows and sum(hits) >= settings.confidence * len(hits):
                            rules.append(set(c))
    return {k for k, u in urls if any(tokens[u] >= r for r in rules)}


def _tokens(url):
    rest = url.split("://", 1)[1]
    head, _, query = rest.partition("?")
    host, *path = head.split("/")
    host = host.lower()
    return {f"h:{x}" for x in host.split(".") if x} | {f"d:{host}"} | {f"p:{x}" for x in path if x} | {f"q:{x.split('=')[0]}" for x in query.split("&") if x.split("=")[0]}


def judged(spark, urls, labels, settings, rules=()):
    pages = spark.createDataFrame([(k, u, "a", "b", "c", "d", "e") for k, u in urls], SCHEMA)
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    return url_rules.judge(pages, spark.createDataFrame(list(rules), "verdict string, host string, path string"), marks, settings)


@pytest.mark.parametrize("seed", range(4))
def test_equals_all_combinations(spark, seed):
    rng = random.Random(seed)
    urls = []
    for k in range(160):
        keys = rng.sample("abcdef", rng.randint(0, 4)) + (["x", "y"] if rng.random() < 0.3 else [])
        urls.append((k, f"http://{rng.choice(['www', 'm'])}.{rng.choice(['one', 'two', 'six'])}.net/{rng.choice(['p', 'q'])}/{rng.choice(['en', 'de'])}?" + "&".join(f"{q}={k}" for q in keys)))
    bad = lambda u: ("a=" in u and "b=" in u) or ("six" in u and "/de" in u) or rng.random() < 0.15
    labels = {k: int(not bad(u)) for k, u in urls if k % 5}
    settings = url_rules.Settings(rows=4, confidence=0.8, widest=30)
    got = judged(spark, urls, labels, settings).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == brute(urls, labels, settings)


@pytest.mark.parametrize("generic", [False, True])
def test_repeated_long_urls_take_seconds(spark, generic):
    spam = "http://spam.biz/win?" + "&".join(f"k{j}=1" for j in range(40))
    urls = [(k, spam) for k in range(50)] + [(k, f"http://good{k % 7}.org/p{k}") for k in range(50, 300)]
    if generic:  # every key, the host and the path are in good pages as well
        urls = [(k, spam.replace("spam.biz/win", "good1.org/p")) for k in range(50)]
        urls += [(k, f"http://good1.org/p?k{k % 40}=1&k{(k * 7 + 3) % 40}=2") for k in range(50, 2050)]
    labels = {k: int(k >= 50) for k, _ in urls}
    began = time.time()
    got = judged(spark, urls, labels, url_rules.Settings()).collect()
    assert {r["page_id"] for r in got if r["verdict"] == "block"} == set(range(50))
    assert time.time() - began < 90


def test_explicit_rules_teach_where_asked(spark):
    urls = [(k, f"http://h{k % 5}.{'com' if k % 2 else 'org'}/{'de' if k % 3 else 'fr'}/{k}") for k in range(120)] + [(k, f"http://n.net/{'de' if k % 2 else 'fr'}") for k in range(200, 230)]
    rules = [("block", "com", "/de/"), ("block", "org", "/de/"), ("allow", "com", "/fr/"), ("allow", "org", "/fr/")]
    taught = {r["page_id"]: r for r in judged(spark, urls, {0: 1}, url_rules.Settings(learn_from_rules=True), rules).collect()}
    assert all((taught[k]["verdict"] == "block") == bool(k % 2) and taught[k]["rule"] is None for k in range(200, 230))
    assert taught[201]["mined"] == "p:de"
    plain = judged(spark, urls, {0: 1}, url_rules.Settings(), rules).collect()
    assert all(r["verdict"] == "allow" for r in plain if r["page_id"] >= 200)


def test_empty_tables(spark):
    assert judged(spark, [], {}, url_rules.Settings(learn_from_rules=True), queries.URL_RULES).collect() == []
    long = "http://x.org/" + "a/" * 5000 + "?" + "&".join(f"q{j}" for j in range(3000))
    got = judged(spark, [(1, long), (2, ""), (3, None), (1, long)], {1: 0, 2: 0, 3: 1}, url_rules.Settings(learn_from_rules=True), queries.URL_RULES).collect()
    assert sorted((r["page_id"], r["verdict"], r["rule"]) for r in got if r["page_id"] == 1) == [(1, "allow", "org/")] * 2
