"""URL rules and the filter cascade."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from mailsift.llm import url_filter
from tests.llm.helpers import clashing

KEYS = "key string, listed boolean"


def test_a_cascade_is_exact_on_its_universe(spark):
    rng = random.Random(6)
    rows = [(f"host{n}.example", rng.random() < 0.2) for n in range(4000)] + [(None, False), ("host1.example", False)]
    universe = spark.createDataFrame(rows, KEYS)
    want = {}
    for key, listed in rows:
        want[key or ""] = want.get(key or "", False) or listed
    for cascade in (url_filter.Cascade(universe), url_filter.Cascade(universe, max_bytes=10)):
        got = cascade.is_listed(universe.select("key").distinct(), F.col("key")).collect()
        assert {(r.key or "", r.listed) for r in got} == set(want.items())


def test_empty_lists_list_nothing(spark):
    universe = spark.createDataFrame([("a", False)], KEYS)
    assert not url_filter.Cascade(universe).is_listed(universe.select("key"), F.col("key")).first().listed
    assert url_filter.Cascade(universe.limit(0)).is_listed(universe.select("key"), F.col("key")).count() == 1


def test_rules_hosts_and_paths(spark):
    cases = {
        "https://WWW.Shop.NET/x?q#f": ("www.shop.net", "/x", "net/", "block"),
        "http://example.net/en/1": ("example.net", "/en/1", "example.net/en/", "allow"),
        "http://a.example.net/english": ("a.example.net", "/english", "net/", "block"),
        "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "http://myexample.com/de/": ("myexample.com", "/de/", None, "allow"),
        "http://b.org/fr/?x": ("b.org", "/fr/", "org/fr/", "allow"),
        "http://spam-farm.example.org/fr/": ("spam-farm.example.org", "/fr/", "org/fr/", "allow"),
        "http://x.spam-farm.example.org/": ("x.spam-farm.example.org", "/", None, "block"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net?to=http://b.net/": ("a.net", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = clashing(spark.createDataFrame([(n, url) for n, url in enumerate(cases)], "page_id long, url string"))
    rows = url_filter.judge(df.unionByName(df.limit(1))).collect()
    assert len(rows) == len(cases) + 1 and rows[0].key == "own key"
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r.url
    assert url_filter.judge(df.limit(0)).count() == 0
