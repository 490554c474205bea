"""URL filters: cascades against sets, judgements against brute force, odd URLs and lists."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from careflow.llm import url_filter
from careflow.llm.url_filter import Cascade, Filter, Params, in_list, judge

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
LISTED = [("spam.example.org",), ("bad.net",)]
URLS = ["http://a.example.com/en/1?x=/fr/", "https://www.example.com/en/2#top", "HTTP://WWW.EXAMPLE.COM/en",
        "https://x.www.example.com/en/", "http://b.com", "http://b.com?/", "http://b.com/", "http://net/es/1",
        "http://notnet/es/1", "http://b.net/fr", "http://b.net/fr/", "http://b.net/de/", "https://x.spam.example.org/",
        "https://spam.example.org", "https://notspam.example.org/", "http://c.bad.net/es/", "http://c.bad.net/de/",
        "no scheme", "", None, "://", "x://y://z.com/", "http://u:p@h.com:80/en/", "http://É.COM/Ü", "http://com/",
        "http://.com/", "http://a..net/es/", "http://a.com./", "http://line\nfeed.com/a\nb", "http://x.net/" + "e" * 200_000,
        "http://" + "s." * 3000 + "com/en/"]


def brute(url, rules, listed):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    under = lambda h: host == h or host.endswith("." + h)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if under(h) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[3:]
    return host, path, None, "block" if any(under(h) for h, in listed) else "allow"


def judged(spark, urls, rules=RULES, listed=LISTED, p=Params()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    return judge(pages, in_list(spark, rules, "host", "path", "verdict"), in_list(spark, listed, "host"), p)


@pytest.mark.parametrize("p", [Params(), Params(max_filter_keys=2)])
def test_judgements_equal_brute_force(spark, p):
    got = {r[0]: tuple(r)[1:] for r in judged(spark, URLS, p=p).collect()}
    assert got == {i: brute(u, RULES, LISTED) for i, u in enumerate(URLS)}


def test_more_rules_and_lists(spark):
    rules = RULES + [("example.com", "/e", "block"), ("net", "/es/", "allow"), ("b.net", "", "block"),
                     ("spam.example.org", "/ok/", "allow"), ("com", "/", "allow")]
    dead = [(None, "/", "block"), ("", "/", "block"), ("com/en", "", "block"), ("com", "en", "block"), ("com", None, "block")]
    urls = [u for u in URLS if u] + ["https://spam.example.org/ok/x", "http://q.example.com/eh"]
    got = {r[0]: tuple(r)[1:] for r in judged(spark, urls, rules + dead, [*LISTED, (None,), ("",)]).collect()}
    assert got == {i: brute(u, rules, LISTED) for i, u in enumerate(urls)}


def test_empty_tables_and_lists(spark):
    assert judged(spark, []).collect() == []
    rows = judged(spark, ["http://a.com/", None], [], []).collect()
    assert [tuple(r)[3:] for r in rows] == [(None, "allow")] * 2


@pytest.mark.parametrize("listed, others, bits", [(40, 3000, 4), (2000, 20_000, 4), (1, 500, 2), (300, 0, 16)])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, listed, others, bits):
    """Filters far too small, so that several levels are needed."""
    monkeypatch.setattr(url_filter, "KEY_BITS", bits)
    p = Params(most_sections=1)
    keys = spark.range(listed).select(F.concat(F.lit("l"), "id").alias("key"))
    universe = (spark.range(others).select(F.concat(F.lit("u"), "id").alias("key"))
                .unionByName(keys.where("key LIKE '%1'")))
    universe = universe.unionByName(universe)
    c = Cascade.build(keys, universe, 2 * (listed + others), "test", p)
    if others > 1000:
        assert len(c.filters) > 2
    every = universe.unionByName(keys).distinct()
    assert every.where(c.holds(F.col("key"), Filter.mask(F.col("key"))) != F.col("key").startswith("l")).count() == 0


def test_no_python_and_no_join_in_the_plan(spark):
    plan = judged(spark, URLS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert not re.search("Python|Arrow|Pandas", plan)
