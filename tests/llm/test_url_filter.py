"""URL rules against a plain search through all rules."""

import random

import pytest
from pyspark.sql import functions as F

from barloom.llm import url_filter
from barloom.llm.catalog import URL_RULES

ODD = [
    None, "", "no scheme/at/all", "://", "http://", "http://ORG", "http://ORG/", "https://example.org/en/17?x#y", "https://example.org/en/2",
    "https://sub.Example.ORG/es/", "https://example.org/es", "https://notexample.org/es/x", "ftp://a.com/de/x", "http://com/fr/?://b.org/",
    "http://org:80/", "http://a.org./", "http://.org/", "http://x.com#/de/", "http://x.com?/de/", "a://b://org/", "http://é.ÀÉ.org/\n/es/",
    "http://" + "a." * 3000 + "org/" + "b/" * 3000,
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules, default):
    host, path = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if not fit:
        return host, path, None, default
    best = max(fit, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"))
    return host, path, best.host + best.path, best.verdict


def judge(spark, urls, rules, default="allow"):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules, default=default).collect()}


def test_given_rules(spark):
    got = judge(spark, ODD + ODD, URL_RULES)
    assert got == {i: plain(u, URL_RULES, "allow") for i, u in enumerate(ODD + ODD)}


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_many_rules_in_any_number_of_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", block)
    rng = random.Random(5)
    name = lambda: ".".join(rng.choice(["a", "b", "com", "", "xa"]) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["/", "/x", "/xy", "/é", "z"]) for _ in range(rng.randint(0, 4)))
    rules = [url_filter.rule(rng.choice(["allow", "block"]), f"{name()}/{path()}"[: rng.randint(1, 20)]) for _ in range(30 if block == 200 else 300)]
    urls = [f"http://{name()}/{path()}" for _ in range(400)] + ODD
    got = judge(spark, urls, rules, "block")
    assert got == {i: plain(u, rules, "block") for i, u in enumerate(urls)}


def test_no_rows_no_rules_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "url string, extra int")
    assert url_filter.filter_urls(empty, URL_RULES).columns == ["url", "extra", "host", "path", "rule", "verdict"]
    assert url_filter.filter_urls(empty, URL_RULES).count() == 0
    assert judge(spark, ["http://a.b/", None], [], "block") == {0: ("a.b", "/", None, "block"), 1: ("", "", None, "block")}
    with pytest.raises(ValueError):
        url_filter.filter_urls(empty.withColumn("Host", F.lit(1)), URL_RULES)
    with pytest.raises(ValueError):
        url_filter.rule("maybe", "org/")


def test_rules_are_broadcast_and_rows_not_shuffled(spark):
    plan = url_filter.filter_urls(spark.createDataFrame([("x",)], "url string"), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
