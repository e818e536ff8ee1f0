"""Parts, rules and features against plain Python; trees on held-out URLs."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from orderlens.llm import url_filter as urls

URLS = [
    "http://a.example.NET/x/1", "https://www.example.net/en/2?q=1&r=%20#top", "example.net/en/2", "", None, "http://",
    "ftp://EXAMPLE.com/de/", "http://example.com", "http://example.com?/de/", "http://notexample.com/de/x", "http://org/fr/ü?a=b=c",
    "http://x.org/fr", "http://a://net/b", "://net/", "http://net:80/x", "http://a-b.c.example.com/de/\nx?y#z?w", "HTTP://Ünet/é/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    found = []
    for rule, verdict in urls.RULES:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            found.append((len(rule), rule, verdict))
    return max(found)[1:] if found else (None, None)


def test_parts_and_rules_equal_plain_python(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    found = {r.page_id: r for r in urls.judged(df).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), url
        assert found[i].verdict == verdict if rule else found[i].verdict in ("allow", "block")


def test_the_longest_rule_wins_and_the_earlier_of_equals(spark):
    rules = (("com/", "block"), ("a.com/x", "allow"), ("com/x/yy", "block"), ("b.com/q", "block"), ("com/q/z", "allow"))
    df = spark.createDataFrame([(1, "http://a.com/z"), (2, "http://a.com/x/y"), (3, "http://a.com/x/yy"), (4, "http://b.com/q/z")], "page_id int, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in urls.judged(df, rules).collect()}
    assert found == {1: ("com/", "block"), 2: ("a.com/x", "allow"), 3: ("com/x/yy", "block"), 4: ("b.com/q", "block")}


def plain_features(url):
    url = url or ""
    host, path = parts(url)
    query = re.match(r"[^?#]*\?([^#]*)", url)
    query = query[1] if query else ""
    kinds = Counter(c if c in urls.ALPHABET else "other" for c in url.lower())
    n = len(url)
    return {
        "url_length": n, "host_length": len(host), "path_length": len(path), "host_labels": host.count(".") + 1 if host else 0,
        "path_depth": path.count("/"), "digit_ratio": sum(c in "0123456789" for c in url) / n if n else 0,
        "entropy": -sum(k / n * math.log2(k / n) for k in kinds.values()) if n else 0,
        "parameters": query.count("&") + 1 if query else 0, "query_length": len(query), "hyphens": host.count("-"),
        "escapes": url.count("%"), "secure": url.startswith("https://"), "fragment": "#" in url,
    }


def test_features_equal_plain_python(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    for row in urls.with_features(urls.with_parts(df)).collect():
        for name, value in plain_features(row.url).items():
            assert row[name] == pytest.approx(float(value), abs=1e-9), (row.url, name)


def made(seed, count):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("aeiourstln") for _ in range(draw.randint(4, 8)))
    for _ in range(count):
        if draw.random() < 0.5:
            noise = "&".join(f"{word()}={draw.randint(10**6, 10**9)}" for _ in range(draw.randint(2, 5)))
            yield f"http://{word()}-{draw.randint(10, 999)}.biz/{draw.randint(1000, 9999)}?{noise}", True
        else:
            yield f"https://www.{word()}.org/{word()}/{word()}", False


def test_held_out_accuracy_and_repeats(spark):
    schema = "url string, blocked boolean"
    train, held = spark.createDataFrame(list(made(1, 600)) * 2, schema), spark.createDataFrame(list(made(2, 300)), schema)
    model = urls.UrlModel(train, max_per_class=250)
    scored = model.judge(urls.with_parts(held)).select("blocked", "p_block").collect()
    assert len(scored) == 300
    assert sum(r.blocked == (r.p_block >= 0.5) for r in scored) >= 290
    pages = held.select(F.monotonically_increasing_id().alias("page_id"), "url")
    judged = urls.judged(pages.unionByName(pages), labelled=train)
    assert judged.count() == 600 and judged.distinct().count() == 300


def test_nothing_to_learn_allows(spark):
    schema = "page_id long, url string"
    df = spark.createDataFrame([(1, "http://net/"), (1, "http://net/"), (2, "http://other.de/"), (None, None)], schema)
    found = sorted((str(r.page_id), r.rule, r.verdict) for r in urls.judged(df).collect())
    assert found == [("1", "net/", "block"), ("1", "net/", "block"), ("2", None, "allow"), ("None", None, "allow")]
    assert urls.judged(spark.createDataFrame([], schema)).collect() == []


def test_long_urls_and_other_columns(spark):
    rows = [(i, f"http://{h}/{'p' * i}?{'k=v&' * 200_000 if i == 3 else ''}", "h", 1.0, True) for i, h in enumerate(["x.net", "org", "b.com"] * 20)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, suffix1 double, blocked boolean")
    found = urls.judged(df)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "p_block"]
    assert {r.page_id for r in found.collect()} == set(range(60))


def test_no_python_on_the_main_path(spark):
    rows = [(i, u) for i, (u, _) in enumerate(made(4, 200))]
    labelled = spark.createDataFrame(list(made(5, 200)), "url string, blocked boolean")
    model = urls.UrlModel(labelled)
    assert model.trees is not None
    table = spark.createDataFrame(rows, "page_id long, url string")
    plan = plan_of(model.judge(urls.with_parts(table)))
    assert "Python" not in plan.replace("PythonRDD", "") and "Arrow" not in plan and "Pandas" not in plan
