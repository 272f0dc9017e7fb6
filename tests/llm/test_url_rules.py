"""URL rules against brute force."""

from __future__ import annotations

import random

from visitloom.llm import url_rules


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(urls, rules, default="allow"):
    out = []
    for page_id, url in urls:
        host, path = parts(url)
        fit = [
            (len(h + p), h + p, v)
            for h, p, v in rules
            if h and p is not None and ("." + host).endswith("." + h) and path.startswith(p)
        ]
        best = max(fit, default=(0, None, default))
        out.append((page_id, host, path, best[1], best[2]))
    return sorted(out, key=str)


def got(spark, urls, rules, **options):
    pages = spark.createDataFrame(urls, "page_id long, url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    return sorted((tuple(r) for r in url_rules.judge_urls(pages, listed, **options).collect()), key=str)


ODD = [
    (1, None), (2, "no scheme/x"), (3, "http://"), (4, "http://EXAMPLE.com"), (5, "https://a.example.com/en/x?y#z"), (6, "x://com/"),
    (7, "http://example.com./en/"), (8, "http://ex\u00c4mple.COM:80/en/"), (9, "a://b://c.com/p"), (10, "http://com?/en/"), (None, "http://x.net/es/"),
    (11, "http://x.net/es/"), (11, "http://x.net/es/"), (12, "http://" + "a." * 3000 + "net/fr/"), (13, "http://notexample.com/en/"), (14, "\nhttp://x.net/fr/\n?"),
]
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"), ("a.example.com", "", "block"), ("net", "/fr/", "allow"), (None, "/", "block"), ("", "/", "block"), ("x.net", None, "block"),
]


def test_odd_urls(spark):
    rules = [r for r in RULES if r != ("net", "/fr/", "allow")]
    assert got(spark, ODD, RULES, salts=3) == brute(ODD, rules)


def test_random_nested_rules(spark):
    rng = random.Random(4)
    name = lambda: ".".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4)))
    rules = {(name(), path()): rng.choice(["allow", "block"]) for _ in range(80)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(i, f"http://{name()}{path()}") for i in range(400)]
    assert got(spark, urls, rules, salts=5) == brute(urls, rules)


def test_empty_tables(spark):
    assert got(spark, [], RULES) == []
    assert got(spark, ODD, [], default="block") == brute(ODD, [], "block")


def test_other_columns_and_native_plan(spark):
    pages = spark.createDataFrame([(1, "http://x.net/es/", "k", 3)], "page_id long, url string, key string, stack int")
    judged = url_rules.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert tuple(judged.first()) == (1, "x.net", "/es/", "net/es/", "block")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
