from __future__ import annotations

import random

from tariffloom.llm.url_filter import RULES, apply_rules, rule_table


def judge(url, rules=RULES, default="allow"):
    """The rules, read off their description."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_against_the_description(spark):
    rng = random.Random(1)
    hosts = ["org", "example.org", "a.example.org", "EXAMPLE.org", "notexample.org", "com", "x.com", "com.", ".org", "", "a..org", "É.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/x", "/fr/", "/de/9", "?q=/es/", "#/es/", "/x?y#z", "/ES/"]
    urls = [f"{s}{h}{p}" for h in hosts for p in paths for s in ("http://", "HTTPS://", "")] + [
        None, "", "://", "http://a://b/", "http://" + "a." * 3000 + "org/" + "p" * 9000]
    rows = [(rng.randint(0, 50), u) for u in urls] + [(1, "http://x.org/"), (1, "http://x.org/")]
    pages = spark.createDataFrame([(i, u, "h", "r", "v", "d") for i, u in rows], "page_id long, url string, host string, rule string, verdict string, digest string")
    got = sorted(map(str, map(tuple, apply_rules(pages, rule_table(spark)).collect())))
    assert got == sorted(str((i, *judge(u))) for i, u in rows)


def test_ties_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://b.a/xy"), (2, "http://q/")], "page_id long, url string")
    rules = [("allow", "b.a", "/x"), ("block", "a", "/xy"), ("allow", "a", "/xy"), ("block", "q", "/"), ("allow", "q", "/")]
    got = {r.page_id: (r.rule, r.verdict) for r in apply_rules(pages, rule_table(spark, rules)).collect()}
    assert got == {1: ("b.a/x", "allow"), 2: ("q/", "block")}
    assert {r.verdict for r in apply_rules(pages, rule_table(spark, []), default="block").collect()} == {"block"}
    assert apply_rules(pages.limit(0), rule_table(spark)).count() == 0
