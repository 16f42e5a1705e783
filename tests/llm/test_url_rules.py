"""URL verdicts against trying every rule."""

import random

from assortment.llm import url_rules
from assortment.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plain(url, rules, otherwise="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h) + len(p), len(h), v, h + p) for v, h, p in ((v, h, p or "") for v, h, p in rules if h is not None)
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, otherwise
    best = max(fits, key=lambda f: (f[0], f[1], f[2]))
    return host, path, best[3], best[2]


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, row int")
    frame = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    got = url_rules.judged(pages.repartition(4), frame).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}


def test_query_against_every_rule(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect()
    expected = {(r["page_id"], *plain(r["url"], rules)) for r in pages}
    assert {tuple(r) for r in QUERIES["op3_url_rules"](spark, DATA).collect()} == expected


def test_random_nested_rules(spark):
    rng = random.Random(4)
    label = lambda: rng.choice(["a", "b", "a-b", "ab", "é", "a,b", "x\x01", "x\x02a", "\x00"])
    host = lambda most: ".".join(label() for _ in range(rng.randint(1, most)))
    path = lambda: rng.choice(["", "/", "/a", "/a/", "/a/b", "/ab", "/é", "/a\x01", "/\U0010ffff"]) + rng.choice(["", "/a", "b", "\U0010ffff"])
    rules = [(rng.choice(["block", "allow"]), host(3), path()) for _ in range(80)]
    rules += [("block", "a", "/"), ("allow", "a", "/"), ("block", "a.b", ""), ("allow", "b", "/x"), ("block", "a.b", "/")]
    urls = [f"http://{host(5)}{path()}{rng.choice(['', '?q=://a', '#f'])}" for _ in range(400)] + ["http://a" + "/" * 5000]
    assert run(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_hard_rows(spark):
    rules = [("block", None, "/"), ("block", "net", None), ("allow", "A.Net", "/x"), ("block", "", "/e")]
    urls = [None, "", "no scheme", "http://", "HTTP://A.NET/X", "http://a.net/x/y", "http://a.net", "http://a.net?x/y", "://net", "http:///e/f", "x://y.net\n/z"] * 2
    assert run(spark, urls, rules) == {i: plain(u, [(v, h and h.lower(), p) for v, h, p in rules]) for i, u in enumerate(urls)}
    assert {v[2:] for v in run(spark, urls, []).values()} == {(None, "allow")}
    assert run(spark, [], rules) == {}


def test_hot_host(spark):
    rules = [("block", "example.net", "/en/"), ("allow", "net", "/")]
    urls = ["http://hot.example.net/en/1"] * 3000 + [f"http://h{i}.example.net/fr/{i}" for i in range(3000)]
    assert run(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_native_plan(spark):
    plan = QUERIES["op3_url_rules"](spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
