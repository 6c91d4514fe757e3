import random

import duckdb

from gridmix.llm import queries, url_filter as uf
from llm_data import SF

SCHEMA = "page_id long, url string, host string, row string"


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in ((v, h, p or "") for v, h, p in rules)
           if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, 0, None, default))
    return host, path, best[3], best[4]


def got(spark, urls, rules):
    table = spark.createDataFrame([(i, u, "clash", "x") for i, u in enumerate(urls)], SCHEMA)
    frame = spark.createDataFrame(rules, "verdict string, host string, path string")
    rows = uf.judge(table, frame).collect()
    assert all(r.host == "clash" and r.row == "x" for r in rows)
    return sorted((r.page_id, *r.judged) for r in rows)


URLS = [None, "", "no scheme", "http://", "http://net", "http://NET/", "http://a.Example.NET/en/1?x=/de/#y", "http://xnet/",
        "https://example.com/de", "https://example.com/de/", "https://m.example.com/de/a://b", "x://example.org/fr/?",
        "http://.net/", "http://net./", "http://a..net//en/", "http://example.net#/en/", "http://example.net?/en/",
        "http://ÄB.net/é\n/", "http://user@a.net:80/", "http://a.net:80/", "://org/fr/", "a://b://org/fr/",
        "http://" + "x." * 5000 + "net/" + "en/" * 5000, "http://" + "y" * 300_000 + ".example.net/en/"]


def test_edges(spark):
    urls = URLS + URLS[:8]  # rows that repeat in all but the id
    assert got(spark, urls, uf.RULES) == [(i, *brute(u, uf.RULES)) for i, u in enumerate(urls)]


def test_rows_that_repeat_and_none(spark):
    rules = uf.query_rules(spark)
    rows = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    assert sorted((tuple(r) for r in uf.digest(rows, rules).collect()), key=str) == [
        (1, "a.net", "/", "net/", "block")] * 2 + [(None, "", "", None, "allow")]
    assert uf.digest(rows.limit(0), rules).collect() == []
    assert uf.digest(rows, rules.limit(0)).filter("verdict = 'allow' and rule is null").count() == 3


def random_rules(rng):
    labels = ["a", "b", "c", "net"]
    rules = {(rng.choice(["allow", "block"]), ".".join(rng.choices(labels, k=rng.randint(1, 3))),
              "".join(rng.choice(["/", "/a", "/b", "/ab/"]) for _ in range(rng.randint(0, 3)))) for _ in range(60)}
    urls = ["http://" + ".".join(rng.choices(labels, k=rng.randint(1, 5)))
            + "".join(rng.choice(["/", "/a", "/b", "/ab/", "/abc"]) for _ in range(rng.randint(0, 5))) for _ in range(400)]
    return sorted(rules) + [("block", None, "/"), ("block", "", ""), ("allow", "c", None)], urls


def test_rules_of_any_shape(spark):
    """Paths that end inside a segment, no path, both verdicts on one expression, ties of length."""
    rules, urls = random_rules(random.Random(1))
    assert got(spark, urls, rules) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_long_lists_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(uf, "BROADCAST_RULES", 0)
    rules, urls = random_rules(random.Random(2))
    assert got(spark, urls, rules) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_short_prefixes_are_confirmed(spark, monkeypatch):
    """With one digit of the digest most meetings are by chance; none of those stays."""
    monkeypatch.setattr(uf, "SHORT", 1)
    rules, urls = random_rules(random.Random(3))
    assert got(spark, urls, rules) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_plan_is_native(spark):
    plan = queries.QUERIES["op12_url_filter"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_query_matches_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    res = c.execute(uf.ORACLE)
    cols = [d[0] for d in res.description]
    rows = queries.QUERIES["op12_url_filter"](spark, SF).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(r[c] for c in cols) for r in rows), key=key) == sorted(res.fetchall(), key=key)
    assert len({r.rule for r in rows}) > 2
