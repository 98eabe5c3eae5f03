import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from spendlens.llm.queries import URL_RULES, op3
from spendlens.llm.url_sql import URL_SQL
from spendlens.llm.urls import Rule, host_reputation, judge_urls, longest_rule, split_url


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    end = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, rest[cut:max(cut, end)]


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host))
            and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.pattern)).pattern if fits else None


def test_split_and_rules(spark):
    r = random.Random(1)
    urls = [None, "", "x", "a://", "http://É.NET", "http://A.net/p?q#f", "http://a.net?x/y", "h://a#b?c/d",
            "://x.example.net/en/", "http://net/", "http://xnet/", "http://a.net", "u://a://b/c",
            "http://example.com/de/x", "http://b.org/fr/", "http://org/fr", "http://a.example.net/en/1"]
    urls += ["".join(r.choice(["http", "://", "/", "?", "#", ".net", ".org", "example", "EN", "fr", "/de/",
                               "é", "\n", "."]) for _ in range(r.randrange(9))) for _ in range(600)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    host, path = split_url(F.col("url"))
    df = df.select("i", host.alias("h"), path.alias("p"))
    got = df.withColumn("r", longest_rule(F.col("h"), F.col("p"), URL_RULES)["pattern"]).collect()
    for x in got:
        assert (x.h, x.p) == plain_split(urls[x.i]), urls[x.i]
        assert x.r == plain_rule(x.h, x.p, URL_RULES), urls[x.i]


def plain_reputation(rows, z=1.6449):
    hosts = defaultdict(lambda: [0, 0])
    for h, bad in rows:
        hosts[h][0] += bad is not None
        hosts[h][1] += bool(bad)
    domain = lambda h: ".".join(h.split(".")[-2:])
    up = lambda groups, f: {g: [sum(v[i] for x, v in groups.items() if f(x) == g) for i in (0, 1)]
                            for g in map(f, groups)}
    domains = up(hosts, domain)
    suffixes = up(domains, lambda d: d.split(".")[-1])

    def strength(groups):
        g = [v for v in groups.values() if v[0]]
        n, k, m = sum(v[0] for v in g), sum(v[1] for v in g), len(g)
        if not n or m < 2 or k in (0, n):
            return 1e6
        p = k / n
        s = sum(v[0] * (v[1] / v[0] - p) ** 2 for v in g)
        t = (s - (m - 1) * p * (1 - p)) / (n - sum(v[0] ** 2 for v in g) / n)
        return 1e6 if t <= 0 else min(1e6, max(1.0, p * (1 - p) / t - 1))

    n, k = (sum(v[i] for v in suffixes.values()) for i in (0, 1))
    base = (k + 0.5) / (n + 1)
    a, b, c = map(strength, (suffixes, domains, hosts))
    ps = {x: (v[1] + a * base) / (v[0] + a) for x, v in suffixes.items()}
    pd = {x: (v[1] + b * ps[x.split(".")[-1]]) / (v[0] + b) for x, v in domains.items()}
    out = {}
    for h, v in hosts.items():
        p = (v[1] + c * pd[domain(h)]) / (v[0] + c)
        out[h] = p, max(0.0, p - z * math.sqrt(p * (1 - p) / (v[0] + c + 1)))
    return out


def test_reputation_against_plain_version(spark):
    r = random.Random(5)
    bad = {"bad.a.com": 0.95, "good.a.com": 0.05, "x.b.net": 0.5, "y.b.net": 0.6, "c.org": 0.1, "": 0.2,
           "one.bad.xyz": 0.9, "two.bad.xyz": 0.95}
    rows = [(h, r.random() < p if r.random() < 0.7 else None)
            for h, p in bad.items() for _ in range(r.randrange(3, 60))] + [("new.bad.xyz", None)]
    got = {x.host: x for x in host_reputation(
        spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    want = plain_reputation(rows)
    assert set(got) == set(want)
    for h, (p, lower) in want.items():
        assert got[h].bad_rate == pytest.approx(p) and got[h].lower == pytest.approx(lower)
    # an unlabelled host of a bad domain is worse than one of a good domain
    assert got["new.bad.xyz"].bad_rate > got["good.a.com"].bad_rate
    assert got["bad.a.com"].lower > 0.5 > got["good.a.com"].lower


def test_query_against_sql_and_both_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = sorted(map(tuple, op3(spark, sf).select("page_id", "host", "path", "rule", "verdict").collect()))
    assert got == sorted(con.execute(URL_SQL).fetchall()) and len(got) == 250
    pages = spark.createDataFrame([(i, f"http://h{i % 2}.x.com/p") for i in range(200)],
                                  "page_id bigint, url string")
    outcomes = pages.select("page_id", (F.col("page_id") % 2 == 0).alias("bad"))
    verdicts = {r.host: r.verdict for r in judge_urls(pages, outcomes, []).collect()}
    assert verdicts == {"h0.x.com": "block", "h1.x.com": "allow"}


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "http://a.net"), (2, ""), (3, "h://" + "a." * 60_000 + "com/x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn(
        "host", F.lit("z")).withColumn("bad", F.lit(3))
    outcomes = spark.createDataFrame([(1, True), (1, None), (None, True), (77, False)],
                                     "page_id bigint, bad boolean")
    got = judge_urls(pages, outcomes, [Rule("net/", "block")]).collect()
    assert len(got) == 5 and {r.verdict for r in got} <= {"allow", "block"}
    assert judge_urls(pages.limit(0), outcomes, []).count() == 0
    assert judge_urls(pages, outcomes.limit(0), []).count() == 5
