import pytest
from pyspark.sql import functions as F

from nightwave.llm.queries import RULES
from nightwave.llm.reputation import domain_and_suffix, host_reputation, judge_urls, matching_rule, url_parts

PAGES = "page_id long, url string, host string, bad int"


def test_parts_and_rules(spark):
    rows = [(1, "HTTP://Ä.Example.NET/en/x?y#z"), (2, None), (3, "no scheme/net/"), (4, "x://a://b/c"), (5, "s://net"), (6, "s://net/"), (7, "s://notnet/"), (8, "s://WWW.example.com/de/1"), (9, "s://a.org/fr/#"), (10, "s://example.net?/en/"), (11, "s://host\nx/p")]
    host, path = url_parts()
    df = spark.createDataFrame(rows, "page_id long, url string").select("page_id", host.alias("host"), path.alias("path"))
    got = {r.page_id: (r.host, r.path, r.fit and tuple(r.fit)) for r in df.withColumn("fit", matching_rule(F.col("host"), F.col("path"), RULES)).collect()}
    assert got == {1: ("Ä.example.net", "/en/x", ("example.net/en/", "allow")), 2: ("", "", None), 3: ("", "", None), 4: ("a:", "//b/c", None), 5: ("net", "", None), 6: ("net", "/", ("net/", "block")),
                   7: ("notnet", "/", None), 8: ("www.example.com", "/de/1", ("example.com/de/", "block")), 9: ("a.org", "/fr/", ("org/fr/", "allow")), 10: ("example.net", "", None), 11: ("host\nx", "/p", None)}


def shrunk(hosts):
    """Means and sizes of the three levels, one group after another."""
    def kappa(groups):
        g = [(n, k) for n, k in groups.values() if n]
        total, bad = sum(n for n, _ in g), sum(k for _, k in g)
        m = bad / total
        room = total - sum(n * n for n, _ in g) / total
        tau = (sum(k * k / n for n, k in g) - m * bad - (len(g) - 1) * m * (1 - m)) / room if room else 0
        return m, min(1000, max(1, m * (1 - m) / tau - 1)) if tau > 0 else 1000
    def level(groups, cut):
        out = {}
        for name, (n, k) in groups.items():
            key = ".".join(name.split(".")[-cut:])
            out[key] = (out.get(key, (0, 0))[0] + n, out.get(key, (0, 0))[1] + k)
        return out
    domains = level(hosts, 2)
    suffixes = level(domains, 1)
    m, kap = kappa(suffixes)
    s = {x: (k + kap * m) / (n + kap) for x, (n, k) in suffixes.items()}
    kap = kappa(domains)[1]
    d = {x: (k + kap * s[x.split(".")[-1]]) / (n + kap) for x, (n, k) in domains.items()}
    kap = kappa(hosts)[1]
    return {x: (k + kap * d[".".join(x.split(".")[-2:])]) / (n + kap) for x, (n, k) in hosts.items()}


def test_shrinkage_equals_plain_arithmetic(spark):
    hosts = {"a.x.com": (40, 30), "b.x.com": (2, 2), "c.x.com": (0, 0), "a.y.com": (50, 1), "z.org": (10, 1), "q.z.org": (5, 4)}
    rows = [(h, int(i < k)) for h, (n, k) in hosts.items() for i in range(n)] + [("c.x.com", None)]
    got = {r["host"]: r["mean"] for r in host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got == pytest.approx(shrunk(hosts))
    assert got["a.y.com"] < got["c.x.com"] < got["b.x.com"]


def test_nulls_repeats_empty(spark):
    pages = spark.createDataFrame([(1, "s://bad.com/", "clash", None), (1, "s://bad.com/", "clash", None), (None, None, None, None), (3, "s://good.com/", None, 7)], PAGES)
    outcomes = spark.createDataFrame([(1, 1)] * 80 + [(3, 0)] * 900 + [(None, 1), (3, None)], "page_id long, bad int")
    got = sorted((r.page_id or 0, r.host, r.verdict) for r in judge_urls(pages, outcomes, ()).collect())
    assert got == [(0, "", "allow"), (1, "bad.com", "block"), (1, "bad.com", "block"), (3, "good.com", "allow")]
    assert {r.verdict for r in judge_urls(pages, outcomes.limit(0), RULES).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), outcomes, RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, outcomes, [("block", str(i), "/") for i in range(10_001)])


def test_domains_and_suffixes(spark):
    want = {"a.b.example.com": ("example.com", "com"), "www.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.org:8080": ("x.org", "org"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"),
            "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "localhost": ("localhost", "localhost"), "": ("", ""), "m." + "long." * 50_000 + "net": ("long.net", "net")}
    domain, suffix = domain_and_suffix(F.col("host"))
    got = {r["host"]: (r.d, r.s) for r in spark.createDataFrame([(h,) for h in want], "host string").select("host", domain.alias("d"), suffix.alias("s")).collect()}
    assert got == want
    assert spark.range(1).select(domain_and_suffix(F.lit("a.b.c.d"), ["c.d"])[0].alias("d")).first().d == "b.c.d"


def test_very_long_urls(spark):
    pages = spark.createDataFrame([(1, "s://a.net/" + "x" * 1_000_000), (2, "s://" + "h" * 1_000_000), (3, "s" * 1_000_000)], "page_id long, url string")
    got = {r.page_id: (len(r.host), len(r.path), r.verdict) for r in judge_urls(pages, spark.createDataFrame([], "page_id long, bad int"), RULES).collect()}
    assert got == {1: (5, 1_000_001, "block"), 2: (1_000_000, 0, "allow"), 3: (0, 0, "allow")}


def test_a_host_of_many_names(spark):
    import time
    urls = [(1, "http://" + "a." * 100_000 + "example.com/de/x", ""), (2, "http://" + "." * 100_000 + "net/", ""), (3, "http://" + "a" * 200_000 + "/", "")]
    pages = spark.createDataFrame(urls, "page_id long, url string, html string")
    outcomes = spark.createDataFrame([(1, 0)], "page_id long, bad int")
    start = time.perf_counter()
    got = {r.page_id: r.rule for r in judge_urls(pages, outcomes, RULES).collect()}
    assert got == {1: "example.com/de/", 2: "net/", 3: None} and time.perf_counter() - start < 30
