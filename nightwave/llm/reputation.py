"""URL filtering by rules, else by the empirical-Bayes reputation of the host. DataFrame functions only.

Labelled outcomes of pages are counted by host, registered domain and suffix. The suffix is the last two names of a host
where these are one of `suffixes` (a parameter, with a few usual ones as default; the public suffix list can be given),
else the last name; the registered domain is the suffix and the name before it. A port is no part of either, and an
address in numbers is its own domain and suffix. Each level's share of bad pages is shrunk towards the level above: with kappa prior pages, a group of n
pages with k bad ones has Beta(k + kappa * m, n - k + kappa * (1 - m)), m being the posterior mean above. kappa comes from
the data, by moments of the beta-binomial over the groups of the level. A url is blocked if the lower posterior bound
(mean - z deviations) of its host's bad share is over `limit`: hosts with few outcomes need strong neighbours to be blocked.

Counts are pre-aggregated by host before anything is joined; pages meet the host table in a join that adaptive
execution can split, as one host may have a third of all pages. Rules are a bounded parameter (`MAX_RULES`).

Defined cases: a null url or one without :// has empty host and path and no rule, and is judged by the reputation of the
empty host; null outcomes do not count; several outcomes of a page all count; with no outcomes nothing is blocked but by
rule; of rules of one length the longer host wins; repeated rows give repeated results; an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightwave.llm.common import written

MAX_RULES = 10_000
Z, LIMIT, KAPPA = 1.28, 0.25, (1.0, 1000.0)
#: Usual public suffixes of two names.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "co.in", "ac.jp", "co.jp", "or.jp", "co.kr", "com.mx", "co.nz", "com.tr", "co.za")


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def _suffixes(host: Column, most: int) -> Column:
    """The last 1, 2, ... `most` names of a host, as many as it has: longer ones fit no rule."""
    names = F.split(host, r"\.")
    last = F.slice(names, -F.least(F.size(names), F.lit(most)), F.lit(most))
    return F.transform(F.sequence(F.lit(1), F.size(last)), lambda i: F.array_join(F.slice(last, i, F.size(last)), "."))


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest of the (verdict, host, path) rules that fits, or null."""
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, name, start in rules:
        by_host.setdefault(name.lower(), []).append((start, verdict))
    if sum(map(len, by_host.values())) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    entry = lambda name: F.array(*[F.struct(F.lit(len(name + p)).alias("length"), F.lit(len(name)).alias("host_length"), F.lit(p).alias("path"), F.lit(name + p).alias("rule"), F.lit(v).alias("verdict")) for p, v in by_host[name]])
    known = F.create_map(*chain.from_iterable((F.lit(name), entry(name)) for name in sorted(by_host)))
    lists = F.filter(F.transform(_suffixes(host, max(name.count(".") + 1 for name in by_host)), lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull())
    best = F.array_max(F.filter(F.flatten(lists), lambda r: F.startswith(path, r["path"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _level(groups: DataFrame, key: str, above: str | None) -> DataFrame:
    """n, k by key, with the key of the level above."""
    keys = [key] + ([above] if above else [])
    return groups.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def _kappa(groups: DataFrame) -> Column:
    """A one-row table with kappa: moments of the beta-binomial over groups with outcomes."""
    seen = groups.filter("n > 0")
    whole = seen.agg(F.sum("n").alias("total"), (F.sum("k") / F.sum("n")).alias("m"), F.count(F.lit(1)).alias("g"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"), F.sum("k").alias("bad"))
    spread = F.col("kk") - F.col("m") * F.col("bad")  # sum of n * (p - m) ** 2
    room = F.col("total") - F.col("squares") / F.col("total")
    tau = (spread - (F.col("g") - 1) * F.col("m") * (1 - F.col("m"))) / F.nullif(room, F.lit(0.0))
    found = F.when(tau > 0, F.least(F.lit(KAPPA[1]), F.greatest(F.lit(KAPPA[0]), F.col("m") * (1 - F.col("m")) / tau - 1))).otherwise(KAPPA[1])
    return whole.select(F.coalesce("m", F.lit(0.0)).alias("m"), found.alias("kappa"))


def domain_and_suffix(host: Column, suffixes: Iterable[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    names = F.split(name, r"\.")
    last = lambda k: F.array_join(F.slice(names, -F.least(F.size(names), k), k), ".")
    number = name.rlike(r"^(\[.*\]|[0-9]+(\.[0-9]+){3})$")
    own = F.when(last(F.lit(2)).isin(*suffixes), 2).otherwise(1) if suffixes else F.lit(1)
    return F.when(number, name).otherwise(last(own + 1)), F.when(number, name).otherwise(last(own))


def host_reputation(pages: DataFrame, suffixes: Iterable[str] = SUFFIXES, z: float = Z) -> DataFrame:
    """host, n, k, mean, bound of every host of pages (host, bad = 1, 0 or null)."""
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    hosts = written(pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k"))
                    .withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = _level(hosts, "domain", "suffix")
    suffixes = _level(domains, "suffix", None)
    means = suffixes.crossJoin(_kappa(suffixes)).select("suffix", ((F.col("k") + F.col("kappa") * F.col("m")) / (F.col("n") + F.col("kappa"))).alias("m"))  # one row crossed
    shrink = lambda below, key, means: below.join(means, key).crossJoin(_kappa(below).select("kappa"))
    means = shrink(domains, "suffix", means).select("domain", ((F.col("k") + F.col("kappa") * F.col("m")) / (F.col("n") + F.col("kappa"))).alias("m"))
    a, b = F.col("k") + F.col("kappa") * F.col("m"), F.col("n") - F.col("k") + F.col("kappa") * (1 - F.col("m"))
    own = shrink(hosts, "domain", means).select("host", "n", "k", (a / (a + b)).alias("mean"), (a + b).alias("size"))
    return own.select("host", "n", "k", "mean", (F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Iterable[tuple[str, str, str]], limit: float = LIMIT, z: float = Z, suffixes: Iterable[str] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, bound of every page. outcomes: (page_id, bad), bad being 1 or 0."""
    host, path = url_parts()
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = outcomes.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).select(F.col("page_id").alias("o_page"), "bad")
    labelled = parts.select("page_id", "host").join(seen, F.col("page_id") == F.col("o_page"), "left").select("host", "bad")
    known = host_reputation(labelled, suffixes, z).select(F.col("host").alias("r_host"), F.round("bound", 6).alias("bound"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parts.hint("merge").join(known, F.col("host") == F.col("r_host")).withColumn("fit", rule)
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.verdict", F.when(F.col("bound") > limit, "block").otherwise("allow")).alias("verdict"), "bound")
