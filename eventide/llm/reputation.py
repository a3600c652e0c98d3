"""URL filter: path rules first, empirical-Bayes host reputation for the rest.

Rules are (host, path prefix, verdict).  A rule fits its host and all
subdomains where the URL's path starts with its path; the longest rule wins.
Pages that no rule decides get the verdict of their host's reputation: labelled
outcomes (1: bad) are counted per host and shrunk through beta-binomial priors,
suffix -> registered domain -> host.  Each level's prior has the parent's
posterior mean and a strength fitted by moments over the whole level.  A host
is blocked if even the lower bound of its posterior bad rate is above a limit.

Defined cases: a null URL, or one without "://", has an empty host and path and
no rule; such pages and hosts without outcomes get their parent's reputation
(the global one at the top), and are allowed where there are no outcomes at
all.  The suffix of a host is its last label, or its last two where these are a
public suffix (``co.uk``), and the registered domain has one label more; a port
and a user name are no part of them, and addresses are domains of their own
under one suffix.  Repeated rows are judged and counted one by one; empty tables give empty
results; clashing columns of the input are replaced.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.scratch import materialize

OWN = ["host", "path", "rule", "verdict", "bad_rate", "bad_rate_low"]
#: Suffix that all hosts share which are addresses.
ADDRESS = "[address]"
#: Public suffixes of two labels that are taken for one suffix; a
#: caller with the whole public list passes it.
PUBLIC_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk",
    "com.au", "net.au", "org.au",
    "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "co.nz", "co.za",
    "com.ar", "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw",
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path): between the first "://" and the first
    of / ? # or the end; then up to ? or # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def last_labels(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def domain_of(host: Column, public_suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    address = name.rlike(r"^(\d{1,3}\.){3}\d{1,3}$|^\[")
    two = last_labels(name, 2).isin(list(public_suffixes))
    domain = F.when(address, name).when(two, last_labels(name, 3)).otherwise(last_labels(name, 2))
    suffix = F.when(address, ADDRESS).when(two, last_labels(name, 2)).otherwise(last_labels(name, 1))
    return domain, suffix


def junk_outcome(html: Column, min_words: int = 20) -> Column:
    """A page's outcome from its visible text: 1 if a fifth of the words carry
    runs of marks, or if fewer than three in ten are different; 0 if not; null
    (no outcome) for a null page or one of fewer than ``min_words`` words."""
    text = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    marked = F.filter(words, lambda w: w.rlike(r"!!|[*$%#&]{3}"))
    bad = (F.size(marked) * 5 > F.size(words)) | (F.size(F.array_distinct(words)) * 10 < F.size(words) * 3)
    return F.when(F.size(words) >= min_words, bad.cast("int"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host the rules of the host itself and of its parents, longest
    first.  Equally long rules: the one with the longer host, then by name."""
    parts = F.split(F.col("host"), r"\.")
    parents = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, n, F.size(parts)), "."))).alias("rule_host"))
    fit = parents.join(rules, "rule_host").select("host", F.struct(
        (-F.length("rule")).alias("order1"), (-F.length("rule_host")).alias("order2"),
        "rule", "rule_path", "rule_verdict").alias("r"))
    return fit.groupBy("host").agg(F.sort_array(F.collect_set("r")).alias("rules"))


def level(stats: DataFrame, key: str, parent: str, prior: DataFrame, own: str) -> DataFrame:
    """Posterior of one level, written: a row per key with ``{own}_mean`` and
    ``{own}_n``.  ``stats`` (key, parent, n, bad), ``prior`` (parent, p_mean).
    The prior's strength comes from moments over the whole level: the spread of
    rates beyond what binomial noise explains.  It is one number, so it alone
    comes to the driver."""
    j = materialize(stats.join(prior, parent), f"{own}-stats")
    noise = F.col("p_mean") * (1 - F.col("p_mean"))
    f = j.select(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("p_mean"), 2)).alias("ss"),
                 F.sum(noise).alias("noise"), F.sum(F.col("n") * noise).alias("full")).first()
    # E[ss] = noise + (full - noise) * rho, with strength = 1 / rho - 1
    spare = (f["full"] or 0.0) - (f["noise"] or 0.0)
    rho = (f["ss"] - f["noise"]) / spare if spare else 0.5
    strength = 1 / max(0.01, min(0.99, rho)) - 1
    size = F.lit(strength) + F.col("n")
    return materialize(j.select(key, ((F.col("p_mean") * strength + F.col("bad")) / size).alias(f"{own}_mean"),
                                size.alias(f"{own}_n")), f"{own}-level")


def host_reputation(outcomes: DataFrame, public_suffixes: Sequence[str] = PUBLIC_SUFFIXES
                    ) -> tuple[DataFrame, DataFrame, DataFrame, float | None]:
    """``outcomes``: one row per labelled page with host and bad (0 or 1).
    Returns suffix, domain and host posteriors in three written tables, and the
    bad rate of all (None without outcomes)."""
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domain, suffix = domain_of(F.col("host"), public_suffixes)
    hosts = materialize(outcomes.filter(F.col("bad").isNotNull())
                        .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
                        .select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts).withColumn("all", F.lit(1))
    rate = domains.agg((F.sum("bad") / F.sum("n")).alias("p")).first()["p"]
    top = suffixes.sparkSession.createDataFrame([(1, rate)], "all int, p_mean double")
    sfx = level(suffixes, "suffix", "all", F.broadcast(top), "suffix")      # one row
    dom = level(domains, "domain", "suffix", sfx.withColumnRenamed("suffix_mean", "p_mean"), "domain")
    hst = level(hosts, "host", "domain", dom.withColumnRenamed("domain_mean", "p_mean"), "host")
    return sfx, dom, hst, rate


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], outcome: Column | None = None,
               url_col: str = "url", limit: float = 0.5, z: float = 1.645,
               public_suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> DataFrame:
    """All columns of ``pages`` with host, path, rule, verdict, bad_rate and
    bad_rate_low.  ``outcome``: a column over ``pages`` that labels a page bad
    (1), good (0) or not at all (null); without one, the pages that rules
    decide are the labelled ones."""
    spark = pages.sparkSession
    host, path = split_url(F.col(url_col).cast("string"))
    keep = [c for c in pages.columns if c not in OWN]
    label = F.lit(None) if outcome is None else outcome
    base = pages.select(*keep, host.alias("host"), path.alias("path"), label.cast("int").alias("__bad"))
    base = materialize(base, "urls")            # labels are looked up once
    table = spark.createDataFrame(
        [(h.lower(), p, h + p, v) for h, p, v in rules] or [("\0", "", "", "allow")],
        "rule_host string, rule_path string, rule string, rule_verdict string")
    hosts = base.select("host").distinct()
    # one row per host, written, so that AQE may split a host with very many pages
    fits = materialize(hosts.join(host_rules(hosts, table), "host", "left"), "host-rules")
    won = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    ruled = (base.join(fits, "host")
             .withColumn("__won", F.when(F.col("rules").isNotNull(), won)).drop("rules")
             .withColumn("rule", F.col("__won.rule"))
             .withColumn("rule_verdict", F.col("__won.rule_verdict")).drop("__won"))
    if outcome is None:
        outcomes = ruled.select("host", F.when(F.col("rule_verdict") == "block", 1)
                                .when(F.col("rule_verdict") == "allow", 0).alias("bad"))
    else:
        outcomes = base.select("host", F.col("__bad").alias("bad"))
    sfx, dom, hst, rate = host_reputation(outcomes, public_suffixes)
    domain, suffix = domain_of(F.col("host"), public_suffixes)
    rated = (hosts.withColumn("domain", domain).withColumn("suffix", suffix)
             .join(hst, "host", "left").join(dom, "domain", "left").join(sfx, "suffix", "left"))
    mean = F.coalesce("host_mean", "domain_mean", "suffix_mean", F.lit(rate or 0.0))
    n = F.coalesce("host_n", "domain_n", "suffix_n", F.lit(0.0))
    low = F.greatest(F.lit(0.0), mean - z * F.sqrt(mean * (1 - mean) / (n + 1)))
    rated = materialize(rated.select("host", mean.alias("bad_rate"), low.alias("bad_rate_low")), "host-rates")
    method = F.when(F.col("bad_rate_low") > limit, "block").otherwise("allow")
    return (ruled.join(rated, "host")
            .withColumn("verdict", F.coalesce("rule_verdict", method))
            .select(*keep, *OWN))
