import pytest
from pyspark.sql import functions as F

from eventide.llm import reputation as rp

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("a.example.net", "/", "allow")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.translate(low), rest[:cut]


def rule_of(host, path):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = ["http://A.Example.NET/en/1?x=/", "http://b.example.net/en/2", "http://example.net/de/", "https://x.net",
        "https://x.net?q", "//no.scheme.org/fr/", "ftp://u@h.org:80/fr/a#b", "http://org/fr/", "http://notorg/fr/",
        "http://example.com/de/x", "http://s.example.com/dex", "http://s.example.com/de/", "x://y://z.org/fr/",
        "http://ÉX.org/FR/", "", None, "http://", "http://a.example.net/q", "http://.org/fr/"]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(URLS * 2)],
                                  "page_id long, url string, host string, verdict string")
    got = rp.judge_urls(pages, RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r["host"], r["path"]) == split(r["url"])
        rule, verdict = rule_of(r["host"], r["path"])
        assert r["rule"] == rule, r["url"]
        assert r["verdict"] in ("allow", "block") if verdict is None else r["verdict"] == verdict
    assert rp.judge_urls(pages.limit(0), RULES).count() == 0
    assert rp.judge_urls(pages, []).filter(F.col("rule").isNotNull()).count() == 0


def test_reputation_is_shrunk_towards_the_domain(spark):
    rows = []
    for host, bad, good in [("a.bad.com", 40, 2), ("b.bad.com", 30, 1), ("c.bad.com", 1, 0), ("a.good.com", 0, 40),
                            ("b.good.com", 1, 30), ("c.good.com", 1, 0)] + [(f"h{i}.mid.com", 1, 9) for i in range(9)]:
        rows += [(host, 1)] * bad + [(host, 0)] * good
    rows += [("new.bad.com", None), ("new.good.com", None), ("other.xyz", None)]
    pages = spark.createDataFrame([(f"http://{h}/p", b) for h, b in rows], "url string, bad int")
    got = {r["host"]: r for r in rp.judge_urls(pages, [], outcome=F.col("bad")).collect()}
    one = {h: got[h]["bad_rate"] for h in got}
    assert one["c.bad.com"] > 0.6 > 0.3 > one["c.good.com"]     # one outcome each; the domain tells them apart
    assert 40 / 42 <= one["a.bad.com"] <= one["new.bad.com"] and 0.6 > one["new.good.com"]
    assert got["a.bad.com"]["verdict"] == "block" and got["a.good.com"]["verdict"] == "allow"
    assert got["c.good.com"]["verdict"] == "allow" and got["other.xyz"]["verdict"] == "allow"
    assert all(r["bad_rate_low"] <= r["bad_rate"] for r in got.values())


def test_public_suffixes_addresses_and_ports(spark):
    rows = [(f"http://s{i}.co.uk/p", 1) for i in range(40)] + [(f"http://g{i}.uk/p", 0) for i in range(40)]
    rows += [("http://spam.net:8080/p", 1)] * 30 + [("http://10.0.0.1/p", 1)] * 30 + [("http://me@spam.net/p", None)]
    rows += [("http://honest.co.uk/p", 0)] * 30 + [("http://new.gov.uk/p", None), ("http://10.0.0.2:80/p", None)]
    pages = spark.createDataFrame(rows, "url string, bad int")
    got = {r["host"]: r for r in rp.judge_urls(pages, [], outcome=F.col("bad")).collect()}
    assert got["honest.co.uk"]["verdict"] == "allow" and got["new.gov.uk"]["verdict"] == "allow"
    assert got["me@spam.net"]["verdict"] == got["spam.net:8080"]["verdict"] == "block"
    parts = {r[0]: r[1:] for r in pages.select(rp.split_url(F.col("url"))[0].alias("h")).distinct().select(
        "h", *rp.domain_of(F.col("h"))).collect()}
    assert parts["s1.co.uk"] == ("s1.co.uk", "co.uk") and parts["g1.uk"] == ("g1.uk", "uk")
    assert parts["spam.net:8080"] == parts["me@spam.net"] == ("spam.net", "net")
    assert parts["10.0.0.2:80"] == ("10.0.0.2", rp.ADDRESS)
    # as one host's own name, a public suffix has no domain above it
    assert spark.range(1).select(*rp.domain_of(F.lit("co.uk"))).first() == ("co.uk", "co.uk")


def test_posteriors_equal_the_formulas(spark):
    seen = {"a.x.com": (40, 38), "b.x.com": (10, 0), "c.y.com": (7, 1), "d.z.org": (5, 5), "e.z.org": (3, 0)}
    rows = [(h, int(i < bad)) for h, (n, bad) in seen.items() for i in range(n)]
    _, _, hst, rate = rp.host_reputation(spark.createDataFrame(rows, "host string, bad int"))

    def posterior(stats, prior):
        noise = sum(prior[k] * (1 - prior[k]) for k in stats)
        full = sum(n * prior[k] * (1 - prior[k]) for k, (n, _) in stats.items())
        ss = sum(n * (b / n - prior[k]) ** 2 for k, (n, b) in stats.items())
        s = 1 / max(0.01, min(0.99, (ss - noise) / (full - noise) if full != noise else 0.5)) - 1
        return {k: (prior[k] * s + b) / (s + n) for k, (n, b) in stats.items()}

    def up(labels):
        out = {}
        for h, (n, b) in seen.items():
            k = ".".join(h.split(".")[-labels:])
            out[k] = (out.get(k, (0, 0))[0] + n, out.get(k, (0, 0))[1] + b)
        return out

    assert abs(rate - 44 / 65) < 1e-12
    sfx = posterior(up(1), {k: rate for k in up(1)})
    dom = posterior(up(2), {k: sfx[k.split(".")[-1]] for k in up(2)})
    want = posterior(seen, {h: dom[".".join(h.split(".")[-2:])] for h in seen})
    got = {r["host"]: r["host_mean"] for r in hst.collect()}
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)


@pytest.mark.parametrize("html,bad", [
    (None, None), ("<p>too short", None), ("<b>" + "word " * 30, 1),
    (" ".join(f"<i>w{i}</i>" for i in range(30)), 0), (" ".join(f"w{i}!!" for i in range(30)), 1),
    ("<script>" + "x " * 99 + "</script>" + " ".join(f"w{i}" for i in range(30)), 0)])
def test_page_outcomes(spark, html, bad):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(rp.junk_outcome(F.col("html"))).first()[0] == bad
