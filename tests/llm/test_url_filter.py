"""URL filter: parsing and rules against plain code, the models against a plain recursion."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter

URLS = [
    None, "", "no scheme/en/7", "http://a.example.com/en/7?x", "HTTP://EXAMPLE.com/en/70#q", "http://example.com/en/8", "x://com/en/", "http://notcom/en/1", "http://b.net/de/8", "http://example.net/de/81", "http://c.example.net/de/8a", "http://u.org/es/", "http://u.org/es?x/es/",
    "http://h?a/b", "http://h#a", "http://", "a://b://c.com/en/d", "http://é.org/es/ü", "http://x.net/fr/" + "y" * 5000, "http://multi.com/en/\nline?z",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = (None, None)
    for said, rule in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = rule, said
    return host, path, *best


def test_rules_and_parts(spark):
    rows = list(enumerate(URLS))
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, host int")
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    for i, u in rows:
        host, path, rule, said = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == said if said else got[i].verdict in ("allow", "block")


def test_scores_equal_plain_model(spark):
    urls = [f"http://s{i}.example.{t}/{g}/{i * 7 % 999}" for i in range(120) for t, g in (("com", "en"), ("net", "de"), ("org", "fr"), ("org", "es"))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judged(pages).select("*", F.pmod(F.xxhash64("host", "path"), F.lit(url_filter.FOLDS)).alias("fold")).collect()
    ends = url_filter.ALPHABET[-1]
    syms = lambda r: re.sub("[^a-z0-9./-]", "_", (r.host + r.path).lower()) + ends
    grams, contexts = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    for r in got:
        if r.rule and r.fold:
            s = ends * url_filter.ORDER + syms(r)
            for i in range(url_filter.ORDER, len(s)):
                for k in range(url_filter.ORDER + 1):
                    grams[r.verdict == "allow"][s[i - k : i + 1]] += 1
                    contexts[r.verdict == "allow"][k, s[i - k : i]] += 1

    def log_p(good, s, i):
        p = 1 / len(url_filter.ALPHABET)
        for k in range(url_filter.ORDER + 1):
            p = (grams[good][s[i - k : i + 1]] + url_filter.BACKOFF * p) / (contexts[good][k, s[i - k : i]] + url_filter.BACKOFF)
        return math.log(p)

    for r in got[::17]:
        s = ends * url_filter.ORDER + syms(r)
        at = range(url_filter.ORDER, len(s))
        assert r.score == pytest.approx(sum(log_p(True, s, i) - log_p(False, s, i) for i in at) / len(at), abs=1e-4)


def test_empty_and_one_class(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judged(pages).count() == 0
    pages = spark.createDataFrame([(1, "http://a.fr/x"), (1, "http://a.fr/x"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.judged(pages).collect()] == ["allow"] * 3


def test_contract_verdicts(spark):
    """The contract's list in its own words: block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/."""
    want = {
        "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/70": ("example.com/en/7", "allow"), "http://b.net/de/8": ("net/de/", "allow"), "http://example.net/de/7": ("net/de/", "allow"),
        "http://c.example.net/de/81": ("example.net/de/8", "block"), "http://u.org/es/": ("org/es/", "block"),
    }
    pages = spark.createDataFrame(list(enumerate(want)), "page_id long, url string")
    assert {r.url: (r.rule, r.verdict) for r in url_filter.judged(pages).collect()} == want
