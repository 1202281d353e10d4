"""URL filter: hosts, paths and rules against brute force; what the trees learn; odd rows."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import url_filter
from rillstone.llm.queries import URL_RULES

from .conftest import SF

ODD = [None, "", "no scheme", "://", "http://", "HTTPS://A.Example.NET/en/x?q=://b/#f", "http://example.net/en", "http://net/", "x://notnet/", "http://a.org/fr/", "http://org/fr", "http://example.com/de/1/2?x", "http://xexample.com/de/", "a://b://c/d", "http://\u00c9.NET/x\n?y", "http://h.net", "http://h.net?a/b", "http://" + "a." * 400 + "net/" + "p/" * 2000]


def _by_hand(url):
    url = url or ""
    host, path = "", ""
    if "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3 :], re.S).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((-len(rule), rule, verdict))
    return host, path, *(min(fits)[1:] if fits else (None, None))


@pytest.mark.parametrize("compiled", [url_filter.COMPILED_RULES, 0])
def test_rules_by_hand(spark, compiled):
    urls = ODD + [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    host, path = url_filter.host_and_path(F.col("url"))
    got = url_filter.match_rules(df.select("page_id", host.alias("host"), path.alias("path")), URL_RULES, compiled).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["rule_verdict"]) for r in got} == {i: _by_hand(u) for i, u in enumerate(urls)}


def test_trees_learn_from_given_labels(spark):
    """Held-out URLs of hosts and shapes that the labels mark."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1500):
        bad = i % 3 == 0
        host = f"{'win' if bad else 'docs'}{rng.integers(40)}.{'spam-x' if bad and i % 2 else 'site'}.example.{'org' if i % 2 else 'com'}"
        tail = "".join(rng.choice(list("0123456789"), 14)) + "?a=1&b=2&c=3" if bad else "guide/intro"
        rows.append((i, f"http://{host}/{tail}", float(bad)))
    df = spark.createDataFrame(rows, "page_id long, url string, label double").withColumns({"host": F.lit("clash"), "rule": F.lit(1), "f_length": F.lit(1)})
    got = url_filter.filter_urls(df.filter("page_id >= 1000"), [], df.filter("page_id < 1000").select("url", "label")).collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 3 == 0) for r in got) > 0.97 * len(got)


@pytest.mark.parametrize("share", [0.1, 0.5])
def test_trees_that_know_nothing_do_not_decide(spark, share):
    """Labels that no URL shows: some scores are high, none blocks."""
    rng = np.random.default_rng(2)
    rows = [(i, f"http://h{rng.integers(60)}.example.{'org' if i % 2 else 'com'}/{rng.integers(10**6)}", float(rng.random() < share)) for i in range(1200)]
    df = spark.createDataFrame(rows, "page_id long, url string, label double")
    got = url_filter.filter_urls(df, [], df.select("url", "label")).collect()
    assert {r["verdict"] for r in got} == {"allow"} and len({r["block_score"] for r in got}) > 10


def test_odd_rows_and_few_labels(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(ODD)] + [(None, None), (1, "http://net/")], "page_id long, url string")
    few = spark.createDataFrame([("http://a.com/", 1.0), ("http://b.com/", 0.0), (None, None)], "url string, label double")
    got = url_filter.filter_urls(df, URL_RULES, few).collect()
    want = Counter((i, _by_hand(u)[2], _by_hand(u)[3] or "allow") for i, u in [*enumerate(ODD), (None, None), (1, "http://net/")])
    assert Counter((r["page_id"], r["rule"], r["verdict"]) for r in got) == want
    assert url_filter.filter_urls(df.limit(0), URL_RULES, few.limit(0)).count() == 0


def test_page_labels(spark):
    words = " ".join(["word"] * 80)
    df = spark.createDataFrame([("a", f"<p>{words}</p>"), ("b", f"<p>short</p><script>{words}</script>"), ("c", f"<p>{words.replace(' ', ' ### ')}"), ("d", None), (None, "")], "url string, html string")
    assert Counter(tuple(r) for r in url_filter.page_labels(df).collect()) == Counter([("a", 0.0), ("b", 1.0), ("c", 1.0), (None, 1.0)])
