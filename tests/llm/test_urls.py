from __future__ import annotations

import re
from pathlib import Path

import duckdb

from cartorio.llm.url_queries import POLICY, SQL, op6_url_filter
from cartorio.llm.urls import Rule, UrlPolicy, judged_urls

URLS = [
    None, "", "no scheme casino", "http://", "HTTPS://A.Example.ORG/es/1", "x://example.org/en/10?q#f",
    "x://example.org/fr/", "x://notorg/", "x://shop.com/fr/x", "x://com/de/", "x://example.com/de",
    "x://a.net/casino", "x://a.net/casinos", "x://a.net/free", "x://a.net/free-free",
    "x://cheap.net/pills", "x://ads.net?win=1", "x://ADS.net#Win", "x://a.net/adsé win", "x://org",
    "x://a.net/\n/spam", "a://b://c/d", "x://ex.org./es/", "x://org?casino", "x://" + "a" * 20000 + ".org/",
]


def _pages(spark, urls):
    return spark.createDataFrame(
        [(i, url, "h", "v") for i, url in enumerate(urls)] + [(0, None, "h", "v"), (None, "x://xxx.net", "h", "v")],
        "page_id bigint, url string, host string, verdict string",
    )


def _plain(url):
    text = url or ""
    host = path = ""
    if "://" in text:
        rest = text.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in POLICY.rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = set(re.split("[^a-z0-9]", low))
    bad = words & set(POLICY.strict) or len(words & set(POLICY.soft)) >= 2
    return host, path, best and best.text, best.verdict if best else "block" if bad else "allow"


def test_edges(spark):
    pages = _pages(spark, URLS)
    want = sorted(((p.page_id, *_plain(p.url)) for p in pages.collect()), key=repr)
    got = sorted((tuple(r)[:5] for r in judged_urls(pages, POLICY).collect()), key=repr)
    assert got == want


def test_rules_of_equal_length_and_empty_policies(spark):
    pages = spark.createDataFrame([(1, "x://b.a/cc")], "page_id int, url string")
    policy = UrlPolicy((Rule("allow", "a", "/cc"), Rule("block", "b.a", "/")), (), ())
    assert judged_urls(pages, policy).first().rule == "b.a/"
    assert judged_urls(pages, UrlPolicy((), (), ())).first().verdict == "allow"
    assert judged_urls(pages.limit(0)).collect() == []


def test_same_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{Path(folder)}/pages.parquet'")
    query = duck.sql(SQL["op6_url_filter"])
    ours = op6_url_filter(spark, folder)
    assert ours.columns == query.columns
    got = sorted(map(tuple, ours.collect()))
    assert got == sorted(query.fetchall())
    assert {row[4] for row in got} == {"allow", "block"}
