"""URL filters and WARC revisits against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from gleanspark.llm import queries, urlfilter, warc

PAGES = "page_id long, url string, html string, host string, Rule string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def verdict(url, entries):
    host, path = parts(url)
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in entries if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rules = [f for f in fit if f[2]]
    best = max(rules) if rules else None
    return host, path, best[3] if best else None, best[2] if best else "block" if fit else "allow"


URLS = [
    None, "", "example.com/en/7", "http://example.com", "https://A.EXAMPLE.com/en/70?x#y", "ftp://x.net/de/8", "https://example.net/de/81", "https://notexample.net/de/8", "http://a.b.c.example.net/de/8/x",
    "http://casino-win.example.net/", "http://casino-win.example.net", "http://www.casino-win.example.net/en/1", "x://", "x://?q", "http://com/en/", "http://example.com/en/", "http://example.org/es/://x", "http://é.com/en/ß" + "a" * 4000,
]


def test_url_filter(spark):
    rows = [(i, u, None, "h", "r") for i, u in enumerate(URLS)] + [(3, URLS[3], None, "h", "r"), (None, URLS[4], None, "h", "r"), (3, URLS[6], None, "h", "r")]
    entries = queries.RULES + queries.LISTED
    got = urlfilter.judge(spark.createDataFrame(rows, PAGES), urlfilter.rule_table(spark, entries)).collect()
    want = sorted([(i, *verdict(u, entries)) for i, u, *_ in rows], key=str)
    assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got], key=str) == want


def test_url_filter_of_hot_urls(spark):
    entries = queries.RULES + queries.LISTED
    rows = [(i, URLS[(0, 3, 9, 5)[i % 4]] if i % 8 else f"http://h{i}.org/es/{i}", None, "h", "r") for i in range(9000)]
    got = urlfilter.judge(spark.createDataFrame(rows, PAGES).repartition(4), urlfilter.rule_table(spark, entries)).collect()
    want = sorted((i, *verdict(u, entries)) for i, u, *_ in rows)
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want


def test_url_filter_of_nothing(spark):
    empty, none = spark.createDataFrame([], PAGES), urlfilter.rule_table(spark, [])
    assert urlfilter.judge(empty, urlfilter.rule_table(spark, queries.RULES)).count() == 0
    got = urlfilter.judge(spark.createDataFrame([(1, "http://a.b/c", None, "", "")], PAGES), none).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [(None, "allow")]


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://WWW.Example.com:80/A/?utm_source=x&b=1#f", "example.com/A?b=1"),
        ("https://example.com/", "example.com"),
        ("https://example.com/a?utm_a=1&utm_b=2", "example.com/a"),
        ("example.com/a//", "example.com/a"),
        ("", ""),
    ],
)
def test_canonical_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == want


RECORD = "record_id long, type string, url string, ts long, status int, headers map<string,string>, canonical_url string, extra int"


def brute_resolve(rows, canonical):
    out = []
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[3] is not None and canonical[r[2]] is not None]
    for r in rows:
        if r[1] != "revisit" or r[4] != 304:
            continue
        earlier = [] if r[3] is None or canonical[r[2]] is None else [(x[3], x[0], x[5]) for x in full if canonical[x[2]] == canonical[r[2]] and x[3] < r[3]]
        if not earlier:
            out.append((r[0], None, "none", r[5]))
            continue
        _, found, stored = max(earlier, key=lambda x: x[:2])
        own, theirs = r[5], stored
        if "etag" in own and "etag" in theirs:
            good = own["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/")
        else:
            good = "last-modified" in own and own.get("last-modified") == theirs.get("last-modified")
        merged = theirs | {k: v for k, v in own.items() if k in warc.PERMITTED}
        out.append((r[0], found if good else None, "resolved" if good else "mismatch", merged if good else own))
    return sorted(_key(*x) for x in out)


def _key(record, found, outcome, headers):
    return record, -1 if found is None else found, outcome, tuple(sorted(headers.items()))


@pytest.mark.parametrize("ranges", [1, 7, 256])
def test_revisits(spark, monkeypatch, ranges):
    monkeypatch.setattr(warc, "RANGES", ranges)
    rng = random.Random(ranges)
    urls = ["http://a.com/x", "https://www.a.com/x/", "http://b.com/?utm_q=1", "http://b.com", None]
    rows = []
    for i in range(300):
        headers = {"content-length": str(i)} | rng.choice([{}, {"etag": rng.choice(['"1"', 'W/"1"', '"2"'])}, {"last-modified": rng.choice("ab")}, {"set-cookie": "x", "cache-control": "y"}])
        ts = None if rng.random() < 0.05 else rng.randrange(100)
        rows.append((i, rng.choice(["response", "revisit", "revisit", "request"]), urls[0] if rng.random() < 0.6 else rng.choice(urls), ts, rng.choice([200, 304, 304]), headers, "c", 1))
    df = spark.createDataFrame(rows, RECORD)
    canonical = {r["url"]: r["c"] for r in df.select("url", warc.canonical_url(F.col("url")).alias("c")).distinct().collect()}
    got = warc.resolve_revisits(df).collect()
    assert sorted(_key(r["record_id"], r["resolved_id"], r["outcome"], r["headers"]) for r in got) == brute_resolve(rows, canonical)


def test_revisits_of_nothing(spark):
    assert warc.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
