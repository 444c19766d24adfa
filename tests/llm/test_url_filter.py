"""URL filtering as of the fetch time, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripmart.llm import url_filter as uf


@pytest.mark.parametrize("url,host,path", [
    ("https://User:pw@WWW.Example.org.:8080/A/b?q#f", "www.example.org", "/A/b"), ("http://x", "x", ""), ("ftp://a.b/c", "a.b", "/c"),
    ("no scheme/x", None, ""), ("", None, ""), (None, None, None), ("https:///path", None, "/path"), (" http://a.b/ ", "a.b", "/"),
])
def test_parts(spark, url, host, path):
    x = spark.createDataFrame([(url,)], "u string").select(uf.host_of(F.col("u")).alias("h"), uf.path_of(F.col("u")).alias("p")).first()
    assert (x.h, x.p) == (host, path)


def matches(pattern, url):
    rest = url.split("://")[1].split("?")[0]
    host, _, path = rest.partition("/")
    return (rest + ("/" if "/" not in rest else "")).startswith(pattern) if "/" in pattern else host == pattern or host.endswith("." + pattern)


def brute(url, day, entries):
    best = None
    for name, pattern, allow in {(e[0], e[1], e[4]) for e in entries}:
        own = [e for e in entries if (e[0], e[1], e[4]) == (name, pattern, allow) and e[2] <= day]
        if own and matches(pattern, url):
            last = max(e[2] for e in own)
            if any(e[3] for e in own if e[2] == last):
                key = (-len(pattern), not allow, name)
                if best is None or key < best[0]:
                    best = (key, not allow, name, pattern, last)
    return (False, None, None, None) if best is None else best[1:]


def test_against_brute_force(spark):
    r = random.Random(4)
    hosts = ["a.org", "b.a.org", "c.b.a.org", "xa.org", "d.net"]
    patterns = [*hosts, "org", "a.org/x/", "b.a.org/x/y/", "d.net/x/"]
    day = lambda: dt.date(2019, 6, 1) + dt.timedelta(r.randint(0, 900))
    entries = [(r.choice(["one", "two"]), r.choice(patterns), day(), r.random() < 0.6, r.random() < 0.3) for _ in range(120)]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/x", "/x/", "/x/y", "/x/y/z?q=/x/", "/xx/")]
    caps = [(i, r.choice(urls), dt.datetime.combine(day(), dt.time(r.randint(0, 23)))) for i in range(400)]
    caps += [(1000, None, caps[0][2]), (1001, urls[0], None), (None, "not a url", caps[0][2]), caps[5], caps[5]]
    noise = [("one", None, dt.date(2020, 1, 1), True, False), ("one", "a.org", None, True, False)]
    got = uf.filter_urls(spark.createDataFrame([(*c, "x") for c in caps], "page_id long, url string, fetched timestamp_ntz, list string"),
                         spark.createDataFrame(entries + noise, "list string, pattern string, day date, active boolean, allow boolean")).collect()
    found = sorted(((x.page_id or -1, x.url, x.blocked, x.list, x.pattern, x.valid_from) for x in got), key=str)
    want = sorted(((i or -1 if i is not None else -1, u, *(brute(u, t.date(), entries) if u and t and "://" in u else (False, None, None, None))) for i, u, t in caps), key=str)
    assert [(-1 if x[0] in (0, -1) else x[0], *x[1:]) for x in found] == [(-1 if x[0] in (0, -1) else x[0], *x[1:]) for x in want]
    assert any(x.blocked for x in got) and len(got) == len(caps)


def test_empty_tables(spark):
    caps = spark.createDataFrame([(1, "http://a.org/", dt.datetime(2020, 1, 1))], "page_id long, url string, fetched timestamp_ntz")
    entries = spark.createDataFrame([], "list string, pattern string, day date, active boolean, allow boolean")
    assert [x.blocked for x in uf.filter_urls(caps, entries).collect()] == [False]
    assert uf.filter_urls(caps.limit(0), entries).collect() == []


@pytest.mark.parametrize("patterns", [["a.org/x/"], ["b.a.org", "c.b.a.org"], ["d.net", "a.org/x/"], ["org", "c.b.a.org"], ["x.d.c.b.a.org"]])
def test_lists_of_few_label_counts(spark, patterns):
    """Domains of fewer labels than any listed one are no keys; nothing is lost by that."""
    day, at = dt.date(2020, 1, 1), dt.datetime(2020, 2, 1)
    entries = [("one", p, day, True, False) for p in patterns]
    urls = [f"http://{h}{p}" for h in ("a.org", "b.a.org", "c.b.a.org", "d.net", "org", "xa.org") for p in ("", "/x", "/x/y")]
    got = uf.filter_urls(spark.createDataFrame([(i, u, at) for i, u in enumerate([*urls, None, "no host"])], "page_id long, url string, fetched timestamp_ntz"),
                         spark.createDataFrame(entries, "list string, pattern string, day date, active boolean, allow boolean")).collect()
    assert len(got) == len(urls) + 2
    for x in got:
        want = brute(x.url, day, entries) if x.url in urls else (False, None, None, None)
        assert (x.blocked, x.list, x.pattern, x.valid_from) == want


def test_candidates_without_short_domains(spark):
    urls = spark.createDataFrame([("http://c.b.a.org/x/",), ("http://org/",), (None,)], "u string")
    found = [x.c for x in urls.select(uf.candidates(F.col("u"), 1, 3).alias("c")).collect()]
    assert found == [["c.b.a.org", "b.a.org", "c.b.a.org/x/"], [], []]
