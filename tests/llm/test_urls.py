from __future__ import annotations

import random
import re

from tallyloom.llm import urls

PAGES = "page_id long, url string"


def _parts(url):
    rest = re.split("[?#]", url.split("://", 1)[1])[0] if url and "://" in url else ""
    host = rest.split("/")[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), rest[len(host):]


def _canonical(host, path):
    return re.sub(r"^(www|m)\.", "", host) + re.sub(r"(\.html?|/)\Z", "", path) if host else None


def _brute(pages, listed):
    out = []
    for i, u in pages:
        host, path = _parts(u)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "block" if _canonical(host, path) in listed else "allow")
        out.append((i, host, path, rule, verdict))
    return sorted(out, key=repr)


def _case():
    rng = random.Random(2)
    hosts = ["net", "a.net", "planet", "Example.NET", "www.example.net", "example.com", "m.Example.com", "x.org", "org", "notorg", "example.com:80", "www.blog.io", "m.b.io", ""]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/2.html", "/fr/3/", "/x?u=/en/", "/en#/x", "?q=://y", "#f", "/É/ü", "/a//b", "/a://b", "/line\nbreak", "/x.htm"]
    pages = [(k, rng.choice(["http://", "https://", "HTTP://", "://", "//", ""]) + rng.choice(hosts) + rng.choice(paths)) for k in range(400)]
    return pages + [(900, None), (901, ""), (None, "http://x.io/1"), (1, pages[1][1]), (902, "http://h.io/" + "y" * 50_000)]


def test_against_a_plain_version(spark):
    pages = _case()
    listed = sorted({c for _, u in pages[::7] if (c := _canonical(*_parts(u)))} | {"nowhere/x"})
    df = spark.createDataFrame(pages, PAGES).selectExpr("*", "'x' AS host", "'x' AS canonical", "'x' AS rule", "0 AS block", "0 AS w0")
    got = urls.judged(df, spark.createDataFrame([(c,) for c in listed] * 2 + [(None,)], "canonical string"))
    assert sorted((tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr) == _brute(pages, set(listed))
    assert any(r[4] == "block" and r[3] is None for r in _brute(pages, set(listed)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "canonical string")
    pages = _case()
    got = urls.judged(spark.createDataFrame(pages, PAGES), none).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == _brute(pages, set())
    assert urls.judged(spark.createDataFrame([], PAGES), none).collect() == []


def test_the_filter_passes_all_listed_and_few_others(spark):
    from pyspark.sql import functions as F
    listed = spark.range(5000).selectExpr("concat('host/', id) AS canonical")
    blocks, n = urls.bloom_blocks(listed)
    others = spark.range(5000, 25000).selectExpr("concat('host/', id) AS canonical")

    def passed(df):
        hit = F.lit(True)
        for w in range(urls.WORDS):
            hit = hit & (F.col(f"w{w}").bitwiseAND(F.col(f"f{w}")) == F.col(f"w{w}"))
        return df.select(*urls._bits(F.col("canonical"), F.lit(n).cast("long"))).join(blocks, "block").where(hit).count()

    assert passed(listed) == 5000
    assert passed(others) < 0.02 * 20000


def test_pages_without_hit_are_spread(spark):
    """With shuffled joins, pages without host, or not on the list, do not share a partition."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for key, value in zip(before, ("-1", "false", "8")):
        spark.conf.set(key, value)
    try:
        from pyspark.sql import functions as F
        listed = spark.createDataFrame([("h.io/1",), ("?5",)], "canonical string")
        for url in ("concat('http://h.io/', id)", "'no host'", "cast(null as string)"):
            pages = spark.range(4000).selectExpr("id AS page_id", f"{url} AS url")
            counts = [r["count"] for r in urls.judged(pages, listed).groupBy(F.spark_partition_id()).count().collect()]
            assert len(counts) == 8 and max(counts) < 2 * 4000 / 8, (url, counts)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
