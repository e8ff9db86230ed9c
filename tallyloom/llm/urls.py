"""URL filter: prefix rules first, then a list of URLs behind a blocked Bloom filter.

A listed URL sets `PROBES` bits in one block of 512 bits. The filter is a table of
blocks, built by bit_or aggregation; pages meet their block by a join, and only pages with all
their bits set go on to the exact join with the list, which removes false hits.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z folded; path: from
there up to `?`, `#` or the end. Both are empty for a null URL or one without `://`.
A rule fits its host and all subdomains if the path starts with the rule's; the
longest rule wins. Without a rule the verdict is `block` for a listed URL, else `allow`.

Canonical URL: host without leading `www.` or `m.`, path without `.html`, `.htm` or a last slash, no scheme, query or
fragment. A page without a host has none and is never listed. Defined cases: null or repeated ids
and URLs give one row each; an empty list blocks nothing; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.frames import ascii_lower, written

# The rules as (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
WORDS = 8  # of 64 bits: a block is one cache line
PROBES = 6
BITS_PER_URL = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^?#]*", 0)
    host = F.substring_index(rest, "/", 1)
    return ascii_lower(host), F.substring(rest, F.length(host) + 1, F.length(rest))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none."""
    rule = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def canonical(host: Column, path: Column) -> Column:
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(?:\.html?|/)$", "")))


def _bits(url: Column, blocks: Column) -> list[Column]:
    """Block number, then the mask of each word."""
    place = F.xxhash64(url, F.lit(1))
    masks = [F.lit(0).cast("long")] * WORDS
    for probe in range(PROBES):
        bit = F.pmod(F.xxhash64(url, F.lit(100 + probe)), F.lit(64 * WORDS)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)
        masks = [m.bitwiseOR(F.when(F.floor(bit / 64) == w, one).otherwise(F.lit(0).cast("long"))) for w, m in enumerate(masks)]
    return [F.pmod(place, blocks).alias("block"), *[m.alias(f"w{w}") for w, m in enumerate(masks)]]


def bloom_blocks(listed: DataFrame) -> tuple[DataFrame, int]:
    """(block, f0..f7) of the listed URLs (column `canonical`), and the number of blocks."""
    blocks = max(1, -(-listed.count() * BITS_PER_URL // (64 * WORDS)))
    bits = listed.select(*_bits(F.col("canonical"), F.lit(blocks).cast("long")))
    return bits.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"f{w}") for w in range(WORDS)]), blocks


def judged(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, canonical, rule, verdict; `listed` has the URLs in column `canonical`."""
    host, path = host_and_path(F.col("url").cast("string"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    own = own.select("page_id", "host", "path", canonical(F.col("host"), F.col("path")).alias("canonical"),
                     rule.alias("rule"), verdict.alias("ruled"))
    listed = written(listed.where("canonical is not null").select("canonical").distinct(), "listed")
    blocks, n = bloom_blocks(listed)
    names = ["page_id", "host", "path", "canonical", "rule", "ruled"]
    # a page without canonical URL, or without possible hit, gets a key of its own that nothing can equal, so that neither
    # join sends all of them to one place
    alone = F.xxhash64("page_id", "host", "path")
    probe = own.select(*names, *_bits(F.col("canonical"), F.lit(n).cast("long")))
    probe = probe.withColumn("block", F.when(F.col("canonical").isNull(), -1 - F.pmod(alone, F.lit(1 << 40))).otherwise(F.col("block")))
    probe = probe.join(blocks, "block", "left")
    hit = F.col("ruled").isNull() & F.col("canonical").isNotNull()
    for w in range(WORDS):
        hit &= F.col(f"w{w}").bitwiseAND(F.col(f"f{w}")) == F.col(f"w{w}")
    # only possible hits have their URL as key; no canonical URL has a question mark
    probe = probe.select(*names, F.when(hit, F.col("canonical")).otherwise(F.concat(F.lit("?"), alone)).alias("possible"))
    exact = probe.join(listed.where(~F.col("canonical").contains("?")).select(F.col("canonical").alias("possible"), F.lit(True).alias("on_list")), "possible", "left")
    return exact.select("page_id", "host", "path", "canonical", "rule",
                        F.coalesce("ruled", F.when(F.col("on_list"), "block").otherwise("allow")).alias("verdict"))
