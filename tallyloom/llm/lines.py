"""Line dedup: lines that stand on many different sites are boilerplate and are cut.

The spread of a line is the number of distinct sites (column `source`) of all rows it stands in. A line must also
stand in `min_sites` different texts, so that a page mirrored on many sites makes no boilerplate of its lines. HyperLogLog
sketches of the sites are built per line by partial aggregation. Lines whose estimate is clearly above `min_sites` are
boilerplate; lines near it are counted exactly. Lines in fewer different texts need no sketch.

A text that has nothing but boilerplate lines is emptied, unless it has a line that no such text before it, by the hash of
the text, has: so every line stays somewhere, in a whole text.

Defined cases: lines are compared without surrounding spaces; blank lines stay;
copies of a text are treated alike; a null text stays null and has no lines; a null site is no site; rows
without or with a repeated doc_id are rows like others; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.frames import small, written

MIN_SITES = 10
LOG_REGISTERS = 12
# Fixed value: relative standard error of a sketch with 2^12 registers, three times over.
BAND = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2)
BROADCAST_CUTS = 64_000_000  # bytes of text and line hashes; more are joined by a shuffle


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line).cast("binary")))


def _keyed(docs: DataFrame) -> DataFrame:
    """(text_key, site, keys): 128-bit hashes of each text and of its lines that are not blank."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    return docs.where("text is not null").select(
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"), F.col("source").cast("string").alias("site"),
        F.array_distinct(F.transform(lines, _key)).alias("keys"))


def boilerplate(keyed: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Line hashes with at least `min_sites` sites and texts; `keyed` has a row (text_key, site, keys) per document."""
    texts = keyed.groupBy("text_key", "keys").agg(F.count(F.lit(1)).alias("n"))
    frequent = texts.select(F.explode("keys").alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("line")
    sites = keyed.where("site is not null").groupBy("text_key", "keys", "site").agg(F.count(F.lit(1)).alias("n"))
    lines = written(sites.select("site", F.explode("keys").alias("line")).distinct().join(frequent, "line"), "lines")
    spread = written(lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites")), "spread")
    margin = max(1.0, BAND * min_sites)
    near = spread.where(F.abs(F.col("sites") - min_sites) <= margin).select("line")
    exact = lines.join(near, "line").groupBy("line").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(F.col("sites") > min_sites + margin).select("line").union(exact.select("line"))


def _cuts(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """(text_key, cut) of the texts with boilerplate; texts that stay whole are not listed."""
    texts = keyed.groupBy("text_key", "keys").agg(F.count(F.lit(1)).alias("n")).select("text_key", F.size("keys").alias("lines"), F.explode("keys").alias("line"))
    cuts = written(texts.join(found, "line").groupBy("text_key", "lines").agg(F.collect_set("line").alias("cut")), "cuts")
    bare = cuts.where(F.size("cut") == F.col("lines"))
    keepers = bare.select("text_key", F.explode("cut").alias("line")).groupBy("line").agg(F.min("text_key").alias("text_key")).select("text_key").distinct()
    return cuts.drop("lines").join(keepers, "text_key", "left_anti")


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, counts: bool = False) -> DataFrame:
    """`docs` with boilerplate lines cut from `text`, and `n_chars` set anew where it exists.

    `counts` adds n_lines and n_removed.
    """
    keyed = written(_keyed(docs), "keyed")
    found = written(boilerplate(keyed, min_sites), "boilerplate")
    cuts = small(written(_cuts(keyed, found), "cuts"), BROADCAST_CUTS, 32 + 24 * F.size("cut"))

    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary")))).join(cuts, "text_key", "left")
    lines = F.split("text", "\n", -1)
    left = F.when(F.col("cut").isNotNull(),
                  F.filter(lines, lambda x: ~F.array_contains("cut", _key(x)))).otherwise(F.lit(None))
    own = own.withColumn("rest", left)
    own = own.withColumn("new", F.when(F.col("cut").isNull(), F.col("text")).when(F.exists("rest", lambda x: F.trim(x) != ""), F.array_join("rest", "\n")).otherwise(""))
    out = []
    for c in names:
        if c == "text":
            out.append(F.col("new").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("text").isNotNull(), F.length("new").cast(docs.schema[c].dataType))
                       .otherwise(F.col("row.n_chars")).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    if counts:
        n_lines = F.coalesce(F.size(lines), F.lit(0))
        out.append(n_lines.cast("long").alias("n_lines"))
        out.append(F.when(F.col("cut").isNull(), 0).when(F.col("new") == "", n_lines).otherwise(n_lines - F.size("rest")).cast("long").alias("n_removed"))
    return own.select(*out)
