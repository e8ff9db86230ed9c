"""Benchmark decontamination with DataFrame functions only.

Words are runs of ASCII letters and digits and of any character beyond ASCII, with A-Z folded. A window is 13 consecutive words of an item, or all words
of a shorter one. Each window is filed under its longest word, its anchor. The
texts are scanned once: words that are an anchor give the windows that could stand
there, and the words around decide. Windows are broadcast while their number is
below a limit; beyond it the same joins are shuffled on the anchor's hash.

Defined cases: null and wordless texts have no words and no hits; null and wordless
items have no window; equal items each count; rows that share a doc_id count as one
document with the hits of all of them and the length of the longest, so repeated rows change
nothing; rows without doc_id are one such document; `clean` judges each row by its own text; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.frames import ascii_lower, small, written

WINDOW = 13
PARTS = 20  # contaminated: one word in 20, or more, is hit
BROADCAST_WINDOWS = 64_000_000  # bytes of windows with their items, and of anchors
# Fixed value: characters between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words in order; an empty string may stand at either end."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN, -1)


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, length, items): the different windows with the items they occur in."""
    words = F.filter(_words(ascii_lower(F.col("text"))), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("words")).where("size(words) > 0 and item is not null")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - width + 1))
    each = items.select("item", "words", F.explode(starts).alias("start"))
    each = each.select("item", F.slice("words", F.col("start"), F.lit(width)).alias("w"))
    return (each.select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("length"))
            .groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _anchored(table: DataFrame) -> DataFrame:
    """(anchor, places): lengths and offsets of the windows whose longest word is `anchor`."""
    words = F.split("window", " ")
    longest = F.array_max(F.transform(words, lambda w, i: F.struct(F.length(w).alias("n"), w.alias("w"), (-i).alias("i"))))
    return (table.select("length", longest.alias("a")).select(
        F.lower("a.w").alias("anchor"), F.struct("length", (-F.col("a.i")).alias("offset")).alias("place"))
        .groupBy("anchor").agg(F.collect_set("place").alias("places")))


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per occurrence: doc_id, n_words, start (0 for the first word), length, items.

    Every row of `docs` also gives one row without length and items.
    """
    table = written(windows(benchmark, width), "windows")
    anchors = _anchored(table)
    table = small(table, BROADCAST_WINDOWS, F.octet_length("window") + F.octet_length(F.array_join("items", ",")))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _words(F.col("text")).alias("words"))
    blank = (F.element_at("words", 1) == "").cast("int")
    last_blank = ((F.element_at("words", -1) == "") & (F.size("words") > 1)).cast("int")
    own = own.select("doc_id", "words", blank.alias("skip"), (F.size("words") - blank - last_blank).cast("long").alias("n_words"))
    # a first entry that is no word stands for the document itself
    entries = own.select("doc_id", "words", "skip", "n_words", F.posexplode(F.concat(F.array(F.lit(" ")), "words")).alias("pos", "word"))
    anchors = anchors.union(anchors.sparkSession.range(1).select(
        F.lit(" ").alias("anchor"), F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("offset"))).alias("places")))
    anchors = written(anchors, "anchors")
    some = small(anchors, BROADCAST_WINDOWS, F.octet_length("anchor") + 8 * F.size("places"))
    first = F.lit(1)  # place in the text of the first of `words`, from 1 as arrays are
    if some is anchors:
        # the rows are shuffled, so each takes the words that a window around it can reach, not the whole text
        first = F.greatest(F.lit(1), F.col("pos") - width + 1)
        around = F.when(F.col("pos") == 0, F.slice("words", 1, 0)).otherwise(F.slice("words", first, F.lit(2 * width - 1)))
        entries = entries.select("doc_id", around.alias("words"), "skip", "n_words", "pos", "word")
    met = entries.join(some, F.lower("word") == F.col("anchor"))
    start = F.col("pos") - F.col("place.offset") - first + 1
    met = (met.select("doc_id", "words", "skip", "n_words", "pos", F.explode("places").alias("place"))
           .where((F.col("place.length") == 0) | ((start >= 1) & (start + F.col("place.length") - 1 <= F.size("words")))))
    there = F.when(F.col("place.length") > 0, F.array_join(F.slice("words", start, F.col("place.length")), " "))
    met = met.select("doc_id", "n_words", F.col("place.length").alias("length"), (start + first - 2 - F.col("skip")).alias("start"),
                     ascii_lower(there).alias("there"))
    hit = met.join(table.withColumnRenamed("length", "l"), (F.col("there") == F.col("window")) & (F.col("length") == F.col("l")), "left")
    return hit.where("length = 0 or window is not null").select("doc_id", "n_words", "start", F.when(F.col("length") > 0, F.col("length")).alias("length"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, parts: int = PARTS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids), items_sha256, contaminated."""
    # equal rows once, before all of a document meet: rows that share an id, or have none, may be very many
    found = occurrences(docs, benchmark, width).distinct()
    hits = F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)
    per = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list(hits))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    per = per.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items")
    return per.select(
        "doc_id", "n_words", "n_hit", "n_items", "items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose own text is not contaminated, whether their doc_id is missing, repeated or neither.

    Texts are named by a 64-bit hash, so copies are judged once; that a clean text has the hash of a contaminated one has a
    chance of 1 in 1.8e19 a pair.
    """
    named = F.xxhash64(docs["text"].cast("string"))
    texts = docs.select(named.alias("doc_id"), docs["text"])
    bad = written(contamination(texts, benchmark).where("contaminated").select(F.col("doc_id").alias("text_hash")), "contaminated")
    return docs.join(bad, named == bad["text_hash"], "left_anti")
