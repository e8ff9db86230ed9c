"""Importance resampling towards a target: array-scored weights, then a distributed radix sort of the scores.

Every run of one to three words is a feature and falls into one of `BUCKETS` buckets. The gain of a bucket is the log
ratio of its smoothed shares in the target and in the corpus; a document's weight is the sum of the gains of its
features, read from one array of gains. A score adds Gumbel noise, fixed by the document's id, so that the highest
scores are a draw without replacement in proportion to the weights.

The scores are ranked by a least-significant-digit radix sort. A row has a place; a pass looks at one digit of the
composite key (falling score, then doc_id). It counts the digits chunk by chunk of places, adds up the counts of all smaller digits
and of the same digit in earlier chunks, and sends each row to that offset plus its own place among the equal digits
of its chunk. After the last pass the place is the rank. A group of one pass has at most a chunk's rows, however
many keys are equal, and digits that are the same in all rows need no pass. Each pass is a written table.

Defined cases: a null or wordless text has no features and weight 0; a null doc_id is hashed as an empty text and
comes last among equal scores; rows that repeat a doc_id are rows like others, and of rows equal in score and doc_id any may come
first; an empty corpus or target leaves the smoothing alone; extra columns are ignored by `ranked` and kept by `drawn`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.frames import written

BUCKETS = 10_000
LONGEST = 3  # words in a feature
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
DIGIT_BITS = 12
CHUNK_BITS = 17  # places in a chunk
PIECE = 1 << 20  # bytes of a text that are split into words at once

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SCORED = "n_words long, n_features long, weight long, score long"
_STRUCT = pa.struct([(name, pa.int64()) for name in ("n_words", "n_features", "weight", "score")])


def features(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end with them) of UTF-8 text, a piece at a time."""
    raw, at, tail = text.translate(_FOLD), 0, []
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        fresh = raw[at:end].split()
        at = end
        if not fresh:
            continue
        words, old = tail + fresh, len(tail)
        spaced = [b" " + w for w in words]
        runs = list(map(crc32, words))
        found = runs[old:]
        for more in range(1, LONGEST):
            runs = list(map(crc32, spaced[more:], runs))
            found += runs[max(old - more, 0):]
        yield len(fresh), np.array(found, np.int64) % BUCKETS
        tail = words[-(LONGEST - 1):]


def _binary(texts: pa.Array) -> Iterator[bytes]:
    for text in texts.cast(pa.large_string()).cast(pa.large_binary()):
        yield text.as_py() or b""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in _binary(batch.column(0)):
            for _, buckets in features(text):
                held += np.bincount(buckets, minlength=BUCKETS)
    some = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket; a task sends one row for each bucket, the driver gets `BUCKETS` numbers."""
    per_task = texts.select(F.col("text").cast("string")).mapInArrow(_count, "bucket int, n long")
    got = per_task.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed shares, rounded down."""
    s_all, t_all = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus, target)], np.int64)


def gumbel(doc_id: int | None, seed: str = SEED) -> int:
    """Noise in thousandths, fixed by the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, column: str = "scored", seed: str = SEED) -> DataFrame:
    """`docs` with a struct of n_words, n_features, weight and score."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            out = np.zeros((4, len(ids)), np.int64)
            for row, (doc_id, text) in enumerate(zip(ids.to_pylist(), _binary(texts))):
                for words, buckets in features(text):
                    out[:3, row] += words, len(buckets), gain[buckets].sum()
                out[3, row] = out[2, row] + gumbel(doc_id, seed)
            yield pa.StructArray.from_arrays([pa.array(c) for c in out], fields=list(_STRUCT))

    return docs.withColumn(column, F.arrow_udf(run, _SCORED)(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def _digits(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The digits of the composite key that differ between rows, least significant first."""
    flipped = {k: F.col(k).bitwiseXOR(F.lit(-1 << 63)) for k in keys}  # unsigned order
    got = rows.agg(*[c for k in keys for c in (F.bit_or(flipped[k]), F.bit_and(flipped[k]))]).first()
    out = []
    for n, k in reversed(list(enumerate(keys))):
        varies = ((got[2 * n] or 0) ^ (got[2 * n + 1] or 0)) & ((1 << 64) - 1)
        for shift in range(0, 64, DIGIT_BITS):
            if varies >> shift & ((1 << DIGIT_BITS) - 1):
                out.append(F.shiftrightunsigned(flipped[k], shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int"))
    return out


def _counting_sort(rows: DataFrame, digit: Column) -> DataFrame:
    """Rows with the places they have after one stable pass."""
    rows = rows.withColumn("chunk", F.shiftright("place", CHUNK_BITS)).withColumn("digit", digit)
    counts = rows.groupBy("digit", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    smaller = (counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2 ^ DIGIT_BITS rows
               .select("digit", before(Window.orderBy("digit")).alias("smaller")))
    earlier = counts.select("digit", "chunk", before(Window.partitionBy("digit").orderBy("chunk")).alias("earlier"))
    offsets = earlier.join(F.broadcast(smaller), "digit").select("digit", "chunk", (F.col("smaller") + F.col("earlier")).alias("offset"))
    own = F.row_number().over(Window.partitionBy("digit", "chunk").orderBy("place")) - 1
    return (rows.withColumn("own", own).join(offsets, ["digit", "chunk"])
            .withColumn("place", (F.col("offset") + F.col("own")).cast("long")).drop("digit", "chunk", "own", "offset"))


def radix_places(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows` with `place`, 0 for the smallest key; `keys` are long columns without nulls, the most significant first."""
    rows = written(rows.withColumn("place", F.monotonically_increasing_id()), "places")
    for digit in _digits(rows, keys) or [F.lit(0)]:
        rows = written(_counting_sort(rows, digit), "places")
    return rows


def _weighted(docs: DataFrame, target: DataFrame, seed: str) -> tuple[DataFrame, np.ndarray]:
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return written(scored(docs.select("doc_id", "text"), gain, seed=seed).select(F.col("doc_id").cast("long").alias("doc_id"), "scored.*"), "scored"), gain


def _placed(rows: DataFrame, min_words: int) -> DataFrame:
    able = rows.where(F.col("n_words") >= min_words)
    top = able.agg(F.max("score")).first()[0]
    keyed = able.select("*", (F.lit(top if top is not None else 0) - F.col("score")).alias("fall"),
                        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id_key"))
    return radix_places(keyed, ["fall", "id_key"]).drop("fall", "id_key")


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, and the rank of the rows that are drawn.

    Of the rows with at least `min_words` words, `percent` of a hundred are drawn.
    """
    rows, _ = _weighted(docs, target, seed)
    placed = _placed(rows, min_words)
    taken = placed.count() * percent // 100
    rank = F.when(F.col("place") < taken, F.col("place") + 1).cast("long").alias("rank")
    rest = rows.where(F.col("n_words") < min_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return placed.select("doc_id", "n_features", "weight", "score", rank).union(rest)


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """The drawn rows with their own columns; those equal to the last one in score and doc_id are all kept."""
    rows, gain = _weighted(docs, target, seed)
    placed = _placed(rows, min_words)
    last = placed.where(F.col("place") == F.lit(placed.count() * percent // 100 - 1)).select("score", "doc_id").first()
    if last is None:
        return docs.where(F.lit(False))
    name = next(c for i in range(len(docs.columns) + 1) if (c := f"scored_{i}") not in docs.columns)
    score, doc_id = F.col(f"{name}.score"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    edge = (1 << 63) - 1 if last.doc_id is None else last.doc_id
    chosen = (score > last.score) | ((score == last.score) & (doc_id <= edge))
    return scored(docs, gain, name, seed).where((F.col(f"{name}.n_words") >= min_words) & chosen).select(*[F.col(f"`{c}`") for c in docs.columns])
