"""Quality classifier: naive Bayes scaled n-gram indicators and a linear support vector machine.

Features of a text are indicators of byte n-grams (1 to 3 bytes) and of word-shape
n-grams (1 and 2 words; a shape is the case of a word, its last punctuation marks,
its length class and whether it repeats the word before), hashed to 2^16 buckets.
Each indicator is scaled by the log-count ratio of the two classes, counted by Spark over all rows
that may be learned from, and divided by the length of the row's indicator vector.
A hinge-loss model is fitted by dual coordinate descent on a bounded sample
(`sample_rows` different texts of each class, lowest hash first), and its margins are
turned into probabilities by a logistic curve fitted on a second such sample that the model has not seen.

Defined cases: a null or empty text has no indicators and is scored by the bias alone;
null labels and labels without a document teach nothing; with only one class, or no
label at all, every score is the share of class 1 (0.5 without labels). Rows that
repeat an id are scored one by one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.frames import byte_blocks, small
from tallyloom.llm.shingles import mixed, words_of

BUCKETS = 1 << 16
SAMPLE_ROWS = 3_000
COST = 1.0
EPOCHS = 12
BLOCK_BYTES = 1 << 17
BLOCK_ROWS = 32
SMOOTHING = 1.0
THRESHOLD = 0.3
BROADCAST_LABELS = 48_000_000  # bytes of ids and labels; more are joined by a shuffle

_U = np.uint64
_ALPHA, _UPPER, _DIGIT, _PUNCT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_ALPHA[97:123] = _ALPHA[65:91] = True
_ALPHA[128:] = True
_PUNCT[33:127] = True
_PUNCT &= ~(_ALPHA | _DIGIT)


def _shapes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shape) of each word."""
    words = words_of(raw, bounds)
    if not len(words.hashes):
        return words.rows, words.hashes
    starts, ends = words.starts, words.ends
    size = ends - starts

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[raw])])
        return sums[ends] - sums[starts]

    upper, punct = count(_UPPER), count(_PUNCT)
    letters = size - punct
    first = _UPPER[raw[starts]].astype(np.int64)
    case = np.where((upper >= 2) & (2 * upper > letters), 2, first)
    last = np.where(_PUNCT[raw[ends - 1]], raw[ends - 1], 0).astype(np.int64)
    marks = np.minimum(punct, 3)
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 7)
    repeats = np.zeros(len(size), np.int64)
    repeats[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.rows[1:] == words.rows[:-1])
    return words.rows, (((case * 256 + last) * 4 + marks) * 8 + length) * 2 + repeats


def indicators(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) pairs, distinct and sorted."""
    n = len(raw)
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    wide = raw.astype(np.uint64)
    parts = [owner * BUCKETS + wide.astype(np.int64)]
    for size in (2, 3):
        if n < size:
            continue
        gram = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            gram = gram * _U(256) + wide[k:n - size + 1 + k]
        same = owner[:n - size + 1] == owner[size - 1:]
        parts.append((owner[:n - size + 1] * BUCKETS + (mixed(gram) >> _U(48)).astype(np.int64))[same])
    rows, shapes = _shapes(raw, bounds)
    shapes = shapes.astype(np.uint64) + _U(1 << 40)
    parts.append(rows * BUCKETS + (mixed(shapes) >> _U(48)).astype(np.int64))
    if len(shapes) > 1:
        same = rows[1:] == rows[:-1]
        pair = mixed(shapes[:-1] * _U(0x9E3779B97F4A7C15) + shapes[1:])
        parts.append((rows[1:] * BUCKETS + (pair >> _U(48)).astype(np.int64))[same])
    codes = np.concatenate(parts)
    rows_in_block = len(bounds) - 1
    if rows_in_block <= 4096:  # a bit for each row and bucket is quicker than sorting
        seen = np.zeros(rows_in_block * BUCKETS, bool)
        seen[codes] = True
        codes = np.flatnonzero(seen)
    else:
        codes = np.unique(codes)
    return codes // BUCKETS, codes % BUCKETS


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first, raw, bounds in byte_blocks(batch.column(column), BLOCK_BYTES):
            for start in range(0, len(bounds) - 1, BLOCK_ROWS):  # bounds the bit table
                part = bounds[start:start + BLOCK_ROWS + 1]
                rows, buckets = indicators(raw[part[0]:part[-1]], part - part[0])
                yield batch.slice(first + start, len(part) - 1), len(part) - 1, rows, buckets


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: rows with each bucket, by class; bucket BUCKETS counts the rows."""
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    for batch, n, rows, buckets in _blocks(batches, "text"):
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
        found = np.bincount(y[rows] * (BUCKETS + 1) + buckets, minlength=2 * (BUCKETS + 1))
        counts += found.reshape(2, BUCKETS + 1)
        counts[:, BUCKETS] += np.bincount(y, minlength=2)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])],
                                     ["bucket", "n0", "n1"])


def _bucket_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, n, rows, buckets in _blocks(batches, "text"):
        ends = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(buckets.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("place"), lists], ["y", "place", "buckets"])


@dataclass(frozen=True)
class Model:
    """Weight of each indicator before division by the vector's length, bias, and logistic curve."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        margins = _margins(self.weights, self.ratios, rows, buckets, n) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def _margins(weights: np.ndarray, ratios: np.ndarray, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
    scaled = ratios[buckets]
    norm = np.sqrt(np.bincount(rows, scaled * scaled, n))
    total = np.bincount(rows, weights[buckets] * scaled, n)
    return np.divide(total, norm, out=np.zeros(n), where=norm > 0)


def descend(rows: list[np.ndarray], ratios: np.ndarray, y: np.ndarray, cost: np.ndarray,
            epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: (weights, bias). The bias is a feature that is always 1.

    `rows` holds the buckets of each row, `y` is -1 or 1, `cost` bounds each dual variable.
    """
    scale = np.array([1.0 / (np.sqrt(ratios[r] @ ratios[r]) or 1.0) for r in rows])
    square = np.array([1.0 + (s * s) * (ratios[r] @ ratios[r]) for r, s in zip(rows, scale)])
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            own = scale[i] * ratios[rows[i]]
            gradient = y[i] * (weights[rows[i]] @ own + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weights[rows[i]] += step * own
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) by Newton steps on the logistic loss with smoothed targets."""
    ones, zeros = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -500, 500)))
        slope = x @ (weight * (p - target)) + 1e-6 * beta
        curve = (x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _sample(labelled: DataFrame, rows: int) -> pa.Table:
    """(y, place, buckets) of the `rows` different texts of each class with the lowest hashes."""
    hashed = labelled.withColumn("place", F.xxhash64("text", F.lit(17)))
    narrow = hashed.select("y", "place").distinct()
    last = [narrow.where(F.col("y") == y).orderBy("place").limit(rows).agg(F.max("place")).first()[0] for y in (0, 1)]
    chosen = hashed.where(F.col("place") <= F.when(F.col("y") == 0, F.lit(last[0])).otherwise(F.lit(last[1])))
    lists = chosen.mapInArrow(_bucket_lists, "y int, place long, buckets array<int>")
    return lists.groupBy("y", "place").agg(F.first("buckets").alias("buckets")).toArrow().sort_by([("y", "ascending"), ("place", "ascending")])


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of `labelled` (text, y in 0 and 1). Counts use all rows, the fit `sample_rows` rows of each class.

    The sample and the counts are bounded (2 * sample_rows rows, 2^16 buckets), so they come to the driver.
    """
    labelled = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int").alias("y")).where("y in (0, 1)")
    partial = labelled.mapInArrow(_class_counts, "bucket long, n0 long, n1 long")
    table = partial.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    counts = np.zeros((2, BUCKETS + 1))
    counts[:, table["bucket"].to_numpy(np.int64)] = table[["n0", "n1"]].to_numpy(float).T
    n0, n1 = counts[:, BUCKETS]
    if not n0 or not n1:
        share = 0.5 if n0 == n1 else float(n1 > 0)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, 36.0 * (2 * share - 1))
    p = counts[:, :BUCKETS] + SMOOTHING
    p = p / (counts[:, BUCKETS:] + 2 * SMOOTHING)
    ratios = np.log(p[1] / p[0])

    taken = _sample(labelled, 2 * sample_rows)
    y = np.where(taken.column("y").to_numpy() == 1, 1.0, -1.0)
    lists = taken.column("buckets").combine_chunks()
    rows = np.split(lists.flatten().to_numpy(), lists.offsets.to_numpy()[1:-1] - lists.offsets.to_numpy()[0])
    fitted = np.arange(len(rows)) % 2 == 0
    y_fit = y[fitted]
    weights, bias = descend([r for r, f in zip(rows, fitted) if f], ratios, y_fit, np.full(len(y_fit), COST))
    rest = [r for r, f in zip(rows, fitted) if not f]
    owner = np.repeat(np.arange(len(rest)), [len(r) for r in rest])
    margins = _margins(weights, ratios, owner, np.concatenate(rest), len(rest)) + bias
    y_rest = y[~fitted]
    share = {1.0: n1 / max((y_rest > 0).sum(), 1), -1.0: n0 / max((y_rest < 0).sum(), 1)}
    weight = np.array([share[v] for v in y_rest])
    slope, offset = logistic_curve(margins, y_rest, weight * len(weight) / weight.sum())
    return Model(weights, ratios, bias, slope, offset)


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """`docs` with the score as one more column; only text goes through Python."""
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], ["text"])
            yield pa.array(np.concatenate([model.scores(r, c, n) for _, n, r, c in _blocks(iter([batch]), "text")]
                                          or [np.zeros(0)]))

    return docs.withColumn(column, F.arrow_udf(score, "double")(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def learn(docs: DataFrame, labels: DataFrame, held_out_fifth: int = 0) -> Model:
    """Model for `labels.quality`, from the labelled rows outside the held-out fifth."""
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("y"))
    known = known.where(~held_out(F.col("doc_id"), held_out_fifth))
    return fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(small(known, BROADCAST_LABELS, F.lit(12)), "doc_id"))


def held_out(doc_id: Column, fifth: int = 0) -> Column:
    """Whether a row is kept for testing; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == fifth, F.lit(True))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted (1 from THRESHOLD on)."""
    out = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are predicted to be good, with their own columns only."""
    score = next(c for i in range(len(docs.columns) + 1) if (c := f"score_{i}") not in docs.columns)
    return scored(docs, learn(docs, labels), score).where(F.col(score) >= THRESHOLD).drop(score)
