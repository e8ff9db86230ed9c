from __future__ import annotations

import numpy as np

from tallyloom.llm import quality
from tests.llm.helpers import documents, prose

DATA = "/root/testdata/sf0.01"


def test_descent_reaches_the_optimum():
    """Primal and dual values of the hinge loss meet."""
    rng = np.random.default_rng(0)
    ratios = rng.normal(size=40)
    rows = [np.sort(rng.choice(40, rng.integers(1, 20), replace=False)) for _ in range(80)]
    y = np.where(rng.random(80) < 0.5, 1.0, -1.0)
    weights, bias = quality.descend(rows, ratios, y, np.full(80, 1.0), epochs=3000)
    x = np.zeros((80, 41))
    for k, r in enumerate(rows):
        x[k, r] = ratios[r] / np.linalg.norm(ratios[r])
    x[:, 40] = 1

    def value(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()

    best = value(np.r_[weights, bias])
    for _ in range(300):
        assert value(np.r_[weights, bias] + rng.normal(scale=0.02, size=41)) >= best - 1e-3


def test_indicators_are_sets_within_their_row():
    texts = ["abab", "", "abab abab", "b", "é"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *[len(t.encode()) for t in texts]])
    rows, buckets = quality.indicators(raw, bounds)
    alone = []
    for t in texts:
        own = np.frombuffer(t.encode(), np.uint8)
        alone.append(quality.indicators(own, np.array([0, len(own)]))[1].tolist())
    assert [buckets[rows == k].tolist() for k in range(5)] == alone
    assert alone[1] == [] and len(set(alone[2])) == len(alone[2])


def test_held_out_accuracy_and_score_range(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    found = quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    assert found.score.between(0, 1).all()
    held = found[found.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_labels_of_the_held_out_fifth_teach_nothing(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_awkward_rows(spark):
    good = [(i, " ".join(prose(i, 40)), "s") for i in range(60)]
    bad = [(100 + i, "!! ".join(w.upper() for w in prose(i, 40)), "s") for i in range(60)]
    odd = [(300, None, "s"), (301, "", "s"), (None, "plain words here", "s"), (302, " ".join(prose(9, 30_000)), "s"), (1, good[1][1], "s")]
    docs = documents(spark, good + bad + odd, extra=True)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)] + [(5, None, 0), (999, 1, 0), (None, 0, 0), (300, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == len(good + bad + odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by_id = {r.doc_id: r.predicted for r in rows}
    assert sum(by_id[i] == 1 for i in range(60)) > 55 and sum(by_id[100 + i] == 0 for i in range(60)) > 55
    kept = quality.good_rows(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id >= 100 and doc_id < 160").count() < 5


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a b", "s"), (2, None, "s")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality(docs, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.99 for r in quality.quality(documents(spark, [(i, "a", "s") for i in range(20)]), one).collect())
    assert quality.quality(documents(spark, []), none).collect() == []
    assert quality.good_rows(documents(spark, []), none).collect() == []
