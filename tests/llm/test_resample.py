from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import resample
from tests.llm.helpers import documents, folded, prose


def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))
    return len(words), [crc32(" ".join(words[k:k + n]).encode()) % 10_000 for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def _brute(texts, items, percent=5):
    s, t = (Counter(b for text in side for b in _features(text)[1]) for side in ([x for _, x, _ in texts], items))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, text, _ in texts:
        n, found = _features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((-r[4], math.inf if r[0] is None else r[0]) for r in rows if r[1] >= 20)
    rank = {key: k + 1 for k, key in reversed(list(enumerate(able[:len(able) * percent // 100])))}
    return [(i, f, w, sc, rank.get((-sc, math.inf if i is None else i)) if n >= 20 else None) for i, n, f, w, sc in rows]


def _texts():
    rng = random.Random(3)
    common = prose(1, 60)
    texts = [(k, " ".join(rng.choice(common) for _ in range(rng.randint(0, 60))), "s") for k in range(300)]
    texts += [(1000, None, "s"), (1001, "", "s"), (1002, "... --- !", "s"), (1003, "É x ÀB 12 ab_cd", "s"), (-7, " ".join(common), "s"), (None, " ".join(common), "s"),
              (2 ** 40, " ".join(prose(2, 30_000)), "s")]
    return texts, [" ".join(common[:20]), None, "word"]


def _items(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_against_plain_counts(spark, percent):
    texts, items = _texts()
    got = resample.ranked(documents(spark, texts, extra=True).repartition(5), _items(spark, items), percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(_brute(texts, items, percent), key=repr)


def test_pieces_of_a_long_text(monkeypatch):
    text = " ".join(prose(5, 500)).encode()
    whole = sorted(b for _, found in resample.features(text) for b in found)
    monkeypatch.setattr(resample, "PIECE", 37)
    pieces = list(resample.features(text))
    assert len(pieces) > 50 and sorted(b for _, found in pieces for b in found) == whole and sum(n for n, _ in pieces) == 500


def test_repeated_rows_empty_tables_and_drawn_rows(spark):
    texts, items = _texts()
    same = [(5, texts[3][1] + " " + texts[4][1] + " and more words" * 10, "s")] * 40
    got = resample.ranked(documents(spark, same), _items(spark, items), 50).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 21)) and len({r.score for r in got}) == 1
    assert resample.ranked(documents(spark, []), _items(spark, items)).collect() == []
    assert len(resample.ranked(documents(spark, texts), _items(spark, [])).collect()) == len(texts)
    docs = documents(spark, texts, extra=True)
    out = resample.drawn(docs, _items(spark, items), 40)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(i or 0 for i, *_, rank in _brute(texts, items, 40) if rank)
    assert resample.drawn(docs, _items(spark, items), 0).collect() == []


@pytest.mark.parametrize("bits", [2])
def test_radix_places_of_all_kinds_of_keys(spark, monkeypatch, bits):
    """Negative, huge and very frequent keys, with chunks of four rows."""
    monkeypatch.setattr(resample, "CHUNK_BITS", bits)
    rng = random.Random(bits)
    rows = [(rng.choice([0, 0, 0, -5, 2 ** 62, -2 ** 63, rng.randint(-9, 9)]), k * 7919 % 500 - 250) for k in range(500)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    got = [(r.a, r.b) for r in resample.radix_places(df, ["a", "b"]).orderBy("place").collect()]
    assert got == sorted(rows)
    places = resample.radix_places(df, ["a"])
    assert [r[0] for r in places.select("place").orderBy("place").collect()] == list(range(500))
    one = resample.radix_places(df.withColumn("c", F.lit(3).cast("long")), ["c"])
    assert [r[0] for r in one.select("place").orderBy("place").collect()] == list(range(500))
