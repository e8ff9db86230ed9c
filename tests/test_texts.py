from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.catalog import search
from tallyloom.functions import chunks as chunking
from tallyloom.functions.chunks import split_column, split_text
from tallyloom.functions.embeddings import batch_provider, embed_column, embed_query, hashing_provider
from tallyloom.plans.vectorizer import Vectorizer
from tallyloom.sources.files import Folder
from tests.conftest import DATA


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .\n?!é", max_size=300), st.integers(1, 40), st.data())
def test_chunks_cover_the_text(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    chunks = split_text(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    for i, chunk in enumerate(chunks):
        # each chunk starts inside or right after the one before, and ends further on
        starts = [s for s in range(max(0, at - overlap), at + 1) if text.startswith(chunk, s) and s + len(chunk) > at or not i]
        assert starts, (chunks, i)
        at = starts[0] + len(chunk)
    assert "".join(split_text(text, size, 0)) == text


def test_coarse_separators_win():
    assert split_text("one two.\n\nthree four.\n\nfive", 14, 0) == ["one two.\n\n", "three four.\n\n", "five"]
    assert split_text("aaaa bbbb cccc", 10, 5) == ["aaaa bbbb ", "bbbb cccc"]
    assert split_text("x" * 25, 10, 0) == ["x" * 10, "x" * 10, "x" * 5]
    assert split_text("", 10, 0) == []
    with pytest.raises(ValueError):
        split_text("a", 5, 5)


def test_split_column_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "aaaa bbbb cccc", "k"), (2, None, "l"), (3, "", "m")], "id int, t string, s string")
    got = split_column(df, "t", 10, 0).collect()
    assert [tuple(r) for r in got] == [(1, "k", 0, "aaaa bbbb "), (1, "k", 1, "cccc")]


def test_hashing_embeddings(spark):
    df = spark.createDataFrame([("snow on the charger",), ("the charger",), ("",), (None,)], "t string")
    rows = embed_column(df, "t", provider=hashing_provider(32)).collect()
    norms = [np.linalg.norm(r.embedding) for r in rows]
    assert all(len(r.embedding) == 32 for r in rows) and norms[0] == pytest.approx(1, abs=1e-6)
    assert embed_query(spark, "the charger", hashing_provider(32)) == pytest.approx(rows[1].embedding)


def test_batch_provider(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "t string")
    lengths = batch_provider(lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert [r.v for r in embed_column(df, "t", "v", lengths).orderBy("t").collect()] == [[2.0, 1.0], [3.0, 1.0]]


def source(spark, **texts):
    return spark.createDataFrame([(k, v) for k, v in texts.items()], "id string, body string")


def test_vectorizer_follows_its_source(spark, tmp_path):
    job = Vectorizer(str(tmp_path / "v"), "id", "body", chunk_size=10, chunk_overlap=0, provider=hashing_provider(8))
    first = source(spark, a="one two three four", b="short", c="gone soon")
    assert tuple(job.status(first).first()) == (0, 3)
    assert job.run(first) == 1 and job.run(first) == 0
    assert tuple(job.status(first).first()) == (3, 0)
    second = source(spark, a="one two three four", b="a changed text here", d="new")
    assert tuple(job.status(second).first()) == (3, 2)
    assert job.run(second) == 2
    view = job.view(second).orderBy("id", "chunk_seq").collect()
    joined = {}
    for r in view:
        joined[r.id] = joined.get(r.id, "") + r.chunk
    assert joined == {"a": "one two three four", "b": "a changed text here", "d": "new"}
    assert spark.read.parquet(job.store).where("run = 2 AND id IS NOT NULL").select("id").distinct().count() == 2
    assert job.run(source(spark, a="one two three four")) == 3
    back = source(spark, a="one two three four", d="new")
    assert job.run(back) == 4 and job.view(back).select("id").distinct().count() == 2


def test_vectorizer_run_cut_short_leaves_nothing(spark, tmp_path):
    job = Vectorizer(str(tmp_path / "v"), "id", "body", provider=hashing_provider(8))
    data = source(spark, a="one")
    split_column(data.withColumnRenamed("body", "t"), "t").withColumn("embedding", F.array(F.lit(0.5).cast("float"))).write.parquet(
        f"{job.path}/chunks/run=1")
    assert job.view(data).count() == 0
    job.run(data)
    assert job.view(data).count() == 1


def stored_ids(spark, job):
    return sorted((r.id, r.chunk_seq) for r in spark.read.parquet(job.store).where("id IS NOT NULL").collect())


def test_vectorizer_keeps_live_chunks_only(spark, tmp_path):
    """After partial changes nothing stale is stored, an empty text stays an item, and emptied buckets are empty."""
    job = Vectorizer(str(tmp_path / "v"), "id", "body", chunk_size=10, chunk_overlap=0, provider=hashing_provider(8), buckets=4)
    texts = {f"k{i}": "one two three four" for i in range(12)} | {"empty": "", "none": None}
    assert job.run(source(spark, **texts)) == 1 and job.run(source(spark, **texts)) == 0
    for change in range(4):
        texts[f"k{change}"] = f"now {change}"
        del texts[f"k{11 - change}"]
        texts["none" if change % 2 else "empty"] = "a text" if change < 2 else None
        data = source(spark, **texts)
        assert job.run(data) == change + 2
        live = split_column(data.where("body is not null"), "body", 10, 0).select("id", "chunk_seq").collect()
        blank = [k for k, v in texts.items() if not v]
        assert sorted(stored_ids(spark, job), key=str) == sorted([tuple(r) for r in live] + [(k, None) for k in blank], key=str)
        assert tuple(job.status(data).first()) == (len(texts), 0)
        assert job.view(data).count() == len(live)
    nothing = source(spark, **texts).limit(0)
    assert job.run(nothing) == 6 and stored_ids(spark, job) == [] and job.view(source(spark, **texts)).count() == 0


def test_vectorizer_rewrites_touched_buckets_only(spark, tmp_path):
    job = Vectorizer(str(tmp_path / "v"), "id", "body", provider=hashing_provider(8), buckets=8)
    texts = {f"k{i}": f"text {i}" for i in range(40)}
    job.run(source(spark, **texts))
    before = {str(p.relative_to(job.store)): p.stat().st_mtime_ns for p in Path(job.store).rglob("*.parquet")}
    job.run(source(spark, **{**texts, "k7": "changed"}))
    after = {str(p.relative_to(job.store)) for p in Path(job.store).rglob("*.parquet")}
    gone = {name.split("/")[0] for name in before if name not in after}
    assert len(gone) == 1 and sum(name in after for name in before) >= 7


def test_vectorizer_embeds_a_lost_bucket_again(spark, tmp_path):
    job = Vectorizer(str(tmp_path / "v"), "id", "body", provider=hashing_provider(8), buckets=4)
    data = source(spark, **{f"k{i}": f"text {i}" for i in range(20)})
    job.run(data)
    whole = stored_ids(spark, job)
    Folder(spark, f"{job.store}/bucket=1").delete()
    lost = job.pending(data).count()
    assert 0 < lost < 20 and job.run(data) == 2
    assert stored_ids(spark, job) == whole and job.pending(data).count() == 0


def test_vectorizer_ids_missing_or_shared(spark, tmp_path):
    job = Vectorizer(str(tmp_path / "v"), "id", "body", provider=hashing_provider(8), buckets=4)
    data = spark.createDataFrame([("a", "one"), ("a", "two"), ("a", ""), (None, "lost"), ("b", "")], "id string, body string")
    assert job.run(data) == 1 and job.run(data) == 0
    assert sorted(r.chunk for r in spark.read.parquet(job.store).where("chunk is not null").collect()) == ["one", "two"]
    assert tuple(job.status(data).first()) == (2, 0)


def test_chunks_are_given_on_in_blocks(spark, monkeypatch):
    """A batch of texts makes many batches of chunks."""
    df = spark.createDataFrame([(i, "ab " * 40 if i % 3 else None) for i in range(30)], "id int, t string").repartition(1)
    monkeypatch.setattr(chunking, "BLOCK_CHARS", 50)
    split = split_column(df, "t", 10, 0)
    sizes = split.mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) == split.count() == 20 * len(split_text("ab " * 40, 10, 0))
    assert "MapInArrow" in split._jdf.queryExecution().executedPlan().toString()
    found = sorted(map(tuple, split.where("id = 4").collect()))
    assert found == [(4, k, chunk) for k, chunk in enumerate(split_text("ab " * 40, 10, 0))]


def test_the_texts_of_found_chunks_are_looked_up_by_id(spark):
    text = search.chunk_search(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id" in text
