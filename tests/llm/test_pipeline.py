from __future__ import annotations

import importlib.util
from pathlib import Path

import public_tokenizers as P
import pytest
import tiktoken

from tallyloom.llm import bpe
from tallyloom.llm.queries import ENTRIES
from tests.llm.helpers import documents, prose

ROOT = Path(__file__).resolve().parents[2]
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.fixture(scope="module")
def pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def _texts():
    own = [(k, " ".join(prose(k, 60)) + "\nshared line of all sites", f"site{k % 15}") for k in range(80)]
    bad = [(100 + k, "!! ".join(w.upper() for w in prose(k, 60)), "site1") for k in range(40)]
    copies = [(200 + k, own[0][1], "site2") for k in range(5)] + [(210, own[1][1] + " and more", "site3")]
    passage = [(300, ITEM + " " + " ".join(prose(77, 20)), "site1"), (301, " ".join(prose(78, 2000)) + " " + ITEM, "site1")]
    return own + bad + copies + passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    documents(spark, _texts()).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, 0) for i, _, _ in _texts() if i < 100] + [(i, 0, 0) for i, _, _ in _texts() if 100 <= i < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_do_what_they_say(spark, pipeline, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good, cut, one, clean, ids = seen.values()
    whole = {i: t for i, t, _ in _texts()}
    assert set(good) == {i for i in whole if not 100 <= i < 200}
    assert set(cut) == set(good) and not any(r.text.endswith("of all sites") for r in cut.values())
    assert set(one) == set(good) - {200, 201, 202, 203, 204, 210}
    assert set(clean) == set(one) - {300}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {i: list(r.token_ids) for i, r in ids.items()} == {i: plain.encode_ordinary(r.text) for i, r in clean.items()}
    assert all(r.n_tokens == len(r.token_ids) for r in ids.values())


def test_run_writes_every_stage(spark, pipeline, folder):
    rows = pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "n_tokens", "token_ids"] and rows.count() == 81


def test_empty_documents(spark, pipeline, folder, tmp_path):
    import shutil
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        shutil.copytree(f"{folder}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_have_the_numbers_of_the_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in ENTRIES) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_queries_match_their_sql(spark, name):
    from tests.compare import compare, connect
    root = "/root/testdata/sf0.001"
    assert compare(spark, connect(root), name, ENTRIES[name].run, ENTRIES[name].sql, root) == ""
