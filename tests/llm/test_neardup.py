from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tallyloom.llm import neardup
from tallyloom.llm.components import components
from tallyloom.llm.shingles import shingles_of, words_of
from tests.llm.helpers import documents, folded, prose


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def _brute(texts):
    """doc_id -> (size, component), by comparing all pairs."""
    sets = {i: _set(t) for i, t, _ in texts if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def _near_copies(n, seed):
    """Copies of one text, each with a number of words changed: some linked, some not, some through others."""
    rng = random.Random(seed)
    base = prose(seed, 120)
    out = []
    for _ in range(n):
        words = list(base)
        for k in rng.sample(range(len(words)), rng.choice([0, 1, 1, 2, 3, 5, 9])):
            words[k] = "changed" + str(rng.randint(0, 3))
        out.append(" ".join(words))
    return out


def _texts():
    texts = [(i, t, "s") for i, t in enumerate(_near_copies(80, 1))]
    texts += [(100 + i, t, "s") for i, t in enumerate(_near_copies(40, 2))]
    texts += [(200 + i, " ".join(prose(50 + i, 30)), "s") for i in range(20)]
    texts += [(300, None, "s"), (301, "", "s"), (302, " \t\n", "s"), (303, "one", "s"), (304, "ONE", "s"), (305, "one two three", "s"),
              (306, "one two", "s"), (307, "one two three four five", "s"), (308, "One two THREE four five", "s")]
    texts += [(400, " ".join(prose(9, 20_000)), "s"), (401, " ".join(prose(9, 20_000)) + " end", "s")]
    return texts


def test_all_pairs(spark):
    texts = _texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents(spark, texts, extra=True).repartition(5)).collect()}
    assert got == _brute(texts)


def test_blocks_of_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    texts = [(i, t, "s") for i, t in enumerate(_near_copies(60, 5))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents(spark, texts)).collect()}
    assert got == _brute(texts)


def test_shuffled_beyond_the_limit(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    texts = [(i, t, "s") for i, t in enumerate(_near_copies(30, 6))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents(spark, texts)).collect()}
    assert got == _brute(texts)


def test_no_pair_within_the_distance_is_missed():
    """Signatures that differ in up to 35 slots share a key, and exactly one counts as the first."""
    rng = np.random.default_rng(4)
    for errors in (0, 1, 17, 18, 30, 35):
        for _ in range(20):
            a = rng.integers(0, 256, (neardup.CHUNKS, neardup.CHUNK_SLOTS), dtype=np.uint64)
            b = a.copy()
            for k in rng.choice(neardup.SLOTS, errors, replace=False):
                b[k // 7, k % 7] ^= np.uint64(rng.integers(1, 256))
            shifts = np.uint64(8) * np.arange(7, dtype=np.uint64)
            sigs = np.stack([(x << shifts).sum(axis=1, dtype=np.uint64) for x in (a, b)])
            assert neardup._errors(sigs[0], sigs[1]).sum() == errors
            import pyarrow as pa
            lists = pa.array([s.view(np.int64).tolist() for s in sigs], pa.list_(pa.int64()))
            keys = next(neardup._deletion_keys(iter([pa.RecordBatch.from_arrays([pa.array([1, 2]), lists], ["rep", "signature"])])))
            of = {r: {k for k, x in zip(keys.column(0).to_pylist(), keys.column(1).to_pylist()) if x == r} for r in (1, 2)}
            counted = 0
            for key in of[1] & of[2]:
                n = np.array([10, 10])
                group = {"key": np.array([key, key]), "rep": np.array([1, 2]), "label": np.array([1, 2]), "n": n, "signature": sigs,
                         "minor": np.array([False, True]), "block": np.array([0, 0]), "i": np.array([0, 0]), "j": np.array([0, 0])}
                counted += sum(len(a) for a, _ in neardup._candidate_forest(group))
            assert counted == 1


def test_empty_table_and_rows_without_id(spark):
    assert neardup.near_duplicates(documents(spark, [])).collect() == []
    assert neardup.one_of_each_group(documents(spark, [])).collect() == []
    text = " ".join(prose(3, 40))
    rows = neardup.near_duplicates(documents(spark, [(None, text, "s"), (5, text, "s"), (4, text, "s"), (4, text, "s")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [(-1, -1, True), (4, 4, True), (4, 4, True), (5, 4, False)]


def test_one_of_each_group_keeps_whole_rows_once(spark):
    text = " ".join(prose(3, 40))
    docs = documents(spark, [(None, text, "s"), (5, text, "a"), (4, text, "b"), (4, text, "b"), (7, None, "c"), (8, "", "d"), (9, "one text", "e"), (9, "another text", "f")], extra=True)
    kept = neardup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.source) for r in kept.collect()) == [(-1, "s"), (4, "b"), (7, "c"), (8, "d"), (9, "e"), (9, "f")]


def test_words_and_shingles_do_not_cross_rows():
    texts = ["a b c d e", "", "f", "g h", "a b c d e", "A\tB\nC\x0bD\x0cE", "a b c d e f"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    assert np.bincount(words_of(raw, bounds).rows, minlength=7).tolist() == [5, 0, 1, 2, 5, 5, 6]
    rows, shingles = shingles_of(raw, bounds)
    sets = [set(shingles[rows == k].tolist()) for k in range(7)]
    assert [len(s) for s in sets] == [1, 0, 1, 1, 1, 1, 2]
    assert sets[0] == sets[4] == sets[5] and sets[0] < sets[6]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(100 + k, 101 + k) for k in range(30)] + [(7, 7), (200, 200), (None, 3)]
    root = {x: x for pair in links for x in pair if None not in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def _written_rows(spark, texts, monkeypatch):
    """Rows of every table written on the way."""
    from tallyloom.llm import components as rounds
    sizes = []

    def counted(df, label):
        out = real(df, label)
        sizes.append(out.count())
        return out

    real = neardup.written
    with monkeypatch.context() as patch:
        patch.setattr(neardup, "written", counted)
        patch.setattr(rounds, "written", counted)
        neardup.near_duplicates(documents(spark, texts)).collect()
    return sum(sizes)


def test_what_is_written_grows_with_the_members_of_a_group(spark, monkeypatch):
    """Copies of one text that are near each other by signature, but not linked: the worst case for a table of pairs."""
    rng = random.Random(8)
    base = prose(8, 400)

    def copies(n):
        out = []
        for k in range(n):
            words = list(base)
            for place in rng.sample(range(0, 400, 6), 5):
                words[place] = f"own{k}x{place}"
            out.append((k, " ".join(words), "s"))
        return out

    small, large = (_written_rows(spark, copies(n), monkeypatch) for n in (100, 200))
    assert large <= 2.3 * small
