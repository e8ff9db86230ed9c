from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import pytest

from tallyloom.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _own(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, key, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in convs.items()}


def _rebuilt(rows):
    own, out = _own(rows), {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def words(p):
        return len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    total = {}
    for p in sorted(members, key=len, reverse=True):
        below = [total[q] for q in children.get(p, [])]
        total[p] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[p]) - 1) * words(p))
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("depth", "name", "place", "row", "part", "digest", "words", "n"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def _rows():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 130), -1, -20, -27, 5000, 10 ** 15, 241, 245]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no  way\there", "", "é x", "a b c"])))
    rows += [(7, 3, "user", "again"), (7, 3, "user", "again"), (8, None, None, None), (8, None, "user", "first"), (None, 1, "user", "x")]
    rows += [(60, t, "user", f"turn {t}") for t in range(20, 60)] + [(61, t, "user", f"turn {t}") for t in range(20, 57)]
    rows += [(c, 0, "user", "the same") for c in range(300, 340)] + [(400, 0, "u", "x " * 50_000)]
    return rows


def _got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_a_plain_trie(spark):
    rows = _rows()
    assert _got(trie.prefix_trie(_table(spark, rows).repartition(5))) == _brute(_rebuilt(rows))


def test_hot_keys(spark, monkeypatch):
    """A limit of two makes nearly every look-up a hot one; without broadcasts the rows are the same."""
    rows = _rows()
    monkeypatch.setattr(trie, "HOT", 2)
    monkeypatch.setattr(trie, "ID_BLOCK_BITS", 2)
    monkeypatch.setattr(trie, "BROADCAST_HOT", 0)
    assert _got(trie.prefix_trie(_table(spark, rows).repartition(5))) == _brute(_rebuilt(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 1, "user", "only")], [(25, 0, None, None), (25, 0, None, None)]])
def test_small_tables(spark, rows):
    assert _got(trie.prefix_trie(_table(spark, rows))) == _brute(_rebuilt(rows))


def test_role_and_text_do_not_run_together(spark):
    rows = [(20, 0, "ab", "c"), (40, 0, "a", "bc"), (60, 0, "1:a", "x"), (80, 0, "1", ":ax"), (100, 0, "ab", "c")]
    got = _got(trie.prefix_trie(_table(spark, rows)))
    assert got == _brute(_rebuilt(rows)) and len(got) == 5
