from __future__ import annotations

import hashlib
import random
import re

from tallyloom.llm import decontaminate
from tests.llm.helpers import documents, folded, prose

ITEMS = "item_id long, text string"


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def _brute(texts, items):
    windows = {}
    for i, t in items:
        words = _words(t)
        for k in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[k:k + 13]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in texts:
        words = _words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                own = windows.get(tuple(words[k:k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(words), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def _case():
    rng = random.Random(8)
    items = [(k, " ".join(prose(k, n))) for k, n in enumerate([30, 13, 12, 14, 1, 2, 40, 40])]
    items += [(20, items[0][1]), (21, "Repeat repeat REPEAT " * 8), (22, None), (23, " ?!"), (24, "Ünï-cödé wörds und zahlen 12 34 a b c d e f g h i"), (25, "the the"),
              (26, "K\u212a \u0130x same sign one two three four five six seven eight nine ten")]
    texts = []
    for k in range(120):
        words = prose(1000 + k, rng.choice([0, 5, 30, 300]))
        for _ in range(rng.randint(0, 3)):
            source = _words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(source) - 5))
            piece = [w.upper() if rng.random() < 0.3 else w for w in source[a:a + rng.choice([3, 12, 13, 20, 99])]]
            at = rng.randint(0, len(words))
            words[at:at] = piece
        texts.append((k, rng.choice([" ", ", ", "\n--"]).join(words)))
    texts += [(300, None), (301, ""), (302, "..."), (303, items[2][1]), (304, " " + items[4][1] + " "), (305, "repeat " * 500),
              (306, " ".join(prose(5, 60_000)) + " " + items[0][1]), (307, "The\x00the"), (308, items[-1][1]), (309, items[-1][1].replace("\u212a", "k"))]
    return texts, items


def _rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_against_all_windows(spark, monkeypatch):
    texts, items = _case()
    docs = documents(spark, [(i, t, "s") for i, t in texts], extra=True)
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS window", "'x' AS anchor", "'x' AS words")
    want = _brute(texts, items)
    assert sum(w[4] for w in want.values()) > 20
    assert _rows(decontaminate.contamination(docs, bench)) == want
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert _rows(decontaminate.contamination(docs, bench)) == want


def test_repeated_and_missing_ids(spark):
    texts, items = _case()
    bench = spark.createDataFrame(items, ITEMS)
    once = documents(spark, [(i, t, "s") for i, t in texts])
    assert _rows(decontaminate.contamination(once.union(once), bench)) == _brute(texts, items)
    rows = decontaminate.contamination(documents(spark, [(None, items[0][1], "s"), (None, "x", "s")]), bench).collect()
    assert [(r.doc_id, r.contaminated) for r in rows] == [(None, True)]


def test_empty_tables(spark):
    bench, none = spark.createDataFrame([(1, "a b")], ITEMS), spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(documents(spark, []), bench).collect() == []
    assert _rows(decontaminate.contamination(documents(spark, [(1, "a b", "s")]), none)) == _brute([(1, "a b")], [])


def test_clean_keeps_the_other_rows_whole(spark):
    """Each row by its own text: with no id, with an id that another text has, and repeated."""
    texts, items = _case()
    bad = next(text for i, text in texts if _brute(texts, items)[i][4])
    more = [(None, bad, "s"), (None, "some other words", "s"), (9001, bad, "s"), (9001, "quite other words", "s"), (9001, "quite other words", "s"), (9002, None, "s")]
    docs = documents(spark, [(i, t, "s") for i, t in texts] + more, extra=True)
    kept = decontaminate.clean(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    single = [(k, t) for k, t in enumerate([t for _, t in texts] + [t for _, t, _ in more])]
    stays = _brute(single, items)
    ids = [i for i, _ in texts] + [i for i, _, _ in more]
    want = sorted(((ids[k], t) for k, t in single if not stays[k][4]), key=repr)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == want
    assert (9001, bad) not in want and (None, bad) not in want and want.count((9001, "quite other words")) == 2


def test_no_python_in_the_plan(spark, capsys):
    texts, items = _case()
    decontaminate.contamination(documents(spark, [(1, "a", "s")]), spark.createDataFrame(items, ITEMS)).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_shuffled_windows_carry_no_whole_text(spark, monkeypatch):
    """Beyond the broadcast limit a word takes the words a window can reach; a long text is not written once per word."""
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    _, items = _case()
    texts = [(1, " ".join(prose(5, 30_000)) + " " + items[0][1]), (2, " ".join(prose(6, 40)))]
    bench = spark.createDataFrame(items, ITEMS)
    docs = documents(spark, [(i, t, "s") for i, t in texts])
    found = decontaminate.occurrences(docs, bench)
    exchange = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "AS words" in line and "slice(" in line]
    assert exchange and f"{2 * decontaminate.WINDOW - 1})" in "".join(exchange)
    assert _rows(decontaminate.contamination(docs, bench)) == _brute(texts, items)
