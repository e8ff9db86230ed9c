from __future__ import annotations

import random
import re
import time

import pytest

from tallyloom.llm import personal
from tests.llm.helpers import documents

# the patterns of the task, read as they stand
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, pattern) in enumerate(PATTERNS.items())
             for m in re.finditer(pattern, text or "") if _passes(kind, m[0])]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def _base(text):
    return [(personal.KINDS[r], a, b) for r, a, b, _, base in personal.find(text) if base]


def _kinds(text, **more):
    return [(personal.KINDS[r], text[a:b]) for r, a, b, _, _ in personal.find(text, **more)]


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_are_those_of_the_patterns(seed):
    rng = random.Random(seed)
    alphabets = ["ab.@-1 ", "0123456789 -", "0123456789.+() -", "a1@.@.é_%", "12.+ "]
    pieces = ["4111 1111 1111 1111", "a@b.c", ".@x.y", "@d.e", "1.2.3.4", "256.1.1.1", "+1 (017) 555-7713", " ", "  ", "é", "000255.1.1.1", "5500005555555559"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) if rng.random() < 0.3 else rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 40)))
        assert _base(text) == _brute(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "1 " * 500_000, "+1" * 500_000, "+1" + "(" * 1_000_000, "a@" * 500_000,
                 "@" * 1_000_000, " @b.c" * 200_000, "1.1.1 " * 200_000, "(at)" * 250_000, "AA00" * 250_000, "1:" * 500_000):
        personal.find(text)
    assert time.time() - start < 40


def test_added_spans_and_their_checks():
    assert _kinds("7536784127813050 4845168114407329") == [("card", "7536784127813050"), ("card", "4845168114407329")]
    assert _kinds("7536784127813051 4845168114407329") == [("card", "4845168114407329")]
    assert _kinds("+1 (826) 555-4081 190.137.223.204") == [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")]
    assert _kinds("pay to GB82 WEST 1234 5698 7654 32 now") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert _kinds("pay to GB83 WEST 1234 5698 7654 32 now") == []
    assert _kinds("DE89370400440532013000") == [("iban", "DE89370400440532013000")]
    assert ("person_id", "2 55 08 14 168 025 38") in _kinds("nir 2 55 08 14 168 025 38")
    assert _kinds("mail: jane (at) example (dot) org, jim at home") == [("email", "jane (at) example (dot) org")]
    assert _kinds("host 2001:0db8:0000:0000:0000:ff00:0042:8329 up") == [("ipv6", "2001:0db8:0000:0000:0000:ff00:0042:8329")]


def test_nearby_words_decide():
    assert _kinds("SSN: 123-45-6789") == [("person_id", "123-45-6789")] and _kinds("part 123-45-6789") == []
    assert _kinds("DNI 12345678Z") == [("person_id", "12345678Z")] and _kinds("DNI 12345678A") == [] and _kinds("x 12345678Z") == []
    assert _kinds("phone (030) 1234 5678") == [("phone", "(030) 1234 5678")] and _kinds("from (030) 1234 5678") == []
    assert _kinds("part 123-45-6789", min_score=0.2) == [("person_id", "123-45-6789")]
    score = lambda text: [s for _, _, _, s, _ in personal.find(text)]
    assert score("server 10.0.0.1") > score("10.0.0.1") > score("version 10.0.0.1") and len(score("version 10.0.0.1")) == 1


def _texts():
    return [(1, "Write to a.b@mail.example.com or 4111-1111-1111-1111.", "s"), (2, None, "s"), (3, "", "s"), (None, "é 10.0.0.1", None),
            (1, "Write to a.b@mail.example.com or 4111-1111-1111-1111.", "s"), (4, "x" * 20_000 + " +49 30 1234567 é", "s"), (5, "nothing here", "s")]


def test_digest_of_a_table(spark):
    import hashlib
    out = personal.digest(personal.personal_data(documents(spark, _texts(), extra=True).repartition(3)))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for i, text, _ in _texts():
        base = _brute(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        want.append((i, *counts, hashlib.sha256(listed.encode()).hexdigest(), listed))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert personal.digest(personal.personal_data(documents(spark, []))).collect() == []


def test_redacted_keeps_rows_and_columns(spark):
    docs = documents(spark, _texts(), extra=True)
    out = personal.redacted(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in out.collect()), key=repr)
    assert ("Write to [EMAIL] or [CARD].") in {t for _, t in got} and (0, "é [IP]") in got and (2, None) in got and (3, "") in got
    assert sum(t is not None and t.endswith("[PHONE] é") for _, t in got) == 1
