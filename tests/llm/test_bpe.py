from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tallyloom.llm import bpe
from tests.llm.helpers import documents

PATH = P.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "the", " ", "  ", "\n", "é", "中文", "🎉", "1", "²", "½", "'s", "'ve", "!!", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "<|endoftext|>", "İ", "e\u0301", "ǅ", "٣",
         "\t", "\r\n", "…", " A", "ſ", "ß", "_", "supercalifragilistic", "\ufeff", "\ud7ff"]


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def _random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_same_ids_as_the_plain_encoder(name):
    path = P.path(name)
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = _random_texts(1500) + ["*" * 20_000, " " * 5_000, "ab" * 10_000, ""]
    own = bpe.codec(path, P.PATTERN)
    for text, ids in zip(texts, own.encode_all(texts)):
        assert ids.tolist() == plain.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_small_cache_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 50)
    texts = _random_texts(200)
    own = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    assert [x.tolist() for x in own.encode_all(texts)] == [plain.encode_ordinary(t) for t in texts]


def test_another_pattern(plain):
    own = bpe.Codec(bpe.read_ranks(PATH), r"\w+|\W")
    other = tiktoken.Encoding("own", pat_str=r"\w+|\W", mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    for text in ("one two, three", "naïve 12"):
        assert own.encode(text).tolist() == other.encode_ordinary(text)


def test_bytes_and_characters_are_inverse():
    data = bytes(range(256))
    assert bpe.to_bytes(bpe.to_chars(data)) == data and not any(c.isspace() for c in bpe.to_chars(data))


def test_unknown_ids_are_refused():
    with pytest.raises(ValueError):
        bpe.codec(PATH, P.PATTERN).decode(np.array([50_256]))


def test_rows(spark, plain):
    texts = [(i, t, "s") for i, t in enumerate(_random_texts(60))] + [(100, None, "s"), (101, "", "s"), (None, "no id", "s"), (1, "again", "s"), (102, "word " * 60_000, "s")]
    rows = bpe.tokens(documents(spark, texts, extra=True), PATH, P.PATTERN).collect()

    def want(i, t):
        ids = plain.encode_ordinary(t or "")
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())

    assert sorted(map(tuple, rows), key=repr) == sorted((want(i, t) for i, t, _ in texts), key=repr)


def test_columns_and_round_trip(spark):
    docs = documents(spark, [(1, "one two", "s"), (2, None, "s"), (3, "ünï 🎉", "s")], extra=True)
    ids = bpe.encoded(docs, PATH, P.PATTERN)
    assert ids.columns == docs.columns and dict(ids.dtypes)["token_ids"] == "array<int>"
    back = bpe.decoded(ids, PATH, P.PATTERN)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "one two", 2: "", 3: "ünï 🎉"}
    assert bpe.encoded(documents(spark, []), PATH, P.PATTERN).collect() == []
    assert bpe.tokens(documents(spark, []), PATH, P.PATTERN).collect() == []
