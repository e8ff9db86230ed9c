"""Byte-level BPE through a SentencePiece model that is written straight from a rank file.

Every token of the rank file becomes a piece: its bytes mapped to printable
characters, scored by its negative rank, so that the merge of the best score is the merge
of the lowest rank. The model does no normalisation. A text is divided by the
pattern, each pre-token is mapped and encoded by itself, and ids are decoded by
the inverse mapping. A pre-token that is a token as a whole is that token.

Defined cases: a null or empty text has no tokens and decodes to nothing; rows that
repeat or lack a doc_id are encoded like others; a lone pre-token of any length is one
input of the model; `encoded` keeps other columns, `tokens` drops them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

CACHE_PIECES = 200_000
GROUP_CHARS = 1 << 19
# Field numbers and kinds of the SentencePiece model format.
_UNKNOWN, _NORMAL, _BPE = 2, 1, 2
# The usual pattern, and one that gives the same pieces where letters are ASCII or Latin and all
# else is ASCII. The standard library matches it several times faster.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_BLANK = "\t-\r "
PLAIN_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANK}{_LETTERS}0-9]+"
                 f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_PLAIN = re.compile(f"[\x00-\x7f{_LETTERS}]*").fullmatch
TOKENS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _printable() -> list[str]:
    """A character for each byte: itself if it is printable and no space, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


_CHARS = _printable()
_TO_CHARS = {b: c for b, c in enumerate(_CHARS)}
_TO_BYTE = {ord(c): b for b, c in enumerate(_CHARS)}


def to_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def to_bytes(chars: str) -> bytes:
    return chars.translate(_TO_BYTE).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised SentencePiece BPE model whose ids are the ranks; the unknown piece comes last."""
    size = max(ranks.values(), default=-1) + 1
    pieces: list[bytes | None] = [None] * size
    for token, rank in ranks.items():
        pieces[rank] = token
    out = []
    for rank, token in enumerate(pieces):
        chars = to_chars(token) if token is not None else f"<gap {rank}>"
        body = _bytes_field(1, chars.encode()) + b"\x15" + struct.pack("<f", -float(rank)) + _int_field(3, _NORMAL)
        out.append(_bytes_field(1, body))
    out.append(_bytes_field(1, _bytes_field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _int_field(3, _UNKNOWN)))
    trainer = _int_field(3, _BPE) + _int_field(4, size + 1) + _int_field(40, size)
    plain = _bytes_field(1, b"identity") + b"".join(_int_field(n, 0) for n in (3, 4, 5))
    return b"".join(out) + _bytes_field(2, trainer) + _bytes_field(3, plain)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.whole = {token.decode(): rank for token, rank in ranks.items() if _is_text(token)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.plain: Callable[[str], list[str]] | None = re.compile(PLAIN_PATTERN).findall if pattern == WORD_PATTERN else None
        self.cache: dict[str, bytes] = {}
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.ends = np.cumsum([0, *map(len, tokens)])
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def _learn(self, pieces: set[str]) -> None:
        rest = []
        for p in pieces:
            whole = self.whole.get(p)
            if whole is None:
                rest.append(p)
            else:
                self.cache[p] = whole.to_bytes(4, "little")
        ids = self.model.encode([to_chars(p.encode()) for p in rest], num_threads=1)
        for p, own in zip(rest, ids):
            self.cache[p] = struct.pack(f"<{len(own)}I", *own)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; null as the empty text. New pre-tokens of many texts go to the model together."""
        waiting: list[list[str]] = []
        fresh: set[str] = set()
        size = 0

        def out() -> Iterator[np.ndarray]:
            self._learn(fresh)
            for pieces in waiting:
                yield np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), "<u4")
            waiting.clear()
            fresh.clear()

        for text in texts:
            text = text or ""
            if len(self.cache) + len(fresh) > CACHE_PIECES:
                yield from out()
                self.cache = {}
            pieces = (self.plain if self.plain is not None and _PLAIN(text) else self.split)(text)
            waiting.append(pieces)
            fresh.update(set(pieces).difference(self.cache))
            size += len(text)
            if size > GROUP_CHARS:
                yield from out()
                size = 0
        yield from out()

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of known ids; an id outside the vocabulary is an error."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.ends[ids + 1] - self.ends[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[ids] - (ends - sizes), sizes)
        return self.flat[places].tobytes()


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker and vocabulary."""
    return Codec(read_ranks(path), pattern)


def tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (32-bit little endian) and decoded_sha256, of the encoded and decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            sizes, ids_sha, text_sha = [], [], []
            for ids in own.encode_all(text.as_py() for text in batch.column(1)):
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, TOKENS)


def encoded(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """`docs` with the token ids of `text` as an array column, which replaces a column of that name."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for part in texts:
            rows = [ids.astype(np.int32) for ids in own.encode_all(t.as_py() for t in part)]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return docs.withColumn(ids, F.arrow_udf(run, "array<int>")(F.col("text").cast("string")))


def decoded(encoded_docs: DataFrame, path: str, pattern: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """The text of the token ids; bytes that are no UTF-8 become U+FFFD, null ids a null text."""
    def run(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for part in lists:
            yield pa.array([None if x.as_py() is None else own.decode(np.array(x.as_py(), np.int64)).decode(errors="replace") for x in part], pa.string())

    return encoded_docs.withColumn(text, F.arrow_udf(run, "string")(F.col(ids)))
