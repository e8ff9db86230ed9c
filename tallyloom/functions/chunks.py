"""Splitting long texts into overlapping pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Separators from coarse to fine, piece size and overlap in characters.
SEPARATORS = ("\n\n", "\n", ".", "?", "!", " ", "")
CHUNK_SIZE = 800
CHUNK_OVERLAP = 400
# Characters of chunks that a task holds before it gives them on.
BLOCK_CHARS = 4_000_000


def _pieces(text: str, size: int, separators: tuple[str, ...]) -> Iterator[str]:
    """Cut at the coarsest separator that helps; every separator stays with the text before it."""
    if len(text) <= size:
        yield text
        return
    mark, finer = separators[0], separators[1:]
    if mark == "":
        yield from (text[i:i + size] for i in range(0, len(text), size))
        return
    start = 0
    while start < len(text):
        at = text.find(mark, start)
        end = len(text) if at < 0 else at + len(mark)
        yield from _pieces(text[start:end], size, finer)
        start = end


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces merged up to `size` characters; each chunk repeats up to `overlap` of the one before.

    Nothing is trimmed: with no overlap the chunks joined together are the text.
    """
    return list(_chunks(text, size, overlap, separators))


def _chunks(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> Iterator[str]:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    if "" not in separators:
        separators = (*separators, "")
    held, length = [], 0
    for piece in _pieces(text, size, separators):
        if held and length + len(piece) > size:
            yield "".join(held)
            first = 0
            while first < len(held) and (length > overlap or length + len(piece) > size):
                length -= len(held[first])
                first += 1
            held = held[first:]
        held.append(piece)
        length += len(piece)
    if length:
        yield "".join(held)


def split_column(df: DataFrame, text_col: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                 separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """One row per chunk: the row's other columns, `chunk_seq` from 0, and `chunk`.

    Texts are read one at a time, and chunks given on in blocks, so a task never holds the chunks of a whole batch of rows.
    """
    kept = [f for f in df.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField("chunk_seq", T.IntegerType()), T.StructField("chunk", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, places, chunks in _blocks(batch.column(text_col)):
                others = [batch.column(f.name).take(pa.array(rows, pa.int64())) for f in kept]
                yield pa.RecordBatch.from_arrays([*others, pa.array(places, pa.int32()), pa.array(chunks, pa.string())], schema.names)

    def _blocks(texts: pa.Array) -> Iterator[tuple[list[int], list[int], list[str]]]:
        rows, places, chunks, held = [], [], [], 0
        for row, text in enumerate(texts):
            for place, chunk in enumerate(_chunks(text.as_py() or "", size, overlap, separators)):
                rows.append(row)
                places.append(place)
                chunks.append(chunk)
                held += len(chunk)
                if held >= BLOCK_CHARS:
                    yield rows, places, chunks
                    rows, places, chunks, held = [], [], [], 0
        if rows:
            yield rows, places, chunks

    return df.mapInArrow(run, schema)
