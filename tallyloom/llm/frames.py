"""Helpers shared by the corpus operators: written intermediate tables and key-safe columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int, size: Column) -> DataFrame:
    """The frame with a broadcast hint if the bytes of its rows (`size` for each) add up to at most `limit`, else as it is.

    `df` should be a written table, as it is read once for the sum.
    """
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= limit else df


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def byte_blocks(texts: pa.Array, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of rows with about `limit` bytes of text.

    A row is never split, so one longer than the limit makes a block of its own.
    Null counts as empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, raw[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last
