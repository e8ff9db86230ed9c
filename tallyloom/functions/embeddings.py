"""Turning a text column into vectors.

A provider is any function from a data frame and a text column to the data frame
with an added array column. The built-in one needs no network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

DIMENSIONS = 1536
Provider = Callable[[DataFrame, str, str], DataFrame]


def hashing_provider(dimensions: int = DIMENSIONS) -> Provider:
    """Hashed word counts of unit length: deterministic, and computed in the JVM."""

    def embed(df: DataFrame, text_col: str, out: str) -> DataFrame:
        words = Tokenizer(inputCol="_text", outputCol="_words").transform(
            df.withColumn("_text", F.coalesce(text_col, F.lit(""))))
        counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions).transform(words)
        unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
        return unit.withColumn(out, vector_to_array("_unit", "float32")).drop("_text", "_words", "_counts", "_unit")

    return embed


def batch_provider(model: Callable[[list[str]], np.ndarray]) -> Provider:
    """Wrap a function from a list of texts to a matrix, called once per Arrow batch."""

    def embed(df: DataFrame, text_col: str, out: str) -> DataFrame:
        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                matrix = np.asarray(model(texts.fillna("").tolist()), dtype="float32")
                yield pd.Series(list(matrix))

        return df.withColumn(out, vectors(text_col))

    return embed


def embed_column(df: DataFrame, text_col: str, out: str = "embedding", provider: Provider | None = None) -> DataFrame:
    return (provider or hashing_provider())(df, text_col, out)


def embed_query(spark, text: str, provider: Provider | None = None) -> list[float]:
    """Vector of one query text."""
    one = spark.createDataFrame([(text,)], "text string")
    return [float(x) for x in embed_column(one, "text", "embedding", provider).first()["embedding"]]
