"""Joining a fact table with a dimension whose size is not known beforehand.

There is one calculation for every size. The joins carry no hint: adaptive execution
broadcasts a side that it has measured to be small, and splits hot partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions.measures import Measure, finalize, merge_partials, partial_aggregate


def join_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join on `key`."""
    return fact.join(dim, key)


def aggregate_by_attribute(fact: DataFrame, dim: DataFrame, key: str, buckets: list[str], attributes: list[str],
                           measures: list[Measure]) -> DataFrame:
    """Measures per bucket and dimension attribute.

    The facts are first reduced to one row per bucket and key, so that the join sees
    reduced rows only and a hot key is down to one row per bucket.
    """
    keys = [*attributes, *buckets]
    reduced = partial_aggregate(fact, [*buckets, key], measures)
    return finalize(merge_partials(reduced.join(dim, key), keys, measures), keys, measures)
