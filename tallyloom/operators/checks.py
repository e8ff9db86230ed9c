"""Schema rules as queries that list the rows breaking them, and dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.session import cut_lineage


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows naming a parent that does not exist; a null reference is allowed."""
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(parents, child_key, "left_anti")


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in any of the columns, with the name of the first one."""
    first = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.withColumn("null_column", first).where(F.col("null_column").isNotNull())


def length_violations(df: DataFrame, column: str, limit: int) -> DataFrame:
    return df.where(F.length(column) > limit)


def count_where(df: DataFrame, condition: Column | None = None, name: str = "row_count") -> DataFrame:
    if condition is not None:
        df = df.where(condition)
    return df.agg(F.count("*").alias(name))


def assign_ids(df: DataFrame, order_by: list[str | Column], name: str = "id", start: int = 1) -> DataFrame:
    """Dense ids in the order of `order_by`, without sorting everything in one task.

    The rows are range-sorted over all tasks by the order and a hash of the row, so that many rows with one order key are
    split as well, and checkpointed, which fixes their place; a partition's first id is then the number of rows
    before it. Only those counts, one per partition, meet in one task. Rows with equal order keys get places by their hash.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    place = cut_lineage(df.orderBy(*order_by, hashed)).select(
        "*", F.spark_partition_id().alias("_part"),
        (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("_offset"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = place.groupBy("_part").agg(F.count("*").alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return (place.join(ends, "_part")
            .withColumn(name, F.col("before") + F.col("_offset") + F.lit(start))
            .drop("_part", "_offset", "before"))
