"""Loading text files and literal rows into declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.scalars import parse_array_literal


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
             columns: Sequence[str] | None = None, delimiter: str = ",", header: bool = True,
             partitions: int | None = None) -> DataFrame:
    """CSV files (plain, gzip or on an object store) as `schema`; a bad row fails the job.

    `columns` names the file's columns in file order when only some of the table's
    columns are present; the others come back null. Array columns hold ``{a,b}``
    literals, quotes inside a quoted value are doubled. A gzip file cannot be split, so give `partitions` to spread its rows
    after the read; many smaller files need no such shuffle.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    in_file = list(columns) if columns is not None else schema.names
    fields = [schema[name] for name in in_file]
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType) for f in fields])
    df = (spark.read.schema(as_text).option("header", header).option("sep", delimiter).option("escape", '"')
          .option("mode", "FAILFAST").option("enforceSchema", not header).csv(path))
    if partitions is not None:
        df = df.repartition(partitions)
    return df.select([
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in in_file
        else parse_array_literal(F.col(f.name)).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in schema.fields])


# Arrow types of the small frames the jobs build themselves.
_ARROW = {"timestamp": pa.timestamp("us", "UTC"), "string": pa.string(), "date": pa.date32(),
          "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A handful of driver rows, handed over as one Arrow table (no Python worker starts)."""
    fields = T.StructType.fromDDL(schema).fields
    columns = [pa.array([row[i] for row in rows], _ARROW[f.dataType.simpleString()]) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=[f.name for f in fields]), schema).coalesce(1)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """A few literal rows with the table's types; text is cast, a bad value fails.

    `columns` gives the order of the values when it differs from the table's.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = list(columns) if columns is not None else schema.names
    scalar = {f.name: not isinstance(f.dataType, T.ArrayType) for f in schema.fields}
    typed = T.StructType([T.StructField(n, T.StringType() if scalar[n] else schema[n].dataType) for n in names])
    text = [tuple(str(v) if v is not None and scalar[n] else v for n, v in zip(names, row, strict=True)) for row in rows]
    df = spark.createDataFrame(text, typed)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) if f.name in names
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
