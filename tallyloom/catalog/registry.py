"""The named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.catalog.view_sql import with_views

# The instant that stands for "now" in the queries over whole days,
# and the arguments of the sample questions.
AS_OF = "2024-01-31 00:00:00"
SYMBOL = "purchase"
SENSOR = 4
ADDRESS = "7"
TXID = "1939"
BLOCK = 1939
CENTRE = (-73.79, 40.641)
RADIUS_MILES = 15.0

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; `sql` is its check, read over `views` and the given tables."""

    def add(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(run, with_views(views, sql) if sql else None)
        return run

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select([F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else F.col(f.name) for f in df.schema.fields])


def text_time(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
