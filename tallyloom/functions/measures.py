"""Aggregates that can be computed in steps.

A `Measure` knows its partial columns, how partials merge and how the final
value is read from them. The same definition serves a plain aggregate, an
aggregate pushed below a dimension join, and a stored roll-up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Measure:
    """One output column: `kind` over `column`, ordered by `by` for first/last."""

    name: str
    kind: str
    column: str | None = None
    by: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("avg", "sum", "min", "max", "count", "first", "last", "stddev"):
            raise ValueError(f"unknown measure kind {self.kind}")
        if self.kind in ("first", "last") and self.by is None:
            raise ValueError(f"{self.name}: {self.kind} needs an ordering column")

    def _part(self, suffix: str) -> str:
        return f"{self.name}__{suffix}"

    def partial(self) -> list[Column]:
        col = self.column
        if self.kind in ("min", "max", "sum"):
            return [getattr(F, self.kind)(col).alias(self._part(self.kind))]
        if self.kind == "count":
            return [F.count(F.col(col) if col else F.lit(1)).alias(self._part("n"))]
        if self.kind == "avg":
            return [F.sum(col).alias(self._part("sum")), F.count(col).alias(self._part("n"))]
        if self.kind == "stddev":
            return [F.count(col).alias(self._part("n")),
                    F.avg(F.col(col).cast("double")).alias(self._part("mean")),
                    (F.var_pop(col) * F.count(col)).alias(self._part("m2"))]
        pick, edge = (F.min_by, F.min) if self.kind == "first" else (F.max_by, F.max)
        return [pick(col, self.by).alias(self._part("value")), edge(self.by).alias(self._part("at"))]

    def merge(self) -> list[Column]:
        part = self._part
        if self.kind in ("min", "max"):
            return [getattr(F, self.kind)(part(self.kind)).alias(part(self.kind))]
        if self.kind == "sum":
            return [F.sum(part("sum")).alias(part("sum"))]
        if self.kind == "count":
            return [F.sum(part("n")).alias(part("n"))]
        if self.kind == "avg":
            return [F.sum(part("sum")).alias(part("sum")), F.sum(part("n")).alias(part("n"))]
        if self.kind == "stddev":
            # differences from the group's own mean, not from zero: nothing large cancels
            n, mean, centre = F.col(part("n")), F.col(part("mean")), F.col(part("centre"))
            return [F.sum(n).alias(part("n")), F.first(centre).alias(part("mean")),
                    F.sum(F.col(part("m2")) + n * (mean - centre) * (mean - centre)).alias(part("m2"))]
        pick, edge = (F.min_by, F.min) if self.kind == "first" else (F.max_by, F.max)
        return [pick(part("value"), part("at")).alias(part("value")), edge(part("at")).alias(part("at"))]

    def centre(self) -> Column:
        """Mean over the partials of a group."""
        n = F.col(self._part("n"))
        return F.try_divide(F.sum(n * F.col(self._part("mean"))), F.sum(n)).alias(self._part("centre"))

    def final(self, schema: T.StructType) -> Column:
        part = self._part
        if self.kind in ("min", "max", "sum"):
            out = F.col(part(self.kind))
        elif self.kind == "count":
            out = F.col(part("n"))
        elif self.kind == "avg":
            out, kind = F.try_divide(F.col(part("sum")), F.col(part("n"))), schema[part("sum")].dataType
            if isinstance(kind, T.DecimalType):
                # a sum has ten digits more than its column, an average four more and four decimals more
                digits = min(kind.precision - 6, 38) if kind.precision < 38 else 38
                out = out.cast(T.DecimalType(digits, min(kind.scale + 4, digits)))
        elif self.kind == "stddev":
            out = F.sqrt(F.try_divide(F.col(part("m2")), F.col(part("n")) - 1))
        else:
            out = F.col(part("value"))
        return out.alias(self.name)

    def direct(self) -> Column:
        """The same value in a single aggregate."""
        if self.kind == "first":
            return F.min_by(self.column, self.by).alias(self.name)
        if self.kind == "last":
            return F.max_by(self.column, self.by).alias(self.name)
        if self.kind == "count":
            return F.count(F.col(self.column) if self.column else F.lit(1)).alias(self.name)
        return getattr(F, self.kind)(self.column).alias(self.name)


def aggregate(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.direct() for m in measures])


def partial_aggregate(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c for m in measures for c in m.partial()])


def merge_partials(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """One row of partials per group. The columns keep their types, so merging can be repeated."""
    spread = [m for m in measures if m.kind == "stddev"]
    names = [c for c in df.columns if c not in keys]
    if spread:
        centres = df.groupBy(*keys).agg(*[m.centre() for m in spread])
        if keys:
            same = [f"_same_{k}" for k in keys]
            centres = centres.toDF(*same, *centres.columns[len(keys):])
            df = df.join(centres, [df[k].eqNullSafe(centres[s]) for k, s in zip(keys, same)])
        else:
            df = df.crossJoin(centres)  # one row
    merged = df.groupBy(*keys).agg(*[c for m in measures for c in m.merge()])
    kept = {n: df.schema[n].dataType for n in names}
    return merged.select(*keys, *[F.col(c).cast(kept[c]).alias(c) if isinstance(kept.get(c), T.DecimalType) else F.col(c)
                                  for c in merged.columns[len(keys):]])


def finalize(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """The final values, with the types that a single aggregate over the rows has."""
    return df.select(*keys, *[m.final(df.schema) for m in measures])
