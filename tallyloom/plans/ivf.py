"""Approximate nearest-vector search over a clustered copy of the vectors.

Unit vectors are clustered on two levels: coarse cells over all rows, and fine cells inside every coarse one, the fourth
root of the number of rows each. So a row is compared with two fourth roots of centres and not with a square root of them. The
copy is partitioned by fine cell. A search looks up the closest coarse centres, then the closest fine centres under these,
reads the few cells that are left and ranks their rows exactly. Probing every cell gives the exact answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyloom.functions.vectors import as_matrix, item_bytes, numbers
from tallyloom.operators.search import DISTANCE_CELLS, QUERY_BLOCK_BYTES, Closest, directions, nearest, width_of
from tallyloom.session import cut_lineage
from tallyloom.sources.files import Folder

# Default size below which clustering does not pay.
MIN_ROWS = 500
# Rows of a coarse cell that place one of its fine centres, and steps of that placement.
ROWS_PER_CENTRE = 256
STEPS = 12
# Rows that are compared with the fine centres in one task.
SPLIT_ROWS = 65_536
# What a task holds for each query and cell of it.
CELL_BYTES = 16


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    vectors, _ = as_matrix(column.combine_chunks())
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _fine_centres(count: int, seed: int):
    """k-means over the sampled rows of one coarse cell; fewer centres if it has fewer different rows."""
    def run(rows: pa.Table) -> pa.Table:
        points = np.unique(_unit(rows.column("vec")), axis=0)
        centres = points[np.random.default_rng(seed).permutation(len(points))[:count]]
        for _ in range(STEPS):
            nearest_centre = (points @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest_centre, points)
            lengths = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1.0), centres)
        return pa.table({"coarse": pa.array([rows.column("coarse")[0].as_py()] * len(centres), pa.int32()),
                         "fine": pa.array(range(len(centres)), pa.int32()), "centre": pa.array(list(centres), pa.list_(pa.float64()))})

    return run


def _assign(vector_col: str, kept: list[str], width: int):
    def run(key: tuple, rows: pa.Table, centres: pa.Table) -> pa.Table:
        if not len(rows):
            return rows.select(kept).append_column("cell", pa.array([], pa.int32()))
        centre, _ = as_matrix(centres.column("centre").combine_chunks())
        fine = centres.column("fine").to_numpy()[(_unit(rows.column(vector_col)) @ centre.T).argmax(axis=1)]
        cell = rows.column("coarse").to_numpy() * width + fine
        return rows.select(kept).append_column("cell", pa.array(cell.astype(np.int32)))

    return run


@dataclass(frozen=True)
class IvfIndex:
    """Where the copy lives, and about how many fine cells it has: by default the square root of the number of vectors."""

    path: str
    cells: int | None = None
    vector_col: str = "embedding"
    id_col: str = "id"

    def build(self, df: DataFrame, min_rows: int = MIN_ROWS, seed: int = 7, training_rows: int | None = None) -> bool:
        """Cluster and write every row. Below `min_rows` rows there are no cells, and a search is exact.

        The coarse centres are placed on all rows, or on a sample of about `training_rows`; the fine ones on a sample of about
        `ROWS_PER_CENTRE` rows for each, by hash, so that no task holds a whole cell. Rows without a direction, or all rows
        without cells, go to cell -1, which every search reads. Returns whether there are cells.
        """
        spark, total = df.sparkSession, df.count()
        norm = F.sqrt(F.aggregate(self.vector_col, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
        whole = df.withColumn("_norm", norm)
        if total < max(min_rows, 2):
            self._write(df.withColumn("cell", F.lit(-1)))
            self._describe(spark.createDataFrame([], "coarse int, centre array<double>, size long"),
                           spark.createDataFrame([], "coarse int, fine int, centre array<double>, cell int, size long"))
            return False
        width = max(2, math.isqrt(self.cells) if self.cells else math.ceil(total ** 0.25))
        coarse = self._coarse(whole.where(F.col("_norm") > 0), width, total, seed, training_rows)
        sizes = coarse.groupBy("coarse").agg(F.count("*").alias("n"))
        hashed = F.pmod(F.xxhash64(self.id_col, self.vector_col), F.greatest(F.floor(F.col("n") / (ROWS_PER_CENTRE * width)), F.lit(1)))
        sample = coarse.join(F.broadcast(sizes), "coarse").where(hashed == 0).select("coarse", F.col(self.vector_col).cast("array<double>").alias("vec"))  # sizes: `width` rows
        centres = cut_lineage(sample.groupBy("coarse").applyInArrow(_fine_centres(width, seed), "coarse int, fine int, centre array<double>"))
        parts = sizes.select("coarse", F.ceil(F.col("n") / SPLIT_ROWS).alias("parts"))
        rows = coarse.join(F.broadcast(parts), "coarse").withColumn("part", F.pmod(F.xxhash64(self.id_col, self.vector_col), F.col("parts"))).drop("parts")
        listed = centres.join(F.broadcast(parts.toDF("coarse", "shares")), "coarse").select(
            "coarse", "fine", "centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("part"))
        schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType())])
        named = rows.groupBy("coarse", "part").cogroup(listed.groupBy("coarse", "part")).applyInArrow(_assign(self.vector_col, df.columns, width), schema)
        loose = whole.where(~(F.col("_norm") > 0) | F.col("_norm").isNull()).drop("_norm").withColumn("cell", F.lit(-1))
        self._write(named.unionByName(loose))
        held = spark.read.parquet(f"{self.path}/rows").groupBy("cell").agg(F.count("*").alias("size"))
        fine = centres.withColumn("cell", F.col("coarse") * width + F.col("fine")).join(held, "cell").select("coarse", "fine", "centre", "cell", "size")
        # a coarse centre is the mean of its fine ones, weighed by their rows
        items = fine.select("coarse", "size", F.posexplode("centre").alias("pos", "x")).groupBy("coarse", "pos").agg((F.sum(F.col("x") * F.col("size")) / F.sum("size")).alias("m"))
        top = items.groupBy("coarse").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centre"))
        self._describe(top.join(fine.groupBy("coarse").agg(F.sum("size").alias("size")), "coarse"), fine)
        return True

    def _coarse(self, directed: DataFrame, width: int, total: int, seed: int, training_rows: int | None) -> DataFrame:
        """The rows with their coarse cell, kept in the shared folder."""
        raw = directed.withColumn("_raw", array_to_vector(F.transform(self.vector_col, lambda x: x.cast("double"))))
        unit = Normalizer(inputCol="_raw", outputCol="_unit", p=2.0).transform(raw)
        share = 1.0 if training_rows is None else min(1.0, training_rows / total)
        model = KMeans(k=width, seed=seed, featuresCol="_unit", predictionCol="coarse").fit(unit if share == 1.0 else unit.sample(fraction=share, seed=seed))
        return cut_lineage(model.transform(unit).drop("_raw", "_unit", "_norm"))

    def _write(self, rows: DataFrame) -> None:
        rows.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/rows")

    def _describe(self, coarse: DataFrame, fine: DataFrame) -> None:
        coarse.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/coarse")
        fine.write.mode("overwrite").parquet(f"{self.path}/centres")

    def drop(self, spark: SparkSession) -> None:
        if Folder(spark, f"{self.path}/centres").exists():
            Folder(spark, self.path).delete()

    def search(self, spark: SparkSession, query: list[float], k: int = 5, probes: int = 4) -> DataFrame:
        """The k closest rows within the `probes` closest cells, and further cells while these hold fewer than k rows.

        The cells are those under the `probes` closest coarse centres, or more of them while these hold fewer than k rows.
        """
        rows = spark.read.parquet(f"{self.path}/rows")
        coarse, fine = (spark.read.parquet(f"{self.path}/{name}") for name in ("coarse", "centres"))
        if probes < fine.count():
            tops = self._closest(coarse, query, "coarse", k, probes)
            cells = self._closest(fine.where(F.col("coarse").isin(tops)), query, "cell", k, probes)
            rows = rows.where(F.col("cell").isin([*cells, -1]))
        return nearest(rows.drop("cell"), query, k, self.vector_col, self.id_col)

    @staticmethod
    def _closest(centres: DataFrame, query: list[float], name: str, k: int, probes: int) -> list[int]:
        """The closest centres that are needed; every one of them holds a row, so k more than `probes` are enough."""
        chosen, held = [], 0
        for row in nearest(centres, query, probes + k, "centre", name).select(name, "size").collect():
            if len(chosen) >= probes and held >= k:
                break
            chosen.append(row[0])
            held += row[1]
        return chosen

    def search_each(self, spark: SparkSession, queries: DataFrame, k: int = 5, probes: int = 4) -> DataFrame:
        """(query_id, rank, id, distance) for many queries (query_id long, query_vector), as a join of blocks.

        For every query the closest coarse cells, then the closest fine ones under these, then their rows. Blocks of queries meet
        the centres, about as many as the square root of the rows, and then the parts of the rows; only the rows of a query's own
        cells are compared with it. Blocks and parts are written once each, and no pair of a query and a cell or a row is: what a task
        gives are k rows for each of its queries. A query whose
        cells hold fewer than k rows gets fewer; ids are 64-bit integers, and vectors and queries have a direction.
        """
        rows = spark.read.parquet(f"{self.path}/rows")
        coarse, fine = (spark.read.parquet(f"{self.path}/{name}") for name in ("coarse", "centres"))
        rows = rows.select("cell", F.col(self.id_col).cast("long").alias("id"), numbers(rows, self.vector_col).alias("vec"))
        queries = cut_lineage(queries.select(F.col("query_id").cast("long").alias("q"), numbers(queries, "query_vector").alias("v")).where("q is not null"))
        cells, held = fine.count(), rows.count()
        size = queries.agg(F.sum(F.greatest(F.size("v"), F.lit(1)) * item_bytes(queries, "v") + CELL_BYTES * min(probes, cells)).alias("b")).first()["b"] or 0
        blocks = max(1, math.ceil(size / QUERY_BLOCK_BYTES))
        parts = max(1, math.ceil(held / SPLIT_ROWS), math.ceil(spark.sparkContext.defaultParallelism / blocks))
        # the vector is part of the hash, so repeated ids do not crowd one block or part
        asked = _packed(queries, F.xxhash64("q", "v"), blocks)
        if cells:
            centres = coarse.select("coarse", F.lit(None).cast("int").alias("cell"), "centre").unionByName(fine.select("coarse", "cell", "centre"))
            asked = cut_lineage(asked.crossJoin(F.broadcast(_packed(centres, F.lit(0), 1).withColumnRenamed("packed", "centres"))).mapInArrow(
                _cells_of_queries(probes), "packed binary"))
        split = _packed(rows, F.xxhash64("id", "vec"), parts).withColumnRenamed("packed", "rows")
        found = asked.crossJoin(split.hint("shuffle_replicate_nl")).mapInArrow(_rows_of_cells(k), "query_id long, id long, distance double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


def _packed(df: DataFrame, dealt: Column, parts: int) -> DataFrame:
    """Column `packed`: the rows of each part as one Arrow stream, a part for each partition; kept in the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, held[0].schema) as stream:
                for batch in held:
                    stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["packed"])

    return cut_lineage(df.repartitionById(parts, F.pmod(dealt, F.lit(parts)).cast("int")).mapInArrow(run, "packed binary"))


def _unpacked(blob: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(blob.as_buffer()).read_all().combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks)


def _cells_of_queries(probes: int):
    """Packed queries with the list of their closest cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, told in zip(batch.column("packed"), batch.column("centres")):
                queries, centres = _unpacked(block), _unpacked(told).sort_by("cell")
                fine = centres.filter(centres.column("cell").is_valid())
                coarse = centres.filter(centres.column("cell").is_null()).sort_by("coarse")
                targets = _column(queries, "v")
                width = width_of(_column(fine, "centre"))
                top = _near(targets, _column(coarse, "centre"), width, 6)
                of, cell = fine.column("coarse").to_numpy(), fine.column("cell").to_numpy()
                place = np.searchsorted(coarse.column("coarse").to_numpy(), of)
                lists = []
                step = max(1, DISTANCE_CELLS // len(fine))
                for at in range(0, len(queries), step):
                    near = np.argsort(top[at:at + step], axis=1, kind="stable")[:, :probes]
                    open_ = np.zeros(top[at:at + step].shape, bool)
                    np.put_along_axis(open_, near, True, axis=1)
                    distance = np.where(open_[:, place], _near(targets[at:at + step], _column(fine, "centre"), width), np.inf)
                    order = np.argsort(distance, axis=1, kind="stable")[:, :probes]
                    reached = np.isfinite(np.take_along_axis(distance, order, axis=1))
                    ends = np.concatenate([[0], np.cumsum(reached.sum(axis=1))]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(cell[order[reached]].astype(np.int32))))
                out = pa.BufferOutputStream()
                named = queries.append_column("cells", pa.chunked_array(lists))
                with pa.ipc.new_stream(out, named.schema) as stream:
                    stream.write_table(named)
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["packed"])

    return run


def _near(targets: pa.Array, centres: pa.Array, width: int, digits: int | None = None) -> np.ndarray:
    """Distances of queries (rows) and centres (columns)."""
    (_, left, known), (_, right, _) = directions(targets, width), directions(centres, width)
    distance = np.where(known[:, None] > 0, known[:, None], 1.0 - left @ right.T)
    return distance if digits is None else np.round(distance, digits)


def _rows_of_cells(k: int):
    """The k best rows of a part for every query of a block, from the query's cells and the rows without a cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, part in zip(batch.column("packed"), batch.column("rows")):
                queries, rows = _unpacked(block), _unpacked(part).sort_by([("cell", "ascending"), ("id", "ascending")])
                targets, vectors, ids = _column(queries, "v"), _column(rows, "vec"), rows.column("id").to_numpy()
                if not (width := width_of(targets)):
                    vectors = pa.nulls(len(vectors), vectors.type)
                closest = Closest(targets, width, k)
                cells, firsts = np.unique(rows.column("cell").to_numpy(), return_index=True)
                if "cells" in queries.column_names:
                    lists = _column(queries, "cells")
                    probed = lists.flatten().to_numpy()
                    order = np.argsort(probed, kind="stable")
                    owner = np.repeat(np.arange(len(queries), dtype=np.int32), np.diff(lists.offsets.to_numpy()))[order]
                    probed = probed[order]
                else:
                    owner = probed = np.zeros(0, np.int32)
                for cell, first, last in zip(cells, firsts, [*firsts[1:], len(rows)]):
                    mine = None if cell < 0 else owner[slice(*np.searchsorted(probed, [cell, cell + 1]))]
                    if mine is None or len(mine):
                        closest.add(vectors[first:last], ids[first:last], mine)
                yield from closest.table(_column(queries, "q")).to_batches()

    return run
