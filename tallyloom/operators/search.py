"""Exact nearest-vector search and the text handed to a chat model."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyloom.functions.scalars import chat_messages
from tallyloom.functions.vectors import as_matrix, cosine_distances, cosine_to, item_bytes, numbers
from tallyloom.session import cut_lineage
from tallyloom.sources.readers import small_frame

# Query vectors and rows that meet in one task.
QUERY_BLOCK_BYTES = 8 * 1024 * 1024
SPLIT_ROWS = 65_536
# Beyond any distance: a zero vector, and a null one, on either side.
ZERO, MISSING = 10.0, 20.0
# Distances held at once by one task.
DISTANCE_CELLS = 4_000_000
# Numbers of the pairs whose distances are computed one by one at once, and what rounding may change in a distance.
PAIR_ITEMS = 2_000_000
SLACK = 2e-6
MERGE_WAYS = 256
SYSTEM_MESSAGE = "you are a helpful assistant"


def _closest(df: DataFrame, distance: Column, k: int, id_col: str, digits: int) -> DataFrame:
    """First k by distance, then id. Rounding makes equal angles tie; NaN and null go last."""
    return (df.withColumn("distance", F.round(distance, digits))
            .orderBy(F.col("distance").asc_nulls_last(), F.col(id_col)).limit(k))


def nearest(df: DataFrame, query: list[float], k: int = 5, vector_col: str = "embedding",
            id_col: str = "id", digits: int = 6) -> DataFrame:
    """The k rows closest to a fixed vector: a map and a top-k, no shuffle of the vectors.

    Vectors without a direction come last: zero ones with NaN, then null ones with null.
    """
    return _closest(df, cosine_to(F.col(vector_col), query), k, id_col, digits)


def nearest_to_row(df: DataFrame, condition: Column, k: int = 5, vector_col: str = "embedding",
                   id_col: str = "id", digits: int = 6) -> DataFrame:
    """The k rows closest to the stored vector of the first row (by id) meeting `condition`.

    The row itself is part of the answer. That one vector is fetched first, so the
    search is the same map and top-k as for a literal; without such a row every
    distance is null.
    """
    found = df.where(condition).orderBy(id_col).select(vector_col).first()
    if found is None or found[0] is None:
        return _closest(df, F.lit(None).cast("double"), k, id_col, digits)
    return nearest(df, [float(x) for x in found[0]], k, vector_col, id_col, digits)


def nearest_with(df: DataFrame, query: list[float], columns: list[str], k: int = 5, vector_col: str = "embedding",
                 id_col: str = "id", digits: int = 6) -> DataFrame:
    """The k closest rows with some of their other columns, closest first; `id_col` must name a row.

    Two phases: ids and vectors alone give the k ids and distances, which are fetched; then those k rows are looked
    up, with a filter on the ids that reaches the scans. So no text is read before or carried through the top-k.
    """
    hits = nearest(df.select(id_col, vector_col), query, k, vector_col, id_col, digits).select(id_col, "distance").collect()
    few = small_frame(df.sparkSession, [tuple(h) for h in hits], f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, distance double")
    rows = df.select(id_col, *columns).where(F.col(id_col).isin([h[0] for h in hits]))
    return rows.join(F.broadcast(few), id_col).orderBy(F.col("distance").asc_nulls_last(), id_col)  # k rows


def directions(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, the same with unit length, and a code for each: 0, ZERO without a direction, MISSING if null."""
    present, missing = as_matrix(column, width)
    plain = np.zeros((len(column), width))
    plain[~missing] = present
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        unit = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    lost = np.isnan(unit).any(axis=1)
    unit[lost] = 0.0
    return plain, unit, np.where(missing, MISSING, np.where(lost, ZERO, 0.0))


class Closest:
    """The k closest rows seen so far, for every query of a block: by distance, then id.

    A matrix product says which rows may be among them; the distances of these few alone are computed pair by pair, as
    `cosine_distances` does, and rounded to `digits` if given.
    """

    def __init__(self, queries: pa.Array, width: int, k: int, digits: int | None = None):
        self.k, self.digits = k, digits
        self.plain, self.unit, self.code = directions(queries, width)
        self.worst = np.full(len(queries), np.inf)
        self.held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]  # query, distance, id
        self.most = 4 * max(len(queries) * k, 10_000)
        self.pairs = max(1, PAIR_ITEMS // max(1, width))

    def add(self, rows: pa.Array, ids: np.ndarray, asked: np.ndarray | None = None) -> None:
        """More rows, for the queries at the places `asked`, or all."""
        plain, unit, code = directions(rows, self.unit.shape[1])
        places = np.arange(len(self.unit)) if asked is None else asked
        own = self.unit if asked is None else self.unit[asked]
        step = max(1, DISTANCE_CELLS // max(1, len(places)))
        for at in range(0, len(ids), step):
            # codes of the two sides make the distance of a pair without a direction
            rough = 1.0 - own @ unit[at:at + step].T
            pair = np.maximum(self.code[places][:, None], code[None, at:at + step]) if code[at:at + step].any() or self.code[places].any() else None
            if pair is not None:
                rough = np.where(pair > 0, pair, rough)
            limit = self.worst[places]
            if rough.shape[1] > self.k and np.isinf(limit).any():
                limit = np.minimum(limit, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
            q, r = np.nonzero(rough <= (limit + SLACK)[:, None])
            distance = np.empty(len(q))
            for first in range(0, len(q), self.pairs):
                part = slice(first, first + self.pairs)
                with np.errstate(over="ignore"):
                    distance[part] = cosine_distances(plain[at + r[part]], self.plain[places[q[part]]])
            if self.digits is not None:
                distance = np.round(distance, self.digits) + 0.0
            distance[np.isnan(distance)] = ZERO
            if pair is not None:
                distance = np.where(pair[q, r] > 0, pair[q, r], distance)
            self.held.append((places[q], distance, ids[at + r]))
            if sum(len(x[0]) for x in self.held) > self.most:
                self._cut()

    def _cut(self) -> None:
        query, distance, ids = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, distance, query))
        query, distance, ids = query[order], distance[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        full = place == self.k - 1
        self.worst[query[full]] = distance[full]
        self.held = [(query[kept], distance[kept], ids[kept])]

    def table(self, names: pa.Array) -> pa.Table:
        self._cut()
        query, distance, ids = self.held[0]
        return pa.table([names.take(pa.array(query)), pa.array(ids), pa.array(np.where(distance == ZERO, np.nan, distance), mask=distance == MISSING)],
                        schema=_FOUND)


def width_of(*columns: pa.Array) -> int:
    """Length of the first vector that is not null; 0 if there is none."""
    return next((len(present[0]) for column in columns if len(present := column.drop_null())), 0)


def _block_topk(k: int):
    """The k best rows of one split of the vectors for every query of one block, both whole in memory."""
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return _FOUND.empty_table()
        vectors, targets = rows.column("vec").combine_chunks(), queries.column("v").combine_chunks()
        if not (width := width_of(targets)):
            # nothing has a distance to queries without a vector
            vectors = pa.nulls(len(vectors), vectors.type)
        closest = Closest(targets, width, k, digits=6)
        closest.add(vectors, rows.column("id").to_numpy())
        return closest.table(queries.column("q").combine_chunks())

    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())])


def nearest_for_each(df: DataFrame, queries: DataFrame, k: int = 5, vector_col: str = "embedding",
                     id_col: str = "id", query_id: str = "query_id", query_vector: str = "query_vector",
                     block_bytes: int = QUERY_BLOCK_BYTES, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """The k closest rows for every query vector, ids being 64-bit integers.

    A block join: the queries are dealt into blocks of about `block_bytes`, the vectors into splits of about `split_rows`, and
    every split meets every block in a task, which multiplies the two and keeps k rows per query; no pair of a row and a query
    is written, and no query passes the driver. The best rows of all splits are merged. The plan does not depend on the
    number of queries. Vectors and queries without a direction are treated as in `nearest`; a query without id is ignored.
    """
    # kept in the shared folder, since the size and the join read it
    queries = cut_lineage(queries.select(F.col(query_id).cast("long").alias("q"), numbers(queries, query_vector).alias("v")).where("q is not null"))
    # what a query takes in a shuffle: floats stay floats until a task multiplies them
    size = queries.agg(F.sum(F.greatest(F.size("v"), F.lit(1)) * item_bytes(queries, "v")).alias("b")).first()["b"] or 0
    rows = df.select(F.col(id_col).cast("long").alias("id"), numbers(df, vector_col).alias("vec"))
    blocks = max(1, math.ceil(size / block_bytes * (1 if size <= block_bytes else 1.5)))
    splits = max(1, math.ceil(df.count() / split_rows), math.ceil(df.sparkSession.sparkContext.defaultParallelism / blocks))
    # the vector is part of the hash, so repeated ids do not crowd one block or split
    split, block = F.pmod(F.xxhash64("id", "vec"), F.lit(splits)), F.pmod(F.xxhash64("q", "v"), F.lit(blocks))
    dealt_rows = rows.withColumn("split", split).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    dealt_queries = queries.withColumn("block", block).withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(splits - 1).cast("long"))))
    found = dealt_rows.groupBy("split", "block").cogroup(dealt_queries.groupBy("split", "block")).applyInArrow(
        _block_topk(k), "query_id long, id long, distance double")
    # the candidates of one query come from every split: merge them in two steps
    order = [F.col("distance").asc_nulls_last(), F.col("id")]
    spread = found.withColumn("_way", F.pmod(F.hash("id"), F.lit(MERGE_WAYS)))
    for keys in (["query_id", "_way"], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        spread = spread.withColumn("rank", rank).where(F.col("rank") <= k)
    return spread.select("query_id", "rank", "id", "distance")


def mean_vectors(df: DataFrame, key: str, vector_col: str = "embedding") -> DataFrame:
    """Mean vector per key, from per-position averages (combined before the shuffle)."""
    items = df.select(F.col(key).cast("long").alias("query_id"), F.posexplode(vector_col).alias("pos", "x"))
    means = items.groupBy("query_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "m")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda s: s["m"]).alias("query_vector"))


def semantic_search(reports: DataFrame, query: list[float], k: int = 10) -> DataFrame:
    """Reports closest to the query vector."""
    return nearest_with(reports, query, ["station_code", "date", "description"], k).select(
        "id", "station_code", "date", "description", F.col("distance").alias("vector_distance"))


def semantic_search_filtered(reports: DataFrame, stations: DataFrame, query: list[float],
                             first_day: str, last_day: str, k: int = 10) -> DataFrame:
    """Closest reports between two dates (both included) at the given stations."""
    wanted = reports.where(F.col("date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    wanted = wanted.join(stations.select("station_code"), "station_code", "left_semi")
    return nearest_with(wanted, query, ["description"], k).select("id", F.col("description").alias("report"), "distance")


def joined_reports(hits: DataFrame, instruction: str, text_col: str = "report") -> DataFrame:
    """One row: the instruction followed by the reports, closest first, one per line.

    `hits` is the bounded answer of a search. No separator stands between the
    instruction and the first report.
    """
    place = F.coalesce(F.col("distance"), F.lit(math.nan)).alias("distance")
    ranked = F.sort_array(F.collect_list(F.struct(place, "id", F.col(text_col).alias("text"))))
    joined = F.array_join(F.transform(ranked, lambda h: h["text"]), "\n")
    return hits.agg(joined.alias("_text")).select(F.concat_ws("", F.lit(instruction), "_text").alias("content"))


def rag_messages(hits: DataFrame, instruction: str, text_col: str = "report",
                 system: str = SYSTEM_MESSAGE) -> DataFrame:
    """The message document for a chat model; the call itself is the caller's."""
    return joined_reports(hits, instruction, text_col).select(
        "content", chat_messages(system, F.col("content")).alias("messages"))
