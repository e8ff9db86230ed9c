"""Queries over vectors, texts and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.catalog.registry import CENTRE, RADIUS_MILES, query, rounded
from tallyloom.functions.chunks import split_column
from tallyloom.functions.embeddings import embed_column, embed_query, hashing_provider
from tallyloom.functions.geo import METRES_PER_MILE, VINCENTY_STEPS, haversine_m
from tallyloom.functions.scalars import round_double, rounded_int, size_pretty
from tallyloom.functions.times import shifted
from tallyloom.operators import checks, search, stations
from tallyloom.plans.ivf import IvfIndex
from tallyloom.plans.vectorizer import Vectorizer
from tallyloom.session import cut_lineage, scratch_path
from tallyloom.sources import views

# The query vector 1, 1/2, 1/3 ... and the words put before the reports.
QUERY_DIMENSIONS = 64
QUERY = [1.0 / (i + 1) for i in range(QUERY_DIMENSIONS)]
INSTRUCTION = "Summarize the maintanance reports in one paragraph"

QUERY_SQL = f"CAST('{QUERY}' AS DOUBLE[])"


def _distance(vector: str, target: str = QUERY_SQL) -> str:
    # abs only turns a rounded -0.0 into 0.0
    return f"abs(ROUND(list_cosine_distance(CAST({vector} AS DOUBLE[]), {target}), 6))"


# great-circle miles as SQL
_ARC = f"""2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians(latitude - {CENTRE[1]}) / 2), 2)
    + cos(radians(latitude)) * cos(radians({CENTRE[1]})) * pow(sin(radians(longitude - {{lon}}) / 2), 2))))"""
ARC_SQL = _ARC.format(lon=f"({CENTRE[0]})")
RADIUS_SQL = f"{ARC_SQL} <= {RADIUS_MILES} * {METRES_PER_MILE}"


def _geodesic_sql(lon: float, lat: float, steps: int) -> str:
    """Ellipsoidal metres as SQL: the iteration written out, one expression per step."""
    f = "(1 / 298.257223563::DOUBLE)"
    a = "6378137.0::DOUBLE"
    parts = [f"""g0 AS (SELECT id, radians({lon}::DOUBLE - longitude) AS lam0, radians({lon}::DOUBLE - longitude) AS lam,
        sin(atan((1 - {f}) * tan(radians(latitude)))) AS su1, cos(atan((1 - {f}) * tan(radians(latitude)))) AS cu1,
        sin(atan((1 - {f}) * tan(radians({lat}::DOUBLE)))) AS su2,
        cos(atan((1 - {f}) * tan(radians({lat}::DOUBLE)))) AS cu2 FROM stations)"""]
    for i in range(steps):
        parts.append(f"""s{i} AS (SELECT *, sqrt(pow(cu2 * sin(lam), 2)
            + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss, su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM g{i}),
        t{i} AS (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM s{i}),
        u{i} AS (SELECT *, 1 - sa * sa AS c2a, cs - 2 * su1 * su2 / (1 - sa * sa) AS c2m,
            {f} / 16 * (1 - sa * sa) * (4 + {f} * (4 - 3 * (1 - sa * sa))) AS c FROM t{i}),
        g{i + 1} AS (SELECT id, lam0, lam0 + (1 - c) * {f} * sa * (atan2(ss, cs) + c * ss
            * (c2m + c * cs * (2 * c2m * c2m - 1))) AS lam, su1, cu1, su2, cu2 FROM u{i})""")
    parts.append(f"""v AS (SELECT *, c2a * (1 / pow(1 - {f}, 2) - 1) AS uu FROM u{steps - 1}),
    w AS (SELECT *, 1 + uu / 16384 * (4096 + uu * (uu * (320 - 175 * uu) - 768)) AS ka,
        uu / 1024 * (256 + uu * (uu * (74 - 47 * uu) - 128)) AS kb FROM v),
    geodesic AS (SELECT id, CASE WHEN ss = 0 THEN 0 ELSE {a} * (1 - {f}) * ka * (atan2(ss, cs) - kb * ss
        * (c2m + kb / 4 * (cs * (2 * c2m * c2m - 1)
        - kb / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))) END AS metres FROM w)""")
    return ", ".join(parts)


@query("vector_topk", f"""SELECT vec_id, label, {_distance('embedding')} AS distance FROM embeddings
ORDER BY distance, vec_id LIMIT 5""")
def vector_topk(spark: SparkSession, root: str) -> DataFrame:
    return search.nearest(views.table(spark, root, "embeddings"), QUERY, 5, id_col="vec_id").drop("embedding")


@query("vector_topk_by_row", f"""WITH target AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label = 3 ORDER BY vec_id LIMIT 1)
SELECT vec_id, label, {_distance('embedding', '(SELECT v FROM target)')} AS distance FROM embeddings
ORDER BY distance, vec_id LIMIT 5""")
def vector_topk_by_row(spark: SparkSession, root: str) -> DataFrame:
    vectors = views.table(spark, root, "embeddings")
    return search.nearest_to_row(vectors, F.col("label") == 3, 5, id_col="vec_id").drop("embedding")


@query("vector_knn_batch", f"""WITH items AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
    unnest(generate_series(1, len(embedding))) AS pos FROM embeddings),
means AS (SELECT label, pos, AVG(x) AS m FROM items GROUP BY 1, 2),
targets AS (SELECT label AS query_id, list(m ORDER BY pos) AS v FROM means GROUP BY 1),
pairs AS (SELECT query_id, vec_id AS id, {_distance('embedding', 'v')} AS distance FROM embeddings, targets)
SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs) WHERE rank <= 5""")
def vector_knn_batch(spark: SparkSession, root: str) -> DataFrame:
    """The five vectors closest to the mean vector of every label."""
    vectors = views.table(spark, root, "embeddings")
    return search.nearest_for_each(vectors, search.mean_vectors(vectors, "label"), 5, id_col="vec_id")


@query("ann_topk")
def ann_topk(spark: SparkSession, root: str) -> DataFrame:
    """Approximate search over the 4 closest cells; its recall is tested."""
    index = IvfIndex(scratch_path(spark, "cells"), id_col="vec_id")
    index.build(views.table(spark, root, "embeddings"), min_rows=1)
    return index.search(spark, QUERY, 5, probes=4).drop("embedding")


@query("ann_topk_all_cells", f"""SELECT vec_id, label, {_distance('embedding')} AS distance FROM embeddings
ORDER BY distance, vec_id LIMIT 5""")
def ann_topk_all_cells(spark: SparkSession, root: str) -> DataFrame:
    """The same index with every cell probed: the exact answer."""
    index = IvfIndex(scratch_path(spark, "cells"), id_col="vec_id")
    index.build(views.table(spark, root, "embeddings"), min_rows=1)
    return index.search(spark, QUERY, 5, probes=10**9).drop("embedding")


@query("ann_recall", """SELECT COUNT(*) AS queries, true AS recalled FROM embeddings""")
def ann_recall(spark: SparkSession, root: str) -> DataFrame:
    """Whether the index finds nine in ten of the true five neighbours, over every vector as a query.

    The given vectors hardly form clusters, so two thirds of the cells are probed.
    """
    vectors = views.table(spark, root, "embeddings")
    index = IvfIndex(scratch_path(spark, "cells"), id_col="vec_id")
    index.build(vectors, min_rows=1)
    probes = spark.read.parquet(f"{index.path}/centres").count() * 2 // 3
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = search.nearest_for_each(vectors, asked, 5, id_col="vec_id").select("query_id", "id")
    found = index.search_each(spark, asked, 5, probes=probes).select("query_id", "id", F.lit(1).alias("hit"))
    share = exact.join(found, ["query_id", "id"], "left").agg(F.countDistinct("query_id").alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    return share.select("queries", (F.col("recall") >= 0.9).alias("recalled"))


@query("semantic_search", f"""SELECT id, station_code, date, description, {_distance('embedding')} AS vector_distance
FROM reports ORDER BY vector_distance, id LIMIT 10""", ("reports",))
def semantic_search(spark: SparkSession, root: str) -> DataFrame:
    return search.semantic_search(views.reports(spark, root), QUERY)


FILTERED_SQL = f"""SELECT id, description AS report, {_distance('embedding')} AS distance FROM reports
WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
AND station_code IN (SELECT station_code FROM stations WHERE {RADIUS_SQL}) ORDER BY distance, id LIMIT 10"""


def _filtered(spark: SparkSession, root: str) -> DataFrame:
    close = stations.near(views.stations(spark, root), *CENTRE, RADIUS_MILES, method="sphere")
    return search.semantic_search_filtered(views.reports(spark, root), close, QUERY, "2024-01-01", "2024-01-31")


@query("semantic_search_filtered", FILTERED_SQL, ("reports", "stations"))
def semantic_search_filtered(spark: SparkSession, root: str) -> DataFrame:
    return _filtered(spark, root)


@query("rag_context", f"""WITH hits AS (SELECT id, description AS report, {_distance('embedding')} AS distance
    FROM reports ORDER BY distance, id LIMIT 10)
SELECT concat('{INSTRUCTION}', string_agg(report, chr(10) ORDER BY distance, id)) AS content FROM hits""",
       ("reports",))
def rag_context(spark: SparkSession, root: str) -> DataFrame:
    hits = search.nearest_with(views.reports(spark, root), QUERY, ["description"], 10)
    return search.joined_reports(hits, INSTRUCTION, "description")


@query("rag_context_filtered", f"""WITH hits AS ({FILTERED_SQL})
SELECT concat('{INSTRUCTION}', string_agg(report, chr(10) ORDER BY distance, id)) AS content FROM hits""",
       ("reports", "stations"))
def rag_context_filtered(spark: SparkSession, root: str) -> DataFrame:
    return search.joined_reports(_filtered(spark, root), INSTRUCTION)


@query("rag_messages", f"""WITH hits AS ({FILTERED_SQL})
SELECT 'system' AS first_role, '{search.SYSTEM_MESSAGE}' AS system, 'user' AS second_role,
    concat('{INSTRUCTION}', string_agg(report, chr(10) ORDER BY distance, id)) AS content FROM hits""", ("reports", "stations"))
def rag_messages(spark: SparkSession, root: str) -> DataFrame:
    """The message document, read back by path, as the spacing of JSON differs between engines."""
    got = search.rag_messages(_filtered(spark, root), INSTRUCTION).select("messages")
    paths = {"first_role": "$[0].role", "system": "$[0].content", "second_role": "$[1].role", "content": "$[1].content"}
    return got.select([F.get_json_object("messages", path).alias(name) for name, path in paths.items()])


@query("geo_distance", f"SELECT id, ROUND({ARC_SQL} / {METRES_PER_MILE}, 6) AS distance_miles FROM stations",
       ("stations",))
def geo_distance(spark: SparkSession, root: str) -> DataFrame:
    arc = haversine_m(F.col("longitude"), F.col("latitude"), *CENTRE)
    return rounded(views.stations(spark, root).select("id", (arc / METRES_PER_MILE).alias("distance_miles")))


@query("stations_within", f"""SELECT id, station_name, station_code, ROUND(longitude, 6) AS longitude,
    ROUND(latitude, 6) AS latitude, ROUND({_ARC.format(lon='(-73.8)')} / {METRES_PER_MILE}, 6) AS distance_miles
FROM stations WHERE {RADIUS_SQL}""", ("stations",))
def stations_within(spark: SparkSession, root: str) -> DataFrame:
    """The distance shown is from a point a little west of the circle's centre."""
    return rounded(stations.within_radius(views.stations(spark, root), *CENTRE, RADIUS_MILES, method="sphere",
                                          from_lon=-73.80, from_lat=CENTRE[1]))


@query("stations_within_ellipsoid", f"""WITH {_geodesic_sql(*CENTRE, VINCENTY_STEPS // 2)}
SELECT station_code, ROUND(metres / {METRES_PER_MILE}, 6) AS distance_miles
FROM geodesic JOIN stations USING (id) WHERE metres <= {RADIUS_MILES} * {METRES_PER_MILE}""", ("stations",))
def stations_within_ellipsoid(spark: SparkSession, root: str) -> DataFrame:
    return rounded(stations.near(views.stations(spark, root), *CENTRE, RADIUS_MILES))


@query("stations_near_airport", f"""SELECT station_code, ROUND({ARC_SQL} / {METRES_PER_MILE}, 6) AS distance_miles
FROM stations WHERE {RADIUS_SQL}""", ("stations",))
def stations_near_airport(spark: SparkSession, root: str) -> DataFrame:
    return rounded(stations.near(views.stations(spark, root), *CENTRE, RADIUS_MILES, method="sphere"))


_CENTRES_SQL = """SELECT s_suppkey AS centre_id, CAST(-73.79 AS DOUBLE) + CAST((s_suppkey * 6007) % 2000 - 1000 AS DOUBLE) / 1000 AS lon,
    CAST(40.641 AS DOUBLE) + CAST((s_suppkey * 9001) % 2000 - 1000 AS DOUBLE) / 1000 AS lat, CAST(1 + s_suppkey % 30 AS DOUBLE) AS miles FROM supplier"""
_ARC_MANY = """2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians(latitude - lat) / 2), 2)
    + cos(radians(latitude)) * cos(radians(lat)) * pow(sin(radians(longitude - lon) / 2), 2))))"""


@query("stations_within_many", f"""WITH centres AS ({_CENTRES_SQL}), pairs AS (SELECT centre_id, station_code, miles, {_ARC_MANY} AS metres FROM stations, centres)
SELECT centre_id, station_code, ROUND(metres / {METRES_PER_MILE}, 6) AS distance_miles FROM pairs WHERE metres <= miles * {METRES_PER_MILE}""", ("stations",))
def stations_within_many(spark: SparkSession, root: str) -> DataFrame:
    """Every supplier as the centre of a circle of 1 to 30 miles."""
    key = F.col("s_suppkey")
    centres = views.table(spark, root, "supplier").select(
        key.alias("centre_id"), (F.lit(-73.79) + ((key * 6007) % 2000 - 1000).cast("double") / 1000).alias("lon"),
        (F.lit(40.641) + ((key * 9001) % 2000 - 1000).cast("double") / 1000).alias("lat"), (key % 30 + 1).cast("double").alias("miles"))
    found = stations.within_radius_of_each(views.stations(spark, root), centres, method="sphere")
    return found.select("centre_id", "station_code", round_double(F.col("distance_miles"), 6).alias("distance_miles"))


@query("row_count", "SELECT COUNT(*) AS row_count FROM embeddings")
def row_count(spark: SparkSession, root: str) -> DataFrame:
    return checks.count_where(views.table(spark, root, "embeddings"))


@query("pending_items", """SELECT COUNT(*) AS pending_items FROM documents
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def pending_items(spark: SparkSession, root: str) -> DataFrame:
    vectors = views.table(spark, root, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return checks.count_where(views.table(spark, root, "documents").join(vectors, "doc_id", "left_anti"),
                              name="pending_items")


@query("orphan_rows", """SELECT doc_id, quality, toxic FROM labels
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def orphan_rows(spark: SparkSession, root: str) -> DataFrame:
    return checks.orphan_rows(views.table(spark, root, "labels"), "doc_id",
                              views.table(spark, root, "embeddings"), "vec_id")


@query("embedding_view", """SELECT doc_id, lang, source, n_chars, label, CAST(len(embedding) AS INTEGER) AS dimensions
FROM documents JOIN embeddings ON doc_id = vec_id""")
def embedding_view(spark: SparkSession, root: str) -> DataFrame:
    documents, vectors = views.table(spark, root, "documents"), views.table(spark, root, "embeddings")
    return documents.join(vectors, documents.doc_id == vectors.vec_id).select(
        "doc_id", "lang", "source", "n_chars", "label", F.size("embedding").alias("dimensions"))


@query("text_chunks")
def text_chunks(spark: SparkSession, root: str) -> DataFrame:
    return split_column(views.table(spark, root, "documents").select("doc_id", "text"), "text")


@query("text_chunks_rebuilt", "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE text <> ''")
def text_chunks_rebuilt(spark: SparkSession, root: str) -> DataFrame:
    """Chunks without overlap, put together again: every character is in exactly one."""
    documents = views.table(spark, root, "documents").select("doc_id", "text")
    ordered = F.sort_array(F.collect_list(F.struct("chunk_seq", "chunk")))
    return split_column(documents, "text", overlap=0).groupBy("doc_id").agg(
        F.md5(F.array_join(F.transform(ordered, lambda c: c["chunk"]), "")).alias("text_md5"))


@query("embedded_documents", """SELECT doc_id, 256 AS dimensions, CASE WHEN text = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS length
FROM documents""")
def embedded_documents(spark: SparkSession, root: str) -> DataFrame:
    """Size and length of the hashed embeddings, whose hash has no SQL."""
    documents = views.table(spark, root, "documents").select("doc_id", "text")
    square = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rounded(embed_column(documents, "text", provider=hashing_provider(256)).select(
        "doc_id", F.size("embedding").alias("dimensions"), F.sqrt(square).alias("length")), 4)


@query("vectorizer_status", """SELECT COUNT(*) AS stored_items, CAST(0 AS BIGINT) AS pending_items FROM documents""")
def vectorizer_status(spark: SparkSession, root: str) -> DataFrame:
    """All documents embedded by one run, none left."""
    documents = views.table(spark, root, "documents")
    job = Vectorizer(scratch_path(spark, "vectorizer"), "doc_id", "text", provider=hashing_provider(64))
    job.run(documents)
    return job.status(documents)


CHUNK_QUESTION = "the that with and"


def _vectorized(spark: SparkSession, root: str) -> tuple[Vectorizer, DataFrame]:
    documents = views.table(spark, root, "documents")
    job = Vectorizer(scratch_path(spark, "vectorizer"), "doc_id", "text", provider=hashing_provider(64))
    job.run(documents)
    return job, documents


@query("chunk_search", """SELECT CAST(range AS INTEGER) AS rank, true AS in_text, true AS nearest,
    CAST(0 AS BIGINT) AS pending_items FROM range(1, 11)""")
def chunk_search(spark: SparkSession, root: str) -> DataFrame:
    """The ten chunks closest to a question: vectoriser, its view, top-k, and only then the texts, looked up by id.

    The embedding has no SQL, so each answer is checked: its chunk stands in its document,
    and no chunk outside the answer is closer.
    """
    job, documents = _vectorized(spark, root)
    chunks = job.view(documents.select("doc_id"))
    question = embed_query(spark, CHUNK_QUESTION, hashing_provider(64))
    # kept in the shared folder: three searches read it
    scored = cut_lineage(chunks.select("doc_id", "chunk_seq", "embedding", (F.col("doc_id") * 1_000_000 + F.col("chunk_seq")).alias("id")))
    hits = search.nearest(scored, question, 10).select("doc_id", "chunk_seq", "id", "distance")
    hits = cut_lineage(hits.withColumn("rank", F.row_number().over(Window.orderBy("distance", "id"))))  # ten rows
    wanted = F.col("doc_id").isin([row[0] for row in hits.select("doc_id").collect()])
    texts = job.view(documents.select("doc_id", "text").where(wanted)).select("doc_id", "chunk_seq", "chunk", "text")
    worst = search.nearest(scored, question, 10).agg(F.max("distance")).scalar()
    closer = search.nearest(scored, question, 11).where(F.col("distance") < worst).agg(F.count("*")).scalar()
    return hits.join(texts, ["doc_id", "chunk_seq"]).select(
        "rank", F.col("text").contains(F.col("chunk")).alias("in_text"), ((F.col("distance") <= worst) & (closer <= 10)).alias("nearest"),
        job.pending(documents).agg(F.count("*")).scalar().alias("pending_items"))


@query("chunk_view_documents", """SELECT doc_id, true AS starts, true AS ends FROM documents WHERE trim(text) <> ''""")
def chunk_view_documents(spark: SparkSession, root: str) -> DataFrame:
    """The destination view by document: its first chunk starts the text, its last one ends it."""
    job, documents = _vectorized(spark, root)
    view = job.view(documents.select("doc_id", "text"))
    edges = view.groupBy("doc_id", "text").agg(F.min_by("chunk", "chunk_seq").alias("first"), F.max_by("chunk", "chunk_seq").alias("last"))
    return edges.select("doc_id", F.col("text").startswith(F.col("first")).alias("starts"), F.col("text").endswith(F.col("last")).alias("ends"))


@query("rounded_ints", "SELECT event_id, CAST(round_even(value, 0) AS INTEGER) AS rounded FROM events")
def rounded_ints(spark: SparkSession, root: str) -> DataFrame:
    return views.table(spark, root, "events").select("event_id", rounded_int(F.col("value")).alias("rounded"))


def _size_sql(size: str) -> str:
    units = ("kB", "MB", "GB", "TB", "PB")
    arms = [f"WHEN {size} // {1024 ** p // 2} < 20479 THEN CAST(({size} // {1024 ** p // 2} + 1) // 2 AS VARCHAR) || ' {u}'"
            for p, u in enumerate(units, start=1)]
    return f"CASE WHEN {size} < 10240 THEN CAST({size} AS VARCHAR) || ' bytes' {' '.join(arms)} END"


@query("pretty_sizes", f"""WITH sizes AS (SELECT doc_id, strlen(text) * (doc_id + 1) * (doc_id + 1) AS num_bytes
    FROM documents) SELECT doc_id, num_bytes, {_size_sql('num_bytes')} AS size FROM sizes""")
def pretty_sizes(spark: SparkSession, root: str) -> DataFrame:
    size = F.octet_length("text").cast("long") * (F.col("doc_id") + 1) * (F.col("doc_id") + 1)
    return views.table(spark, root, "documents").select("doc_id", size.alias("num_bytes"), size_pretty(size).alias("size"))


@query("shifted_days", "SELECT event_id, ts + INTERVAL '1 day' AS next_day FROM events")
def shifted_days(spark: SparkSession, root: str) -> DataFrame:
    return views.table(spark, root, "events").select("event_id", shifted("ts", "1 day").alias("next_day"))


@query("length_violations", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def length_violations(spark: SparkSession, root: str) -> DataFrame:
    return checks.length_violations(views.table(spark, root, "part"), "p_name", 10).select("p_partkey", "p_name")


@query("assign_ids", """SELECT row_number() OVER (ORDER BY ts DESC, event_id) AS id, event_id FROM events""")
def assign_ids(spark: SparkSession, root: str) -> DataFrame:
    events = views.table(spark, root, "events").select("event_id", "ts")
    return checks.assign_ids(events, [F.desc("ts"), F.asc("event_id")]).select("id", "event_id")
