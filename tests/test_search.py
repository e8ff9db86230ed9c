from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.geo import EARTH_RADIUS_M, METRES_PER_MILE, arc_m, bounding_box, cells_of_circle, circle_level, half_width, haversine_m, sine_squared, vincenty
from tallyloom.functions.scalars import parse_vector, round_double
from tallyloom.functions.vectors import cosine_distance
from tallyloom.operators import search, stations
from tallyloom.plans.ivf import IvfIndex

COLOURS = [("Red", "[1.0, 0.0, 0.0]"), ("Green", "[0.0, 1.0, 0.0]"), ("Blue", "[0.0, 0.0, 1.0]"), ("Yellow", "[1.0, 1.0, 0.0]"),
           ("Magenta", "[1.0, 0.0, 1.0]"), ("Cyan", "[0.0, 1.0, 1.0]"), ("White", "[1.0, 1.0, 1.0]"), ("Black", "[0.0, 0.0, 0.0]"),
           ("Light gray", "[0.5, 0.5, 0.5]"), ("Orange", "[1.0, 0.5, 0.0]")]


@pytest.fixture
def colours(spark):
    rows = [(i, name, text) for i, (name, text) in enumerate(COLOURS, start=1)]
    return spark.createDataFrame(rows, "id long, description string, t string").select(
        "id", "description", parse_vector(F.col("t")).alias("embedding"))


def test_colours_close_to_red(colours):
    got = [(r.description, r.distance) for r in search.nearest(colours, [1.0, 0.0, 0.0], 10).collect()]
    assert got[:6] == [("Red", 0.0), ("Orange", 0.105573), ("Yellow", 0.292893), ("Magenta", 0.292893),
                       ("White", 0.42265), ("Light gray", 0.42265)]
    assert got[-1][0] == "Black" and math.isnan(got[-1][1])


def test_close_to_a_stored_row(colours):
    like_red = F.col("description").contains("Red")
    assert search.nearest_to_row(colours, like_red).collect() == search.nearest(colours, [1.0, 0.0, 0.0]).collect()
    nothing = search.nearest_to_row(colours, F.lit(False)).collect()
    assert [r.id for r in nothing] == [1, 2, 3, 4, 5] and all(r.distance is None for r in nothing)


def test_column_distance_handles_nulls(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), (None, [1.0, 1.0]), ([1.0, 1.0], None)],
                               "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(0.2) and got[1:] == [None, None]
    assert df.where("a is null and b is null").select(cosine_distance(F.col("a"), F.col("b"))).count() == 0


def test_vectors_of_another_width_are_an_error(colours):
    with pytest.raises(Exception, match="must all have 2 items"):
        search.nearest(colours, [1.0, 0.0]).collect()


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12))
    rows = [(int(i), [float(x) for x in centres[i % 8] + 0.3 * rng.normal(size=12)]) for i in range(1200)]
    rows += [(5000 + i, rows[0][1]) for i in range(400)]  # one vector holds a quarter of the rows
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5).cache()


def brute(rows, query, k):
    m = np.array([r.embedding for r in rows])
    d = np.round(1 - m @ query / np.linalg.norm(m, axis=1) / np.linalg.norm(query), 6) + 0.0
    return sorted(zip(d.tolist(), (r.id for r in rows)))[:k]


@pytest.mark.parametrize("block_bytes", [10 ** 6, 300])
def test_batch_search_matches_brute_force(spark, cloud, block_bytes):
    rows = cloud.collect()
    queries = spark.createDataFrame([(i, rows[i * 90].embedding) for i in range(9)], "query_id long, query_vector array<double>")
    got = search.nearest_for_each(cloud, queries, 7, block_bytes=block_bytes).collect()
    for i in range(9):
        mine = [(r.distance, r.id) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])]
        assert mine == brute(rows, np.array(rows[i * 90].embedding), 7)
    assert search.nearest_for_each(cloud, queries.limit(0), 7).count() == 0
    split = search.nearest_for_each(cloud, queries, 7, block_bytes=block_bytes, split_rows=100)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, got))


def test_the_plan_of_a_batch_does_not_grow_with_the_queries(spark, cloud):
    few, many = (cloud.limit(n).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")) for n in (3, 900))
    plans = [search.nearest_for_each(cloud, q, 3, block_bytes=1000)._jdf.queryExecution().executedPlan().toString().count("\n") for q in (few, many)]
    assert plans[0] == plans[1]


def test_texts_are_fetched_after_the_top_k(spark, colours):
    found = search.nearest_with(colours, [1.0, 0.0, 0.0], ["description"], 10).collect()
    want = search.nearest(colours, [1.0, 0.0, 0.0], 10).collect()
    assert [(r.id, r.description, str(r.distance)) for r in found] == [(r.id, r.description, str(r.distance)) for r in want]
    assert search.nearest_with(colours.limit(0), [1.0, 0.0, 0.0], ["description"], 10).collect() == []


def test_batch_and_single_search_treat_vectors_alike(spark, colours):
    """Zero and null vectors, among the rows and as queries."""
    rows = colours.unionByName(spark.createDataFrame([(0, "none", None)], colours.schema))
    asked = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (3, None)]
    queries = spark.createDataFrame(asked, "query_id long, query_vector array<double>")
    found = search.nearest_for_each(rows, queries, 12).collect()
    plain = lambda d: "null" if d is None else "nan" if math.isnan(d) else d
    for i, q in asked:
        mine = [(r.id, plain(r.distance)) for r in sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])]
        if q is None:
            assert mine == [(k, "null") for k in range(11)]
        else:
            assert mine == [(r.id, plain(r.distance)) for r in search.nearest(rows, q, 12).collect()]


def test_small_cells_are_filled_up_and_small_tables_are_exact(spark, cloud, tmp_path):
    few = cloud.orderBy("id").limit(42).cache()
    query = few.first().embedding
    small, large = IvfIndex(str(tmp_path / "a")), IvfIndex(str(tmp_path / "b"), cells=20)
    assert not small.build(few)
    assert large.build(few, min_rows=10)
    exact = search.nearest(few, query, 10).select("id", "distance").collect()
    assert small.search(spark, query, 10, probes=1).select("id", "distance").collect() == exact
    assert large.search(spark, query, 10, probes=1).count() == 10
    assert large.search(spark, query, 50, probes=1).count() == 42


def test_ivf(spark, cloud, tmp_path):
    index = IvfIndex(str(tmp_path / "ivf"), cells=8)
    with_zero = cloud.unionByName(spark.createDataFrame([(9999, [0.0] * 12)], cloud.schema))
    assert not index.build(with_zero, min_rows=10 ** 6)
    assert index.build(with_zero)
    rows = with_zero.collect()
    assert spark.read.parquet(f"{index.path}/rows").count() == len(rows)
    hits = 0
    for i in (3, 400, 801):
        query = next(r.embedding for r in rows if r.id == i)
        exact = search.nearest(with_zero, query, 10).select("id", "distance").collect()
        assert index.search(spark, query, 10, probes=8).select("id", "distance").collect() == exact
        near = {r.id for r in index.search(spark, query, 10, probes=2).collect()}
        hits += len(near & {r.id for r in exact})
    assert hits >= 27
    index.drop(spark)
    assert not (tmp_path / "ivf").exists()


def test_many_queries_on_the_index(spark, cloud, tmp_path):
    """All cells give the exact answer, few cells most of it; a split of ten rows does not change the cells."""
    index = IvfIndex(str(tmp_path / "many"), cells=36)
    assert index.build(cloud)
    queries = cloud.where("id < 60").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = {(r.query_id, r["rank"], r.id) for r in search.nearest_for_each(cloud, queries, 5).collect()}
    assert {(r.query_id, r["rank"], r.id) for r in index.search_each(spark, queries, 5, probes=36).collect()} == exact
    few = {(r.query_id, r["rank"], r.id) for r in index.search_each(spark, queries, 5, probes=6).collect()}
    assert len(few & exact) >= 0.9 * len(exact)
    cells = {r.id: r.cell for r in spark.read.parquet(f"{index.path}/rows").collect()}
    centres = {r.cell: np.array(r.centre) for r in spark.read.parquet(f"{index.path}/centres").collect()}
    for r in cloud.where("id % 40 = 0").collect():
        unit = np.array(r.embedding) / np.linalg.norm(r.embedding)
        width = max(2, math.isqrt(36))
        mine = {c: unit @ v for c, v in centres.items() if c // width == cells[r.id] // width}
        assert mine[cells[r.id]] == pytest.approx(max(mine.values()))


def test_a_batch_on_the_index_joins_blocks(spark, cloud, tmp_path):
    """No pair of a query and a cell or a row is joined or sorted: blocks meet, and k rows of each query go on."""
    index = IvfIndex(str(tmp_path / "blocks"), cells=36)
    index.build(cloud)
    queries = cloud.where("id < 60").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = index.search_each(spark, queries, 5, probes=24)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "HashJoin" not in text and "[packed" in text
    assert found.count() == 5 * queries.count()


def test_rows_are_assigned_in_splits(spark, cloud, tmp_path, monkeypatch):
    from tallyloom.plans import ivf
    whole, split = IvfIndex(str(tmp_path / "w"), cells=9), IvfIndex(str(tmp_path / "s"), cells=9)
    whole.build(cloud)
    monkeypatch.setattr(ivf, "SPLIT_ROWS", 50)
    split.build(cloud)
    a, b = (sorted((r.id, r.cell) for r in spark.read.parquet(f"{i.path}/rows").select("id", "cell").collect()) for i in (whole, split))
    assert a == b


# id, longitude, latitude of stations around an airport, and two far away
PLACES = [(11, -73.79, 40.641), (12, -73.785, 40.65), (13, -73.775, 40.645), (14, -73.95, 40.68), (15, -73.99, 40.73),
          (16, -73.91, 40.85), (19, -74.03, 40.75), (20, -74.07, 40.72), (1, -122.375, 37.621), (79, -80.13, 25.79)]


@pytest.fixture
def places(spark):
    return spark.createDataFrame([(i, f"Station_{i}", x, y) for i, x, y in PLACES],
                                 "id int, station_code string, longitude double, latitude double")


def test_radius_on_the_ellipsoid(places):
    got = stations.within_radius(places, -73.79, 40.641, 15).orderBy("distance_miles").collect()
    assert [(r.id, round(r.distance_miles, 4)) for r in got] == [
        (11, 0.0), (12, 0.6743), (13, 0.8353), (14, 8.8276), (15, 12.1687), (19, 14.678)]
    shifted = stations.within_radius(places, -73.79, 40.641, 15, from_lon=-73.80, from_lat=40.641).where("id = 11").first()
    assert 0.5 < shifted.distance_miles < 0.55


def test_the_edge_is_inside(places):
    edge = stations.within_radius(places, -73.79, 40.641, 15).where("id = 19").first().distance_miles
    assert stations.within_radius(places, -73.79, 40.641, edge).where("id = 19").count() == 1
    assert stations.within_radius(places, -73.79, 40.641, edge - 1e-9).where("id = 19").count() == 0


def test_box_never_loses_a_point(spark):
    rng = random.Random(9)
    for lon, lat, metres in [(0, 0, 50_000), (-73.79, 40.6, 24_140), (179.9, 10, 80_000), (20, 89.5, 100_000), (5, -60, 900_000),
                             (10, 20, 19_000_000)]:
        points = [(((lon + rng.uniform(-12, 12)) + 180) % 360 - 180, max(-90.0, min(90.0, lat + rng.uniform(-12, 12)))) for _ in range(400)]
        far = vincenty(np.array([p[0] for p in points]), np.array([p[1] for p in points]), lon, lat)
        df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x double, y double")
        kept = {r.i for r in df.where(bounding_box(F.col("x"), F.col("y"), lon, lat, metres)).collect()}
        assert {i for i, d in enumerate(far) if d <= metres} <= kept


@pytest.fixture(scope="module")
def globe():
    """Points all over the globe, dense at the date line, the poles and one city; circles of all sizes, some at their edges."""
    rng = random.Random(12)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(250)]
    points += [(s * rng.uniform(179.5, 180), rng.uniform(-5, 5)) for s in (-1, 1) for _ in range(40)]
    points += [(rng.uniform(-180, 180), s * rng.uniform(88, 90)) for s in (-1, 1) for _ in range(40)]
    points += [(rng.gauss(10, 0.05), rng.gauss(50, 0.05)) for _ in range(150)]
    points += [(180.0, 0.0), (-180.0, 0.0), (0.0, 90.0), (0.0, -90.0), (10.0, 50.0)]
    circles = [(lon, lat, rng.choice([0.0, 0.5, 3.0, 20.0, 100.0, 900.0, 5000.0, 13000.0])) for lon, lat in rng.sample(points, 60)]
    return points, circles + [(179.999, 0.0, 60.0), (-180.0, 1.0, 200.0), (0.0, 90.0, 100.0), (33.0, -89.9, 30.0), (10.0, 50.0, 0.0), (10.0, 50.0, -1.0)]


def _frames(spark, points, circles):
    places = spark.createDataFrame([(i, f"S{i}", x, y) for i, (x, y) in enumerate(points)] + [(-1, "none", None, 1.0)], "id int, station_code string, longitude double, latitude double")
    centres = spark.createDataFrame([(i, *c) for i, c in enumerate(circles)] + [(-1, None, 1.0, 5.0), (-2, 1.0, 1.0, None)], "centre_id int, lon double, lat double, miles double")
    return places, centres


@pytest.mark.parametrize("method", ["sphere", "ellipsoid"])
def test_circles_around_many_centres(spark, globe, method):
    points, circles = globe
    got = {(r.centre_id, r.id): r.distance_miles for r in stations.within_radius_of_each(*_frames(spark, points, circles), method).collect()}
    x, y = (np.array(side) for side in zip(*points))
    want = {}
    for c, (lon, lat, miles) in enumerate(circles):
        if method == "sphere":
            half = np.sin(np.radians(y - lat) / 2) ** 2 + np.cos(np.radians(y)) * math.cos(math.radians(lat)) * np.sin(np.radians(x - lon) / 2) ** 2
            metres = 2 * 6371008.7714 * np.arcsin(np.sqrt(np.minimum(half, 1.0)))
        else:
            metres = vincenty(x, y, lon, lat)
        want |= {(c, int(i)): metres[i] / 1609.34 for i in np.flatnonzero(metres <= miles * 1609.34)}
    assert set(got) == set(want) and len(got) > 1500
    assert all(abs(got[pair] - want[pair]) < 1e-6 for pair in want)


def test_the_radius_join_is_an_equi_join(spark, globe):
    text = stations.within_radius_of_each(*_frames(spark, *globe), "sphere")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "_cell" in text


def test_circles_list_hardly_more_ground_than_their_own(spark):
    circles = spark.createDataFrame([(float(lat), miles * METRES_PER_MILE) for lat in (-50, 0, 41, 60) for miles in (1.0, 7.0, 30.0)], "lat double, reach double")
    size = 360 / F.pow(F.lit(2.0), circle_level(F.col("lat"), F.col("reach")))
    d_lat, d_lon = half_width(F.col("lat"), F.col("reach"))
    box = F.size(cells_of_circle(F.lit(-73.79), F.col("lat"), F.col("reach"))) * size * size / (2 * F.greatest(d_lat, d_lon)) ** 2
    assert circles.agg(F.max(box)).first()[0] < 2.0


def test_a_crowded_cell_is_dealt_into_parts(spark, globe, monkeypatch):
    whole = sorted(map(tuple, stations.within_radius_of_each(*_frames(spark, *globe), "sphere").collect()))
    monkeypatch.setattr(stations, "PART_PAIRS", 20)
    df = stations.within_radius_of_each(*_frames(spark, *globe), "sphere")
    assert sorted(map(tuple, df.collect())) == whole
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CoalescedShuffleRead" not in text and "AQEShuffleRead coalesced" not in text


def test_the_radius_join_shuffles_each_side_once(spark, globe):
    text = stations.within_radius_of_each(*_frames(spark, *globe), "sphere")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def test_both_sides_of_a_crowded_cell_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(stations, "PART_PAIRS", 400)
    listed = spark.range(400).select(F.col("id").alias("c"), F.lit(7).cast("long").alias("_cell"))
    known = spark.range(900).select(F.col("id").alias("p"), F.lit(7).cast("long").alias("_cell"))
    circles, places = stations.in_blocks(listed, known, [F.col("c")], [F.col("p")])
    # 20 x 45 blocks: every pair meets once, and a row is copied for each block of the other side, not for each 400 pairs
    assert circles.count() == 400 * 45 and places.count() == 900 * 20
    met = circles.join(places, ["_cell", "_part"]).select("c", "p")
    assert met.count() == met.distinct().count() == 400 * 900
    assert circles.groupBy("_part").count().agg(F.max("count")).first()[0] < 60


def test_the_edge_of_many_circles_is_exact(spark):
    at = [(10.0, 50.0, 13.001, 52.002), (179.99, -3.0, -179.98, -3.01), (0.0, 89.9, 170.0, 89.95), (-73.79, 40.641, -73.7900001, 40.641), (5.0, 5.0, -174.0, -5.0)]
    far = spark.createDataFrame(at, "a double, b double, c double, d double").select(
        (haversine_m(F.col("c"), F.col("d"), F.col("a"), F.col("b")) / METRES_PER_MILE).alias("m")).collect()
    circles = [(lon, lat, r.m + step) for (lon, lat, _, _), r in zip(at, far) for step in (-1e-8, 1e-8)]
    got = stations.within_radius_of_each(*_frames(spark, [p[2:] for p in at], circles), "sphere").collect()
    assert {(r.centre_id, r.id) for r in got if r.centre_id // 2 == r.id} == {(2 * i + 1, i) for i in range(len(at))}


def test_series_are_as_exact_as_the_functions(spark):
    df = spark.range(1, 4000).select((F.pow(F.col("id") / 4000, 3) * 3.1).alias("x"))
    near = F.sin(F.col("x") / 2) * F.sin(F.col("x") / 2)
    got = df.select((sine_squared(F.col("x") * F.col("x"), F.col("x")) / F.pow(F.sin("x"), 2) - 1).alias("s"),
                    (arc_m(near) / (2 * EARTH_RADIUS_M * F.asin(F.sqrt(near))) - 1).alias("a")).agg(F.max(F.abs("s")), F.max(F.abs("a"))).first()
    assert max(got) < 2e-15


def test_rounding_by_arithmetic_is_that_of_decimals(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 18) for _ in range(3000)] + [(n + 0.5) / 1e6 for n in range(-1000, 1000)]
    values += [(n + 0.5) / 1e6 + s * 1e-12 for n in range(1000) for s in (-1, 1)] + [0.0, -0.0, -1e-9, float("nan"), float("inf"), -float("inf"), 1e300, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(F.round("v", 6).cast("string").alias("a"), round_double(F.col("v"), 6).cast("string").alias("b"))
    assert got.where("not a <=> b").collect() == []


def test_no_circles_and_no_places(spark, globe):
    places, centres = _frames(spark, *globe)
    assert stations.within_radius_of_each(places, centres.limit(0)).collect() == []
    assert stations.within_radius_of_each(places.limit(0), centres).collect() == []


def test_known_geodesics():
    # equator, one degree; meridian quadrant; a point to itself
    got = vincenty(np.array([1.0, 0.0, 5.0]), np.array([0.0, 90.0, 7.0]), 0.0, 0.0)
    assert got[0] == pytest.approx(111319.4908, abs=1e-3) and got[1] == pytest.approx(10001965.7293, abs=1e-3)
    assert vincenty(np.array([5.0]), np.array([7.0]), 5.0, 7.0)[0] == 0.0


def test_joined_reports(spark):
    hits = spark.createDataFrame([(2, "second", 0.1), (1, "first", 0.1), (3, None, 0.05), (4, "last", float("nan"))],
                                 "id int, report string, distance double")
    assert search.joined_reports(hits, "Sum up").first()[0] == "Sum upfirst\nsecond\nlast"
    assert search.joined_reports(hits.limit(0), "Sum up").first()[0] == "Sum up"
