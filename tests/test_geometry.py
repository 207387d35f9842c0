"""Projections and geometry against known values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citygrain.functions import crs, geometry as geo, tiles
from citygrain.functions.text import slug, to_latin

# published control points: (lon, lat, zone, easting, northing)
UTM_POINTS = [
    (-75.0, 0.0, 18, 500000.0, 0.0),
    (2.2945, 48.8582, 31, 448251.8, 5411932.7),
    (-79.387139, 43.642567, 17, 630084.3, 4833438.6),
]


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def polygons(spark, rows):
    return spark.createDataFrame(rows, "id int, rings array<array<struct<x:double,y:double>>>")


def test_utm_control_points(spark):
    df = spark.createDataFrame([(p[0], p[1]) for p in UTM_POINTS], "lon double, lat double")
    zone = crs.utm_zone(F.col("lon"))
    x, y = crs.project(F.col("lon"), F.col("lat"), "4326", "utm")
    for row, point in zip(df.select(zone.alias("z"), x.alias("x"), y.alias("y")).collect(), UTM_POINTS):
        assert row["z"] == point[2]
        assert row["x"] == pytest.approx(point[3], abs=1.0)
        assert row["y"] == pytest.approx(point[4], abs=1.0)


@pytest.mark.parametrize("name", ["3857", "6933", "mollweide"])
def test_round_trip(spark, name):
    df = spark.createDataFrame([(float(a), float(b)) for a in range(-170, 171, 34) for b in range(-84, 85, 12)], "lon double, lat double")
    x, y = crs.project(F.col("lon"), F.col("lat"), "4326", name)
    placed = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = crs.project(F.col("x"), F.col("y"), name, "4326")
    worst = placed.agg(F.max(F.greatest(F.abs(lon - F.col("lon")), F.abs(lat - F.col("lat"))))).first()[0]
    assert worst < 1e-5


def test_known_projected_values(spark):
    df = spark.createDataFrame([(180.0, 85.0511287798066), (10.0, 45.0)], "lon double, lat double")
    mx, my = crs.to_mercator(F.col("lon"), F.col("lat"))
    rows = df.select(mx.alias("x"), my.alias("y")).collect()
    assert rows[0]["x"] == pytest.approx(20037508.3428, abs=0.01)
    assert rows[0]["y"] == pytest.approx(20037508.3428, abs=0.01)
    ex, ey = crs.to_equal_area(F.col("lon"), F.col("lat"))
    rows = df.select(ex.alias("x"), ey.alias("y")).collect()
    assert rows[0]["x"] == pytest.approx(17367530.45, abs=0.1)
    px, py = crs.to_mollweide(F.lit(180.0), F.lit(0.0))
    edge = spark.range(1).select(px.alias("x"), py.alias("y")).first()
    assert edge["x"] == pytest.approx(2 * math.sqrt(2) * 6378137, abs=0.01)
    assert edge["y"] == pytest.approx(0, abs=1e-6)


def test_square_with_hole(spark):
    outer = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
    hole = ring((4, 4), (6, 4), (6, 6), (4, 6), (4, 4))
    other = ring((20, 0), (22, 0), (22, 2), (20, 2), (20, 0))
    df = polygons(spark, [(1, [outer, hole, other])])
    rings = F.col("rings")
    row = df.select(
        geo.polygon_area(rings).alias("area"),
        geo.contains(rings, F.lit(5.0), F.lit(5.0)).alias("in_hole"),
        geo.contains(rings, F.lit(1.0), F.lit(5.0)).alias("inside"),
        geo.contains(rings, F.lit(21.0), F.lit(1.0)).alias("in_part"),
        geo.box_center(rings)["x"].alias("cx"),
    ).first()
    assert row["area"] == pytest.approx(100 - 4 + 4)
    assert (row["in_hole"], row["inside"], row["in_part"]) == (False, True, True)
    assert row["cx"] == 11.0


def test_intersection_area_of_any_shapes(spark):
    # an L shape (concave) against a square, and a square with a hole against a square
    shape = ring((0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0))
    box = ring((1, 1), (3, 1), (3, 3), (1, 3), (1, 1))
    holed = [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (1, 2), (2, 2), (2, 1), (1, 1))]
    schema = "a array<array<struct<x:double,y:double>>>, b array<array<struct<x:double,y:double>>>, area double"
    rows = [([shape], [box], 3.0), ([box], [shape], 3.0), (holed, [box], 3.0), ([box], holed, 3.0), ([shape], [ring((5, 5), (6, 5), (6, 6), (5, 5))], 0.0)]
    df = spark.createDataFrame(rows, schema)
    for r in df.select("area", geo.intersection_area(F.col("a"), F.col("b")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["area"])


def test_line_lengths(spark):
    df = spark.createDataFrame([(ring((0, 0), (0, 1)),)], "line array<struct<x:double,y:double>>")
    row = df.select(
        geo.line_length_km(F.col("line")).alias("sphere"), geo.line_length_km(F.col("line"), True).alias("ellipsoid")
    ).first()
    assert row["sphere"] == pytest.approx(111.195, abs=0.001)
    assert row["ellipsoid"] == pytest.approx(110.574, abs=0.002)


def test_tile_labels_three_cases(spark):
    df = spark.createDataFrame(
        [(1, 0.5, 2.5), (2, -1.5, 1.2), (3, -5.5, -3.1)], "id int, ymin double, ymax double"
    ).withColumns({"xmin": F.lit(0.0), "xmax": F.lit(1.0)})
    got = {}
    for r in tiles.tile_labels(df, "lat").collect():
        got.setdefault(r["id"], set()).add(r["label"])
    assert got == {1: {"N00", "N01", "N02"}, 2: {"S02", "S01", "N00", "N01"}, 3: {"S06", "S05", "S04"}}


def test_far_corner(spark):
    df = spark.createDataFrame([("S10", "N00"), ("W010", "E000"), ("N20", "N30"), ("W120", "W110")], "a string, b string")
    for r in df.select("b", tiles.far_corner(F.col("a")).alias("got")).collect():
        assert r["got"] == r["b"]


def test_quadkey_and_box(spark):
    df = spark.createDataFrame([(47.6, -122.3)], "lat double, lon double")
    key = tiles.quadkey(F.col("lat"), F.col("lon"), 9)
    row = df.select(key.alias("k"), tiles.quadkey_box(key, 9).alias("b")).first()
    assert row["k"].startswith("0212300")
    assert row["b"]["xmin"] <= -122.3 <= row["b"]["xmax"]
    assert row["b"]["ymin"] <= 47.6 <= row["b"]["ymax"]


def test_text(spark):
    row = spark.range(1).select(
        slug(F.lit("New 'York' City")).alias("s"), to_latin(F.lit("São Łódź Œuvre")).alias("l")
    ).first()
    assert row["s"] == "new_york_city"
    assert row["l"] == "Sao Lodz OEuvre"


def star(n, cx, cy, r, rough, seed):
    """A closed ring around a centre whose radius wobbles."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = 2 * math.pi * i / n
        d = r * (1 + rough * math.sin(7 * at) + 0.02 * rng.random())
        out.append((cx + d * math.cos(at), cy + d * math.sin(at)))
    return [*out, out[0]]


def inside_rings(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_long_boundaries_in_tiles(spark):
    from citygrain.operators import spatial

    shapes = {
        "long": [star(100_000, 0, 0, 40, 0.3, 1)],
        "hole": [star(300, 5, 5, 20, 0.1, 2), star(200, 5, 5, 8, 0.2, 3)],
        "box": [[(-10.0, -10.0), (10.0, -10.0), (10.0, 10.0), (-10.0, 10.0), (-10.0, -10.0)]],
    }
    polys = spark.createDataFrame(list(shapes.items()), "name string, r array<array<struct<x:double,y:double>>>").withColumnRenamed("r", "rings")
    rng = random.Random(4)
    spots = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(150)] + [(200, 0.0, 0.0), (201, 10.0, 5.0), (202, -10.0, -10.0)]
    points = spark.createDataFrame(spots, "id long, lon double, lat double")
    for size in (2.0, 9.0):
        got = {(r["id"], r["name"]) for r in spatial.point_in_polygon(points, polys, size).collect()}
        assert got == {(i, n) for i, x, y in spots for n, rings in shapes.items() if inside_rings(rings, x, y)}
    tiles = spatial.tile_polygons(spatial.identified(polys), 5.0)
    held = tiles.select(F.sum(F.size("_segs")).alias("n"), F.max(F.size("_segs")).alias("most")).first()
    # segments are copied only where they cross from tile to tile
    assert held["n"] < 1.2 * 100_505 and held["most"] < 20_000
    assert tiles.where("size(_segs) = 0 and _odd = 1").count() > 0


def test_label_points_of_irregular_shapes(spark):
    from citygrain.operators import shapes

    rows = {
        "l": [[(0.0, 0.0), (9.0, 0.0), (9.0, 3.0), (4.0, 3.0), (4.0, 8.0), (0.0, 8.0), (0.0, 0.0)]],
        "star": [star(40, 3, -2, 5, 0.4, 6)],
        "hole": [star(60, 0, 0, 10, 0.0, 7), star(30, 1, 1, 4, 0.1, 8)],
        "thin": [[(0.0, 0.0), (100.0, 1.0), (100.0, 2.0), (0.0, 1.0), (0.0, 0.0)]],
    }
    polys = spark.createDataFrame(list(rows.items()), "zone string, r array<array<struct<x:double,y:double>>>").withColumnRenamed("r", "rings")

    def gap(rings, x, y):
        best = math.inf
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                t = max(0.0, min(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
                best = min(best, math.hypot(x1 + t * (x2 - x1) - x, y1 + t * (y2 - y1) - y))
        return best if inside_rings(rings, x, y) else -best

    for r in shapes.label_points(polys).collect():
        rings = rows[r["zone"]]
        assert gap(rings, r["x"], r["y"]) == pytest.approx(r["radius"])
        xs, ys = zip(*rings[0])
        side = min(max(xs) - min(xs), max(ys) - min(ys))
        tried = [
            gap(rings, min(xs) + (max(xs) - min(xs)) * i / 120, min(ys) + (max(ys) - min(ys)) * j / 120) for i in range(121) for j in range(121)
        ]
        assert r["radius"] >= max(tried) - 1e-3 * side


def test_pairs_of_points_and_polygons_meet_no_geometry_that_nobody_reads(spark, capsys):
    from citygrain.operators import spatial

    box = lambda a, b: [[(a, a), (b, a), (b, b), (a, b), (a, a)]]
    # a notch gives one tile more segments than are spelled out
    notched = [[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (5.0, 9.0), (4.5, 6.0), (4.2, 8.0), (4.0, 6.0), (3.5, 9.0), (0.0, 9.0), (0.0, 0.0)]]
    kind = "zone long, nation string, rings array<array<struct<x:double,y:double>>>"
    polys = spark.createDataFrame([(1, "a", box(0.0, 6.0)), (2, None, notched), (2, None, notched)], kind)
    points = spark.createDataFrame([(i, i % 20 / 2.0 + 0.1, i // 20 / 2.0 + 0.1, "p") for i in range(400)], "id long, lon double, lat double, nation string")
    found = spatial.point_in_polygon(points, polys, 5.0)
    assert found.columns == ["id", "lon", "lat", "nation", "zone", "nation", "rings"]

    def inside(x, y, ring):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:])) % 2

    want = sorted((p.id, z.zone) for p in points.collect() for z in polys.collect() if inside(p.lon, p.lat, z.rings[0]))
    assert sorted((r.id, r.zone) for r in found.select("id", "zone").collect()) == want
    left = spatial.point_in_polygon(points, polys, 5.0, how="left").select("id", "zone").collect()
    assert {r.id for r in left if r.zone is None} == set(range(400)) - {i for i, _ in want} and len(left) == len(want) + 400 - len({i for i, _ in want})
    capsys.readouterr()
    found.select("id", "zone").explain()
    joins = [line for line in capsys.readouterr().out.splitlines() if "Join" in line]
    assert "_tx" in joins[0] and "_pid" not in joins[0]
