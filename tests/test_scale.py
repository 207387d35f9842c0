"""Skew-safe building blocks against plain computations."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from citygrain.functions import geometry as geo
from citygrain.operators import display, nearest, pixels, spatial, terrain
from citygrain.grid import Grid
from citygrain.scale import crowded_join, cut_lineage, exact_quantiles, fill_along, next_along, numbered, with_totals


def quantile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (at - low) * (values[high] - values[low])


@pytest.mark.parametrize("grouped", [False, True])
def test_exact_quantiles(spark, grouped):
    rng = random.Random(8)
    rows = [("hot", rng.choice([1.0, 1.0, 1.0, rng.gauss(0, 9)])) for _ in range(4000)]
    rows += [("cold", rng.gauss(5, 2)) for _ in range(37)] + [("one", 3.0), ("one", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    qs = [0.0, 0.05, 0.5, 0.6, 0.986, 1.0]
    by = ["k"] if grouped else []
    for r in exact_quantiles(df, "v", qs, by, splits=20).collect() + exact_quantiles(df, "v", qs, by, splits=4, most=3).collect():
        values = [v for k, v in rows if v is not None and v == v and (not grouped or k == r["k"])]
        for i, q in enumerate(qs):
            assert r[f"q{i}"] == pytest.approx(quantile(values, q))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert exact_quantiles(df, "v", [0.5], ["k"]).count() == 0


def test_numbered(spark):
    rng = random.Random(1)
    values = list(range(500))
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert all(r["n"] == r["v"] for r in numbered(df, ["v"], "n").collect())


def test_with_totals_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    got = {(r["k"], r["v"]): r["s"] for r in with_totals(df, ["k"], s=F.sum("v")).collect()}
    assert got == {(None, 1): 3, (None, 2): 3, ("a", 5): 5}
    assert {r["s"] for r in with_totals(df, [], s=F.sum("v")).collect()} == {8}


def test_fill_along(spark):
    rows = [("a", i, "x" if i in (3, 40) else None) for i in range(60)] + [("b", i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    down = {(r["k"], r["i"]): r["v"] for r in fill_along(df, ["k"], "i", ["v"], block=7).collect()}
    assert all(down[("a", i)] == ("x" if i >= 3 else None) for i in range(60))
    assert all(down[("b", i)] is None for i in range(5))
    up = {(r["k"], r["i"]): r["v"] for r in fill_along(df, ["k"], "i", ["v"], "up", block=7).collect()}
    assert all(up[("a", i)] == ("x" if i <= 40 else None) for i in range(60))


def test_next_along(spark):
    rng = random.Random(3)
    spots = sorted({round(rng.random(), 3) for _ in range(80)} | {0.0, 1.0})
    df = spark.createDataFrame([(1, s) for s in spots], "k int, t double")
    got = {r["t"]: r["n"] for r in next_along(df, ["k"], "t", "n", parts=5).collect()}
    assert got == dict(zip(spots, spots[1:] + [None]))


def test_checkpoints_use_the_named_folder(spark):
    cut_lineage(spark.range(3))
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_clip_is_idempotent(spark):
    px = spark.range(400).select((F.col("id") % 20).cast("int").alias("x"), F.floor(F.col("id") / 20).cast("int").alias("y"), F.lit(1.0).alias("value"))
    ring = [{"x": 2.3, "y": 2.1}, {"x": 15.7, "y": 4.2}, {"x": 9.1, "y": 17.8}, {"x": 2.3, "y": 2.1}]
    polys = spark.createDataFrame([(1, [ring])], "id int, rings array<array<struct<x:double,y:double>>>")
    grid = Grid(0.0, 0.0, 1.0, 1.0)
    for touched in (True, False):
        once = spatial.clip(px, polys, grid, touched, tile=8)
        twice = spatial.clip(once, polys, grid, touched, tile=8)
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    inner = spatial.clip(px, polys, grid, False).count()
    assert inner < spatial.clip(px, polys, grid, True).count()


def test_slope_of_a_plane(spark):
    px = spark.range(100).select(
        F.lit("a").alias("city"), (F.col("id") % 10).cast("int").alias("x"), F.floor(F.col("id") / 10).cast("int").alias("y")
    ).withColumn("value", F.col("x") * 10.0)
    out = terrain.slope(px, Grid(0.0, 0.0, 10.0, 10.0)).where("x BETWEEN 1 AND 8")
    assert out.agg(F.min("value")).first()[0] == pytest.approx(45.0)
    assert out.agg(F.max("value")).first()[0] == pytest.approx(45.0)
    steeper = terrain.slope(px, Grid(0.0, 6_000_000.0, 10.0, 10.0), true_scale=True).where("x = 5").first()["value"]
    assert steeper > 45.0


def test_mixed_years_fail(spark):
    px = spark.createDataFrame([("a", 0, 0, 5), ("a", 1, 0, 2005)], "city string, x int, y int, value int")
    with pytest.raises(Exception, match="both in 1-99 and above 2000"):
        pixels.calendar_years(px).collect()
    empty = spark.createDataFrame([("a", 0, 0, None)], "city string, x int, y int, value int")
    assert pixels.calendar_years(empty).first()["value"] is None


def test_nodata_becomes_null(spark):
    px = spark.createDataFrame([(-99999.0,), (float("nan"),), (3.0,)], "value double")
    assert [r[0] for r in pixels.drop_nodata(px, -99999.0).collect()] == [None, None, 3.0]


def test_resample_needs_a_target(spark):
    px = spark.createDataFrame([(0, 0, 1.0)], "x int, y int, value double")
    with pytest.raises(ValueError):
        spatial.resample(px, Grid(0, 0, 1, 1), Grid(0, 0, 2, 2))


def test_one_label_fewer_than_breaks(spark):
    px = spark.createDataFrame([(1.0,)], "value double")
    with pytest.raises(ValueError):
        display.bin_values(px, [0, 1, 2], ["a"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_crowded_join_gives_the_plain_rows(spark, how):
    rng = random.Random(12)
    rows = [(1 if rng.random() < 0.6 else rng.randrange(9), rng.randrange(5)) for _ in range(900)] + [(None, 1)]
    left = spark.createDataFrame(rows, "k long, v long").repartition(6)
    right = spark.createDataFrame([(rng.randrange(12), rng.randrange(5)) for _ in range(60)] + [(None, 3)], "k long, w long")
    got = crowded_join(left, right, ["k"], F.col("v") < F.col("w"), how, crowd=50)
    plain = left.join(right.select(F.col("k").alias("_r_k"), "w"), (F.col("k") == F.col("_r_k")) & (F.col("v") < F.col("w")), how)
    key = lambda r: tuple((x is None, x) for x in r)
    columns = ["k", "v", "w"] if how in ("inner", "left") else ["k", "v"]
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, plain.select(*columns).collect()))


def test_half_the_points_in_one_tile(spark):
    """Parts of a crowded tile are about equal, and its polygons are repeated there alone."""
    n = 40_000
    spread = F.rand(5) * 100
    points = spark.range(n).select("id", F.when(F.col("id") < n / 2, 3.3).otherwise(spread).alias("lon"), F.when(F.col("id") < n / 2, 4.4).otherwise(F.rand(6) * 100).alias("lat"))
    points = cut_lineage(points.repartition(8))
    tiles = spatial.tile_points(points, "lon", "lat", 25.0)
    marked = crowded_join(tiles, spark.createDataFrame([(0, 0), (1, 1), (2, 3)], "_tx long, _ty long"), ["_tx", "_ty"], F.lit(True), crowd=2000)
    held = marked.groupBy("_tx", "_ty").count().collect()
    assert sorted(r["count"] for r in held)[-1] > n / 2
    squares = [[(x, y), (x + 10.0, y), (x + 10.0, y + 10.0), (x, y + 10.0), (x, y)] for x in (0.0, 30.0, 70.0) for y in (0.0, 50.0)]
    polys = spark.createDataFrame([(i, [[{"x": a, "y": b} for a, b in s]]) for i, s in enumerate(squares)], "zone long, rings array<array<struct<x:double,y:double>>>")
    split = spatial.point_in_polygon(points, polys, 25.0, crowd=2000).select("id", "zone")
    whole = spatial.point_in_polygon(points, polys, 25.0, crowd=n).select("id", "zone")
    assert split.exceptAll(whole).isEmpty() and split.count() == whole.count() > n / 2
    # rows of every part of a tile, as the join deals them
    parts = tiles.withColumn("_part", F.pmod(F.xxhash64(*tiles.columns, F.spark_partition_id()), F.lit(11))).where("_tx = 0 and _ty = 0")
    sizes = sorted(r["count"] for r in parts.groupBy("_part").count().collect())
    assert len(sizes) == 11 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_nearest_with_half_the_points_in_one_tile(spark):
    rng = random.Random(14)
    places = [(i, 5 + rng.random() / 1000 if i % 2 else rng.uniform(0, 50), 5 + rng.random() / 1000 if i % 2 else rng.uniform(0, 50)) for i in range(600)]
    nodes = [(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(400)]
    points = spark.createDataFrame(places, "id long, lon double, lat double")
    queries = nearest._distinct_queries(points, "lon", "lat")
    items = spark.createDataFrame(nodes, "node long, x double, y double").select(
        F.struct("node", "x", "y").alias("_i"), F.col("x").alias("_ix"), F.col("y").alias("_iy"), F.lit(0.0).alias("_slack")
    )
    pairs = nearest.candidate_pairs(queries, items, 1, crowd=20).select("_px", "_py", F.hypot(F.col("_px") - F.col("_i.x"), F.col("_py") - F.col("_i.y")).alias("d"))
    got = {(r["_px"], r["_py"]): r["d"] for r in pairs.groupBy("_px", "_py").agg(F.min("d").alias("d")).collect()}
    assert len(got) == 600
    for (_, x, y) in places:
        assert got[(x, y)] == pytest.approx(min(((x - a) ** 2 + (y - b) ** 2) ** 0.5 for _, a, b in nodes))


def test_polygons_of_a_crowded_tile_are_dealt_out(spark):
    """Half of the boxes lie in one tile; the pairs found are those of the boxes that meet, however the tile is split."""
    rng = random.Random(12)

    def box(i, x, y, r):
        return (i, [[(x, y), (x + r, y), (x + r, y + r), (x, y + r), (x, y)]])

    spots = [(rng.uniform(0, 1), rng.uniform(0, 1)) if i % 2 else (rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(120)]
    sizes = [rng.uniform(0.05, 0.4) for _ in spots]
    schema = "struct<x:double,y:double>"
    boxes = spark.createDataFrame([box(i, x, y, r) for i, ((x, y), r) in enumerate(zip(spots, sizes))], f"id long, rings array<array<{schema}>>")
    areas = boxes.select((F.col("id") + 1000).alias("area"), "rings").where("id % 3 = 0")
    apart = lambda a, b: spots[a][0] > spots[b][0] + sizes[b] or spots[a][1] > spots[b][1] + sizes[b]
    want = {(a, b + 1000) for a in range(120) for b in range(0, 120, 3) if not apart(a, b) and not apart(b, a)}
    for crowd in (7, 10_000):
        found = spatial.intersecting(boxes, areas, 1.0, how="inner", crowd=crowd).collect()
        assert sorted((r.id, r.area) for r in found) == sorted(want), crowd


def test_rows_are_dealt_over_as_many_partitions_as_they_take(spark, monkeypatch):
    from citygrain import scale
    from citygrain.operators import pixels

    monkeypatch.setattr(scale, "PARTITION_ROWS", 100)
    px = spark.range(3000).select((F.col("id") % 2).alias("city"), (F.col("id") % 60).cast("int").alias("x"), (F.col("id") / 60).cast("int").alias("y"), (F.col("id") % 7).alias("value"))
    for made in (pixels.mosaic([px, px], "max"), pixels.mosaic([px, px]), pixels.composite_max(px)):
        assert made.rdd.getNumPartitions() >= 30 and sorted(made.collect()) == sorted(px.collect())
    runs = pixels.dissolve_values(px)
    assert runs.rdd.getNumPartitions() == 30 and runs.count() == 3000
    few = px.limit(500)
    assert scale.dealt(few, ["x"]) is few


def test_several_nearest_nodes_leave_few_rows_a_tile(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 8)
    rng = random.Random(5)
    # places on a coarse lattice, so that many distances are equal, and several nodes at one place
    nodes = [(i, rng.randrange(40) / 4.0, rng.randrange(40) / 4.0) for i in range(900)] + [(900, None, 1.0)]
    points = [(i, rng.randrange(80) / 8.0, rng.randrange(80) / 8.0) for i in range(60)] + [(60, None, None)]
    rows, pairs_of = [], nearest.candidate_pairs

    def counted(*args, **named):
        out = pairs_of(*args, **named)
        rows.append(out.count())
        return out

    monkeypatch.setattr(nearest, "candidate_pairs", counted)
    found = nearest.k_nearest_nodes(
        spark.createDataFrame(points, "id long, lon double, lat double"), spark.createDataFrame(nodes, "node long, x double, y double"), 5
    )
    got = {r.id: r.nodes for r in found.collect()}
    held = [n for n in nodes if n[1] is not None]
    assert got == {i: [n for _, n in sorted((math.hypot(x - a, y - b), n) for n, a, b in held)[:5]] for i, x, y in points if x is not None}
    # at most five of each tile, not all its items
    assert rows[0] <= 60 * 5 * 9


def test_long_segments_are_cut_on_the_way_down(spark, monkeypatch):
    rng = random.Random(13)
    segs = []
    for i in range(3000):
        x, y, a = rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(0, 2 * math.pi)
        segs.append((i, x, y, x + 30 * math.cos(a), y + 30 * math.sin(a)))
    points = [(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(40)]
    seen, pairs_of = [], nearest.candidate_pairs
    monkeypatch.setattr(nearest, "LEAF", 4)
    monkeypatch.setattr(nearest, "candidate_pairs", lambda *a, **k: seen.append(pairs_of(*a, **k)) or seen[-1])
    table = spark.createDataFrame(segs, "segment long, x1 double, y1 double, x2 double, y2 double")
    found = nearest.nearest_segment(spark.createDataFrame(points, "id long, lon double, lat double"), table)
    got = {r.id: (r.segment, r.distance) for r in found.collect()}

    def gap(px, py, x1, y1, x2, y2):
        t = max(0.0, min(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
        return math.hypot(x1 + t * (x2 - x1) - px, y1 + t * (y2 - y1) - py)

    for i, px, py in points:
        d, best = min((gap(px, py, *s[1:]), s[0]) for s in segs)
        assert got[i][0] == best and abs(got[i][1] - d) < 1e-9
    # half a segment's length around each point there are more than 200 middles
    assert seen[0].select("_q", "_i").distinct().count() < 100 * len(points)


def test_nearest_polygon_reads_points_as_often_as_it_returns_them(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, i * 0.7 % 21 - 1.5, i * 1.3 % 9 - 1.5) for i in range(70)]
    points = spark.createDataFrame(rows, "id long, lon double, lat double").mapInArrow(counted, "id long, lon double, lat double")
    boxes = [(k, 2.0 * k, 0.0, 2.0 * k + 1, 5.0) for k in range(20)]
    polys = spark.createDataFrame(boxes, "zone long, xmin double, ymin double, xmax double, ymax double").withColumn("rings", geo.box_polygon())
    found = {r["id"]: r["distance"] for r in nearest.nearest_polygon(points, polys, 2.0).collect()}
    want = {i: min(math.hypot(max(a - x, x - c, 0), max(b - y, y - d, 0)) for _, a, b, c, d in boxes) for i, x, y in rows}
    assert found == pytest.approx(want)
    # once for their places, and once for the result
    assert read.value <= 2 * len(rows)


def test_expected_sizes_do_not_grow_with_the_levels_of_a_search(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 1)
    nodes = [("a", i, 1.5**-i, 0.0) for i in range(12)]
    points = spark.createDataFrame([("a", i, 0.0, 0.1 * i) for i in range(4)], "city string, id long, lon double, lat double")
    found = nearest.k_nearest(points, spark.createDataFrame(nodes, "city string, node long, x double, y double"), 1, by=["city"])
    assert {r["id"]: r["node"] for r in found.collect()} == {i: min(nodes, key=lambda n: math.hypot(n[2], 0.1 * i))[1] for i in range(4)}
    expected = found._jdf.queryExecution().optimizedPlan().stats().simpleString()
    power = re.search(r"E\+(\d+)", expected)
    assert power is None or int(power[1]) < 1000, expected
