"""Cell footprints, density surfaces, rasterized points and label points."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions import geometry as geo
from citygrain.grid import Grid
from citygrain.operators.nearest import k_nearest
from citygrain.operators.topology import connected_components
from citygrain.scale import cut_lineage, exact_quantiles, join_on

CELL = ("x", "y")


def footprint(segments: DataFrame, radius: float, grid: Grid, by: Sequence[str] = (), fill: bool = False) -> DataFrame:
    """Cells whose centre lies within the radius of a segment (or of a point, when both ends agree).

    ``segments`` has x1, y1, x2, y2. Long segments are walked in pieces of four radii, so the
    cells tried grow with length, not with the bounding box.
    """
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    pieces = F.greatest(F.ceil(length / (4.0 * radius)), F.lit(1)).cast("int")
    cut = (
        segments.select(*by, "x1", "y1", "x2", "y2").distinct()
        .withColumn("_n", pieces)
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    )
    a, b = (F.col("_k") - 1) / F.col("_n"), F.col("_k") / F.col("_n")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cut = cut.select(
        *by,
        (F.col("x1") + dx * a).alias("x1"), (F.col("y1") + dy * a).alias("y1"),
        (F.col("x1") + dx * b).alias("x2"), (F.col("y1") + dy * b).alias("y2"),
    )

    def span(p: str, q: str, origin: float, step: float) -> Column:
        e1 = F.floor((F.least(p, q) - radius - origin) / step)
        e2 = F.floor((F.greatest(p, q) + radius - origin) / step)
        return F.explode(F.sequence(F.least(e1, e2).cast("int"), F.greatest(e1, e2).cast("int")))

    cells = cut.withColumn("x", span("x1", "x2", grid.x0, grid.dx)).withColumn("y", span("y1", "y2", grid.y0, grid.dy))
    cx, cy = grid.center(F.col("x"), F.col("y"))
    near = geo.point_segment(cx, cy, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))["distance"] <= radius
    if grid.width is not None and grid.height is not None:
        cells = cells.where(F.col("x").between(0, grid.width - 1) & F.col("y").between(0, grid.height - 1))
    found = cells.where(near).select(*by, *CELL).distinct()
    return fill_holes(found, by) if fill else found


def fill_holes(cells: DataFrame, by: Sequence[str] = (), block: int = 64) -> DataFrame:
    """Add the empty cells that cannot reach the outside through empty neighbours.

    Empty stretches between occupied cells of a row are the units; stretches that touch in
    neighbouring rows are joined into components, and a component that touches open space is
    outside. The work grows with the stretches, not with the cells of the surroundings.
    """
    row = Window.partitionBy(*by, "y").orderBy("x")
    gaps = (
        cells.withColumn("_prev", F.lag("x").over(row))
        .where(F.col("x") > F.col("_prev") + 1)
        .select(*by, "y", (F.col("_prev") + 1).alias("a"), (F.col("x") - 1).alias("b"))
        .withColumn("node", F.concat_ws("|", *by, "y", "a"))
    )
    extent = cells.groupBy(*by, "y").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # open space lies beyond the first and last occupied cell of a neighbouring row, or the row is empty
    up = gaps.withColumn("_row", F.explode(F.array(F.col("y") - 1, F.col("y") + 1)))
    beside = up.join(extent.withColumnRenamed("y", "_row"), [*by, "_row"], "left")
    open_gaps = (
        beside.where(F.col("lo").isNull() | (F.col("a") < F.col("lo")) | (F.col("b") > F.col("hi")))
        .select("node").distinct()
    )
    parts = gaps.withColumn("_blk", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor(F.col("b") / block))))
    below = parts.select(
        *by, (F.col("y") - 1).alias("y"), "_blk", F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("node").alias("v")
    )
    touching = (
        parts.join(below, [*by, "y", "_blk"])
        .where((F.col("a") <= F.col("_b")) & (F.col("_a") <= F.col("b")))
        .select(F.col("node").alias("u"), "v").distinct()
    )
    labels = connected_components(touching, gaps.select("node"))
    outside = labels.join(open_gaps, "node", "left_semi").select("label").distinct()
    closed = labels.join(outside, "label", "left_anti").select("node")
    holes = gaps.join(closed, "node", "left_semi").select(*by, F.explode(F.sequence("a", "b")).alias("x"), "y")
    return cells.select(*by, *CELL).unionByName(holes)


def distance_bands(footprints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each cell belongs to its smallest threshold: every zone without the next smaller one."""
    return footprints.groupBy(*by, *CELL).agg(F.min("threshold").alias("threshold"))


def dissolve(footprints: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct cells per key, across the parts of an area."""
    return footprints.select(*keys, *CELL).distinct()


def label_points(polys: DataFrame, key: str = "zone", precision: float = 1e-3) -> DataFrame:
    """Centre and radius of the largest circle inside each polygon.

    The radius is at most ``precision`` times the shorter side of the polygon's box below the largest one. Squares over the
    box are searched: a square whose centre, with its half diagonal, cannot beat the best centre found by that
    much is dropped, the others are cut in four.
    """
    base = polys.select(key, geo.polygon_segments(F.col("rings")).alias("_segs"), geo.bounds(F.col("rings")).alias("_b"))
    width, height = F.col("_b.xmax") - F.col("_b.xmin"), F.col("_b.ymax") - F.col("_b.ymin")
    base = base.withColumns({"_side": F.least(width, height), "_w": width, "_h": height}).where("_side > 0")

    def measured(cells: DataFrame) -> DataFrame:
        """Distance of each centre to the boundary, negative outside."""
        px, py = F.col("px"), F.col("py")
        gap = F.array_min(
            F.transform("_segs", lambda s: geo.point_segment(px, py, s["x1"], s["y1"], s["x2"], s["y2"])["distance"])
        )
        signed = F.when(geo.crossings(F.col("_segs"), px, py) % 2 == 1, gap).otherwise(-gap)
        near = cells.join(base.select(key, "_segs", "_side"), key)
        return cut_lineage(near.select(key, "px", "py", "half", "_side", signed.alias("radius")))

    def places(low: str, size: str) -> Column:
        n = F.ceil(F.col(size) / F.col("_side") * 2).cast("int")
        return F.explode(F.transform(F.sequence(F.lit(0), n), lambda i: F.col(low) + i * F.col("_side") / 2 + F.col("_side") / 4))

    grid = base.select(key, "_side", "_b", "_h", places("_b.xmin", "_w").alias("px"))
    grid = grid.select(key, "px", places("_b.ymin", "_h").alias("py"), (F.col("_side") / 4).alias("half"))
    middle = base.select(
        key, ((F.col("_b.xmin") + F.col("_b.xmax")) / 2).alias("px"), ((F.col("_b.ymin") + F.col("_b.ymax")) / 2).alias("py"), F.lit(0.0).alias("half")
    )
    cells = measured(grid.unionByName(middle))
    best = None
    pick = F.max(F.struct("radius", (-F.col("px")).alias("a"), (-F.col("py")).alias("b"))).alias("_best")
    while True:
        found = cells.select(key, "radius", "px", "py")
        found = found if best is None else found.unionByName(best)
        best = cut_lineage(found.groupBy(key).agg(pick).select(key, "_best.radius", (-F.col("_best.a")).alias("px"), (-F.col("_best.b")).alias("py")))
        limit = best.select(key, F.col("radius").alias("_top"))
        reach = F.col("radius") + F.col("half") * math.sqrt(2)
        open_cells = cells.join(limit, key).where(reach > F.greatest("_top", F.lit(0.0)) + F.col("_side") * precision)
        quarters = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-0.5, 0.5) for j in (-0.5, 0.5)]))
        split = open_cells.withColumn("_q", quarters).select(
            key, (F.col("px") + F.col("_q.i") * F.col("half")).alias("px"), (F.col("py") + F.col("_q.j") * F.col("half")).alias("py"),
            (F.col("half") / 2).alias("half"),
        )
        cells = measured(split)
        if cells.isEmpty():
            return best.where("radius > 0").select(key, F.col("px").alias("x"), F.col("py").alias("y"), "radius")


def density(points: DataFrame, n: int = 200, aspect: float | None = None, by: Sequence[str] = (), x: str = "x",
            y: str = "y", flush: int = 64) -> DataFrame:
    """Gaussian kernel density on an n x n grid over the points' extent, rescaled to 0..1.

    The kernel is separable, so each batch of points adds the product of two n-column
    matrices to its group's grid; only grids leave a task, and they are summed by cell.
    Bandwidth per axis is 1.06 min(sd, IQR / 1.34) n^(-1/5).
    """
    pts = points.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(
        "_x IS NOT NULL AND _y IS NOT NULL"
    )
    shape = pts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_x").alias("x1"), F.max("_x").alias("x2"), F.min("_y").alias("y1"), F.max("_y").alias("y2"),
        F.stddev_samp("_x").alias("_sx"), F.stddev_samp("_y").alias("_sy"),
    )
    # both axes in one pass
    axes = pts.unpivot(list(by), ["_x", "_y"], "_axis", "_at")
    q = exact_quantiles(axes, "_at", [0.25, 0.75], [*by, "_axis"])
    width = lambda axis: F.max(F.when(F.col("_axis") == axis, (F.col("q1") - F.col("q0")) / 1.34))
    spread = q.groupBy(*by).agg(width("_x").alias("_qx"), width("_y").alias("_qy"))
    if by:
        shape = join_on(shape, spread, by)
    else:
        shape = shape.withColumns({c: spread.select(c).scalar() for c in ("_qx", "_qy")})
    shape = shape.withColumns(
        {f"_h{a}": F.least(f"_s{a}", F.when(F.col(f"_q{a}") > 0, F.col(f"_q{a}"))) * 1.06 * F.pow("_n", F.lit(-0.2)) for a in ("x", "y")}
    ).where("_hx > 0 AND _hy > 0")
    if aspect is not None:
        w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
        wide, tall = F.greatest(w, h * aspect), F.greatest(h, w / aspect)
        shape = shape.withColumns(
            {
                "x1": (F.col("x1") + F.col("x2")) / 2 - wide / 2, "x2": (F.col("x1") + F.col("x2")) / 2 + wide / 2,
                "y1": (F.col("y1") + F.col("y2")) / 2 - tall / 2, "y2": (F.col("y1") + F.col("y2")) / 2 + tall / 2,
            }
        )
    facts = ["_n", "x1", "x2", "y1", "y2", "_hx", "_hy"]
    shape = shape.select(*by, F.struct(*facts).alias("_f"))
    joined = pts.join(shape, list(by)) if by else pts.withColumn("_f", shape.select("_f").scalar())
    flat = joined.where("_f IS NOT NULL").select(*by, "_x", "_y", *[F.col(f"_f.{c}").alias(c) for c in facts])
    key_fields = [f for f in flat.schema.fields if f.name in by]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in key_fields] + ["x int", "y int", "_part double"])
    names = list(by)
    rows, cols = np.divmod(np.arange(n * n), n)

    def grids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}

        def emit():
            for key, total in sums.items():
                out = pd.DataFrame({"x": rows.astype("int32"), "y": cols.astype("int32"), "_part": total.ravel()})
                for name, value in zip(names, key):
                    out[name] = value
                yield out[names + ["x", "y", "_part"]]

        for batch in batches:
            groups = batch.groupby(names, dropna=False) if names else [((), batch)]
            for key, rows_of in groups:
                f = rows_of.iloc[0]
                gx, gy = np.linspace(f["x1"], f["x2"], n), np.linspace(f["y1"], f["y2"], n)
                kx = np.exp(-0.5 * ((gx[:, None] - rows_of["_x"].to_numpy()[None, :]) / f["_hx"]) ** 2)
                ky = np.exp(-0.5 * ((gy[:, None] - rows_of["_y"].to_numpy()[None, :]) / f["_hy"]) ** 2)
                part = (kx @ ky.T) / (2 * math.pi * f["_n"] * f["_hx"] * f["_hy"])
                key = key if isinstance(key, tuple) else (key,)
                sums[key] = sums[key] + part if key in sums else part
                if len(sums) >= flush:
                    yield from emit()
                    sums.clear()
        yield from emit()

    summed = flat.mapInPandas(grids, schema).groupBy(*by, "x", "y").agg(F.sum("_part").alias("_d"))
    # n x n cells per group
    limits = summed.groupBy(*by).agg(F.struct(F.min("_d").alias("lo"), F.max("_d").alias("hi")).alias("_l"))
    scaled = summed.join(limits, list(by)) if by else summed.withColumn("_l", limits.scalar())
    value = F.coalesce(F.try_divide(F.col("_d") - F.col("_l.lo"), F.col("_l.hi") - F.col("_l.lo")), F.lit(0.0))
    return scaled.select(*by, "x", "y", value.alias("value"))


def rasterize(points: DataFrame, grid: Grid, value: str, order: str, x: str = "lon", y: str = "lat") -> DataFrame:
    """Value of the last point (by ``order``, unique) in each cell of a template grid."""
    col, row = grid.to_cell(F.col(x), F.col(y))
    placed = points.select(col.alias("x"), row.alias("y"), F.col(value).alias("_v"), F.col(order).alias("_o"))
    return placed.where("x IS NOT NULL AND y IS NOT NULL").groupBy(*CELL).agg(F.max_by("_v", "_o").alias("value"))


def interpolate(points: DataFrame, grid: Grid, value: str, k: int = 3, key: str = "id", x: str = "lon",
                y: str = "lat") -> DataFrame:
    """Every cell of a bounded grid, filled by inverse distance from its k nearest points."""
    if grid.width is None or grid.height is None:
        raise ValueError("interpolation needs a grid with width and height")
    cells = points.sparkSession.range(grid.width * grid.height).select(
        (F.col("id") % grid.width).cast("int").alias("x"), F.floor(F.col("id") / grid.width).cast("int").alias("y")
    )
    cx, cy = grid.center(F.col("x"), F.col("y"))
    spots = cells.withColumns({"_cx": cx, "_cy": cy})
    items = points.select(F.col(key).alias("item"), F.col(x).alias("ix"), F.col(y).alias("iy"))
    near = k_nearest(spots, items, k, "_cx", "_cy", "item", "ix", "iy")
    values = points.select(F.col(key).alias("item"), F.col(value).alias("_v"))
    weight = 1 / F.greatest("distance", F.lit(1e-12))
    joined = near.join(values, "item").withColumn("_w", weight)
    return joined.groupBy(*CELL).agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias("value"))


def point_grid(points: DataFrame, x: str = "lon", y: str = "lat") -> Grid:
    """Grid through the distinct coordinates of gridded points, for use without a template."""
    f = points.agg(
        F.min(x).alias("x1"), F.max(x).alias("x2"), F.min(y).alias("y1"), F.max(y).alias("y2"),
        F.count_distinct(F.col(x)).alias("nx"), F.count_distinct(F.col(y)).alias("ny"),
    ).first()
    dx = (f["x2"] - f["x1"]) / max(f["nx"] - 1, 1) or 1.0
    dy = (f["y2"] - f["y1"]) / max(f["ny"] - 1, 1) or 1.0
    return Grid(f["x1"] - dx / 2, f["y1"] - dy / 2, dx, dy, f["nx"], f["ny"])
