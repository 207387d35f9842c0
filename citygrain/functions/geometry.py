"""Geometry on coordinate arrays.

A line or ring is ``array<struct<x double, y double>>``. A polygon is an array of rings,
holes and further parts included; a point is inside by the even-odd rule over all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from citygrain.functions.crs import to_mercator


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))


def box_polygon(xmin: str = "xmin", ymin: str = "ymin", xmax: str = "xmax", ymax: str = "ymax") -> Column:
    return F.array(box_ring(F.col(xmin), F.col(ymin), F.col(xmax), F.col(ymax)))


def segments(line: Column) -> Column:
    """Consecutive vertex pairs as an array of x1, y1, x2, y2."""
    n = F.size(line)
    return F.when(
        n >= 2,
        F.zip_with(
            F.slice(line, F.lit(1), n - 1),
            F.slice(line, F.lit(2), n - 1),
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"))


def polygon_segments(rings: Column) -> Column:
    return F.flatten(F.transform(rings, segments))


def crossings(segs: Column, x: Column, y: Column) -> Column:
    """Number of segments a ray to the right of the point crosses."""
    return F.size(
        F.filter(
            segs,
            lambda s: ((s["y1"] > y) != (s["y2"] > y))
            & (x < (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]),
        )
    )


def contains(rings: Column, x: Column, y: Column) -> Column:
    return crossings(polygon_segments(rings), x, y) % 2 == 1


def bounds(rings: Column) -> Column:
    """Struct xmin, ymin, xmax, ymax over all rings."""
    xs = F.transform(F.flatten(rings), lambda p: p["x"])
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6371.0) -> Column:
    """Great-circle distance; pass radius 6367 for the second convention."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.asin(F.sqrt(a)) * (2 * radius)


def ellipsoid_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance on the ellipsoid by the mid-latitude radii; accurate for street-length segments."""
    from citygrain.functions.crs import E2, SEMI_MAJOR

    mid = F.radians((lat1 + lat2) / 2)
    w = 1 - E2 * F.pow(F.sin(mid), 2)
    meridian = SEMI_MAJOR * (1 - E2) / F.pow(w, 1.5)
    parallel = F.cos(mid) * SEMI_MAJOR / F.sqrt(w)
    return F.hypot(F.radians(lat2 - lat1) * meridian, F.radians(lon2 - lon1) * parallel) / 1000


def line_length_km(line: Column, ellipsoidal: bool = False) -> Column:
    measure = ellipsoid_km if ellipsoidal else haversine_km
    return F.aggregate(
        segments(line), F.lit(0.0), lambda t, s: t + measure(s["x1"], s["y1"], s["x2"], s["y2"])
    )


def planar_km(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """Distance in the 3857 plane, in kilometres."""
    x, y = to_mercator(lon, lat)
    x0, y0 = to_mercator(lon0, lat0)
    return F.hypot(x - x0, y - y0) / 1000


def signed_area(ring: Column) -> Column:
    return (
        F.aggregate(segments(ring), F.lit(0.0), lambda t, s: t + (s["x1"] * s["y2"] - s["x2"] * s["y1"])) / 2
    )


def polygon_area(rings: Column) -> Column:
    """Area of the even-odd polygon: outer rings minus holes."""
    parts = F.transform(rings, lambda ring: F.abs(signed_area(ring)) * ring_sign(rings, ring))
    return F.when(F.size(rings) == 1, F.abs(signed_area(rings[0]))).otherwise(
        F.aggregate(parts, F.lit(0.0), lambda t, a: t + a)
    )


def centroid(ring: Column) -> Column:
    """Area-weighted centroid of a ring, relative to its first vertex for precision."""
    ox, oy = ring[0]["x"], ring[0]["y"]
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))

    def step(t, s):
        x1, y1, x2, y2 = s["x1"] - ox, s["y1"] - oy, s["x2"] - ox, s["y2"] - oy
        w = x1 * y2 - x2 * y1
        return F.struct(
            (t["a"] + w).alias("a"), (t["cx"] + (x1 + x2) * w).alias("cx"), (t["cy"] + (y1 + y2) * w).alias("cy")
        )

    return F.aggregate(
        segments(ring),
        zero,
        step,
        lambda t: F.struct(
            (ox + F.try_divide(t["cx"], t["a"] * 3)).alias("x"), (oy + F.try_divide(t["cy"], t["a"] * 3)).alias("y")
        ),
    )


def box_center(rings: Column) -> Column:
    """Centre of the bounding box of all parts."""
    b = bounds(rings)
    return F.struct(((b["xmin"] + b["xmax"]) / 2).alias("x"), ((b["ymin"] + b["ymax"]) / 2).alias("y"))


def valid_ring(ring: Column) -> Column:
    """Closed, at least four vertices, some area."""
    closed = (ring[0] == F.element_at(ring, -1))
    return F.coalesce((F.size(ring) >= 4) & closed & (signed_area(ring) != 0), F.lit(False))


def drop_z(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def buffer_ring(lon: Column, lat: Column, km: float, vertices: int = 64) -> Column:
    """Ring of a circle of the given radius in the 3857 plane, back in degrees."""
    from citygrain.functions.crs import from_mercator

    x, y = to_mercator(lon, lat)

    def vertex(i: Column) -> Column:
        angle = i * (2 * math.pi / vertices)
        px, py = from_mercator(x + F.cos(angle) * (km * 1000), y + F.sin(angle) * (km * 1000))
        return F.struct(px.alias("x"), py.alias("y"))

    ring = F.transform(F.sequence(F.lit(0), F.lit(vertices - 1)), vertex)
    return F.concat(ring, F.slice(ring, 1, 1))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial bearing in degrees, 0 to 360, clockwise from north."""
    p1, p2, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.atan2(F.sin(d) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(d))
    return F.pmod(F.degrees(angle), F.lit(360.0))


def pad_box(box: Column, *growth: float) -> Column:
    """Grow a box by multiples of its size: one factor, (x, y), or (xmin, xmax, ymin, ymax)."""
    if len(growth) == 1:
        growth = growth * 4
    elif len(growth) == 2:
        growth = (growth[0], growth[0], growth[1], growth[1])
    w, h = box["xmax"] - box["xmin"], box["ymax"] - box["ymin"]
    return F.struct(
        (box["xmin"] - w * growth[0]).alias("xmin"),
        (box["ymin"] - h * growth[2]).alias("ymin"),
        (box["xmax"] + w * growth[1]).alias("xmax"),
        (box["ymax"] + h * growth[3]).alias("ymax"),
    )


def buffer_box(box: Column, distance: Column | float) -> Column:
    """Box grown by a fixed distance on every side."""
    d = distance if isinstance(distance, Column) else F.lit(float(distance))
    return F.struct(
        (box["xmin"] - d).alias("xmin"),
        (box["ymin"] - d).alias("ymin"),
        (box["xmax"] + d).alias("xmax"),
        (box["ymax"] + d).alias("ymax"),
    )


def fit_aspect(box: Column, ratio: float, pad: float = 0.0) -> Column:
    """Smallest box around the centre with the aspect ratio, in the 3857 plane, back in degrees."""
    from citygrain.functions.crs import from_mercator

    x1, y1 = to_mercator(box["xmin"], box["ymin"])
    x2, y2 = to_mercator(box["xmax"], box["ymax"])
    w, h = x2 - x1, y2 - y1
    width, height = F.greatest(w, h * ratio), F.greatest(h, w / ratio)
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    half_w, half_h = width / 2 * (1 + pad), height / 2 * (1 + pad)
    lon1, lat1 = from_mercator(cx - half_w, cy - half_h)
    lon2, lat2 = from_mercator(cx + half_w, cy + half_h)
    return F.struct(lon1.alias("xmin"), lat1.alias("ymin"), lon2.alias("xmax"), lat2.alias("ymax"))


def point_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Nearest place on a segment: parameter t in 0..1, its x and y, and the distance."""
    dx, dy = x2 - x1, y2 - y1
    norm = dx * dx + dy * dy
    t = F.when(norm == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / norm))
    )
    return F.struct(
        t.alias("t"),
        (x1 + dx * t).alias("x"),
        (y1 + dy * t).alias("y"),
        F.hypot(px - x1 - dx * t, py - y1 - dy * t).alias("distance"),
    )


def segment_meets_box(s: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """True when a segment touches a closed box (separating axes)."""
    x1, y1, x2, y2 = s["x1"], s["y1"], s["x2"], s["y2"]
    nx, ny = y2 - y1, x1 - x2
    c = nx * x1 + ny * y1
    corners = [nx * a + ny * b - c for a in (xmin, xmax) for b in (ymin, ymax)]
    return (
        (F.least(x1, x2) <= xmax)
        & (F.greatest(x1, x2) >= xmin)
        & (F.least(y1, y2) <= ymax)
        & (F.greatest(y1, y2) >= ymin)
        & (F.least(*corners) <= 0)
        & (F.greatest(*corners) >= 0)
    )


def clip_to_convex(ring: Column, clipper: Column) -> Column:
    """Ring cut to a convex ring, one side of it after the other. Empty when nothing is left.

    The ring may be concave; pieces stay connected along the clipper, so areas are exact.
    """
    empty = F.array().cast("array<struct<x:double,y:double>>")

    # every intermediate is an array or struct bound by a lambda, so it is computed once
    def side(current: Column, edge: Column) -> Column:
        def offset(x: Column, y: Column) -> Column:
            return edge["ex"] * (y - edge["y1"]) - edge["ey"] * (x - edge["x1"])

        def cut(s: Column) -> Column:
            a, b, t = s["a"], s["b"], s["a"] / (s["a"] - s["b"])
            meet = point(s["x1"] + (s["x2"] - s["x1"]) * t, s["y1"] + (s["y2"] - s["y1"]) * t)
            end = point(s["x2"], s["y2"])
            return (
                F.when((a >= 0) & (b >= 0), F.array(end))
                .when(a >= 0, F.array(meet))
                .when(b >= 0, F.array(meet, end))
                .otherwise(empty)
            )

        measured = F.transform(
            segments(current),
            lambda s: F.struct(
                s["x1"], s["y1"], s["x2"], s["y2"],
                offset(s["x1"], s["y1"]).alias("a"), offset(s["x2"], s["y2"]).alias("b"),
            ),
        )
        kept = F.flatten(F.transform(measured, cut))
        return F.transform(
            F.array(kept), lambda k: F.when(F.size(k) > 0, F.concat(F.slice(k, -1, 1), k)).otherwise(empty)
        )[0]

    oriented = F.transform(
        F.array(F.struct(segments(clipper).alias("edges"), F.signum(signed_area(clipper)).alias("turn"))),
        lambda c: F.transform(
            c["edges"],
            lambda e: F.struct(
                e["x1"], e["y1"],
                ((e["x2"] - e["x1"]) * c["turn"]).alias("ex"), ((e["y2"] - e["y1"]) * c["turn"]).alias("ey"),
            ),
        ),
    )[0]
    plain = F.transform(ring, lambda p: point(p["x"], p["y"]))
    return F.aggregate(oriented, plain, side)


def ring_sign(rings: Column, ring: Column) -> Column:
    """1 for an outer ring, -1 for a hole (inside an odd number of the other rings)."""
    first = ring[0]
    depth = F.size(
        F.filter(rings, lambda o: (o != ring) & (crossings(segments(o), first["x"], first["y"]) % 2 == 1))
    )
    return F.when(depth % 2 == 1, F.lit(-1.0)).otherwise(F.lit(1.0))


def intersection_area(a: Column, b: Column) -> Column:
    """Area shared by two polygons of any shape.

    Polygon ``a`` is read as a signed fan of triangles, and ``b`` is cut to each of them.
    """
    signed_b = F.transform(b, lambda ring: F.struct(ring_sign(b, ring).alias("sign"), ring.alias("ring")))

    def fan(ring: Column) -> Column:
        """Triangles of a ring with their signed areas."""
        apex = ring[0]
        corners = F.transform(
            segments(ring), lambda s: F.array(apex, point(s["x1"], s["y1"]), point(s["x2"], s["y2"]), apex)
        )
        return F.transform(corners, lambda t: F.struct(F.signum(signed_area(t)).alias("sign"), t.alias("ring")))

    def shared(triangle: Column, part: Column) -> Column:
        return triangle["sign"] * part["sign"] * F.abs(signed_area(clip_to_convex(part["ring"], triangle["ring"])))

    def ring_total(ring: Column) -> Column:
        pieces = F.flatten(
            F.transform(
                F.filter(fan(ring), lambda t: t["sign"] != 0),
                lambda t: F.transform(signed_b, lambda p: shared(t, p)),
            )
        )
        return F.abs(F.aggregate(pieces, F.lit(0.0), lambda total, v: total + v)) * ring_sign(a, ring)

    return F.aggregate(F.transform(a, ring_total), F.lit(0.0), lambda total, v: total + v)


def segments_meet(s: Column, o: Column) -> Column:
    """True when two segments cross or touch."""

    def turn(ax, ay, bx, by, cx, cy):
        return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    d1 = turn(s["x1"], s["y1"], s["x2"], s["y2"], o["x1"], o["y1"])
    d2 = turn(s["x1"], s["y1"], s["x2"], s["y2"], o["x2"], o["y2"])
    d3 = turn(o["x1"], o["y1"], o["x2"], o["y2"], s["x1"], s["y1"])
    d4 = turn(o["x1"], o["y1"], o["x2"], o["y2"], s["x2"], s["y2"])
    overlap = (
        (F.least(s["x1"], s["x2"]) <= F.greatest(o["x1"], o["x2"]))
        & (F.least(o["x1"], o["x2"]) <= F.greatest(s["x1"], s["x2"]))
        & (F.least(s["y1"], s["y2"]) <= F.greatest(o["y1"], o["y2"]))
        & (F.least(o["y1"], o["y2"]) <= F.greatest(s["y1"], s["y2"]))
    )
    return overlap & (d1 * d2 <= 0) & (d3 * d4 <= 0)
