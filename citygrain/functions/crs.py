"""Projections as closed-form column expressions.

Longitude and latitude are degrees on the WGS 84 ellipsoid; projected units are metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS 84.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(E2)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Mercator (3857)."""
    return (
        F.radians(lon) * SEMI_MAJOR,
        F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * SEMI_MAJOR,
    )


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / SEMI_MAJOR), F.degrees(F.atan(F.sinh(y / SEMI_MAJOR)))


def _authalic(s: Column) -> Column:
    """q of the authalic latitude, from the sine of the latitude."""
    return (1 - E2) * (s / (1 - E2 * s * s) - F.ln((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


def _equal_area_scale() -> tuple[float, float]:
    ts = math.radians(30.0)
    k0 = math.cos(ts) / math.sqrt(1 - E2 * math.sin(ts) ** 2)
    qp = (1 - E2) * (1 / (1 - E2) - math.log((1 - ECC) / (1 + ECC)) / (2 * ECC))
    return k0, qp


def to_equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Ellipsoidal cylindrical equal area with standard parallel 30 (6933)."""
    k0, _ = _equal_area_scale()
    return F.radians(lon) * (SEMI_MAJOR * k0), _authalic(F.sin(F.radians(lat))) * (SEMI_MAJOR / (2 * k0))


def from_equal_area(x: Column, y: Column) -> tuple[Column, Column]:
    k0, qp = _equal_area_scale()
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y * (2 * k0 / (SEMI_MAJOR * qp)))))
    lat = (
        beta
        + F.sin(beta * 2) * (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040)
        + F.sin(beta * 4) * (23 * E2**2 / 360 + 251 * E2**3 / 3780)
        + F.sin(beta * 6) * (761 * E2**3 / 45360)
    )
    return F.degrees(x / (SEMI_MAJOR * k0)), F.degrees(lat)


def to_mollweide(lon: Column, lat: Column, steps: int = 8) -> tuple[Column, Column]:
    """Mollweide on a sphere; the auxiliary angle by a fixed number of Newton steps.

    The steps run inside ``aggregate`` so the expression does not double per step.
    """
    phi = F.radians(lat)
    target = F.sin(phi) * math.pi

    def newton(theta: Column, _: Column) -> Column:
        slope = 2 + 2 * F.cos(theta * 2)
        step = F.when(F.abs(slope) < 1e-9, F.lit(0.0)).otherwise((theta * 2 + F.sin(theta * 2) - target) / slope)
        return theta - step

    start = F.when(F.abs(lat) >= 90, F.signum(phi) * (math.pi / 2)).otherwise(phi)
    theta = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, newton)
    radius = SEMI_MAJOR * math.sqrt(2)
    return F.radians(lon) * F.cos(theta) * (2 * radius / math.pi), F.sin(theta) * radius


def from_mollweide(x: Column, y: Column) -> tuple[Column, Column]:
    radius = SEMI_MAJOR * math.sqrt(2)
    theta = F.asin(y / radius)
    lat = F.degrees(F.asin((theta * 2 + F.sin(theta * 2)) / math.pi))
    lon = F.degrees(x * math.pi / (F.cos(theta) * (2 * radius)))
    return lon, lat


# Transverse Mercator by the Krueger series to the third order.
N3 = FLATTENING / (2 - FLATTENING)
RECTIFYING = SEMI_MAJOR / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
ALPHA = (
    N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16,
    13 * N3**2 / 48 - 3 * N3**3 / 5,
    61 * N3**3 / 240,
)
BETA = (
    N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96,
    N3**2 / 48 + N3**3 / 15,
    17 * N3**3 / 480,
)
DELTA = (
    2 * N3 - 2 * N3**2 / 3 - 2 * N3**3,
    7 * N3**2 / 3 - 8 * N3**3 / 5,
    56 * N3**3 / 15,
)
UTM_SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500000.0, 10000000.0


def to_utm(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    phi, dlon = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    c = 2 * math.sqrt(N3) / (1 + N3)
    t = F.sinh(F.atanh(F.sin(phi)) - F.atanh(F.sin(phi) * c) * c)
    xi, eta = F.atan2(t, F.cos(dlon)), F.atanh(F.sin(dlon) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, start=1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    scale = UTM_SCALE * RECTIFYING
    return (
        east * scale + FALSE_EAST,
        north * scale + F.when(south, F.lit(FALSE_NORTH)).otherwise(F.lit(0.0)),
    )


def from_utm(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    scale = UTM_SCALE * RECTIFYING
    xi = (y - F.when(south, F.lit(FALSE_NORTH)).otherwise(F.lit(0.0))) / scale
    eta = (x - FALSE_EAST) / scale
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, start=1):
        xi1 = xi1 - F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * b
        eta1 = eta1 - F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * b
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(DELTA, start=1):
        lat = lat + F.sin(chi * (2 * j)) * d
    lon = F.lit(-183.0) + zone * 6 + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1)))
    return lon, F.degrees(lat)


def project(x: Column, y: Column, src: str, dst: str, zone: Column | None = None, south: Column | None = None):
    """Coordinates from one system to another: 4326, 3857, 6933, mollweide or utm."""
    inverse = {"3857": from_mercator, "6933": from_equal_area, "mollweide": from_mollweide}
    forward = {"3857": to_mercator, "6933": to_equal_area, "mollweide": to_mollweide}
    if src == dst:
        return x, y
    if src == "utm":
        x, y = from_utm(x, y, zone, south)
    elif src != "4326":
        x, y = inverse[src](x, y)
    if dst == "4326":
        return x, y
    if dst == "utm":
        zone = utm_zone(x) if zone is None else zone
        return to_utm(x, y, zone, y < 0 if south is None else south)
    return forward[dst](x, y)


def to_crs(df: DataFrame, x: str, y: str, src: str, dst: str, **utm: Column) -> DataFrame:
    """Replace two coordinate columns by their projection."""
    nx, ny = project(F.col(x), F.col(y), src, dst, **utm)
    return df.withColumns({x: nx, y: ny})
