"""Tile names, quadkeys and tile boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# latitude or longitude: positive letter, negative letter, digits
AXES = {"lat": ("N", "S", 2), "lon": ("E", "W", 3)}


def degree_label(degrees: Column, axis: str) -> Column:
    """Hemisphere letter and zero-padded absolute degrees, such as S07 or E012."""
    positive, negative, digits = AXES[axis]
    letter = F.when(degrees < 0, F.lit(negative)).otherwise(F.lit(positive))
    return F.concat(letter, F.format_string(f"%0{digits}d", F.abs(degrees)))


def tile_starts(low: Column, high: Column, size: int) -> Column:
    """Lower edges of the tiles that cover an interval; empty when it has no extent."""
    first = (F.floor(low / size) * size).cast("int")
    last = (F.ceil(high / size) * size - size).cast("int")
    return F.when(last >= first, F.sequence(first, last, F.lit(size))).otherwise(F.array().cast("array<int>"))


def tile_labels(boxes: DataFrame, axis: str, size: int = 1, name: str = "label") -> DataFrame:
    """One row per box and tile that covers it along latitude or longitude."""
    low, high = (F.col("ymin"), F.col("ymax")) if axis == "lat" else (F.col("xmin"), F.col("xmax"))
    out = boxes.withColumn("_start", F.explode(tile_starts(low, high, size)))
    return out.withColumn(name, degree_label(F.col("_start"), axis)).drop("_start")


def tile_to_degrees(label: Column) -> Column:
    """Signed degrees of a tile label; null for anything else."""
    letter, number = F.substring(label, 1, 1), F.substring(label, 2, 10).try_cast("int")
    return F.when(letter.isin("N", "E"), number).when(letter.isin("S", "W"), -number)


def parent_tile(label: Column, axis: str, size: int = 10) -> Column:
    """Label of the larger tile a small tile lies in."""
    return degree_label((F.floor(tile_to_degrees(label) / size) * size).cast("int"), axis)


def far_corner(label: Column, size: int = 10) -> Column:
    """Label one tile further north or east, across zero where needed (S10 -> N00)."""
    degrees = tile_to_degrees(label) + size
    is_lat = F.substring(label, 1, 1).isin("N", "S")
    return F.when(is_lat, degree_label(degrees, "lat")).otherwise(degree_label(degrees, "lon"))


def even_tiles(boxes: DataFrame, size: int = 2) -> DataFrame:
    """Ids ``lon_lat`` of the size-degree tiles with multiples-of-size origins covering each box."""
    lon, lat = (
        tile_starts(F.col("xmin"), F.col("xmax"), size),
        tile_starts(F.col("ymin"), F.col("ymax"), size),
    )
    out = boxes.withColumn("_lon", F.explode(lon)).withColumn("_lat", F.explode(lat))
    return out.withColumn("tile_id", F.concat_ws("_", "_lon", "_lat")).drop("_lon", "_lat")


def quadkey(lat: Column, lon: Column, zoom: int) -> Column:
    """Quadkey text of a coordinate; leading zeros are kept."""
    n = float(1 << zoom)
    x = F.floor((lon + 180) / 360 * n)
    y = F.floor((1 - F.ln(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / math.pi) / 2 * n)

    def bit(value: Column, position: int) -> Column:
        return F.floor(value / float(1 << position)) % 2

    digits = [(bit(x, i) + 2 * bit(y, i)).cast("int").cast("string") for i in range(zoom - 1, -1, -1)]
    return F.concat(*digits)


def feature_quadkeys(features: DataFrame, vertices: str, zoom: int, keys: list[str]) -> DataFrame:
    """Distinct quadkeys of all vertices of each feature; ``vertices`` is an array of x, y."""
    v = features.select(*keys, F.explode(vertices).alias("_v"))
    return v.select(*keys, quadkey(F.col("_v.y"), F.col("_v.x"), zoom).alias("quadkey")).distinct()


def quadkey_box(key: Column, digits: int = 14) -> Column:
    """Struct xmin, ymin, xmax, ymax of a quadkey, padded on the left with zeros."""
    padded = F.lpad(key, digits, "0")
    x = y = F.lit(0).cast("long")
    for i in range(1, digits + 1):
        digit = F.substring(padded, i, 1).cast("int")
        x = x * 2 + digit % 2
        y = y * 2 + F.floor(digit / 2.0)
    n = float(1 << digits)

    def lat(row: Column) -> Column:
        return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * row / n))))

    return F.struct(
        (x / n * 360 - 180).alias("xmin"),
        lat(y + 1).alias("ymin"),
        ((x + 1) / n * 360 - 180).alias("xmax"),
        lat(y).alias("ymax"),
    )


def join_quadkeys(tiles: DataFrame, values: DataFrame, key: str = "quadkey", digits: int = 14) -> DataFrame:
    """Join attributes to tiles on the padded quadkey."""
    padded = values.withColumn(key, F.lpad(F.col(key), digits, "0"))
    return tiles.withColumn(key, F.lpad(F.col(key), digits, "0")).join(padded, key)
