"""Points of interest: representative points, category union, export, thinning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import geometry as geo
from citygrain.scale import cut_lineage, numbered


def points_from_columns(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Point table from two coordinate columns; rows without a coordinate are dropped."""
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    return df.withColumns({"lon": x, "lat": y}).where("lon IS NOT NULL AND lat IS NOT NULL")


def poi_points(features: DataFrame) -> DataFrame:
    """A point per feature: nodes as they are, ways by centroid, relations by bounding-box centre."""
    kind, rings = F.col("element_type"), F.col("rings")
    at = (
        F.when(kind == "node", rings[0][0])
        .when(kind == "way", geo.centroid(rings[0]))
        .otherwise(geo.box_center(rings))
    )
    return features.withColumn("_p", at).select(
        *[c for c in features.columns if c != "rings"], F.col("_p.x").alias("lon"), F.col("_p.y").alias("lat")
    )


def poi_union(features: Sequence[DataFrame], categories: dict[str, Sequence[str]], tag: str = "amenity") -> DataFrame:
    """Features of the wanted tags from several tables, labelled by category."""
    pairs = [(F.lit(value), F.lit(label)) for label, values in categories.items() for value in values]
    label = F.try_element_at(F.create_map(*[x for p in pairs for x in p]), F.col(tag))
    out = features[0]
    for f in features[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.withColumn("feature", label).where("feature IS NOT NULL")


def with_coordinates(points: DataFrame, order: Sequence[str], x: str = "lon", y: str = "lat") -> DataFrame:
    """Export form: Lat, Lon and a running id from 0 in the given (unique) order."""
    return numbered(points.withColumns({"Lat": F.col(y), "Lon": F.col(x)}), list(order), "mID")


def thin_points(points: DataFrame, radius: float, key: str = "id", order: str = "id", x: str = "lon",
                y: str = "lat") -> DataFrame:
    """Keep a point when its buffer meets no buffer of a point kept earlier in the order.

    Equal to the sequential rule. Tiles have a diagonal of two radii, so a tile keeps at
    most one point: its earliest undecided one is the only candidate. A candidate is kept
    when no undecided earlier point lies within two radii, and then removes all points
    that close. Every point meets at most one candidate per neighbouring tile, so the work
    per round is linear, however crowded a tile is. ``order`` must be unique.
    """
    reach = 2.0 * radius
    size = reach / 2**0.5
    span = F.array(*[F.lit(d) for d in (-2, -1, 0, 1, 2)])
    undecided = cut_lineage(
        points.select(
            F.col(key).alias("_id"),
            F.col(order).alias("_o"),
            F.col(x).alias("_x"),
            F.col(y).alias("_y"),
            F.floor(F.col(x) / size).alias("_tx"),
            F.floor(F.col(y) / size).alias("_ty"),
        )
    )

    def spread(df: DataFrame) -> DataFrame:
        """Copies of the few chosen points, one per neighbouring tile."""
        return (
            df.select(*[F.col(c).alias(f"c{c}") for c in df.columns])
            .withColumn("_tx", F.explode(F.transform(span, lambda d: F.col("c_tx") + d)))
            .withColumn("_ty", F.explode(F.transform(span, lambda d: F.col("c_ty") + d)))
        )

    near: Column = F.hypot(F.col("_x") - F.col("c_x"), F.col("_y") - F.col("c_y")) <= reach
    kept = None
    while not undecided.isEmpty():
        first = F.min_by(F.struct("_id", "_o", "_x", "_y"), "_o")
        candidates = undecided.groupBy("_tx", "_ty").agg(first.alias("_c")).select("_c.*", "_tx", "_ty")
        around = spread(candidates)
        blocked = (
            undecided.join(around, ["_tx", "_ty"])
            .where(near & (F.col("_o") < F.col("c_o")))
            .select(F.col("c_id").alias("_id"))
            .distinct()
        )
        chosen = cut_lineage(candidates.join(blocked, "_id", "left_anti"))
        removed = spread(chosen)
        condition = (
            (undecided["_tx"] == removed["_tx"]) & (undecided["_ty"] == removed["_ty"]) & near
        )
        undecided = cut_lineage(undecided.join(removed, condition, "left_anti"))
        picked = chosen.select(F.col("_id").alias(key))
        kept = picked if kept is None else kept.unionByName(picked)
    if kept is None:
        return points
    return points.join(kept, key, "left_semi")
