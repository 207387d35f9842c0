"""Slope, contour levels and elevation bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.functions.crs import from_mercator


def slope(px: DataFrame, grid: Grid, by: Sequence[str] = ("city",), true_scale: bool = False) -> DataFrame:
    """Slope in degrees by central differences; a missing neighbour counts as the cell itself.

    Neighbours come from two sorts, along rows and along columns, so a task holds one raster
    row at a time. ``true_scale`` corrects Mercator metres by the latitude of the row.
    """

    def side(along: str, across: str, step: int) -> Column:
        order = Window.partitionBy(*by, across).orderBy(along)
        value = F.lead("value", 1).over(order) if step > 0 else F.lag("value", 1).over(order)
        at = F.lead(along, 1).over(order) if step > 0 else F.lag(along, 1).over(order)
        return F.coalesce(F.when(at == F.col(along) + step, value), F.col("value"))

    work = px.where(F.col("value").isNotNull())
    work = work.withColumns({"_e": side("x", "y", 1), "_w": side("x", "y", -1)})
    work = work.withColumns({"_s": side("y", "x", 1), "_n": side("y", "x", -1)})
    stretch: Column = F.lit(1.0)
    if true_scale:
        _, cy = grid.center(F.col("x"), F.col("y"))
        _, lat = from_mercator(F.lit(0.0), cy)
        stretch = F.cos(F.radians(lat))
    dx = (F.col("_e") - F.col("_w")) / (stretch * (2 * abs(grid.dx)))
    dy = (F.col("_s") - F.col("_n")) / (stretch * (2 * abs(grid.dy)))
    return work.withColumn("value", F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))).drop("_e", "_w", "_s", "_n")


def contour_levels(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Contour interval, all levels, and the levels drawn (from the first above the lowest cell)."""
    ranges = px.groupBy(*by).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    spread = F.col("high") - F.col("low")
    interval = (
        F.when(spread > 250, F.ceil(spread / 500) * 10).when(spread > 100, 5).when(spread > 50, 2).otherwise(1).cast("int")
    )
    out = ranges.withColumn("interval", interval)
    first = (F.floor(F.col("low") / F.col("interval")) * F.col("interval")).cast("int")
    last = (F.ceil(F.col("high") / F.col("interval")) * F.col("interval")).cast("int")
    out = out.withColumn("levels", F.sequence(first, last, F.col("interval")))
    drawn = F.when(
        F.col("levels")[0] < F.col("low"), F.slice("levels", F.lit(2), F.size("levels"))
    ).otherwise(F.col("levels"))
    return out.withColumn("drawn", drawn)


def histogram_edges(levels: Column, n: int = 5) -> Column:
    """n + 1 edges picked evenly from a list of levels."""
    size = F.size(levels)
    picks = F.sequence(F.lit(0), F.lit(n))
    return F.transform(picks, lambda i: F.get(levels, F.floor(((size - (n + 1)) / n + 1) * i).cast("int")))


def elevation_bands(px: DataFrame, levels: DataFrame, grid: Grid, by: Sequence[str] = ("city",)) -> DataFrame:
    """Area between neighbouring contour levels; ``levels`` as from ``contour_levels``."""
    facts = levels.select(*by, F.col("levels")[0].alias("_first"), "interval")
    joined = px.where(F.col("value").isNotNull()).join(facts, list(by))
    band = F.floor((F.col("value") - F.col("_first")) / F.col("interval")).cast("int")
    counted = joined.groupBy(*by, band.alias("band"), "_first", "interval").agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(
        *by, "band", (F.col("_first") + F.col("band") * F.col("interval")).cast("int").alias("level"),
        (F.col("_n") * grid.cell_area).alias("area"),
    )

