"""Exposure of settlement, people, places and streets to a hazard raster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators.spatial import align
from citygrain.scale import dealt, exact_quantiles, join_on

CELL = ("x", "y")


def exposure_by_year(
    hazard: DataFrame, settlement: DataFrame, grid: Grid, years: Sequence[int], by: Sequence[str] = ("city",),
    scale: float = 1.0, settlement_grid: Grid | None = None,
) -> DataFrame:
    """Cumulative area settled by each year in cells with a hazard, in squared grid units times ``scale``.

    ``grid`` is the hazard's; a settlement table on another grid (``settlement_grid``) is brought to it first.

    Every year of the range is present for every group of the hazard table, also when nothing was
    settled in it. A grid in metres and a scale of 1e-6 give square kilometres.
    """
    exposed = hazard.where("value > 0").select(*by, *CELL)
    if settlement_grid is not None:
        settlement = align(settlement, settlement_grid, grid, [b for b in by if b in settlement.columns])
    place = [b for b in by if b in settlement.columns]
    hits = exposed.join(settlement.withColumnRenamed("value", "year"), [*place, *CELL])
    counts = hits.groupBy(*by).agg(*[F.count_if(F.col("year") == y).alias(f"_y{y}") for y in years])
    if by:
        counts = join_on(hazard.select(*by).distinct(), counts, by, "left")
    rows, running = [], F.lit(0)
    for y in years:
        running = running + F.coalesce(f"_y{y}", F.lit(0))
        rows.append(F.struct(F.lit(y).alias("year"), (running * F.lit(grid.cell_area * scale)).alias("cumulative_area")))
    return counts.select(*by, F.inline(F.array(*rows)))


def exposed_dense_share(
    hazard: DataFrame, population: DataFrame, q: float = 0.6, by: Sequence[str] = ("city",),
    grid: Grid | None = None, population_grid: Grid | None = None,
) -> DataFrame:
    """Percent of densely populated cells that lie in a hazard.

    Where the grids differ, the dense cells are found on the population's grid and brought to the hazard's. Dense cells reach the given percentile of the city's population cells. The
    denominator counts dense cells that the hazard grid covers.
    """
    place = [b for b in by if b in population.columns]
    limits = exact_quantiles(population, "value", [q], place).withColumnRenamed("q0", "_limit")
    people = population.withColumnRenamed("value", "_people")
    dense = join_on(people, limits, place) if place else people.withColumn("_limit", limits.scalar())
    dense = dense.where(F.col("_people") >= F.col("_limit")).select(*place, *CELL)
    if grid is not None and population_grid is not None:
        dense = align(dense.withColumn("value", F.lit(1)), population_grid, grid, place).drop("value")
    return (
        hazard.join(dense, [*place, *CELL])
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("dense_cells"),
            F.try_divide(F.count_if(F.col("value") > 0) * F.lit(100.0), F.count(F.lit(1))).alias("exposed_pct"),
        )
    )


def sample_raster(points: DataFrame, px: DataFrame, grid: Grid, name: str, lon: str = "lon", lat: str = "lat",
                  by: Sequence[str] = ()) -> DataFrame:
    """Attach the raster value under each point; null outside the raster.

    ``by`` names columns of both tables that tell cells apart, such as the city or the layer.
    """
    col, row = grid.to_cell(F.col(lon), F.col(lat))
    # points outside the grid meet no cell; they are spread over keys that no raster has
    outside = col.isNull() | row.isNull()
    placed = points.withColumn("_x", F.when(outside, F.lit(-(2**31))).otherwise(col)).withColumn(
        "_y", F.when(outside, F.pmod(F.xxhash64(lon, lat), F.lit(4096)).cast("int")).otherwise(row)
    )
    values = px.select(*by, F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("value").alias(name))
    return placed.join(values, [*by, "_x", "_y"], "left").drop("_x", "_y")


def points_in_hazard(points: DataFrame, hazard: DataFrame, grid: Grid, by: Sequence[str] = ("category",),
                     lon: str = "lon", lat: str = "lat", cells_by: Sequence[str] = ()) -> DataFrame:
    """Number and percent of points whose cell has a hazard; outside the grid counts as not.

    ``cells_by`` names columns of both tables that tell cells apart. Several values of one cell count as
    their largest, so no point is counted twice.
    """
    cells = dealt(hazard, [*cells_by, *CELL]).groupBy(*cells_by, *CELL).agg(F.max("value").alias("value"))
    sampled = sample_raster(points, cells, grid, "_hazard", lon, lat, cells_by)
    inside = F.count_if(F.coalesce(F.col("_hazard") > 0, F.lit(False)))
    total = F.count(F.lit(1))
    return sampled.groupBy(*by).agg(
        total.alias("total"), inside.alias("in_hazard"), F.try_divide(inside * F.lit(100.0), total).alias("pct")
    )


def cut_at_cells(lines: DataFrame, grid: Grid, x1: Column, y1: Column, x2: Column, y2: Column) -> DataFrame:
    """Cut straight segments at the grid lines: one row per segment and cell crossed.

    Adds the cell (``x``, ``y``) and ``share``, the part of the segment inside it. The
    rows grow with the cells a segment crosses, not with the raster.
    """

    def crossings(a: Column, b: Column, origin: float, step: float) -> Column:
        lo = F.least((a - origin) / step, (b - origin) / step)
        hi = F.greatest((a - origin) / step, (b - origin) / step)
        first, last = F.floor(lo) + 1, F.ceil(hi) - 1
        k = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(k, lambda i: (F.lit(origin) + i * F.lit(step) - a) / (b - a))

    cuts = F.array_sort(
        F.array_distinct(
            F.concat(
                F.array(F.lit(0.0), F.lit(1.0)),
                F.when(x1 != x2, crossings(x1, x2, grid.x0, grid.dx)).otherwise(F.array().cast("array<double>")),
                F.when(y1 != y2, crossings(y1, y2, grid.y0, grid.dy)).otherwise(F.array().cast("array<double>")),
            )
        )
    )
    pieces = F.zip_with(
        F.slice("_cuts", 1, F.size("_cuts") - 1),
        F.slice("_cuts", 2, F.size("_cuts") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    keep = [c for c in lines.columns]
    out = lines.withColumn("_cuts", cuts).select(*keep, F.explode(pieces).alias("_piece"))
    middle = (F.col("_piece.a") + F.col("_piece.b")) / 2
    col, row = grid.to_cell(x1 + (x2 - x1) * middle, y1 + (y2 - y1) * middle)
    return (
        out.withColumn("x", col)
        .withColumn("y", row)
        .withColumn("share", F.col("_piece.b") - F.col("_piece.a"))
        .drop("_piece")
    )


def line_exposure(segments: DataFrame, hazard: DataFrame, grid: Grid, by: Sequence[str] = (),
                  length: str = "length", cells_by: Sequence[str] = ()) -> DataFrame:
    """Total length, length inside hazard cells and percent, of straight segments.

    ``cells_by`` names columns of both tables that tell cells apart, such as the city; a cell counts once.
    ``segments`` has x1, y1, x2, y2 and a length; a table without rows gives zeros.
    """
    cut = cut_at_cells(segments, grid, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    cells = hazard.where("value > 0").select(*cells_by, *CELL).distinct().withColumn("_hit", F.lit(True))
    joined = cut.join(cells, [*cells_by, *CELL], "left")
    part = F.col(length) * F.col("share")
    total = F.coalesce(F.sum(part), F.lit(0.0))
    inside = F.coalesce(F.sum(F.when(F.col("_hit"), part)), F.lit(0.0))
    return joined.groupBy(*by).agg(
        total.alias("total_length"),
        inside.alias("length_in_hazard"),
        F.coalesce(F.try_divide(inside * 100, total), F.lit(0.0)).alias("pct"),
    )


def scenario_label(flood_type: Column, year: Column, ssp: Column, base_year: int = 2020) -> Column:
    """``type_year``, with ``_sspN`` for years after the base year."""
    return F.concat_ws(
        "_",
        flood_type,
        year.cast("string"),
        F.when(year > base_year, F.concat(F.lit("ssp"), ssp.cast("string"))),
    )


def scenario_tables(exposure: DataFrame, value: str, base_year: int = 2020, by: Sequence[str] = ("city",)) -> DataFrame:
    """Long scenario table: one label and value per type, year and scenario.

    The base year has no scenario, so its rows collapse to one.
    """
    label = scenario_label(F.col("flood_type"), F.col("year"), F.col("ssp"), base_year)
    return (
        exposure.withColumn("type", label)
        .groupBy(*by, "type")
        .agg(F.max(value).alias(value))
    )


def scenario_pivot(exposure: DataFrame, value: str, scenarios: Sequence[str], year: str = "settled",
                   by: Sequence[str] = ("city",)) -> DataFrame:
    """One row per settlement year, one column per scenario label; a label without a column fails."""
    label = F.col("type")
    known = label.isNull() | label.isin(*scenarios)
    missing = F.raise_error(F.concat(F.lit("no column for scenario "), label)).cast("boolean")
    exposure = exposure.where(F.when(known, F.lit(True)).otherwise(missing))
    return exposure.groupBy(*by, year).agg(
        *[F.max(F.when(F.col("type") == s, F.col(value))).alias(s) for s in scenarios]
    )
