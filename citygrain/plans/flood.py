"""Flood assessment: depth rasters to exposure tables, without intermediate files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from citygrain.grid import Grid
from citygrain.operators import exposure, pixels, spatial


def composite_hazard(
    depth: DataFrame, threshold: float, return_period: Column | float, by: Sequence[str] = ("city",)
) -> DataFrame:
    """Highest annual probability of each cell over the return periods."""
    return pixels.composite_max(pixels.hazard_probability(depth, threshold, return_period), by)


def settlement_exposure(
    depth: DataFrame,
    settled: DataFrame,
    grid: Grid,
    threshold: float,
    return_period: Column | float,
    years: Sequence[int],
    by: Sequence[str] = ("city",),
    scale: float = 1.0,
    settled_grid: Grid | None = None,
    areas: DataFrame | None = None,
) -> DataFrame:
    """Cumulative built-up area exposed, by settlement year; zero where a hazard meets no settlement.

    With ``areas`` (rings, and the ``by`` columns it has) depths are cut to every touched cell of the city's area first; a city
    without an area has no rows then.
    """
    if areas is not None:
        depth = spatial.clip(depth, areas, grid, True, [b for b in by if b in areas.columns])
    hazard = composite_hazard(depth, threshold, return_period, by)
    return exposure.exposure_by_year(hazard, settled, grid, years, by, scale, settled_grid)
