"""The placement of a raster: origin, cell size, extent, coordinate system, nodata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Cells are addressed by column ``x`` and row ``y``; row 0 starts at ``y0``.

    ``dy`` is negative for a north-up raster whose first row is the northernmost.
    """

    x0: float
    y0: float
    dx: float
    dy: float
    width: int | None = None
    height: int | None = None
    crs: str = "EPSG:4326"
    nodata: float | None = None

    @property
    def cell_area(self) -> float:
        return abs(self.dx * self.dy)

    def to_cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Column and row that hold a coordinate; null outside a bounded grid."""
        col = F.floor((x - F.lit(self.x0)) / F.lit(self.dx)).cast("int")
        row = F.floor((y - F.lit(self.y0)) / F.lit(self.dy)).cast("int")
        if self.width is None or self.height is None:
            return col, row
        inside = col.between(0, self.width - 1) & row.between(0, self.height - 1)
        return F.when(inside, col), F.when(inside, row)

    def center(self, col: Column, row: Column) -> tuple[Column, Column]:
        """Coordinate of a cell's centre."""
        return F.lit(self.x0) + (col + 0.5) * F.lit(self.dx), F.lit(self.y0) + (row + 0.5) * F.lit(self.dy)
