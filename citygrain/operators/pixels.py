"""Cell-wise and zonal operators on pixel tables.

A pixel table has one row per cell: ``x``, ``y``, ``value`` and any of ``city``,
``layer``, ``band``, ``date``. Missing cells are absent or null, never a sentinel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators.spatial import align
from citygrain.scale import dealt, exact_quantiles, lookup, with_totals

# Burnability weight of each land-cover code.
BURN_WEIGHTS = {
    0.0: [190, 200, 201, 202, 210, 220],
    0.16: [151],
    0.33: [12, 140, 152, 153],
    0.5: [11, 82, 110, 150, 180],
    0.66: [10, 20, 30, 40, 70, 71, 81, 90, 121, 130],
    0.83: [50, 61, 80, 100, 120, 122, 160, 170],
    1.0: [60, 62],
}

# Names of the land-cover classes.
LAND_COVER = {
    10: "Tree cover",
    20: "Shrubland",
    30: "Grassland",
    40: "Cropland",
    50: "Built-up",
    60: "Bare / sparse vegetation",
    70: "Snow and ice",
    80: "Permanent water bodies",
    90: "Herbaceous wetland",
    95: "Mangroves",
    100: "Moss and lichen",
}

CELL = ("x", "y")


def drop_nodata(px: DataFrame, nodata: float | None, value: str = "value") -> DataFrame:
    """Turn the file's nodata value and NaN into null, once, at ingest."""
    v = F.col(value)
    missing = F.isnan(v.cast("double"))
    if nodata is not None:
        missing = missing | (v == nodata)
    return px.withColumn(value, F.when(~missing, v))


def mosaic(tiles: Sequence[DataFrame], how: str = "first", by: Sequence[str] = ("city",)) -> DataFrame:
    """One raster from overlapping tiles: the first listed tile wins, or the cell maximum."""
    numbered = [t.withColumn("_priority", F.lit(i)) for i, t in enumerate(tiles)]
    stacked = numbered[0]
    for t in numbered[1:]:
        stacked = stacked.unionByName(t)
    stacked = dealt(stacked.where(F.col("value").isNotNull()), [*by, *CELL])
    pick = {"first": F.min_by("value", "_priority"), "max": F.max("value")}[how]
    return stacked.groupBy(*by, *CELL).agg(pick.alias("value"))


def bin_edges_column(value: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open bin that holds a value; the last bin is closed."""
    index = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        low, high = F.lit(float(edges[i])), F.lit(float(edges[i + 1]))
        last = i == len(edges) - 2
        inside = (value >= low) & ((value <= high) if last else (value < high))
        index = F.when(inside, F.lit(i)).otherwise(index)
    return index


def histogram(px: DataFrame, edges: Sequence[float], by: Sequence[str] = ("city",)) -> DataFrame:
    """Cell counts per bin, zero for empty bins; nulls and values outside are not counted."""
    labels = [f"{edges[i]}-{edges[i + 1]}" for i in range(len(edges) - 1)]
    index = bin_edges_column(F.col("value"), edges)
    counts = px.groupBy(*by).agg(
        *[F.count_if(index == i).alias(f"_bin{i}") for i in range(len(labels))]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("bin_no"), F.lit(label).alias("bin"), F.col(f"_bin{i}").alias("count"))
            for i, label in enumerate(labels)
        ]
    )
    return counts.select(*by, F.inline(rows))


def class_area(px: DataFrame, values: Sequence[float], grid: Grid, by: Sequence[str] = ("city",)) -> DataFrame:
    """Area of each wanted value: count times cell area, zero when absent."""
    counts = px.groupBy(*by).agg(*[F.count_if(F.col("value") == v).alias(f"_c{i}") for i, v in enumerate(values)])
    rows = F.array(
        *[
            F.struct(F.lit(v).alias("value"), (F.col(f"_c{i}") * F.lit(grid.cell_area)).alias("area"))
            for i, v in enumerate(values)
        ]
    )
    return counts.select(*by, F.inline(rows))


def hazard_probability(px: DataFrame, threshold: float, return_period: Column | float) -> DataFrame:
    """Annual probability in percent where the depth reaches the threshold, else 0."""
    period = return_period if isinstance(return_period, Column) else F.lit(float(return_period))
    reached = F.coalesce(F.col("value") >= threshold, F.lit(False))
    return px.withColumn("value", F.when(reached, 100.0 / period).otherwise(F.lit(0.0)))


def composite_max(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Cell maximum over the layers of a stack."""
    return dealt(px, [*by, *CELL]).groupBy(*by, *CELL).agg(F.max("value").alias("value"))


def combine_hazards(px: DataFrame, types: Sequence[str], type_col: str, by: Sequence[str] = ("city",),
                    grids: dict[str, Grid] | None = None) -> DataFrame:
    """Cell maximum over hazard types, ignoring nulls.

    ``grids`` gives the grid of each type where they differ; all are brought to that of the first type.
    """
    if grids is None:
        return composite_max(px.where(F.col(type_col).isin(*types)), by)
    parts = [align(px.where(F.col(type_col) == t), grids[t], grids[types[0]], by) for t in types]
    return composite_max(reduce(DataFrame.unionByName, parts), by)


def reclass(px: DataFrame, table: dict | None = None, default: float = 0.0) -> DataFrame:
    """Recode values by a lookup; codes not listed, and results outside 0..1, become the default."""
    table = table or {float(code): w for w, codes in BURN_WEIGHTS.items() for code in codes}
    weight = lookup(table, F.col("value").cast("double"))
    return px.withColumn("value", F.when(weight.between(0, 1), weight).otherwise(F.lit(default)))


def cell_percentile(px: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Percentile over dates in each cell; dates on which every cell is zero are left out.

    A cell holds one value per date, so the exact aggregate's buffer is bounded by the dates.
    """
    live = px.groupBy(*by, "date").agg(F.sum("value").alias("_s")).where("_s <> 0").drop("_s")
    kept = px.join(live, [*by, "date"], "left_semi")
    return kept.groupBy(*by, *CELL).agg(F.percentile("value", q).alias("value"))


def weekly_percentile(px: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Percentile of all cells and years for each ISO week."""
    weeks = px.withColumn("week", F.weekofyear("date"))
    return exact_quantiles(weeks, "value", [q], [*by, "week"]).withColumnRenamed("q0", "value")


def first_year_over(px: DataFrame, threshold: float, year: str = "year", by: Sequence[str] = ("city",)) -> DataFrame:
    """First year in which a cell reaches the threshold, 0 if it never does."""
    first = F.min(F.when(F.col("value") >= threshold, F.col(year)))
    return px.groupBy(*by, *CELL).agg(F.coalesce(first, F.lit(0)).alias("value"))


def band_stats(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Minimum, maximum and mean of each band over the (already clipped) zone."""
    return px.groupBy(*by, "band").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean")
    )


def age_label(age: Column) -> Column:
    """Label of an age code: 0-1, 1-4, then five-year groups up to 80+."""
    low = age.cast("int")
    return (
        F.when(low == 0, F.lit("0-1"))
        .when(low == 1, F.lit("1-4"))
        .when(low >= 80, F.lit("80+"))
        .otherwise(F.concat_ws("-", low.cast("string"), (low + 4).cast("string")))
    )


def age_sex_totals(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Zonal sum by age group and sex of clipped age/sex rasters."""
    return (
        px.groupBy(*by, "sex", "age")
        .agg(F.sum("value").alias("population"))
        .withColumn("age_group", age_label(F.col("age")))
    )


def class_frequency(px: DataFrame, classes: dict | None = None, by: Sequence[str] = ("city",)) -> DataFrame:
    """Cell count of every known class, zero when absent."""
    classes = classes or LAND_COVER
    counts = px.groupBy(*by).agg(*[F.count_if(F.col("value") == c).alias(f"_c{c}") for c in classes])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("code"), F.lit(n).alias("class"), F.col(f"_c{c}").alias("pixels"))
            for c, n in classes.items()
        ]
    )
    return counts.select(*by, F.inline(rows))


def mask_bits(px: DataFrame, qa: str, bits: Sequence[int], zero: Sequence[str] = ()) -> DataFrame:
    """Keep pixels whose quality bits are all unset and whose listed bands are zero."""
    mask = sum(1 << b for b in bits)
    keep = F.col(qa).bitwiseAND(F.lit(mask).cast("long")) == 0
    for column in zero:
        keep = keep & (F.col(column) == 0)
    return px.where(keep)


def filter_scenes(
    scenes: DataFrame,
    months: Sequence[int],
    years: tuple[int, int],
    max_cloud: float = 10.0,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Scenes under the cloud limit in a season, a year range and, optionally, a box."""
    out = scenes.where(
        (F.col("cloud") < max_cloud)
        & F.month("date").isin(*months)
        & F.year("date").between(years[0], years[1])
    )
    if box is not None:
        xmin, ymin, xmax, ymax = box
        out = out.where(
            (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)
        )
    return out


def season_mean(
    px: DataFrame, scale: float = 0.00341802, offset: float = 149.0, shift: float = -273.15, by: Sequence[str] = ()
) -> DataFrame:
    """Mean of a scaled band per cell, in degrees Celsius by default."""
    return px.groupBy(*by, *CELL).agg((F.avg(F.col("value") * scale + offset) + shift).alias("value"))


def fill_for_export(px: DataFrame, nodata: float = -9999.0) -> DataFrame:
    """Null to the nodata value that written rasters carry."""
    return px.withColumn("value", F.coalesce("value", F.lit(nodata)))


def season_index(px: DataFrame, band_a: str, band_b: str, scale: float = 10000.0, by: Sequence[str] = ()) -> DataFrame:
    """Normalized difference of two bands, each the median over its scenes."""

    def band(name):
        return F.median(F.when(F.col("band") == name, F.col("value") / scale))

    medians = px.groupBy(*by, *CELL).agg(band(band_a).alias("_a"), band(band_b).alias("_b"))
    index = F.try_divide(F.col("_a") - F.col("_b"), F.col("_a") + F.col("_b"))
    return medians.select(*by, *CELL, index.alias("value"))


def season_months(series: DataFrame, kind: str = "hot", by: Sequence[str] = ("city",)) -> DataFrame:
    """The three consecutive months with the highest (or lowest) mean value, wrapping at year end.

    ``series`` has ``date`` and ``value``. Ties go to the later start month.
    """
    monthly = series.groupBy(*by, F.month("date").alias("_m")).agg(F.avg("value").alias("_v"))
    year = monthly.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_m", "_v"))).alias("_year"))
    starts = F.transform(
        F.sequence(F.lit(1), F.lit(12)),
        lambda m: F.struct(
            (
                (
                    F.try_element_at("_year", m)
                    + F.try_element_at("_year", F.pmod(m, F.lit(12)) + 1)
                    + F.try_element_at("_year", F.pmod(m + 1, F.lit(12)) + 1)
                )
                / 3
                * F.lit(1.0 if kind == "hot" else -1.0)
            ).alias("mean"),
            m.alias("start"),
        ),
    )
    best = F.array_max(F.filter(starts, lambda s: s["mean"].isNotNull()))
    start = F.col("_best.start")
    return (
        year.withColumn("_best", best)
        .where("_best IS NOT NULL")
        .select(
            *by,
            (F.col("_best.mean") * F.lit(1.0 if kind == "hot" else -1.0)).alias("season_mean"),
            F.posexplode(
                F.array(start, F.pmod(start, F.lit(12)) + 1, F.pmod(start + 1, F.lit(12)) + 1)
            ).alias("ord", "month"),
        )
    )


def forest_cover(px: DataFrame, minimum: float = 20.0) -> DataFrame:
    """1 where tree cover, less loss, plus gain, is present; columns cover, loss, gain."""
    base = (F.coalesce(F.col("cover") >= minimum, F.lit(False))).cast("int")
    left = base - F.coalesce("loss", F.lit(0)) + F.coalesce("gain", F.lit(0))
    return px.withColumn("forest", (left >= 1).cast("int"))


def loss_year(px: DataFrame, column: str = "loss_year") -> DataFrame:
    """Cells with a recorded year of loss."""
    return px.where(F.col(column) > 0)


def cell_trend(px: DataFrame, years: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Slope per day and sum of each cell over the last years up to the newest date."""
    newest = px.agg(F.max("date").alias("d")).scalar()
    recent = px.where(F.col("date") > F.add_months(newest, -12 * years))
    return recent.groupBy(*by, *CELL).agg(
        F.regr_slope("value", F.unix_date("date").cast("double")).alias("slope"),
        F.sum("value").alias("total"),
    )


def zero_to_null(px: DataFrame) -> DataFrame:
    return px.withColumn("value", F.nullif("value", F.lit(0)))


def negative_to_null(px: DataFrame) -> DataFrame:
    return px.withColumn("value", F.when(F.col("value") >= 0, F.col("value")))


def tracker_years(px: DataFrame, base: int = 2016) -> DataFrame:
    """Half-year steps since the base year to calendar years."""
    return px.withColumn("value", F.lit(base) + F.col("value") / 2)


def calendar_years(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Years stored as 1..99 to 2001..2099; full years stay; a mixture is an error."""
    v = F.col("value")
    checked = with_totals(
        px, by, _short=F.bool_and(v.between(1, 99)), _full=F.bool_and(v > 2000)
    )
    fixed = F.when(F.col("_short"), v + 2000).when(F.col("_full") | v.isNull(), v)
    # bool_and skips nulls, so a raster without values has neither flag
    guard = F.when(
        F.coalesce("_short", F.lit(True)) | F.coalesce("_full", F.lit(True)), fixed
    ).otherwise(F.raise_error(F.lit("years both in 1-99 and above 2000")).cast("int"))
    return checked.withColumn("value", guard).drop("_short", "_full")


def presence(px: DataFrame, threshold: float = 0.18) -> DataFrame:
    """1 where the index reaches the threshold, else null; and the value kept only there."""
    v = F.col("value")
    return px.withColumn("present", F.when(v >= threshold, 1)).withColumn("value", F.when(v >= threshold, v))


def coarsen(
    px: DataFrame,
    max_cells: float,
    how: str = "mode",
    cells: DataFrame | None = None,
    by: Sequence[str] = ("city",),
) -> DataFrame:
    """Aggregate blocks of cells when a raster has more cells than the limit.

    ``cells`` gives the cell count of each area as ``cell_count`` (area divided by cell
    area); by default the rows are counted. The factor is round(sqrt(count / limit)).
    """
    if cells is None:
        sized = with_totals(px, by, cell_count=F.count(F.lit(1)))
    else:
        sized = px.join(cells, list(by)) if by else px.withColumn("cell_count", cells.scalar())
    factor = F.greatest(F.bround(F.sqrt(F.col("cell_count") / max_cells)).cast("int"), F.lit(1))
    pick = {"mode": F.mode("value", True), "max": F.max("value")}[how]
    return (
        sized.withColumn("factor", factor)
        .groupBy(*by, "factor", F.floor(F.col("x") / F.col("factor")).cast("int").alias("x"),
                 F.floor(F.col("y") / F.col("factor")).cast("int").alias("y"))
        .agg(pick.alias("value"))
    )


def dissolve_values(px: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Equal-value cells as features, each stored as horizontal runs of cells.

    A run is a row (value, y, x_start, x_end); the union of a value's runs is its shape.
    Only one raster row is ordered at a time, so a value that covers a third of the
    raster is never gathered whole.
    """
    row = Window.partitionBy(*by, "value", "y").orderBy("x")
    known = dealt(px.where(F.col("value").isNotNull()), [*by, "value", "y"])
    marked = known.withColumn("_run", F.col("x") - F.row_number().over(row))
    return (
        marked.groupBy(*by, "value", "y", "_run")
        .agg(F.min("x").alias("x_start"), F.max("x").alias("x_end"))
        .drop("_run")
    )


def overlay(px_a: DataFrame, px_b: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Cross-tabulated cell counts of two rasters on one grid."""
    b = px_b.select(*by, *CELL, F.col("value").alias("value_b"))
    return (
        px_a.withColumnRenamed("value", "value_a")
        .join(b, [*by, *CELL])
        .groupBy(*by, "value_a", "value_b")
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def epoch_series(tiles: DataFrame, epochs: Sequence[int], by: Sequence[str] = ("city",)) -> DataFrame:
    """A stack of settlement or population epochs, mosaicked by tile priority, in one pass."""
    return (
        tiles.where(F.col("epoch").isin(*epochs) & F.col("value").isNotNull())
        .groupBy(*by, "epoch", *CELL)
        .agg(F.min_by("value", "tile").alias("value"))
    )
