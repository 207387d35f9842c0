"""Queries on pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from citygrain.grid import Grid
from citygrain.operators import exposure, pixels
from citygrain.plans import flood
from citygrain.queries.registry import query

GRID = Grid(0.0, 0.0, 0.1, 0.1)
YEARS = list(range(1995, 2003))

PROBABILITY = (
    "(SELECT city, layer, x, y, CASE WHEN value >= 45 THEN 100.0::double / CASE layer WHEN 'A' THEN 10 WHEN 'N' THEN 100 "
    "ELSE 1000 END ELSE 0 END AS value FROM hazard)"
)


def return_period():
    return F.when(F.col("layer") == "A", 10.0).when(F.col("layer") == "N", 100.0).otherwise(1000.0)


@query(
    "flood_exposure_by_settlement_year",
    f"""WITH p AS (SELECT city, x, y, max(value) AS value FROM {PROBABILITY} GROUP BY ALL),
    h AS (SELECT p.city, s.value AS year, count(*) AS n FROM p JOIN settled s USING (city, x, y)
          WHERE p.value > 0 GROUP BY ALL),
    spine AS (SELECT city, unnest(range(1995, 2003)) AS year FROM (SELECT DISTINCT city FROM p))
    SELECT spine.city, cast(spine.year as int) AS year,
      round(sum(coalesce(n, 0)) OVER (PARTITION BY spine.city ORDER BY spine.year) * 0.01::double, 6) AS cumulative_area
    FROM spine LEFT JOIN h ON h.city = spine.city AND h.year = spine.year""",
)
def flood_exposure(t):
    """Built-up area exposed to a flood hazard, cumulative by settlement year."""
    out = flood.settlement_exposure(t.hazard(), t.settled(), GRID, 45.0, return_period(), YEARS)
    return out.select("city", "year", F.round("cumulative_area", 6).alias("cumulative_area"))


@query(
    "mosaic_first",
    """SELECT city, x, y, arg_min(value, layer) AS value FROM hazard GROUP BY ALL""",
)
def mosaic_first(t):
    h = t.hazard()
    tiles = [h.where(F.col("layer") == k).drop("layer") for k in ("A", "N", "R")]
    return pixels.mosaic(tiles, "first")


@query("mosaic_max", "SELECT city, x, y, max(value) AS value FROM hazard GROUP BY ALL")
def mosaic_max(t):
    h = t.hazard()
    tiles = [h.where(F.col("layer") == k).drop("layer") for k in ("A", "N", "R")]
    return pixels.mosaic(tiles, "max")


@query(
    "raster_histogram",
    """WITH e AS (SELECT unnest([0, 10, 20, 30, 40, 50]) AS lo),
    bins AS (SELECT lo, lo + 10 AS hi FROM e WHERE lo < 50),
    c AS (SELECT DISTINCT city, layer FROM hazard)
    SELECT c.city, c.layer, cast(lo / 10 as int) AS bin_no, lo || '-' || hi AS bin, count(h.value) AS count
    FROM c CROSS JOIN bins LEFT JOIN hazard h ON h.city = c.city AND h.layer = c.layer AND h.value >= lo
      AND (h.value < hi OR (hi = 50 AND h.value = 50)) GROUP BY ALL""",
)
def raster_histogram(t):
    return pixels.histogram(t.hazard(), [0, 10, 20, 30, 40, 50], ("city", "layer"))


@query(
    "raster_class_area",
    """SELECT city, v AS value, round(count(c.value) * 0.01::double, 6) AS area
    FROM (SELECT DISTINCT city FROM classes) CROSS JOIN (SELECT unnest([10, 30, 70, 95]) AS v)
    LEFT JOIN classes c USING (city) WHERE c.value = v OR c.value IS NULL GROUP BY ALL
    UNION ALL SELECT DISTINCT city, 95, 0.0::double FROM classes""",
)
def raster_class_area(t):
    out = pixels.class_area(t.classes(), [10, 30, 70, 95], GRID)
    return out.select("city", "value", F.round("area", 6).alias("area"))


@query("hazard_probability", f"SELECT city, layer, x, y, value FROM {PROBABILITY}")
def hazard_probability(t):
    return pixels.hazard_probability(t.hazard(), 45.0, return_period()).select("city", "layer", "x", "y", "value")


@query(
    "hazard_composite",
    f"SELECT city, x, y, max(value) AS value FROM {PROBABILITY} GROUP BY ALL",
)
def hazard_composite(t):
    return pixels.composite_max(pixels.hazard_probability(t.hazard(), 45.0, return_period()))


@query(
    "hazards_combined",
    """WITH cs AS (SELECT c, cast(floor((c + 0.5) / 1.5::double) as int) AS x FROM (SELECT unnest(range(-300, 900)) AS c)),
    rs AS (SELECT r, cast(floor((r + 0.5) / 0.75::double) as int) AS y FROM (SELECT unnest(range(-300, 900)) AS r)),
    moved AS (SELECT city, c::int AS x, r::int AS y, value FROM hazard JOIN cs USING (x) JOIN rs USING (y) WHERE layer = 'R')
    SELECT city, x, y, max(value) AS value FROM (SELECT city, x, y, value FROM hazard WHERE layer = 'A' UNION ALL SELECT * FROM moved) GROUP BY ALL""",
)
def hazards_combined(t):
    """Two hazards on different grids, on the grid of the first."""
    grids = {"A": Grid(0.0, 0.0, 1.0, 1.0), "R": Grid(0.0, 0.0, 1.5, 0.75)}
    return pixels.combine_hazards(t.hazard(), ["A", "R"], "layer", grids=grids)


@query(
    "dense_population_exposed",
    """WITH lim AS (SELECT city, quantile_cont(value, 0.6) AS lim FROM people GROUP BY city),
    dense AS (SELECT p.city, p.x, p.y FROM people p JOIN lim USING (city) WHERE p.value >= lim)
    SELECT h.city, h.layer, count(*) AS dense_cells,
      round(100.0 * count(*) FILTER (WHERE h.value > 30) / count(*), 6)::double AS exposed_pct
    FROM hazard h JOIN dense USING (city, x, y) GROUP BY ALL""",
)
def dense_population_exposed(t):
    deep = t.hazard().withColumn("value", F.when(F.col("value") > 30, F.col("value")).otherwise(0.0))
    out = exposure.exposed_dense_share(deep, t.people(), 0.6, ("city", "layer"))
    return out.withColumn("exposed_pct", F.round("exposed_pct", 6))


@query(
    "land_cover_burnability",
    """SELECT city, x, y, CASE value WHEN 10 THEN 0.66 WHEN 20 THEN 0.66 WHEN 30 THEN 0.66 WHEN 40 THEN 0.66
      WHEN 50 THEN 0.83 WHEN 60 THEN 1.0 WHEN 70 THEN 0.66 ELSE 0 END::double AS value FROM classes""",
)
def land_cover_burnability(t):
    return pixels.reclass(t.classes()).select("city", "x", "y", "value")


@query(
    "fire_weather_percentile",
    """WITH live AS (SELECT date FROM stack GROUP BY date HAVING sum(value) <> 0)
    SELECT x, y, round(quantile_cont(value, 0.986), 6) AS value FROM stack JOIN live USING (date) GROUP BY ALL""",
)
def fire_weather_percentile(t):
    return pixels.cell_percentile(t.stack(), 0.986).withColumn("value", F.round("value", 6))


@query(
    "fire_weather_weekly",
    """SELECT cast(week(date) as int) AS week, round(quantile_cont(value, 0.95), 6) AS value
    FROM stack GROUP BY ALL""",
)
def fire_weather_weekly(t):
    return pixels.weekly_percentile(t.stack(), 0.95).withColumn("value", F.round("value", 6))


@query(
    "first_built_year",
    """SELECT city, x, y, coalesce(min(CASE WHEN value >= 25 THEN year END), 0)::int AS value FROM
    (SELECT city, x, y, year(l_shipdate) AS year, sum(l_quantity) AS value FROM cells GROUP BY ALL) GROUP BY ALL""",
)
def first_built_year(t):
    yearly = t.cells().groupBy("city", "x", "y", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("value"))
    return pixels.first_year_over(yearly, 25.0)


@query(
    "solar_band_stats",
    """SELECT city, cast(month(l_shipdate) as int) AS band, min(l_quantity) AS min, max(l_quantity) AS max,
    round(avg(l_quantity), 6) AS mean FROM cells GROUP BY ALL""",
)
def solar_band_stats(t):
    px = t.cells().select("city", F.month("l_shipdate").alias("band"), F.col("l_quantity").alias("value"))
    return pixels.band_stats(px).withColumn("mean", F.round("mean", 6))


@query(
    "age_sex_totals",
    """SELECT city, sex, age, population, CASE WHEN age = 0 THEN '0-1' WHEN age = 1 THEN '1-4' WHEN age >= 80 THEN '80+'
      ELSE age || '-' || (age + 4) END AS age_group FROM
    (SELECT city, CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 'm' END AS sex,
      cast(CASE WHEN x % 18 < 2 THEN x % 18 ELSE (x % 18 - 1) * 5 END as int) AS age, sum(l_quantity) AS population
     FROM cells GROUP BY ALL)""",
)
def age_sex_totals(t):
    band = F.col("x") % 18
    px = t.cells().select(
        "city",
        F.when(F.col("l_linestatus") == "F", "f").otherwise("m").alias("sex"),
        F.when(band < 2, band).otherwise((band - 1) * 5).cast("int").alias("age"),
        F.col("l_quantity").alias("value"),
    )
    return pixels.age_sex_totals(px)


@query(
    "land_cover_frequency",
    """WITH k AS (SELECT unnest([10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 100]) AS code,
      unnest(['Tree cover', 'Shrubland', 'Grassland', 'Cropland', 'Built-up', 'Bare / sparse vegetation', 'Snow and ice',
      'Permanent water bodies', 'Herbaceous wetland', 'Mangroves', 'Moss and lichen']) AS class),
    c AS (SELECT city, value, count(*) AS n FROM classes GROUP BY ALL)
    SELECT a.city, k.code, k.class, coalesce(c.n, 0) AS pixels FROM (SELECT DISTINCT city FROM classes) a
    CROSS JOIN k LEFT JOIN c ON c.city = a.city AND c.value = k.code""",
)
def land_cover_frequency(t):
    return pixels.class_frequency(t.classes())


@query(
    "clear_pixels",
    """SELECT event_id, value FROM events WHERE event_id & 31 = 0 AND event_type <> 'error'
    UNION ALL SELECT -1 - event_id, value FROM events WHERE event_id & 3072 = 0""",
)
def clear_pixels(t):
    events = t.read("events").withColumn("saturation", (F.col("event_type") == "error").cast("int"))
    first = pixels.mask_bits(events, "event_id", range(5), ["saturation"])
    second = pixels.mask_bits(events, "event_id", (10, 11)).withColumn("event_id", -1 - F.col("event_id"))
    return first.select("event_id", "value").unionByName(second.select("event_id", "value"))


@query(
    "season_scenes",
    """SELECT o_orderkey AS scene, cast(o_orderdate as date) AS date FROM orders
    WHERE o_totalprice / 5000 < 10 AND month(o_orderdate) IN (6, 7, 8) AND year(o_orderdate) BETWEEN 1996 AND 1999""",
)
def season_scenes(t):
    scenes = t.read("orders").select(
        F.col("o_orderkey").alias("scene"),
        F.col("o_orderdate").cast("date").alias("date"),
        (F.col("o_totalprice") / 5000).alias("cloud"),
    )
    return pixels.filter_scenes(scenes, (6, 7, 8), (1996, 1999)).drop("cloud")


@query(
    "summer_surface_temperature",
    """SELECT x, y, round(avg(value * 0.00341802 + 149) - 273.15, 6) AS value FROM stack GROUP BY ALL""",
)
def summer_surface_temperature(t):
    out = pixels.fill_for_export(pixels.season_mean(t.stack()))
    return out.withColumn("value", F.round("value", 6))


@query(
    "vegetation_index",
    """WITH m AS (SELECT city, x, y, median(l_quantity / 10000) FILTER (WHERE l_returnflag = 'A') AS a,
      median(l_quantity / 10000) FILTER (WHERE l_returnflag = 'N') AS b FROM cells GROUP BY ALL)
    SELECT city, x, y, round((a - b) / nullif(a + b, 0), 6) AS value FROM m""",
)
def vegetation_index(t):
    px = t.cells().select("city", "x", "y", F.col("l_returnflag").alias("band"), F.col("l_quantity").alias("value"))
    out = pixels.season_index(px, "A", "N", by=("city",))
    return out.withColumn("value", F.round("value", 6))


def season_sql(sign: int) -> str:
    return f"""WITH m AS (SELECT c_nationkey AS city, month(o_orderdate) AS m, avg(o_totalprice) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    s AS (SELECT a.city, a.m, (a.v + b.v + c.v) / 3 AS mean FROM m a JOIN m b ON b.city = a.city AND b.m = a.m % 12 + 1
      JOIN m c ON c.city = a.city AND c.m = (a.m + 1) % 12 + 1),
    best AS (SELECT city, arg_max(m, ({sign} * mean, m)) AS m, arg_max(mean, ({sign} * mean, m)) AS mean FROM s GROUP BY city)
    SELECT city, round(mean, 2) AS season_mean, cast(i as int) AS ord, cast((m - 1 + i) % 12 + 1 as int) AS month
    FROM best CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)"""


def season_table(t, kind):
    orders, customer = t.read("orders"), t.read("customer")
    series = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_nationkey").alias("city"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("value"),
    )
    return pixels.season_months(series, kind).withColumn("season_mean", F.round("season_mean", 2))


@query("hot_season", season_sql(1))
def hot_season(t):
    return season_table(t, "hot")


@query("cold_season", season_sql(-1))
def cold_season(t):
    return season_table(t, "cold")


FOREST_SQL = """(SELECT city, x, y, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS cover,
  max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS loss, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS gain,
  max(CASE WHEN l_returnflag = 'N' THEN year(l_shipdate) - 1994 ELSE 0 END) AS loss_year FROM cells GROUP BY ALL)"""


def forest_px(t):
    flag = F.col("l_returnflag")
    return (
        t.cells()
        .groupBy("city", "x", "y")
        .agg(
            F.sum(F.when(flag == "A", F.col("l_quantity"))).alias("cover"),
            F.max(F.when(flag == "N", 1).otherwise(0)).alias("loss"),
            F.max(F.when(flag == "R", 1).otherwise(0)).alias("gain"),
            F.max(F.when(flag == "N", F.year("l_shipdate") - 1994).otherwise(0)).alias("loss_year"),
        )
    )


@query(
    "forest_cover",
    f"""SELECT city, x, y, CASE WHEN (CASE WHEN cover >= 20 THEN 1 ELSE 0 END) - loss + gain >= 1 THEN 1 ELSE 0 END
    AS forest FROM {FOREST_SQL}""",
)
def forest_cover(t):
    return pixels.forest_cover(forest_px(t)).select("city", "x", "y", "forest")


@query("forest_loss_year", f"SELECT city, x, y, cast(loss_year as int) AS loss_year FROM {FOREST_SQL} WHERE loss_year > 0")
def forest_loss_year(t):
    return pixels.loss_year(forest_px(t)).select("city", "x", "y", "loss_year")


@query(
    "night_light_trend",
    """WITH s AS (SELECT city, cast(date_trunc('year', l_shipdate) as date) AS date, y, sum(l_quantity) AS value
      FROM cells GROUP BY ALL)
    SELECT city, y, round(regr_slope(value, date - DATE '1970-01-01'), 8) AS slope, sum(value) AS total FROM s
    WHERE date > (SELECT max(date) FROM s) - INTERVAL 5 YEAR GROUP BY ALL""",
)
def night_light_trend(t):
    px = (
        t.cells()
        .groupBy("city", F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1)).alias("date"), F.lit(0).alias("x"), "y")
        .agg(F.sum("l_quantity").alias("value"))
    )
    out = pixels.cell_trend(px, 5, ("city",))
    return out.select("city", "y", F.round("slope", 8).alias("slope"), "total")


@query(
    "settlement_year_fixes",
    """WITH s AS (SELECT city, x, y, cast(value - 1995 as int) AS v FROM settled)
    SELECT city, x, y, nullif(v, 0) AS zero_null, 2016 + v / 2 AS tracker, CASE WHEN v - 3 >= 0 THEN v - 3 END AS positive,
      cast(v + 1 + 2000 as int) AS calendar FROM s""",
)
def settlement_year_fixes(t):
    s = t.settled().withColumn("value", F.col("value") - 1995)
    keys = ["city", "x", "y"]

    def named(df, name):
        return df.select(*keys, F.col("value").alias(name))

    out = named(pixels.zero_to_null(s), "zero_null")
    out = out.join(named(pixels.tracker_years(s), "tracker"), keys)
    out = out.join(named(pixels.negative_to_null(s.withColumn("value", F.col("value") - 3)), "positive"), keys)
    years = pixels.calendar_years(s.withColumn("value", F.col("value") + 1))
    return out.join(named(years, "calendar"), keys)


@query(
    "vegetation_presence",
    "SELECT city, x, y, CASE WHEN value >= 100 THEN 1 END AS present, CASE WHEN value >= 100 THEN value END AS value FROM people",
)
def vegetation_presence(t):
    return pixels.presence(t.people(), 100.0).select("city", "x", "y", "present", "value")


COARSEN = """WITH f AS (SELECT city, cast(greatest(round_even(sqrt(count(*) / 300.0), 0), 1) as int) AS factor
      FROM {px} GROUP BY city),
    c AS (SELECT p.city, factor, cast(floor(x / factor) as int) AS x, cast(floor(y / factor) as int) AS y, value
      FROM {px} p JOIN f USING (city)) """


@query(
    "coarsened_classes",
    COARSEN.format(px="classes")
    + """SELECT city, factor, x, y, arg_min(value, (-n, value)) AS value FROM
    (SELECT city, factor, x, y, value, count(*) AS n FROM c GROUP BY ALL) GROUP BY ALL""",
)
def coarsened_classes(t):
    return pixels.coarsen(t.classes(), 300.0, "mode")


@query(
    "coarsened_heights",
    COARSEN.format(px="heights") + "SELECT city, factor, x, y, max(value) AS value FROM c GROUP BY ALL",
)
def coarsened_heights(t):
    return pixels.coarsen(t.heights(), 300.0, "max")


@query(
    "dissolved_classes",
    """WITH r AS (SELECT city, value, x, y, x - row_number() OVER (PARTITION BY city, value, y ORDER BY x) AS run FROM classes)
    SELECT city, value, y, min(x) AS x_start, max(x) AS x_end FROM r GROUP BY city, value, y, run""",
)
def dissolved_classes(t):
    return pixels.dissolve_values(t.classes())


@query(
    "hazard_settlement_overlay",
    """SELECT h.city, h.value AS value_a, s.value AS value_b, count(*) AS cells
    FROM hazard h JOIN settled s USING (city, x, y) GROUP BY ALL""",
)
def hazard_settlement_overlay(t):
    return pixels.overlay(t.hazard(), t.settled())


@query(
    "population_epochs",
    """SELECT city, epoch, x, y, arg_min(value, tile) AS value FROM
    (SELECT city, cast(floor(year(l_shipdate) / 5.0) * 5 as int) AS epoch, l_returnflag AS tile, x, y, sum(l_quantity) AS value
     FROM cells GROUP BY ALL) WHERE epoch IN (1995, 2000) GROUP BY ALL""",
)
def population_epochs(t):
    px = (
        t.cells()
        .groupBy(
            "city",
            (F.floor(F.year("l_shipdate") / 5.0) * 5).cast("int").alias("epoch"),
            F.col("l_returnflag").alias("tile"),
            "x",
            "y",
        )
        .agg(F.sum("l_quantity").alias("value"))
    )
    return pixels.epoch_series(px, [1995, 2000])


# flood scenarios ----------------------------------------------------------------

SCENARIO_SQL = """(SELECT city, CASE l_returnflag WHEN 'A' THEN 'coastal' WHEN 'N' THEN 'fluvial' ELSE 'pluvial' END AS flood_type,
  CASE WHEN l_linenumber % 2 = 0 THEN 2050 ELSE 2020 END AS year, l_linenumber % 3 + 1 AS ssp, sum(l_quantity) AS exposed
  FROM cells GROUP BY ALL)"""


def scenario_exposure(t):
    flag = F.col("l_returnflag")
    return (
        t.cells()
        .groupBy(
            "city",
            F.when(flag == "A", "coastal").when(flag == "N", "fluvial").otherwise("pluvial").alias("flood_type"),
            F.when(F.col("l_linenumber") % 2 == 0, 2050).otherwise(2020).alias("year"),
            (F.col("l_linenumber") % 3 + 1).alias("ssp"),
        )
        .agg(F.sum("l_quantity").alias("exposed"))
    )


@query(
    "flood_scenarios",
    f"""SELECT city, concat_ws('_', flood_type, year, CASE WHEN year > 2020 THEN 'ssp' || ssp END) AS type,
      max(exposed) AS exposed FROM {SCENARIO_SQL} GROUP BY ALL""",
)
def flood_scenarios(t):
    return exposure.scenario_tables(scenario_exposure(t), "exposed")


# every type of flood in the base year and in three scenarios of a later one
SCENARIOS = [(kind, year, ssp) for kind in ("coastal", "fluvial", "pluvial") for year, ssp in ((2020, None), (2050, 1), (2050, 2), (2050, 3))]


def scenario_name(kind: str, year: int, ssp: int | None) -> str:
    return f"{kind}_{year}" + (f"_ssp{ssp}" if ssp else "")


@query(
    "flood_scenario_pivot",
    "SELECT city, "
    + ", ".join(
        f"max(exposed) FILTER (WHERE flood_type = '{kind}' AND year = {year}{f' AND ssp = {ssp}' if ssp else ''}) AS {scenario_name(kind, year, ssp)}"
        for kind, year, ssp in SCENARIOS
    )
    + f" FROM {SCENARIO_SQL} GROUP BY ALL",
)
def flood_scenario_pivot(t):
    long = exposure.scenario_tables(scenario_exposure(t), "exposed").withColumn("settled", F.lit(1))
    return exposure.scenario_pivot(long, "exposed", [scenario_name(*s) for s in SCENARIOS]).drop("settled")


# points and lines on rasters ------------------------------------------------------

POINT_GRID = Grid(-180.0, -85.0, 0.72, 3.4, 500, 50)


@query(
    "places_in_hazard",
    """WITH h AS (SELECT x, y, max(value) AS value FROM hazard GROUP BY ALL),
    p AS (SELECT *, cast(floor((lon + 180.0) / 0.72) as int) AS x, cast(floor((lat + 85.0) / 3.4) as int) AS y FROM points)
    SELECT category, count(*) AS total, count(*) FILTER (WHERE h.value > 40) AS in_hazard,
      round(100.0 * count(*) FILTER (WHERE h.value > 40) / count(*), 6)::double AS pct
    FROM p LEFT JOIN h USING (x, y) GROUP BY category""",
)
def places_in_hazard(t):
    h = pixels.composite_max(t.hazard(), ()).withColumn("value", F.when(F.col("value") > 40, F.col("value")))
    out = exposure.points_in_hazard(t.points(), h, POINT_GRID)
    return out.withColumn("pct", F.round("pct", 6))


@query(
    "raster_at_points",
    """WITH h AS (SELECT x, y, max(value) AS value FROM hazard GROUP BY ALL)
    SELECT id, value AS depth FROM points p LEFT JOIN h
    ON h.x = cast(floor((lon + 180.0) / 0.72) as int) AND h.y = cast(floor((lat + 85.0) / 3.4) as int)
    AND h.x BETWEEN 0 AND 499 AND h.y BETWEEN 0 AND 49""",
)
def raster_at_points(t):
    h = pixels.composite_max(t.hazard(), ())
    return exposure.sample_raster(t.points(), h, POINT_GRID, "depth").select("id", "depth")


def street_segments(t):
    n = t.nodes()
    a = n.select(F.col("node").alias("u"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = n.select(F.col("node").alias("v"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return t.streets().join(a, "u").join(b, "v")


@query(
    "street_hazard_exposure",
    """WITH h AS (SELECT x, y FROM hazard GROUP BY ALL HAVING max(value) > 40),
    s AS (SELECT road, length, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM streets
      JOIN nodes a ON a.node = u JOIN nodes b ON b.node = v),
    m AS (SELECT *, (x1 - 0.001) / 0.005 AS gx1, (x2 - 0.001) / 0.005 AS gx2, (y1 - 0.001) / 0.005 AS gy1,
      (y2 - 0.001) / 0.005 AS gy2 FROM s),
    kx AS (SELECT road, length, x, cast(floor(gy1) as int) AS y,
      (least(greatest(gx1, gx2), x + 1) - greatest(least(gx1, gx2), x)) / abs(gx2 - gx1) AS share FROM
      (SELECT *, unnest(range(cast(floor(least(gx1, gx2)) as int), cast(floor(greatest(gx1, gx2)) as int) + 1)) AS x
       FROM m WHERE y1 = y2)),
    ky AS (SELECT road, length, cast(floor(gx1) as int) AS x, y,
      (least(greatest(gy1, gy2), y + 1) - greatest(least(gy1, gy2), y)) / abs(gy2 - gy1) AS share FROM
      (SELECT *, unnest(range(cast(floor(least(gy1, gy2)) as int), cast(floor(greatest(gy1, gy2)) as int) + 1)) AS y
       FROM m WHERE x1 = x2)),
    p AS (SELECT * FROM kx UNION ALL SELECT * FROM ky)
    SELECT road, round(sum(length * share), 3) AS total_length,
      round(coalesce(sum(length * share) FILTER (WHERE h.x IS NOT NULL), 0), 3) AS length_in_hazard,
      round(100 * coalesce(sum(length * share) FILTER (WHERE h.x IS NOT NULL), 0) / sum(length * share), 6) AS pct
    FROM p LEFT JOIN h ON h.x = p.x AND h.y = p.y GROUP BY road""",
)
def street_hazard_exposure(t):
    h = pixels.composite_max(t.hazard(), ()).withColumn("value", F.when(F.col("value") > 40, F.col("value")))
    grid = Grid(0.001, 0.001, 0.005, 0.005)
    segments = street_segments(t).withColumn("road", F.element_at("highway", 1))
    out = exposure.line_exposure(segments, h, grid, ("road",))
    return out.select(
        "road",
        F.round("total_length", 3).alias("total_length"),
        F.round("length_in_hazard", 3).alias("length_in_hazard"),
        F.round("pct", 6).alias("pct"),
    )
