"""Queries on demographics, events, indicators, display and terrain."""

from __future__ import annotations

from pyspark.sql import functions as F

from citygrain.functions.text import to_latin
from citygrain.grid import Grid
from citygrain.operators import demographics as demo
from citygrain.operators import display, events, indicators as ind, pixels, statistics as stat, terrain
from citygrain.queries.registry import query

GRID = Grid(0.0, 0.0, 0.1, 0.1)

# demographics -----------------------------------------------------------------------------

AGES = """(SELECT c_nationkey AS city, CASE WHEN o_orderkey % 2 = 0 THEN 'f' ELSE 'm' END AS sex,
  CASE WHEN o_custkey % 18 = 0 THEN '0-1' WHEN o_custkey % 18 = 1 THEN '1-4' WHEN o_custkey % 18 = 17 THEN '80+'
    ELSE ((o_custkey % 18 - 1) * 5) || '-' || ((o_custkey % 18 - 1) * 5 + 4) END AS age_group, sum(floor(o_totalprice)) AS population
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
BANDS = f"""(SELECT city, CASE WHEN age_group IN ('0-1', '1-4') THEN '0-4' ELSE age_group END AS age_group, sex, sum(population)::double AS n,
  CASE WHEN age_group IN ('0-1', '1-4') THEN 1 WHEN age_group = '80+' THEN 17 ELSE cast(split_part(age_group, '-', 1) as int) / 5 + 1 END AS ord
  FROM {AGES} GROUP BY ALL)"""


def ages(t):
    band = F.col("o_custkey") % 18
    low = ((band - 1) * 5).cast("int")
    label = (
        F.when(band == 0, "0-1").when(band == 1, "1-4").when(band == 17, "80+")
        .otherwise(F.concat_ws("-", low.cast("string"), (low + 4).cast("string")))
    )
    return (
        t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("city"), F.when(F.col("o_orderkey") % 2 == 0, "f").otherwise("m").alias("sex"), label.alias("age_group"))
        .agg(F.sum(F.floor("o_totalprice")).alias("population"))
    )


@query(
    "age_shares_by_sex",
    f"""WITH s AS (SELECT city, age_group, sex, ord, n * 100 / sum(n) OVER (PARTITION BY city, sex) AS p FROM {BANDS})
    SELECT city, age_group, sex, round(p, 6) AS percent, round(sum(p) OVER (PARTITION BY city, sex ORDER BY ord), 6) AS cumulative FROM s""",
)
def age_shares_by_sex(t):
    out = demo.age_shares(ages(t))
    return out.select(
        "city", "age_group", "sex", F.round("percent", 6).alias("percent"), F.round("sexed_percent_cum", 6).alias("cumulative")
    )


@query(
    "age_shares_of_all",
    f"""SELECT city, age_group, sex, round(n * 100 / sum(n) OVER (PARTITION BY city), 6) AS percent,
      round(n * 100 / sum(n) OVER (PARTITION BY city, sex), 6) AS sexed_percent FROM {BANDS}""",
)
def age_shares_of_all(t):
    out = demo.age_shares(ages(t), by_sex=False)
    return out.select(
        "city", "age_group", "sex", F.round("percent", 6).alias("percent"), F.round("sexed_percent", 6).alias("sexed_percent")
    )


@query(
    "demographic_summary",
    f"""SELECT city, round(100 * coalesce(sum(n) FILTER (WHERE ord = 1), 0) / sum(n), 6) AS under5, round(100 * coalesce(sum(n) FILTER (WHERE ord IN (4, 5)), 0) / sum(n), 6) AS youth,
      round(100 * coalesce(sum(n) FILTER (WHERE ord BETWEEN 4 AND 13), 0) / sum(n), 6) AS working_age, round(100 * coalesce(sum(n) FILTER (WHERE ord >= 13), 0) / sum(n), 6) AS elderly,
      round(100 * coalesce(sum(n) FILTER (WHERE sex = 'f' AND ord BETWEEN 4 AND 10), 0) / sum(n) FILTER (WHERE sex = 'f'), 6) AS reproductive_age,
      round(100 * sum(n) FILTER (WHERE sex = 'm') / sum(n) FILTER (WHERE sex = 'f'), 6) AS sex_ratio FROM {BANDS} GROUP BY city""",
)
def demographic_summary(t):
    out = demo.demographic_summary(ages(t))
    return out.select("city", *[F.round(c, 6).alias(c) for c in out.columns if c != "city"])


def settled_area(t):
    return (
        t.settled().groupBy("city", F.col("value").alias("year"))
        .agg((F.count(F.lit(1)) * 0.01).alias("area"))
    )


SETTLED_AREA = "(SELECT city, value AS year, count(*) * 0.01::double AS area FROM settled GROUP BY ALL)"
CUMULATIVE = f"(SELECT city, year, sum(area) OVER (PARTITION BY city ORDER BY year) AS value FROM {SETTLED_AREA})"


@query("built_up_growth", f"""SELECT city, year, round(value, 6) AS value, round(value - lag(value) OVER w, 6) AS growth,
      round(value / lag(value) OVER w - 1, 6) AS growth_pct FROM {CUMULATIVE} WINDOW w AS (PARTITION BY city ORDER BY year)""")
def built_up_growth(t):
    area = demo.cumulative_area(settled_area(t)).withColumnRenamed("cumulative", "value")
    out = demo.growth(area)
    return out.select(
        "city", "year", F.round("value", 6).alias("value"), F.round("growth", 6).alias("growth"), F.round("growth_pct", 6).alias("growth_pct")
    )


@query(
    "built_up_sentence",
    f"""WITH e AS (SELECT city, min(year) AS y0, max(year) AS y1, arg_min(value, year) AS a0, arg_max(value, year) AS a1 FROM {CUMULATIVE} GROUP BY city)
    SELECT city, printf('The city''s built-up area grew from %.2f sq. km in %d to %.2f in %d for %.2f%% growth', a0, y0, a1, y1, (a1 - a0) * 100 / a0) AS sentence FROM e""",
)
def built_up_sentence(t):
    area = demo.cumulative_area(settled_area(t)).withColumnRenamed("cumulative", "value")
    return demo.growth_sentence(area)


# events -------------------------------------------------------------------------------------

QUAKES = """(SELECT event_id, city, clon, clat, cast(event_id * 104729 % 1700 as double) / 100 - 8.5 AS latitude,
  CASE WHEN event_id % 11 <> 0 THEN cast(event_id * 7919 % 2000 as double) / 100 - 10 END AS longitude,
  CASE WHEN event_id % 7 <> 0 THEN round(4 + event_id % 45 / 10.0, 1)::double END AS mag, CASE WHEN event_id % 3 <> 0 THEN event_id % 5 END AS damage_order,
  CASE WHEN event_id % 5 <> 0 THEN event_id % 40 END AS deaths, CASE WHEN event_id % 13 = 0 THEN event_id END AS tsunami,
  cast(1900 + event_id % 120 as int) AS year, cast(event_id % 12 + 1 as int) AS month, CASE WHEN event_id % 4 <> 0 THEN cast(event_id % 28 + 1 as int) END AS day
  FROM events, (SELECT n_nationkey AS city, (n_nationkey % 5 * 4 - 8)::double AS clon, (floor(n_nationkey / 5) * 3 - 6)::double AS clat FROM nation))"""


def quakes(t):
    k = F.col("event_id")
    return t.read("events").select(
        "event_id",
        ((k * 104729 % 1700).cast("double") / 100 - 8.5).alias("latitude"),
        F.when(k % 11 != 0, (k * 7919 % 2000).cast("double") / 100 - 10).alias("longitude"),
        F.when(k % 7 != 0, F.round(4 + k % 45 / 10, 1)).alias("eqMagnitude"),
        F.when(k % 3 != 0, k % 5).cast("int").alias("damageAmountOrder"),
        F.lit(None).cast("double").alias("damageMillionsDollars"),
        F.when(k % 5 != 0, k % 40).cast("int").alias("deaths"),
        F.lit(None).cast("int").alias("deathsAmountOrder"),
        F.lit(None).cast("int").alias("intensity"),
        F.when(k % 13 == 0, k).alias("tsunamiEventId"),
        F.concat(F.lit("REGION:  Place "), k.cast("string")).alias("locationName"),
        (F.lit(1900) + k % 120).cast("int").alias("year"),
        (k % 12 + 1).cast("int").alias("month"),
        F.when(k % 4 != 0, (k % 28 + 1).cast("int")).alias("day"),
    )


def quake_cities(t):
    k = F.col("n_nationkey")
    return t.read("nation").select(
        k.alias("city"), (k % 5 * 4 - 8).cast("double").alias("lon"), (F.floor(k / 5) * 3 - 6).cast("double").alias("lat")
    )


PLANAR = """sqrt((radians(longitude) - radians(clon)) ** 2 + (ln(tan(pi() / 4 + radians(latitude) / 2)) - ln(tan(pi() / 4 + radians(clat) / 2))) ** 2) * 6378.137"""
SIGNIFICANT = f"""(SELECT * FROM (SELECT *, {PLANAR} AS distance FROM {QUAKES} WHERE longitude IS NOT NULL)
  WHERE distance < 500 AND (damage_order >= 2 OR deaths >= 10 OR mag >= 7.5 OR tsunami IS NOT NULL))"""


@query(
    "significant_earthquakes",
    f"""SELECT event_id, city, round(distance, 4) AS distance, round(mag * (2000 - distance), 3) AS score, coalesce(deaths, 0)::int AS deaths
    FROM {SIGNIFICANT}""",
)
def significant_earthquakes(t):
    out = events.significant_quakes(quakes(t), quake_cities(t))
    return out.select("event_id", "city", F.round("distance", 4).alias("distance"), F.round("score", 3).alias("score"), "deaths")


@query(
    "earthquake_texts",
    f"""SELECT event_id, city, upper(strftime(make_date(year, month, coalesce(day, 1)), '%B %Y')) AS line1,
      CASE coalesce(damage_order, 0) WHEN 0 THEN 'None' WHEN 1 THEN 'Limited' WHEN 2 THEN 'Moderate' WHEN 3 THEN 'Severe' ELSE 'Extreme' END || ' damage' AS line3,
      CASE WHEN deaths IS NULL THEN '' WHEN deaths = 1 THEN '1 fatality' ELSE deaths || ' fatalities' END AS line4,
      'Place ' || event_id AS location FROM {SIGNIFICANT}""",
)
def earthquake_texts(t):
    out = events.event_text(events.significant_quakes(quakes(t), quake_cities(t)))
    return out.select("event_id", "city", "line1", "line3", "line4", "location")


@query(
    "top_earthquakes",
    f"""WITH k AS (SELECT *, make_date(year, month, coalesce(day, 1)) AS began, row_number() OVER (PARTITION BY city ORDER BY mag * (2000 - distance) DESC, event_id) AS r
      FROM {SIGNIFICANT} WHERE mag IS NOT NULL)
    SELECT city, event_id, began, cast(row_number() OVER (PARTITION BY city ORDER BY began, event_id) as int) AS ord FROM k WHERE r <= 10""",
)
def top_earthquakes(t):
    texts = events.event_text(events.significant_quakes(quakes(t), quake_cities(t)))
    return events.top_events(texts, "score").select("city", "event_id", "began", "ord")


GREAT = "asin(sqrt(sin(radians(clat - latitude) / 2) ** 2 + cos(radians(latitude)) * cos(radians(clat)) * sin(radians(clon - longitude) / 2) ** 2)) * 2 * 6371"


@query(
    "earthquake_timeline",
    f"""WITH q AS (SELECT *, {GREAT} AS distance, make_date(year, month, coalesce(day, 1)) AS began FROM {QUAKES} WHERE longitude IS NOT NULL)
    SELECT event_id, city, round(distance, 5) AS distance, cast(CASE WHEN row_number() OVER (PARTITION BY city ORDER BY began, event_id) % 2 = 1 THEN 1 ELSE -1 END as int) AS above_line
    FROM q WHERE distance < 500 AND (damage_order >= 2 OR deaths >= 10 OR mag >= 7.5 OR tsunami IS NOT NULL)""",
)
def earthquake_timeline(t):
    out = events.quake_timeline(quakes(t), quake_cities(t))
    return out.select("event_id", "city", F.round("distance", 5).alias("distance"), "above_line")


FLOODS = """(SELECT o_orderkey AS flood, cast(o_custkey % 25 as int) AS city, cast(o_orderdate as date) AS began,
  cast(o_orderdate as date) + cast(o_orderkey % 20 as int) AS ended, o_orderkey % 97 AS dead, cast(floor(o_totalprice) as bigint) AS displaced,
  o_orderpriority AS maincause, CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 1.5 ELSE 2.0 END::double AS severity FROM orders)"""


def floods(t):
    status = F.col("o_orderstatus")
    day = F.col("o_orderdate").cast("date")
    return t.read("orders").select(
        F.col("o_orderkey").alias("flood"),
        (F.col("o_custkey") % 25).cast("int").alias("city"),
        day.alias("began"),
        F.date_add(day, (F.col("o_orderkey") % 20).cast("int")).alias("ended"),
        (F.col("o_orderkey") % 97).alias("dead"),
        F.floor("o_totalprice").cast("long").alias("displaced"),
        F.col("o_orderpriority").alias("maincause"),
        F.when(status == "F", 1.0).when(status == "O", 1.5).otherwise(2.0).alias("severity"),
    )


@query(
    "flood_summary",
    f"""WITH s AS (SELECT city, count(*) AS events, cast(sum(dead) as bigint) AS dead, cast(sum(displaced) as bigint) AS displaced FROM {FLOODS} GROUP BY city)
    SELECT *, 'The ' || events || ' flood event' || CASE WHEN events = 1 THEN '' ELSE 's' END || ' displaced ' || displaced || ' and killed ' || dead || '.' AS sentence FROM s""",
)
def flood_summary(t):
    return events.flood_summary(floods(t))


@query(
    "flood_labels",
    f"""SELECT flood, cast(year(began) as int) AS year, strftime(began, '%B') AS month, cast(month(began) as int) AS month_ord,
      strftime(began, '%Y-%m-%d') || ', ' || CASE severity WHEN 1 THEN 'large event' WHEN 1.5 THEN 'very large event' ELSE 'extreme event' END || ' ' || maincause
      || ', ' || format('{{:,}}', dead) || ' fatalities, ' || format('{{:,}}', displaced) || ' displaced' AS text FROM {FLOODS}""",
)
def flood_labels(t):
    return events.flood_labels(floods(t)).select("flood", "year", "month", "month_ord", "text")


@query(
    "flood_magnitudes",
    f"""WITH m AS (SELECT *, (dead - min(dead) OVER w) / (max(dead) OVER w - min(dead) OVER w) * ((displaced - min(displaced) OVER w) / (max(displaced) OVER w - min(displaced) OVER w))
      * severity AS magnitude FROM {FLOODS} WINDOW w AS (PARTITION BY city)),
    r AS (SELECT *, rank() OVER (PARTITION BY city ORDER BY magnitude DESC) + (count(*) OVER (PARTITION BY city, magnitude) - 1) / 2 AS r FROM m)
    SELECT flood, city, round(magnitude, 6) AS magnitude, r <= 10 AS labelled, cast(ended - began as int) AS duration, cast(dayofyear(began) as int) AS begin_day,
      round(year(began) + dayofyear(began) / 1000, 3)::double AS begin_year FROM r""",
)
def flood_magnitudes(t):
    out = events.flood_magnitude(floods(t))
    return out.select(
        "flood", "city", F.round("magnitude", 6).alias("magnitude"), "labelled", "duration", "begin_day",
        F.round(F.col("begin_year").cast("double"), 3).alias("begin_year"),
    )


@query(
    "flood_medians",
    f"""SELECT median(dead)::double AS dead, median(displaced)::double AS displaced, median(ended - began)::double AS duration FROM {FLOODS}""",
)
def flood_medians(t):
    return events.event_medians(floods(t))


@query("flood_causes", f"SELECT maincause, count(*) AS events FROM {FLOODS} GROUP BY maincause")
def flood_causes(t):
    return events.event_causes(floods(t))


# statistic tables -----------------------------------------------------------------------------

EDGES = [0, 100, 200, 300, 400, 500]
HEIGHT_BINS = """(SELECT city, lo || '-' || (lo + 100) AS bin, lo, count(*) AS count FROM
  (SELECT city, cast(least(floor(value / 100), 4) * 100 as int) AS lo FROM heights WHERE value BETWEEN 0 AND 500) GROUP BY ALL)"""


def height_bins(t):
    return pixels.histogram(t.heights(), EDGES)


@query(
    "elevation_shares",
    f"""SELECT city, bin, count, round(count * 100 / sum(count) OVER (PARTITION BY city), 6)::double AS percent, lo::double AS low, (lo + 100)::double AS high FROM {HEIGHT_BINS}""",
)
def elevation_shares(t):
    out = stat.bin_shares(height_bins(t))
    return out.select("city", "bin", "count", F.round("percent", 6).alias("percent"), "low", "high")


@query(
    "elevation_sentence",
    f"""WITH s AS (SELECT *, count * 100 / sum(count) OVER (PARTITION BY city) AS p FROM {HEIGHT_BINS}),
    b AS (SELECT city, arg_max(bin, (p, -lo)) AS bin, max(p)::double AS p FROM s GROUP BY city)
    SELECT city, printf('The most common elevation range in the city is %s meters, with a %.2f%% frequency.', bin, p) AS sentence FROM b""",
)
def elevation_sentence(t):
    return stat.common_bin_sentence(stat.bin_shares(height_bins(t)), "elevation", "meters")


COVER = """(SELECT city, CASE value WHEN 10 THEN 'Tree cover' WHEN 20 THEN 'Shrubland' WHEN 30 THEN 'Grassland' WHEN 40 THEN 'Cropland' WHEN 50 THEN 'Built-up'
  WHEN 60 THEN 'Bare / sparse vegetation' ELSE 'Snow and ice' END AS class, count(*) AS pixels FROM classes GROUP BY ALL)"""


@query(
    "top_land_covers",
    f"""WITH s AS (SELECT *, pixels * 100 / sum(pixels) OVER (PARTITION BY city) AS p FROM {COVER}),
    r AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY p DESC, class) AS r FROM s)
    SELECT city, cast(r as int) AS rank, class, round(p, 6)::double AS percent, printf('The %shighest landcover value is %s with %.2f%% of the total land area',
      CASE r WHEN 1 THEN '' WHEN 2 THEN 'second ' ELSE 'third ' END, class, p::double) AS sentence FROM r WHERE r <= 3""",
)
def top_land_covers(t):
    return stat.top_classes(pixels.class_frequency(t.classes())).withColumn("percent", F.round("percent", 6))


@query(
    "land_cover_decimals",
    f"""WITH s AS (SELECT city, class, round(pixels / sum(pixels) OVER (PARTITION BY city), 4)::double AS decimal FROM {COVER})
    SELECT city, cast(row_number() OVER (PARTITION BY city ORDER BY decimal DESC, class) as int) AS ord, class, decimal FROM s""",
)
def land_cover_decimals(t):
    return stat.class_decimals(pixels.class_frequency(t.classes()))


@query(
    "land_cover_ring",
    f"""WITH s AS (SELECT city, class, pixels / sum(pixels) OVER (PARTITION BY city) AS d FROM {COVER}),
    m AS (SELECT *, sum(d) OVER (PARTITION BY city ORDER BY class) AS mx FROM s)
    SELECT city, class, round(d, 6)::double AS decimal, round(mx, 6)::double AS max, round(mx - d / 2, 6)::double AS middle,
      CASE WHEN d < 0.02 THEN '' ELSE printf('%.1f%%', d::double * 100) END AS text FROM m""",
)
def land_cover_ring(t):
    out = stat.ring_segments(pixels.class_frequency(t.classes()), "class", "pixels", "class")
    return out.select(
        "city", "class", F.round("decimal", 6).alias("decimal"), F.round("max", 6).alias("max"), F.round("middle", 6).alias("middle"), "text"
    )


@query(
    "solar_seasonality",
    """WITH b AS (SELECT city, month(l_shipdate) AS band, sum(l_quantity) / 1000 AS mx FROM cells GROUP BY ALL),
    s AS (SELECT city, max(mx) / min(mx) AS ratio, max(mx) AS best FROM b GROUP BY city)
    SELECT city, round(ratio, 6) AS ratio, round(best, 6) AS best, CASE WHEN ratio > 2.5 THEN 'Seasonality is high, making solar energy available in only some of the months'
      ELSE 'Seasonality is low to moderate, making solar energy available throughout the year' END AS text,
      CASE WHEN best >= 4.5 THEN 'excellent' WHEN best >= 3.5 THEN 'favourable' ELSE 'low' END AS condition FROM s""",
)
def solar_seasonality(t):
    monthly = t.cells().groupBy("city", F.month("l_shipdate").alias("band")).agg((F.sum("l_quantity") / 1000).alias("max"))
    out = stat.seasonality(monthly)
    return out.withColumns({"ratio": F.round("ratio", 6), "best": F.round("best", 6)})


@query(
    "flood_exposure_long",
    """WITH w AS (SELECT city, year(l_shipdate) AS year, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) AS coastal,
      coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0) AS fluvial FROM cells GROUP BY ALL)
    SELECT city, cast(year as int) AS year, 'coastal' AS type, coastal AS area FROM w UNION ALL SELECT city, year, 'fluvial', fluvial FROM w
    UNION ALL SELECT city, year, 'total', coastal + fluvial FROM w""",
)
def flood_exposure_long(t):
    flag = F.col("l_returnflag")
    wide = t.cells().groupBy("city", F.year("l_shipdate").alias("year")).agg(
        F.coalesce(F.sum(F.when(flag == "A", F.col("l_quantity"))), F.lit(0.0)).alias("coastal_2020"),
        F.coalesce(F.sum(F.when(flag == "N", F.col("l_quantity"))), F.lit(0.0)).alias("fluvial_2020"),
        F.sum("l_linenumber").alias("fluvial_2050"),
    )
    return stat.exposure_long(wide, "_2020")


@query(
    "listing_differences",
    """SELECT 'first' AS side, k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey + 3 FROM orders)
    UNION ALL SELECT 'second', k FROM (SELECT o_custkey + 3 AS k FROM orders EXCEPT SELECT c_custkey FROM customer)""",
)
def listing_differences(t):
    a = t.read("customer").select(F.col("c_custkey").alias("k"))
    b = t.read("orders").select((F.col("o_custkey") + 3).alias("k")).distinct()
    return stat.set_diff(a, b, both=True)


@query(
    "duplicated_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN
    (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def duplicated_rows(t):
    out = stat.duplicated_all(t.read("lineitem"), ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "filled_slide_labels",
    """WITH l AS (SELECT conv_id AS doc, turn AS line, role, text FROM conversations),
    s AS (SELECT *, last_value(CASE WHEN role = 'user' THEN 'slide ' || line END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line) AS slide FROM l)
    SELECT doc, line, 'all' AS section, slide, length(text) AS chars FROM s WHERE role <> 'user' AND slide IS NOT NULL AND trim(text, ' ') <> ''
      AND text NOT LIKE '/%' AND text NOT LIKE '----%'""",
)
def filled_slide_labels(t):
    """Conversation turns read as lines: a user turn names the slide of the turns after it."""
    c = t.read("conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("line"), "role", "text")
    lines = c.withColumn(
        "text", F.when(F.col("role") == "user", F.concat(F.lit("// slide "), F.col("line").cast("string"))).otherwise(F.col("text"))
    ).drop("role")
    heads = c.groupBy("doc").agg((F.min("line") - 1).alias("line")).withColumn("text", F.lit("//// all"))
    out = stat.fill_labels(lines.unionByName(heads))
    return out.select("doc", "line", "section", "slide", F.length("text").alias("chars"))


# indicators -------------------------------------------------------------------------------------

NAMES = {
    "1-URGENT": "Total population",
    "2-HIGH": "Employment - Total",
    "3-MEDIUM": "GDP, real, US$ - Total",
    "4-NOT SPECIFIED": "Employment - Industry",
    "5-LOW": "Employment - Other",
}
NAMED = "(SELECT location, country, CASE indicator " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " END AS indicator, year, value FROM indicators)"


def named_indicators(t):
    name = F.col("indicator")
    label = F.when(F.lit(False), F.lit(""))
    for k, v in NAMES.items():
        label = label.when(name == k, F.lit(v))
    return t.indicators().withColumn("indicator", label)


def wide_years(t):
    long = named_indicators(t)
    return long.groupBy("location", "country", "indicator").agg(
        *[F.max(F.when(F.col("year") == y, F.col("value"))).alias(str(y)) for y in range(1995, 2002)]
    )


@query(
    "indicator_years_long",
    f"""SELECT k.location, k.country, k.indicator, cast(y as int) AS year, value FROM (SELECT DISTINCT location, country, indicator FROM {NAMED}) k
    CROSS JOIN (SELECT unnest(range(1995, 2002)) AS y) LEFT JOIN {NAMED} n ON n.location = k.location AND n.country = k.country
      AND n.indicator = k.indicator AND n.year = y""",
)
def indicator_years_long(t):
    return ind.years_to_long(wide_years(t), ["location", "country", "indicator"])


@query(
    "indicator_columns",
    f"""SELECT location, country, year, avg(value) FILTER (WHERE indicator = 'Total population') AS population, avg(value) FILTER (WHERE indicator = 'Employment - Total') AS employment
    FROM {NAMED} GROUP BY ALL""",
)
def indicator_columns(t):
    names = ["Total population", "Employment - Total"]
    out = ind.indicators_to_columns(named_indicators(t), names, ["location", "country", "year"])
    return out.withColumnsRenamed({"Total population": "population", "Employment - Total": "employment"})


@query(
    "employment_series",
    f"SELECT location, year, value * 1000 AS value FROM {NAMED} WHERE indicator = 'Employment - Total' AND year <= 1999",
)
def employment_series(t):
    return ind.scaled_series(named_indicators(t), "Employment - Total", last_year=1999).select("location", "year", "value")


@query(
    "cities_with_indicators",
    """SELECT 'City ' || s_suppkey % 100 AS location, 'NATION_' || s_suppkey % 50 AS country FROM supplier
    WHERE ('City ' || s_suppkey % 100, 'NATION_' || s_suppkey % 50) IN (SELECT (location, country) FROM indicators)""",
)
def cities_with_indicators(t):
    cities = t.read("supplier").select(
        F.concat(F.lit("City "), F.col("s_suppkey") % 100).alias("location"),
        F.concat(F.lit("NATION_"), F.col("s_suppkey") % 50).alias("country"),
    )
    return ind.has_city(cities, t.indicators())


def populations(t):
    return named_indicators(t).where(F.col("indicator") == "Total population").select(
        "location", "country", "year", F.col("value").alias("population")
    )


def country_neighbours(t):
    from citygrain.operators.spatial import nearby_countries

    c = t.countries().withColumns({"cx": (F.col("xmin") + F.col("xmax")) / 2, "cy": (F.col("ymin") + F.col("ymax")) / 2})
    return nearby_countries(c, c.select("name"), None).select("country", "neighbour", "rank")


@query(
    "benchmark_cities",
    f"""WITH p AS (SELECT location, country, year, value AS pop FROM {NAMED} WHERE indicator = 'Total population'),
    c AS (SELECT name, region, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy FROM countries),
    n AS (SELECT a.name AS country, b.name AS neighbour, row_number() OVER (PARTITION BY a.name ORDER BY sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2), b.name) AS rank
      FROM c a JOIN c b ON a.region = b.region AND a.name <> b.name UNION ALL SELECT name, name, 0 FROM c),
    x AS (SELECT a.location, a.country, a.year, n.rank, b.location AS benchmark, b.country AS benchmark_country, b.pop / a.pop AS ratio FROM p a JOIN n USING (country)
      JOIN p b ON b.country = n.neighbour AND b.year = a.year AND b.location <> a.location AND (n.rank = 0 OR b.pop BETWEEN a.pop * 0.5 AND a.pop * 1.5)),
    xr AS (SELECT location, country, year, rank, count(*) AS n FROM x GROUP BY ALL),
    k AS (SELECT a.location, a.country, a.year, n.rank, sum(coalesce(xr.n, 0)) OVER (PARTITION BY a.location, a.country, a.year ORDER BY n.rank) AS total
      FROM p a JOIN n USING (country) LEFT JOIN xr ON xr.location = a.location AND xr.country = a.country AND xr.year = a.year AND xr.rank = n.rank),
    w AS (SELECT location, country, year, coalesce(min(rank) FILTER (WHERE rank >= 3 AND total >= 4), max(rank)) AS k FROM k GROUP BY ALL),
    f AS (SELECT w.*, k.total FROM w JOIN k ON k.location = w.location AND k.country = w.country AND k.year = w.year AND k.rank = w.k)
    SELECT x.location, x.country, x.year, benchmark, benchmark_country FROM x JOIN f USING (location, country, year) WHERE x.rank <= f.k
      AND (f.total <= 12 OR x.rank = 0 OR ratio BETWEEN 0.6 AND 1.4)""",
)
def benchmark_cities(t):
    p = populations(t)
    return ind.benchmark_cities(p, p, country_neighbours(t), by=["year"])


@query(
    "benchmark_by_pattern",
    """SELECT DISTINCT location, CASE WHEN location = 'City 7' THEN location ELSE 'Benchmark' END AS "group" FROM
    (SELECT location FROM indicators WHERE regexp_matches(lower(country), 'nation_1$|nation_2') UNION SELECT 'City 500') WHERE location <> 'City 3'""",
)
def benchmark_by_pattern(t):
    locations = t.indicators().select("location", "country").distinct()
    out = ind.benchmark_manual(locations, "nation_1$|nation_2", ["City 500"], "City 3")
    return ind.with_group(out, "City 7").select("location", "group")


@query(
    "national_shares",
    f"""WITH c AS (SELECT location, country, year, max(value) FILTER (WHERE indicator = 'Total population') AS p, max(value) FILTER (WHERE indicator = 'GDP, real, US$ - Total') AS g,
      max(value) FILTER (WHERE indicator = 'Employment - Total') AS e FROM {NAMED} GROUP BY ALL),
    n AS (SELECT country, year, sum(p) AS np, sum(g) AS ng, sum(e) AS ne FROM c GROUP BY ALL)
    SELECT location, year, CASE WHEN location = 'City 7' THEN location ELSE 'Benchmark' END AS "group", i AS indicator, round(CASE i WHEN 'Population Share' THEN p / np
      WHEN 'GDP Share' THEN g / ng ELSE e / ne END, 6) AS share, cast(o as int) AS ord FROM c JOIN n USING (country, year), (SELECT unnest(['GDP Share', 'Employment Share', 'Population Share']) AS i, unnest([1, 2, 3]) AS o)""",
)
def national_shares(t):
    years = named_indicators(t).select("location", "country", "indicator", "year", "value")
    totals = years.groupBy("country", "indicator", "year").agg(F.sum("value").alias("value"))
    out = ind.national_shares(ind.with_group(years, "City 7"), totals, ["year"])
    return out.select("location", "year", "group", "indicator", F.round("share", 6).alias("share"), "ord")


@query(
    "sector_shares",
    f"""WITH s AS (SELECT location, year, CASE WHEN location = 'City 7' THEN location ELSE 'Benchmark' END AS grp, replace(indicator, 'Employment - ', '') AS indicator, value
      FROM {NAMED} WHERE indicator LIKE 'Employment - %' AND indicator NOT LIKE '%Total%'),
    h AS (SELECT grp, year, indicator, value / sum(value) OVER (PARTITION BY location, grp, year) AS share FROM s),
    m AS (SELECT grp, year, indicator, quantile_cont(share, 0.5) AS share FROM h GROUP BY ALL),
    o AS (SELECT indicator, year, row_number() OVER (PARTITION BY year ORDER BY indicator = 'Other', share DESC, indicator) AS ord FROM m WHERE grp = 'City 7')
    SELECT grp AS "group", year, indicator, round(share, 6) AS share, cast(ord as int) AS ord FROM m LEFT JOIN o USING (indicator, year)""",
)
def sector_shares(t):
    years = named_indicators(t).select("location", "country", "indicator", "year", "value")
    out = ind.sector_shares(ind.with_group(years, "City 7"), "Employment - ", "City 7", ["year"])
    return out.select("group", "year", "indicator", F.round("share", 6).alias("share"), "ord")


@query(
    "city_search",
    """WITH s AS (SELECT p_partkey AS id, p_name AS name, CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 ELSE 2 END AS tab FROM part),
    h AS (SELECT 'RED BOLT' AS city, id, name, CASE WHEN name LIKE '%red bolt%' THEN tab WHEN name LIKE '%blue%' THEN tab + 3 END AS p FROM s
      UNION ALL SELECT 'nowhere', id, name, CASE WHEN name LIKE '%nowhere%' THEN tab WHEN name LIKE '%ring%' THEN tab + 3 END FROM s)
    SELECT city, id, name FROM h WHERE p = (SELECT min(p) FROM h g WHERE g.city = h.city)""",
)
def city_search(t):
    p = t.read("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type")
    first, second = p.where("p_type = 'ECONOMY'"), p.where("p_type = 'SMALL'")
    rest = p.where("p_type NOT IN ('ECONOMY', 'SMALL')")
    tables = [x.select("id", "name") for x in (first, second, rest)]
    return ind.find_city(tables, [("RED BOLT", "blue"), ("nowhere", "ring")]).select("city", "id", "name")


@query(
    "census_long",
    """SELECT p_name || ' ' || p_partkey AS location, cast(y as int) AS year, cast(floor(p_retailprice * (y - 1989)) as bigint) AS population, p_size / 100 AS area_km,
      'census' AS source FROM part CROSS JOIN (SELECT unnest([1990, 2001, 2011]) AS y)""",
)
def census_long(t):
    price = F.col("p_retailprice")
    wide = t.read("part").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("Name"),
        F.col("p_size").cast("string").alias("Area"),
        *[
            F.format_number(F.floor(price * (y - 1989)).cast("long"), 0).alias(f"Population Census {y}-03-01")
            for y in (1990, 2001, 2011)
        ],
    )
    return ind.census_to_long(wide)


@query(
    "plain_letters",
    """SELECT doc_id, length(replace(replace(replace(text, 'æ', 'ae'), 'œ', 'oe'), 'ß', 'ss')) AS chars,
    length(text) - length(replace(translate(text, 'éèêÉÈÊ', 'eeeEEE'), 'e', '')) AS e_letters FROM documents""",
)
def plain_letters(t):
    plain = to_latin(F.col("text"))
    folded = F.translate(F.col("text"), "éèêÉÈÊ", "eeeEEE")
    return t.read("documents").select(
        "doc_id",
        F.length(plain).alias("chars"),
        (F.length("text") - F.length(F.replace(folded, F.lit("e"), F.lit("")))).alias("e_letters"),
    )


@query(
    "statistics_office_series",
    """SELECT c_name AS location, cast(year(o_orderdate) as int) AS year, o_totalprice AS population, 'statistics office' AS source FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE c_nationkey = 4 AND o_orderstatus = 'F' AND lower(c_name) LIKE '%er#0000000%'""",
)
def statistics_office_series(t):
    table = t.read("orders").join(t.read("customer"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("Country or Area"),
        F.when(F.col("o_orderstatus") == "F", "Both Sexes").otherwise("Female").alias("Sex"),
        F.col("c_name").alias("City"),
        F.year("o_orderdate").alias("Year"),
        F.col("o_totalprice").alias("Value"),
    )
    return ind.un_series(table, "N4", "ÉR#0000000")


@query(
    "population_table",
    f"""WITH s AS (SELECT 0 AS tab, location, country, year, value AS population, NULL::double AS area FROM {NAMED} WHERE indicator = 'Total population'
      UNION ALL SELECT 1, location, NULL, year, max(value), max(year % 4)::double FROM {NAMED} WHERE indicator = 'Employment - Total' GROUP BY ALL),
    a AS (SELECT 'City ' || s_suppkey AS location, max(s_nationkey % 5)::double AS known FROM supplier GROUP BY ALL),
    j AS (SELECT tab, s.location, country, year, population, nullif(coalesce(area, known), 0) AS area FROM s LEFT JOIN a USING (location)),
    o AS (SELECT *, row_number() OVER (PARTITION BY year, location ORDER BY tab, population, area NULLS FIRST) AS i FROM j),
    u AS (SELECT *, coalesce(area, first_value(area IGNORE NULLS) OVER (PARTITION BY year, location ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS a1,
      coalesce(country, first_value(country IGNORE NULLS) OVER (PARTITION BY year, location ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS c1 FROM o),
    d AS (SELECT *, last_value(a1 IGNORE NULLS) OVER (PARTITION BY year, location ORDER BY i) AS a2, last_value(c1 IGNORE NULLS) OVER (PARTITION BY year, location ORDER BY i) AS c2 FROM u)
    SELECT location, year, population, arg_min(a2, i) FILTER (WHERE a2 IS NOT NULL) AS area_km, arg_min(c2, i) FILTER (WHERE c2 IS NOT NULL) AS country FROM d GROUP BY location, year, population""",
)
def population_table(t):
    long = named_indicators(t)
    first = long.where("indicator = 'Total population'").select("location", "country", "year", F.col("value").alias("population"))
    second = (
        long.where("indicator = 'Employment - Total'").groupBy("location", "year")
        .agg(F.max("value").alias("population"), F.max(F.col("year") % 4).cast("double").alias("area_km"))
    )
    areas = t.read("supplier").groupBy(F.concat(F.lit("City "), F.col("s_suppkey")).alias("location")).agg(
        F.max(F.col("s_nationkey") % 5).cast("double").alias("area_km")
    )
    return ind.assemble_population([first, second], areas)


@query(
    "latest_population",
    f"SELECT location, country, max(year) AS year, arg_max(value, year) AS value FROM {NAMED} WHERE indicator = 'Total population' GROUP BY ALL",
)
def latest_population(t):
    p = named_indicators(t).where("indicator = 'Total population'")
    return ind.latest(p, ["location", "country"], "year", "value")


@query(
    "sources_united",
    """SELECT location, year, value, NULL::double AS area, 'indicator' AS source FROM indicators UNION ALL
    SELECT s_name, NULL, s_acctbal, s_nationkey::double, 'supplier' FROM supplier""",
)
def sources_united(t):
    a = t.indicators().select("location", "year", "value").withColumn("source", F.lit("indicator"))
    b = t.read("supplier").select(
        F.col("s_name").alias("location"), F.col("s_acctbal").alias("value"), F.col("s_nationkey").cast("double").alias("area")
    ).withColumn("source", F.lit("supplier"))
    return stat.union_all([a, b])


@query(
    "city_sentences",
    """SELECT name AS city, printf('%s has %d customers in %s', name, count(*), r_name) AS sentence FROM countries JOIN customer ON 'NATION_' || c_nationkey = name
    JOIN region ON r_regionkey = region GROUP BY name, r_name""",
)
def city_sentences(t):
    c = t.read("customer").groupBy(F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    joined = t.countries().join(c, "name").join(t.read("region"), F.col("r_regionkey") == F.col("region"))
    out = demo.sentence(joined, "%s has %d customers in %s", "name", "n", "r_name")
    return out.select(F.col("name").alias("city"), "sentence")


# display and terrain ------------------------------------------------------------------------------


@query(
    "binned_values",
    """WITH v AS (SELECT city, x, y, greatest(20, least(200, value)) AS v, value FROM people)
    SELECT city, x, y, CASE WHEN v >= 100 THEN 2 WHEN v >= 50 THEN 1 ELSE 0 END AS bin, CASE WHEN v >= 100 THEN 'high' WHEN v >= 50 THEN 'medium' ELSE 'low' END AS label,
      CASE WHEN value BETWEEN 20 AND 200 THEN CASE WHEN v >= 100 THEN 2 WHEN v >= 50 THEN 1 ELSE 0 END END AS inside FROM v""",
)
def binned_values(t):
    squished = display.bin_values(t.people(), [20, 50, 100, 200], ["low", "medium", "high"])
    censored = display.bin_values(t.people(), [20, 50, 100, 200], ["low", "medium", "high"], "censor")
    keys = ["city", "x", "y"]
    return squished.select(*keys, "bin", "label").join(censored.select(*keys, F.col("bin").alias("inside")), keys)


@query(
    "quantile_breaks",
    """WITH d AS (SELECT city, value AS v FROM people), q AS (SELECT city, unnest([0, 1, 2, 3, 4, 5]) AS i, unnest(quantile_cont(v, [0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS b FROM d GROUP BY city),
    t AS (SELECT city, i, g, CASE WHEN b = 0 THEN 0 ELSE round_even(b * 10.0 ** (g - 1 - floor(log10(abs(b)))), 0) / 10.0 ** (g - 1 - floor(log10(abs(b)))) END AS b
      FROM q, (SELECT unnest([1, 2, 3, 4, 5]) AS g)),
    w AS (SELECT city, g, bool_and(b = floor(b)) FILTER (WHERE i > 0) AS whole FROM t GROUP BY ALL),
    p AS (SELECT t.city, i, t.g, CASE WHEN whole AND i = 0 THEN floor(b) ELSE b END AS b FROM t JOIN w ON w.city = t.city AND w.g = t.g),
    e AS (SELECT p.city, p.g, p.i, p.b, (SELECT count(*) FROM d WHERE d.city = p.city AND d.v <= p.b) / (SELECT count(*) FROM d WHERE d.city = p.city) AS f FROM p),
    ok AS (SELECT city, coalesce(min(g) FILTER (WHERE good), 5) AS g FROM (SELECT city, g, bool_and(abs(f - i / 5.0) <= 0.05) AS good FROM e GROUP BY ALL) GROUP BY city)
    SELECT p.city, cast(ok.g as int) AS digits, cast(i as int) AS i, round(b, 6)::double AS b FROM p JOIN ok ON ok.city = p.city AND ok.g = p.g""",
)
def quantile_breaks(t):
    out = display.pretty_breaks(t.people(), 6, by=("city",))
    return out.select("city", "digits", F.posexplode("breaks").alias("i", "b")).withColumn("b", F.round("b", 6))


@query(
    "interval_breaks",
    """WITH r AS (SELECT min(value) AS a, max(value) AS z FROM (SELECT c_acctbal AS value FROM customer UNION ALL SELECT 0 - c_acctbal FROM customer)),
    q AS (SELECT i, a + (z - a) * (i / 5.0::double) AS b FROM r, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS i)),
    t AS (SELECT i, g, b AS raw, CASE WHEN b = 0 THEN 0 ELSE round_even(b * 10.0 ** (g - 1 - floor(log10(abs(b)))), 0) / 10.0 ** (g - 1 - floor(log10(abs(b)))) END AS b
      FROM q, (SELECT unnest([1, 2, 3, 4, 5]) AS g)),
    w AS (SELECT g, bool_and(b = floor(b)) FILTER (WHERE i > 0) AS whole FROM t GROUP BY g),
    p AS (SELECT i, t.g, raw, CASE WHEN whole AND i = 0 THEN floor(b) ELSE b END AS b FROM t JOIN w USING (g)),
    ok AS (SELECT coalesce(min(g) FILTER (WHERE good), 5) AS g FROM (SELECT g, bool_and(coalesce(abs((b - raw) / nullif(CASE WHEN raw <> 0 THEN raw ELSE b END, 0)), 0) <= 0.05) AS good FROM p GROUP BY g))
    SELECT cast(i as int) AS i, round(b, 6)::double AS b FROM p WHERE g = (SELECT g FROM ok)""",
)
def interval_breaks(t):
    values = t.read("customer").select(F.col("c_acctbal").alias("value"))
    out = display.pretty_breaks(values, 6, "interval", center=0.0)
    return out.select(F.posexplode("breaks").alias("i", "b")).withColumn("b", F.round("b", 6))


@query(
    "value_domains",
    """SELECT c_nationkey AS city, -greatest(abs(min(c_acctbal)), abs(max(c_acctbal))) AS low, greatest(abs(min(c_acctbal)), abs(max(c_acctbal))) AS high
    FROM customer GROUP BY ALL""",
)
def value_domains(t):
    values = t.read("customer").select(F.col("c_nationkey").alias("city"), F.col("c_acctbal").alias("value"))
    return display.value_domain(values, 0.0, by=("city",))


@query(
    "top_slice",
    """WITH d AS (SELECT value AS v FROM people), q AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS i,
      unnest(quantile_cont(v, [0, 1/9, 2/9, 3/9, 4/9, 5/9, 6/9, 7/9, 8/9, 1.0])) AS b FROM d),
    t AS (SELECT i, g, CASE WHEN b = 0 THEN 0 ELSE round_even(b * 10.0 ** (g - 1 - floor(log10(abs(b)))), 0) / 10.0 ** (g - 1 - floor(log10(abs(b)))) END AS b
      FROM q, (SELECT unnest([1, 2, 3, 4, 5]) AS g)),
    w AS (SELECT g, bool_and(b = floor(b)) FILTER (WHERE i > 0) AS whole FROM t GROUP BY g),
    p AS (SELECT i, t.g, CASE WHEN whole AND i = 0 THEN floor(b) ELSE b END AS b FROM t JOIN w USING (g)),
    e AS (SELECT g, i, b, (SELECT count(*) FROM d WHERE v <= p.b) / (SELECT count(*) FROM d) AS f FROM p),
    ok AS (SELECT coalesce(min(g) FILTER (WHERE good), 5) AS g FROM (SELECT g, bool_and(abs(f - i / 9.0) <= 1 / 36.0) AS good FROM e GROUP BY g))
    SELECT city, x, y, value FROM people WHERE value > (SELECT b FROM p WHERE g = (SELECT g FROM ok) AND i = 8)""",
)
def top_slice(t):
    """Cells above the ninth of ten breaks of the population."""
    return display.top_slice(t.people()).select("city", "x", "y", "value")


@query(
    "terrain_slope",
    """WITH n AS (SELECT h.city, h.x, h.y, coalesce(e.value, h.value) - coalesce(w.value, h.value) AS dx, coalesce(s.value, h.value) - coalesce(u.value, h.value) AS dy FROM heights h
      LEFT JOIN heights e ON e.city = h.city AND e.x = h.x + 1 AND e.y = h.y LEFT JOIN heights w ON w.city = h.city AND w.x = h.x - 1 AND w.y = h.y
      LEFT JOIN heights s ON s.city = h.city AND s.x = h.x AND s.y = h.y + 1 LEFT JOIN heights u ON u.city = h.city AND u.x = h.x AND u.y = h.y - 1)
    SELECT city, x, y, round(degrees(atan(sqrt((dx / 200) ** 2 + (dy / 200) ** 2))), 6) AS value FROM n""",
)
def terrain_slope(t):
    out = terrain.slope(t.heights(), Grid(0.0, 0.0, 100.0, 100.0))
    return out.select("city", "x", "y", F.round("value", 6).alias("value"))


CONTOURS = """(SELECT city, i, cast(floor(lo / i) * i as int) AS a, cast(ceil(hi / i) * i as int) AS z, lo FROM (SELECT city, min(value) AS lo, max(value) AS hi,
  cast(CASE WHEN max(value) - min(value) > 250 THEN ceil((max(value) - min(value)) / 500) * 10 WHEN max(value) - min(value) > 100 THEN 5
    WHEN max(value) - min(value) > 50 THEN 2 ELSE 1 END as int) AS i FROM heights GROUP BY city))"""


@query(
    "contour_levels",
    f"""SELECT city, i AS interval, cast((z - a) / i + 1 as int) AS levels, cast((z - a) / i + CASE WHEN a < lo THEN 0 ELSE 1 END as int) AS drawn,
      cast(a + i * floor(((z - a) / i + 1 - 6) / 5 + 1) as int) AS second_edge, cast(a + i * floor((((z - a) / i + 1 - 6) / 5 + 1) * 5) as int) AS last_edge FROM {CONTOURS}""",
)
def contour_levels(t):
    out = terrain.contour_levels(t.heights())
    edges = terrain.histogram_edges(F.col("levels"))
    return out.withColumn("edges", edges).select(
        "city", "interval", F.size("levels").alias("levels"), F.size("drawn").alias("drawn"),
        F.col("edges")[1].alias("second_edge"), F.col("edges")[5].alias("last_edge"),
    )


@query(
    "elevation_bands",
    f"""SELECT h.city, cast(floor((value - a) / i) as int) AS band, cast(a + floor((value - a) / i) * i as int) AS level, round(count(*) * 0.01::double, 6) AS area
    FROM heights h JOIN {CONTOURS} c ON c.city = h.city GROUP BY ALL""",
)
def elevation_bands(t):
    levels = terrain.contour_levels(t.heights())
    return terrain.elevation_bands(t.heights(), levels, GRID).withColumn("area", F.round("area", 6))
