"""Queries on readers, sinks, street tags and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from citygrain.functions import tiles
from citygrain.queries.geometry_queries import QUADKEY
from citygrain.queries.registry import query
from citygrain.scale import work_folder
from citygrain.sources import listings, streets
from citygrain.sources import tables as src


@query(
    "csv_with_types",
    "SELECT c_custkey AS lon, c_acctbal AS lat, c_mktsegment AS cls FROM customer",
)
def csv_with_types(t):
    """A CSV whose header names carry leading blanks, read with declared types."""
    path = work_folder(t.spark, "classes")
    t.read("customer").select(
        F.col("c_custkey").alias(" Lon"), F.col("c_acctbal").alias("Lat"), F.col("c_mktsegment").alias(" Cls")
    ).write.option("header", True).csv(path)
    df = src.read_csv_typed(t.spark, path, "` Lon` long, Lat double, ` Cls` string")
    return df.select(F.col("Lon").alias("lon"), F.col("Lat").alias("lat"), F.col("Cls").alias("cls"))


@query(
    "building_footprints",
    f"""WITH k AS (SELECT id, weight AS height, {QUADKEY.format(z=2, lon='lon', lat='lat')} AS quadkey FROM points)
    SELECT id, height, quadkey FROM k WHERE quadkey < '2'""",
)
def building_footprints(t):
    """Footprints of one country's tiles, from JSON partitioned by quadkey."""
    path = work_folder(t.spark, "footprints")
    keyed = t.points().withColumn("quadkey", tiles.quadkey(F.col("lat"), F.col("lon"), 2))
    keyed.select("quadkey", F.col("weight").alias("height"), F.col("id").cast("double").alias("area")).write.partitionBy(
        "quadkey"
    ).json(path)
    links = keyed.select(F.when(F.col("quadkey") < "2", "north").otherwise("south").alias("location"), "quadkey").distinct()
    found = src.read_footprints(t.spark, path, links, "north", keyed.select("quadkey").distinct())
    return found.select(F.col("area").cast("long").alias("id"), "height", "quadkey")


@query(
    "flattened_pages",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem",
)
def flattened_pages(t):
    """Response pages with nested item lists, flattened to one row per item."""
    items = F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))
    pages = t.read("lineitem").groupBy("l_orderkey").agg(items.alias("items"))
    path = work_folder(t.spark, "pages")
    pages.write.json(path)
    read = t.spark.read.schema(
        "l_orderkey long, items array<struct<l_linenumber:int,l_partkey:long,l_quantity:double>>"
    ).json(path)
    flat = read.select(F.transform("items", lambda i: F.struct(F.col("l_orderkey"), i["l_linenumber"].alias("l_linenumber"), i["l_partkey"].alias("l_partkey"), i["l_quantity"].alias("l_quantity"))).alias("items"))
    return src.flatten_items(flat)


@query(
    "monthly_files",
    "SELECT o_orderkey AS id, cast(year(o_orderdate) as int) AS year, cast(month(o_orderdate) as int) AS month FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997",
)
def monthly_files(t):
    path = work_folder(t.spark, "months")
    t.read("orders").select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).repartition("year", "month").write.partitionBy("year", "month").parquet(path)
    return src.read_months(t.spark, path, (1996, 1997))


@query(
    "dated_pixels",
    "SELECT date, x, y, value FROM stack",
)
def dated_pixels(t):
    """Dates parsed from raster file names."""
    path = work_folder(t.spark, "pixels")
    named = t.stack().withColumn("file", F.concat(F.lit("fwi_"), F.date_format("date", "yyyyMMdd"), F.lit(".tif")))
    named.drop("date").withColumn("layer", F.lit("fwi")).write.partitionBy("layer").parquet(path)
    return src.read_pixels(t.spark, path, ["fwi"]).select("date", "x", "y", "value")


@query(
    "nearest_climate_series",
    """WITH k AS (SELECT DISTINCT (l_suppkey % 36) * 10.0::double - 175 AS lon, (floor(l_suppkey / 36) % 17) * 10.0::double - 80 AS lat, l_suppkey FROM lineitem),
    cube AS (SELECT lon, lat, cast(date_trunc('month', l_shipdate) as date) AS month, avg(l_quantity) AS value FROM lineitem JOIN k USING (l_suppkey) GROUP BY ALL),
    d AS (SELECT zone, lon, lat, sqrt((cx - lon) ** 2 + (cy - lat) ** 2) AS d FROM zones, (SELECT DISTINCT lon, lat FROM k)),
    n AS (SELECT zone, arg_min(lon, (d, lon, lat)) AS lon, arg_min(lat, (d, lon, lat)) AS lat FROM d GROUP BY zone)
    SELECT zone AS city, lon, lat, month, round(value, 6) AS value FROM n JOIN cube USING (lon, lat)""",
)
def nearest_climate_series(t):
    k = F.col("l_suppkey")
    cube = t.read("lineitem").groupBy(
        (k % 36 * 10.0 - 175).alias("lon"), (F.floor(k / 36.0) % 17 * 10.0 - 80).alias("lat"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"),
    ).agg(F.avg("l_quantity").alias("value"))
    cities = t.zones().select(F.col("zone").alias("city"), F.col("cx").alias("lon"), F.col("cy").alias("lat"))
    out = src.nearest_cell_series(cube, cities)
    return out.select("city", "lon", "lat", "month", F.round("value", 6).alias("value"))


@query(
    "outputs_by_kind",
    """SELECT l_orderkey || CASE l_linenumber WHEN 1 THEN '.tif' WHEN 2 THEN '.gpkg' WHEN 3 THEN '.csv' WHEN 4 THEN '.txt' WHEN 5 THEN '.yml' WHEN 6 THEN '.png' ELSE '.html' END AS name,
      CASE WHEN l_linenumber <= 2 THEN 'spatial' WHEN l_linenumber <= 5 THEN 'tabular' WHEN l_linenumber = 6 THEN 'images' ELSE 'other' END AS kind FROM lineitem""",
)
def outputs_by_kind(t):
    path = work_folder(t.spark, "outputs")
    endings = F.array(*[F.lit(e) for e in (".tif", ".gpkg", ".csv", ".txt", ".yml", ".png", ".html")])
    names = t.read("lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.element_at(endings, F.col("l_linenumber"))).alias("name")
    )
    src.write_by_kind(names, path)
    return t.spark.read.parquet(path)


@query(
    "written_statistics",
    """SELECT year(l_shipdate)::int AS year, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS coastal, sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS fluvial,
      sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS pluvial
    FROM lineitem GROUP BY ALL""",
)
def written_statistics(t):
    path = work_folder(t.spark, "statistics")
    flag = F.col("l_returnflag")
    long = t.read("lineitem").groupBy(
        F.year("l_shipdate").alias("year"), F.when(flag == "A", "coastal").when(flag == "N", "fluvial").otherwise("pluvial").alias("type")
    ).agg(F.sum("l_quantity").alias("area"))
    src.write_stats(long, path, ("year", "type", "area", ["coastal", "fluvial", "pluvial"]))
    return src.read_csv_typed(t.spark, path, "year int, coastal double, fluvial double, pluvial double")


@query(
    "street_tags",
    """SELECT o_orderkey AS id, o_orderstatus = 'F' AND o_orderkey % 10 <> 0 AS oneway, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS surface FROM orders""",
)
def street_tags(t):
    way = F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no")
    text = F.concat(F.lit('"surface"=>"'), F.col("o_orderpriority"), F.lit('","oneway"=>"'), way, F.lit('"'))
    broken = F.concat(text, F.lit(',"name"=>"a,b"'))
    ways = t.read("orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 10 == 0, broken).otherwise(text).alias("other_tags")
    )
    out = streets.parse_tags(ways, "other_tags")
    return out.select("id", "oneway", F.try_element_at("tags", F.lit("surface")).alias("surface"))


@query(
    "classified_ways",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'pier' WHEN o_orderstatus = 'P' THEN 'ferry' ELSE lower(o_orderpriority) END AS infra_type FROM orders
      WHERE o_orderkey % 9 <> 1 AND (o_orderkey % 9 = 0 OR o_orderstatus = 'P' OR o_orderkey % 5 <> 0)
    UNION ALL SELECT -s_suppkey, 'pier' FROM supplier WHERE s_nationkey = 3""",
)
def classified_ways(t):
    k = F.col("o_orderkey")
    lines = t.read("orders").select(
        k.alias("id"),
        F.when(k % 9 == 0, "pier;jetty").when(k % 9 == 1, "breakwater").alias("man_made"),
        F.when(F.col("o_orderstatus") == "P", '"route"=>"ferry"').alias("other_tags"),
        F.when(k % 5 != 0, F.lower("o_orderpriority")).alias("highway"),
    )
    areas = t.read("supplier").select(
        (-F.col("s_suppkey")).alias("id"), F.when(F.col("s_nationkey") == 3, "ferry_terminal").otherwise("cafe").alias("amenity")
    )
    return streets.classify_ways(lines, areas)


@query(
    "graph_files",
    "SELECT edge, u, v, length, a.weight AS u_weight FROM streets JOIN nodes a ON a.node = u",
)
def graph_files(t):
    path = work_folder(t.spark, "graph")
    src.write_graph(t.streets().select("edge", "u", "v", "length"), t.nodes(), path)
    nodes, edges = src.read_graph(
        t.spark, f"{path}/edges", "edge long, u long, v long, length double", f"{path}/nodes", "node long, x double, y double, weight double"
    )
    return edges.join(nodes.select(F.col("node").alias("u"), F.col("weight").alias("u_weight")), "u")


@query(
    "missing_maps",
    """WITH c AS (SELECT s_suppkey AS city, s_acctbal AS area FROM supplier WHERE s_nationkey % 2 = 0),
    e AS (SELECT c.*, m AS output FROM c, (SELECT unnest(range(0, 400)) AS m)),
    f AS (SELECT DISTINCT l_suppkey, l_partkey % 400 AS m FROM lineitem),
    x AS (SELECT city, area, 'map' || output AS output FROM e WHERE NOT EXISTS (SELECT 1 FROM f WHERE l_suppkey = city AND m = output))
    SELECT city, output, area, count(*) OVER (PARTITION BY city) AS missing FROM x QUALIFY count(*) OVER (PARTITION BY city) >= 5""",
)
def missing_maps(t):
    cities = t.read("supplier").select(
        F.col("s_suppkey").alias("city"), (F.col("s_nationkey") % 2 == 0).alias("ready"), F.col("s_acctbal").alias("area")
    )
    files = t.read("lineitem").select(
        F.col("l_suppkey").alias("city"), F.concat(F.lit("map"), (F.col("l_partkey") % 400).cast("string")).alias("output")
    )
    return listings.missing_outputs(cities, [f"map{i}" for i in range(400)], files, 5)


LISTS = """(SELECT 'd' || p_size AS folder, 'f' || p_partkey AS file, p_partkey * 3 AS time FROM part) {a} FULL OUTER JOIN
  (SELECT DISTINCT 'd' || p_size AS folder, 'f' || p_partkey AS file, CASE WHEN p_partkey % 2 = 0 THEN p_partkey * 3 + 5 ELSE p_partkey * 3 - 5 END AS time FROM part JOIN lineitem ON l_partkey = p_partkey) {b} USING (folder, file)"""


def two_listings(t):
    part = t.read("part")
    folder, file = F.concat(F.lit("d"), F.col("p_size")), F.concat(F.lit("f"), F.col("p_partkey"))
    left = part.select(folder.alias("folder"), file.alias("file"), (F.col("p_partkey") * 3).alias("time"))
    ordered = t.read("lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    right = part.join(ordered, "p_partkey").select(
        folder.alias("folder"), file.alias("file"),
        (F.col("p_partkey") * 3 + F.when(F.col("p_partkey") % 2 == 0, 5).otherwise(-5)).alias("time"),
    )
    return listings.reconcile(left, right)


@query(
    "reconciled_listings",
    f"""SELECT folder, file, a.time AS left_time, b.time AS right_time, CASE WHEN a.time IS NULL THEN 'missing_left' WHEN b.time IS NULL THEN 'missing_right'
      WHEN b.time > a.time THEN 'older_left' ELSE 'same' END AS status FROM {LISTS.format(a='a', b='b')}""",
)
def reconciled_listings(t):
    return two_listings(t)


@query(
    "files_to_fetch",
    f"""SELECT folder, file, count(*) OVER (PARTITION BY folder) AS files FROM {LISTS.format(a='a', b='b')} WHERE a.time IS NULL OR b.time > a.time""",
)
def files_to_fetch(t):
    return listings.to_fetch(two_listings(t))
