"""The given tables, and domain tables derived from them by key arithmetic.

Every derivation reads whole tables, and is written once for Spark and once as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.scale import dealt

STREET_CLASSES = {
    "1-URGENT": "motorway",
    "2-HIGH": "primary",
    "3-MEDIUM": "secondary",
    "4-NOT SPECIFIED": "residential",
    "5-LOW": "track",
}


def cell_of(column: str, width: float):
    return F.floor(F.col(column) / width).cast("int")


class Tables:
    """Reads a given table by attribute; builds a derived table by method."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # pixel tables ---------------------------------------------------------------

    def cells(self) -> DataFrame:
        return self.read("lineitem").select(
            cell_of("l_suppkey", 20.0).alias("city"),
            cell_of("l_partkey", 4.0).alias("x"),
            cell_of("l_suppkey", 2.0).alias("y"),
            "l_returnflag",
            "l_linestatus",
            "l_linenumber",
            "l_quantity",
            "l_shipdate",
        )

    def dealt_cells(self) -> DataFrame:
        """Cells, those of one place together in one of as many partitions as the rows take."""
        return dealt(self.cells(), ["city", "x", "y"], self.read("lineitem").count())

    def hazard(self) -> DataFrame:
        return (
            self.dealt_cells()
            .groupBy("city", F.col("l_returnflag").alias("layer"), "x", "y")
            .agg(F.max("l_quantity").alias("value"))
        )

    def classes(self) -> DataFrame:
        return self.dealt_cells().groupBy("city", "x", "y").agg((F.mode("l_linenumber", True) * 10).alias("value"))

    def settled(self) -> DataFrame:
        return self.dealt_cells().groupBy("city", "x", "y").agg(F.min(F.year("l_shipdate")).alias("value"))

    def people(self) -> DataFrame:
        return self.dealt_cells().groupBy("city", "x", "y").agg(F.sum("l_quantity").alias("value"))

    def heights(self) -> DataFrame:
        return self.dealt_cells().groupBy("city", "x", "y").agg((F.max("l_quantity") * 10).alias("value"))

    def stack(self) -> DataFrame:
        """Dated pixels: one value per cell and day."""
        return (
            self.read("events")
            .select(
                F.col("ts").cast("date").alias("date"),
                (F.col("user_id") % 15).cast("int").alias("x"),
                cell_of("user_id", 15.0).alias("y"),
                "value",
            )
            .groupBy("date", "x", "y")
            .agg(F.max("value").alias("value"))
        )

    # points and polygons --------------------------------------------------------

    def points(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.read("customer").select(
            k.alias("id"),
            ((k * 7919 % 36000).cast("double") / 100 - 180).alias("lon"),
            ((k * 104729 % 17000).cast("double") / 100 - 85).alias("lat"),
            F.col("c_mktsegment").alias("category"),
            F.col("c_acctbal").alias("weight"),
            F.col("c_nationkey").alias("nation"),
        )

    def countries(self) -> DataFrame:
        """A 5 x 5 grid of boxes, one per nation."""
        k = F.col("n_nationkey")
        x0 = (F.lit(-180) + 72 * (k % 5)).cast("double")
        y0 = (F.lit(-85) + 34 * F.floor(k / 5.0)).cast("double")
        return self.read("nation").select(
            F.col("n_name").alias("name"),
            F.col("n_regionkey").alias("region"),
            x0.alias("xmin"),
            y0.alias("ymin"),
            (x0 + 72).alias("xmax"),
            (y0 + 34).alias("ymax"),
        )

    def zones(self) -> DataFrame:
        """Diamonds around supplier places."""
        k = F.col("s_suppkey")
        return self.read("supplier").select(
            k.alias("zone"),
            ((k * 7919 % 36000).cast("double") / 100 - 180).alias("cx"),
            ((k * 104729 % 17000).cast("double") / 100 - 85).alias("cy"),
            (F.lit(3.3337) + F.col("s_nationkey") % 5).alias("r"),
            F.col("s_nationkey").alias("nation"),
        )

    def zone_polygons(self) -> DataFrame:
        cx, cy, r = F.col("cx"), F.col("cy"), F.col("r")

        def p(x, y):
            return F.struct(x.alias("x"), y.alias("y"))

        ring = F.array(p(cx - r, cy), p(cx, cy - r), p(cx + r, cy), p(cx, cy + r), p(cx - r, cy))
        return self.zones().select("zone", "nation", F.array(ring).alias("rings"))

    # street networks ------------------------------------------------------------

    def nodes(self) -> DataFrame:
        """Junctions of a street lattice 40 wide, one per customer."""
        k = F.col("c_custkey")
        return self.read("customer").select(
            k.alias("node"),
            ((k % 40) * 0.01).alias("x"),
            (F.floor(k / 40.0) * 0.01).alias("y"),
            F.col("c_acctbal").alias("weight"),
        )

    def streets(self) -> DataFrame:
        """Directed street edges, one per order, to a neighbour on the lattice."""
        u, d = F.col("o_custkey"), F.col("o_orderkey") % 4
        v = (
            F.when((d == 0) & (u % 40 < 39), u + 1)
            .when((d == 1) & (u % 40 > 0), u - 1)
            .when(d == 2, u + 40)
            .when(d == 3, u - 40)
        )
        priority = F.col("o_orderpriority")
        road = F.when(F.lit(False), F.lit(""))
        for code, name in STREET_CLASSES.items():
            road = road.when(priority == code, F.lit(name))
        edges = self.read("orders").select(
            F.col("o_orderkey").alias("edge"),
            u.alias("u"),
            v.alias("v"),
            (F.floor("o_totalprice") % 400 + 50).cast("double").alias("length"),
            F.array(road, F.lit("unclassified")).alias("highway"),
            (F.col("o_orderstatus") == "P").alias("oneway"),
        )
        known = self.read("customer").select(F.col("c_custkey").alias("v"))
        return edges.join(known, "v", "left_semi")

    def facilities(self) -> DataFrame:
        """Facility nodes on the lattice, one per supplier, in three categories."""
        total = self.read("customer").agg(F.count(F.lit(1)).alias("n"))
        return self.read("supplier").select(
            F.col("s_suppkey").alias("facility"),
            (F.col("s_suppkey") * 13 % total.scalar()).alias("node"),
            F.concat(F.lit("kind"), (F.col("s_nationkey") % 3).cast("string")).alias("category"),
        )

    def links(self) -> DataFrame:
        """A ring of suppliers with short and long cross links, one link per distinct pair."""
        steps = {1: 1, 2: -1, 3: 10, 4: -10, 5: 37, 6: -37, 7: 100}
        total = self.read("supplier").agg(F.count(F.lit(1)).alias("n"))
        step = F.when(F.lit(False), F.lit(0))
        for number, size in steps.items():
            step = step.when(F.col("l_linenumber") == number, F.lit(size))
        return (
            self.read("lineitem")
            .select(
                F.col("l_suppkey").alias("u"),
                F.pmod(F.col("l_suppkey") + step, total.scalar()).alias("v"),
                (F.col("l_partkey") % 97 + 3).cast("double").alias("length"),
            )
            .where("u <> v")
            .groupBy("u", "v")
            .agg(F.min("length").alias("length"))
        )

    # indicators -----------------------------------------------------------------

    def indicators(self) -> DataFrame:
        """Long indicators: location, country, indicator, year, value."""
        orders, customer = self.read("orders"), self.read("customer")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .groupBy(
                F.concat(F.lit("City "), F.col("c_custkey") % 100).alias("location"),
                F.concat(F.lit("NATION_"), F.col("c_custkey") % 25).alias("country"),
                F.col("o_orderpriority").alias("indicator"),
                F.year("o_orderdate").alias("year"),
            )
            .agg(F.sum(F.floor("o_totalprice")).cast("double").alias("value"))
        )


_CELL = (
    "SELECT cast(floor(l_suppkey / 20.0) as int) AS city, cast(floor(l_partkey / 4.0) as int) AS x, "
    "cast(floor(l_suppkey / 2.0) as int) AS y, l_returnflag, l_linestatus, l_linenumber, l_quantity, l_shipdate "
    "FROM lineitem"
)

DERIVED_SQL: dict[str, str] = {
    "cells": _CELL,
    "hazard": "SELECT city, l_returnflag AS layer, x, y, max(l_quantity) AS value FROM cells GROUP BY ALL",
    "classes": (
        "SELECT city, x, y, arg_min(l_linenumber, (-n, l_linenumber)) * 10 AS value FROM "
        "(SELECT city, x, y, l_linenumber, count(*) AS n FROM cells GROUP BY ALL) GROUP BY ALL"
    ),
    "settled": "SELECT city, x, y, cast(min(year(l_shipdate)) as int) AS value FROM cells GROUP BY ALL",
    "people": "SELECT city, x, y, sum(l_quantity) AS value FROM cells GROUP BY ALL",
    "heights": "SELECT city, x, y, max(l_quantity) * 10 AS value FROM cells GROUP BY ALL",
    "stack": (
        "SELECT cast(ts as date) AS date, cast(user_id % 15 as int) AS x, cast(floor(user_id / 15.0) as int) AS y, "
        "max(value) AS value FROM events GROUP BY ALL"
    ),
    "points": (
        "SELECT c_custkey AS id, cast(c_custkey * 7919 % 36000 as double) / 100 - 180 AS lon, "
        "cast(c_custkey * 104729 % 17000 as double) / 100 - 85 AS lat, c_mktsegment AS category, "
        "c_acctbal AS weight, c_nationkey AS nation FROM customer"
    ),
    "countries": (
        "SELECT n_name AS name, n_regionkey AS region, x0 AS xmin, y0 AS ymin, x0 + 72 AS xmax, y0 + 34 AS ymax FROM "
        "(SELECT *, cast(-180 + 72 * (n_nationkey % 5) as double) AS x0, "
        "cast(-85 + 34 * floor(n_nationkey / 5.0) as double) AS y0 FROM nation)"
    ),
    "zones": (
        "SELECT s_suppkey AS zone, cast(s_suppkey * 7919 % 36000 as double) / 100 - 180 AS cx, "
        "cast(s_suppkey * 104729 % 17000 as double) / 100 - 85 AS cy, "
        "cast(3.3337 as double) + s_nationkey % 5 AS r, s_nationkey AS nation FROM supplier"
    ),
    "nodes": (
        "SELECT c_custkey AS node, (c_custkey % 40) * cast(0.01 as double) AS x, "
        "floor(c_custkey / 40.0) * cast(0.01 as double) AS y, c_acctbal AS weight FROM customer"
    ),
    "streets": (
        "SELECT edge, u, v, length, road, oneway FROM (SELECT o_orderkey AS edge, o_custkey AS u, "
        "CASE WHEN o_orderkey % 4 = 0 AND o_custkey % 40 < 39 THEN o_custkey + 1 "
        "WHEN o_orderkey % 4 = 1 AND o_custkey % 40 > 0 THEN o_custkey - 1 "
        "WHEN o_orderkey % 4 = 2 THEN o_custkey + 40 WHEN o_orderkey % 4 = 3 THEN o_custkey - 40 END AS v, "
        "cast(floor(o_totalprice) % 400 + 50 as double) AS length, "
        "CASE o_orderpriority "
        + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in STREET_CLASSES.items())
        + " END AS road, o_orderstatus = 'P' AS oneway FROM orders) "
        "WHERE v IN (SELECT c_custkey FROM customer)"
    ),
    "facilities": (
        "SELECT s_suppkey AS facility, s_suppkey * 13 % (SELECT count(*) FROM customer) AS node, "
        "'kind' || cast(s_nationkey % 3 as varchar) AS category FROM supplier"
    ),
    "links": (
        "SELECT u, v, min(length) AS length FROM (SELECT l_suppkey AS u, "
        "(l_suppkey + CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN -1 WHEN 3 THEN 10 WHEN 4 THEN -10 "
        "WHEN 5 THEN 37 WHEN 6 THEN -37 ELSE 100 END + 10 * (SELECT count(*) FROM supplier)) "
        "% (SELECT count(*) FROM supplier) AS v, cast(l_partkey % 97 + 3 as double) AS length FROM lineitem) "
        "WHERE u <> v GROUP BY ALL"
    ),
    "indicators": (
        "SELECT 'City ' || cast(c_custkey % 100 as varchar) AS location, "
        "'NATION_' || cast(c_custkey % 25 as varchar) AS country, o_orderpriority AS indicator, "
        "cast(year(o_orderdate) as int) AS year, cast(sum(floor(o_totalprice)) as double) AS value "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
    ),
}
