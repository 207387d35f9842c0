"""Readers and sinks of point, pixel, statistic and graph tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.operators.nearest import k_nearest

# File endings of each kind of output.
KINDS = {"spatial": (".tif", ".gpkg"), "tabular": (".csv", ".txt", ".yml"), "images": (".png",)}


def read_csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and declared types; blanks around column names are removed."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def read_footprints(spark: SparkSession, path: str, links: DataFrame, country: str, quadkeys: DataFrame,
                    schema: str = "height double, area double") -> DataFrame:
    """Newline JSON footprints of a country's tiles.

    ``path`` is partitioned by quadkey; ``links`` (location, quadkey) says which tiles belong to
    the country. The semi join prunes partitions, so other tiles are not opened.
    """
    data = spark.read.schema(f"{schema}, quadkey string").json(path)
    wanted = (
        links.where(F.col("location") == country)
        .join(quadkeys.select("quadkey"), "quadkey", "left_semi")
        .select("quadkey").distinct()
    )
    return data.join(wanted, "quadkey", "left_semi")


def flatten_items(df: DataFrame, array_col: str = "items") -> DataFrame:
    """Rows of a nested array of structs, over all pages."""
    return df.select(F.inline(array_col))


def read_months(spark: SparkSession, path: str, years: tuple[int, int]) -> DataFrame:
    """Month-partitioned files of a year range; other partitions are not read."""
    return spark.read.parquet(path).where(F.col("year").between(years[0], years[1]))


def date_from_name(name: Column) -> Column:
    """Date of the eight digits just before a file's extension."""
    return F.to_date(F.regexp_extract(name, r"(\d{8})\.[^.]*$", 1), "yyyyMMdd")


def read_pixels(spark: SparkSession, path: str, layers: Sequence[str] | None = None) -> DataFrame:
    """Pixel table partitioned by layer, with the date of its file name when there is one."""
    df = spark.read.parquet(path)
    if layers is not None:
        df = df.where(F.col("layer").isin(*layers))
    if "date" not in df.columns and "file" in df.columns:
        df = df.withColumn("date", date_from_name(F.col("file")))
    return df


def nearest_cell_series(cube: DataFrame, points: DataFrame, key: str = "city") -> DataFrame:
    """Series of the cell nearest to each point; the cube has lon, lat, month and value.

    The nearest cell is found once among the distinct cell coordinates.
    """
    cells = cube.select(F.col("lon").alias("cx"), F.col("lat").alias("cy")).distinct()
    cells = cells.withColumn("cell", F.struct("cx", "cy"))
    near = k_nearest(points.select(key, "lon", "lat"), cells, 1, item="cell", ix="cx", iy="cy")
    at = near.select(key, F.col("cell.cx").alias("lon"), F.col("cell.cy").alias("lat"))
    return at.join(cube, ["lon", "lat"])


def kind_of(name: Column) -> Column:
    """Kind of an output by its file ending."""
    out = F.lit("other")
    for kind, endings in KINDS.items():
        hit = F.lit(False)
        for e in endings:
            hit = hit | F.endswith(name, F.lit(e))
        out = F.when(hit, F.lit(kind)).otherwise(out)
    return out


def write_by_kind(df: DataFrame, path: str, name: str = "name") -> None:
    """Write outputs under one folder per kind."""
    df.withColumn("kind", kind_of(F.col(name))).write.mode("overwrite").partitionBy("kind").parquet(path)


def write_stats(df: DataFrame, path: str, pivot: tuple[str, str, str, Sequence[str]] | None = None) -> DataFrame:
    """Write a statistic table as CSV; ``pivot`` is (row key, column key, value, column values).

    A value of the column key that is not listed fails the write, so nothing is left out unseen.
    Returns the table as written.
    """
    if pivot is not None:
        row, column, value, names = pivot
        listed = F.col(column).isNull() | F.col(column).isin(*names)
        unlisted = F.raise_error(F.concat(F.lit(f"{column} is not listed: "), F.col(column).cast("string"))).cast("boolean")
        df = df.where(F.when(listed, F.lit(True)).otherwise(unlisted))
        df = df.groupBy(row).agg(*[F.max(F.when(F.col(column) == n, F.col(value))).alias(n) for n in names])
    df.write.mode("overwrite").option("header", True).csv(path)
    return df


def write_graph(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    edges.write.mode("overwrite").option("header", True).csv(f"{path}/edges")
    nodes.write.mode("overwrite").option("header", True).csv(f"{path}/nodes")


def read_graph(spark: SparkSession, edges_path: str, edge_schema: str, nodes_path: str | None = None,
               node_schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Edge and node tables from CSV; without a node file the nodes are the edges' ends."""
    edges = read_csv_typed(spark, edges_path, edge_schema)
    if nodes_path is None:
        return edges.select(F.explode(F.array("u", "v")).alias("node")).distinct(), edges
    return read_csv_typed(spark, nodes_path, node_schema), edges
