"""Street features: tag strings, way classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_map(text: Column) -> Column:
    """Map of a ``"k"=>"v","k"=>"v"`` string; null when an element is not a pair."""
    parts = F.split(F.replace(text, F.lit('"'), F.lit("")), ",")
    pairs = F.transform(parts, lambda p: F.split(p, "=>"))
    well_formed = F.forall(pairs, lambda p: F.size(p) == 2)
    # of repeated keys the last counts
    entries = F.transform(pairs, lambda p: F.struct(F.trim(F.get(p, F.lit(0))).alias("k"), F.trim(F.get(p, F.lit(1))).alias("v")))
    last_only = F.filter(
        F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), e["v"].alias("v"), i.alias("i"))),
        lambda e: F.size(F.filter(F.slice(entries, e["i"] + 2, F.size(entries)), lambda o: o["k"] == e["k"])) == 0,
    )
    as_map = F.map_from_entries(F.transform(last_only, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))
    return F.when(text.isNotNull() & well_formed, as_map)


def parse_tags(df: DataFrame, column: str) -> DataFrame:
    """Tag map and one-way flag; malformed or missing tags mean two-way."""
    tags = tag_map(F.col(column))
    out = df.withColumn("tags", tags)
    return out.withColumn("oneway", F.coalesce(F.try_element_at("tags", F.lit("oneway")) == "yes", F.lit(False)))


def classify_ways(lines: DataFrame, areas: DataFrame) -> DataFrame:
    """Roads, piers and ferries: a pier tag wins, then a ferry tag, then the road class.

    ``lines``: id, man_made, other_tags, highway. ``areas``: id, amenity; ferry terminals are piers.
    """
    made = F.col("man_made").isNotNull() & (F.col("man_made") != "")
    kind = (
        F.when(made, F.when(F.contains("man_made", F.lit("pier")), "pier"))
        .when(F.contains("other_tags", F.lit("ferry")), "ferry")
        .otherwise(F.col("highway"))
    )
    roads = lines.withColumn("infra_type", kind).where("infra_type IS NOT NULL").select("id", "infra_type")
    piers = areas.where(F.col("amenity") == "ferry_terminal").select("id", F.lit("pier").alias("infra_type"))
    return roads.unionByName(piers)
