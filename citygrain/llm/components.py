"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.scale import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of links ``u``, ``v``.

    Each round hangs every node on the smallest of its neighbours, first among larger, then among smaller ones;
    a chain shrinks by half at least, so the rounds grow with the logarithm of the longest one. A hub is
    aggregated before the shuffle and its links are joined, never gathered.
    """
    edges = cut_lineage(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state or not mark[0]:
            return edges.select(_pairs(("u", "v"), ("v", "v"))).toDF("node", "label").distinct()
        state = mark
        both = edges.select(_pairs(("u", "v"), ("v", "u")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("n")).withColumns({"a": F.greatest("v", "m"), "b": F.least("v", "m")})
        edges = cut_lineage(small.select(_pairs(("a", "b"), ("u", "m"))).where("u <> v").distinct())


def _pairs(*pairs: tuple[str, str]):
    """Several (u, v) rows made of the columns of one row."""
    return F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]))
