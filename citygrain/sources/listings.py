"""Listings of outputs: what is missing, what differs between two places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.scale import with_totals


def missing_outputs(cities: DataFrame, outputs: Sequence[str], files: DataFrame, min_missing: int = 30) -> DataFrame:
    """Ready cities with enough missing outputs, and the names they miss; largest area first.

    ``cities`` has city, ready and area; ``outputs`` is the list of expected names; ``files``
    (city, output) lists what exists. Every missing output is one row.
    """
    # the list is a run parameter: a city's row carries it and loses what exists
    expected = cities.where("ready").withColumn("output", F.explode(F.array(*[F.lit(o) for o in outputs])))
    missing = expected.join(files.select("city", "output").distinct(), ["city", "output"], "left_anti")
    counts = missing.groupBy("city").agg(F.count(F.lit(1)).alias("missing")).where(F.col("missing") >= min_missing)
    return missing.join(counts, "city").select("city", "output", "area", "missing").orderBy(F.desc("area"), "city", "output")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("folder", "file"), time: str = "time") -> DataFrame:
    """Full outer join of two listings with a status: same, missing_left, missing_right, older_left."""
    a = left.select(*keys, F.col(time).alias("left_time"))
    b = right.select(*keys, F.col(time).alias("right_time"))
    out = a.join(b, list(keys), "full_outer")
    status = (
        F.when(F.col("left_time").isNull(), "missing_left")
        .when(F.col("right_time").isNull(), "missing_right")
        .when(F.col("right_time") > F.col("left_time"), "older_left")
        .otherwise("same")
    )
    return out.withColumn("status", status)


def to_fetch(reconciled: DataFrame, folder: str = "folder", file: str = "file") -> DataFrame:
    """Files to copy: missing or older on the left, one row each with the number of them in the folder."""
    wanted = reconciled.where(F.col("status").isin("missing_left", "older_left")).select(folder, file)
    return with_totals(wanted, [folder], files=F.count(F.lit(1)))
