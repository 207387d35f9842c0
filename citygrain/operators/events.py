"""Earthquake and flood event tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions import geometry as geo
from citygrain.functions.text import grouped, plural
from citygrain.scale import exact_quantiles, join_on, lookup, numbered, with_totals

#: Kilometres, the larger of the radii in use.
EARTH = 6378.137

# Damage codes and flood severities.
DAMAGES = {0: "None", 1: "Limited", 2: "Moderate", 3: "Severe", 4: "Extreme"}
SEVERITIES = {1.0: "Large event", 1.5: "Very large event", 2.0: "Extreme event"}

FILLS = {
    "damageAmountOrder": "int", "damageMillionsDollars": "double", "deaths": "int", "deathsAmountOrder": "int",
    "eqMagnitude": "double", "intensity": "int",
}


def _significant() -> Column:
    return (
        (F.col("damageAmountOrder") >= 2)
        | (F.col("damageMillionsDollars") >= 1)
        | (F.col("deaths") >= 10)
        | (F.col("deathsAmountOrder") >= 2)
        | (F.col("eqMagnitude") >= 7.5)
        | (F.col("intensity") >= 10)
        | F.col("tsunamiEventId").isNotNull()
    )


def _near(df: DataFrame, points: DataFrame, by: Sequence[str], place, km: float) -> DataFrame:
    """Every event with every city whose point can be within ``km``, as ``_lon``, ``_lat``.

    ``place`` gives coordinates in km in which no pair is further apart than its distance. Cities are put
    into the cubes around their own, so events meet them in an equi join. Events without a place
    are dropped, and a city that an event may carry is ignored.
    """
    def cube(lon: Column, lat: Column) -> list[Column]:
        return [F.floor(c / km).cast("int") for c in place(lon, lat)]

    at = points.select(*by, F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    axes = len(cube(F.col("_lon"), F.col("_lat")))
    for i, c in enumerate(cube(F.col("_lon"), F.col("_lat"))):
        at = at.withColumn(f"_c{i}", F.explode(F.sequence(c - 1, c + 1)))
    events = df.drop(*by).where("latitude IS NOT NULL AND longitude IS NOT NULL")
    for i, c in enumerate(cube(F.col("longitude"), F.col("latitude"))):
        events = events.withColumn(f"_c{i}", c)
    keys = [f"_c{i}" for i in range(axes)]
    return events.join(at, keys).drop(*keys)


def _mercator(lon: Column, lat: Column) -> list[Column]:
    """Kilometres in the 3857 plane."""
    return [F.radians(lon) * EARTH, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH]


def _on_sphere(lon: Column, lat: Column) -> list[Column]:
    """Kilometres from the centre of the earth; straight lines are shorter than great circles."""
    a, b = F.radians(lon), F.radians(lat)
    return [F.cos(b) * F.cos(a) * EARTH, F.cos(b) * F.sin(a) * EARTH, F.sin(b) * EARTH]


def significant_quakes(df: DataFrame, points: DataFrame, km: float = 500.0, by: Sequence[str] = ("city",)) -> DataFrame:
    """Damaging, deadly, strong or tsunami earthquakes near each city, with a score.

    One row per event and city within ``km`` of it in the 3857 plane.
    The score (magnitude times 2000 less the distance in the 3857 plane) is taken before
    missing values become 0, so it stays null without a magnitude. Missing deaths keep a flag.
    """
    placed = _near(df, points, by, _mercator, km)
    distance = geo.planar_km(F.col("longitude"), F.col("latitude"), F.col("_lon"), F.col("_lat"))
    scored = placed.withColumn("distance", distance).where(F.col("distance") < km)
    scored = scored.withColumn("score", F.col("eqMagnitude") * (2000 - F.col("distance")))
    scored = scored.withColumn("deaths_known", F.col("deaths").isNotNull())
    filled = scored.withColumns({c: F.coalesce(F.col(c).cast(t), F.lit(0).cast(t)) for c, t in FILLS.items()})
    return filled.where(_significant()).drop("_lon", "_lat")


def event_text(df: DataFrame, separator: str = "\n") -> DataFrame:
    """Date, location and text lines of each event.

    A missing day is the first; "fatality" is singular only for one; unknown deaths stay blank.
    """
    began = F.make_date("year", "month", F.coalesce("day", F.lit(1)))
    known = F.col("deaths_known") if "deaths_known" in df.columns else F.col("deaths").isNotNull()
    fatal = F.concat_ws(" ", grouped(F.col("deaths")), F.when(F.col("deaths") == 1, "fatality").otherwise("fatalities"))
    damage = F.concat_ws(" ", lookup(DAMAGES, F.col("damageAmountOrder").cast("int"), "Unknown"), F.lit("damage"))
    strength = F.concat(
        F.col("eqMagnitude").cast("string"), F.lit("-magnitude; "), grouped(F.floor("distance")), F.lit(" km away")
    )
    out = df.withColumns(
        {
            "began": began,
            "location": F.trim(F.regexp_extract("locationName", r"([^:]\s+.*)", 1)),
            "line2": strength,
            "line3": damage,
            "line4": F.when(known, fatal).otherwise(F.lit("")),
        }
    ).withColumn("line1", F.upper(F.date_format("began", "MMMM yyyy")))
    return out.withColumn("text", F.concat_ws(separator, "line1", "line2", "line3", "line4"))


def alternating(df: DataFrame, order: Sequence[str], by: Sequence[str] = ("city",)) -> DataFrame:
    """+1, -1, +1, .. by date order within each city (``order`` must be unique)."""
    placed = numbered(df, [*by, *order], "_n")
    first = with_totals(placed, by, _first=F.min("_n"))
    sign = F.when((F.col("_n") - F.col("_first")) % 2 == 0, 1).otherwise(-1)
    return first.withColumn("above_line", sign).drop("_n", "_first")


def top_events(df: DataFrame, score: str, n: int = 10, key: str = "event_id", date: str = "began",
               by: Sequence[str] = ("city",)) -> DataFrame:
    """The n highest-scored events of each city, with their place in date order."""
    best = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score), key)
    top = df.where(F.col(score).isNotNull()).withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n)
    by_date = Window.partitionBy(*by).orderBy(date, key)
    return top.withColumn("ord", F.row_number().over(by_date)).drop("_rank")


def quake_timeline(df: DataFrame, points: DataFrame, km: float = 500.0, key: str = "event_id",
                   by: Sequence[str] = ("city",)) -> DataFrame:
    """Significant events by great-circle distance, missing values kept, text on one line."""
    placed = _near(df, points, by, _on_sphere, km)
    distance = geo.haversine_km(F.col("longitude"), F.col("latitude"), F.col("_lon"), F.col("_lat"))
    near = placed.withColumn("distance", distance).where((F.col("distance") < km) & _significant())
    scored = near.withColumn("score", F.col("eqMagnitude") * (2000 - F.col("distance"))).drop("_lon", "_lat")
    return alternating(event_text(scored, "; "), ["began", key], by)


def flood_summary(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Number of flood events, people killed and displaced, and the sentence."""
    out = df.groupBy(*by).agg(
        F.count("began").alias("events"), F.sum("dead").alias("dead"), F.sum("displaced").alias("displaced")
    )
    text = F.concat(
        F.lit("The "), F.col("events").cast("string"), F.lit(" flood "), plural(F.col("events"), "event"),
        F.lit(" displaced "), F.col("displaced").cast("string"), F.lit(" and killed "), F.col("dead").cast("string"), F.lit("."),
    )
    return out.withColumn("sentence", text)


def flood_labels(df: DataFrame) -> DataFrame:
    """Severity label, year, month name and number, and the text line of each flood."""
    label = lookup(SEVERITIES, F.col("severity").cast("double"))
    line = F.concat_ws(
        ", ",
        F.date_format("began", "yyyy-MM-dd"),
        F.concat_ws(" ", F.lower(label), "maincause"),
        F.concat_ws(" ", grouped(F.col("dead")), F.lit("fatalities")),
        F.concat_ws(" ", grouped(F.col("displaced")), F.lit("displaced")),
    )
    return df.withColumns(
        {
            "severity_label": label,
            "year": F.year("began"),
            "month": F.date_format("began", "MMMM"),
            "month_ord": F.month("began"),
            "text": line,
        }
    )


def flood_magnitude(df: DataFrame, n: int = 10, by: Sequence[str] = ("city",)) -> DataFrame:
    """Magnitude (scaled deaths times scaled displaced times severity), and who gets a label.

    Scaling is to 0..1 within the city, 0 when all are equal. A flood is labelled when its
    rank by magnitude, ties at their mean rank, is at most n.
    """
    wide = with_totals(
        df, by, _d0=F.min("dead"), _d1=F.max("dead"), _p0=F.min("displaced"), _p1=F.max("displaced")
    )

    def scaled(column: str, low: str, high: str) -> Column:
        return F.coalesce(F.try_divide(F.col(column) - F.col(low), F.col(high) - F.col(low)), F.lit(0.0))

    sized = wide.withColumn(
        "magnitude", scaled("dead", "_d0", "_d1") * scaled("displaced", "_p0", "_p1") * F.col("severity")
    ).drop("_d0", "_d1", "_p0", "_p1")
    values = sized.groupBy(*by, "magnitude").agg(F.count(F.lit(1)).alias("_n"))
    down = Window.partitionBy(*by).orderBy(F.desc("magnitude"))
    # n + 1 values per city are enough to find the limit
    few = values.withColumn("_k", F.row_number().over(down)).where(F.col("_k") <= n + 1)
    mean_rank = F.sum("_n").over(down) - F.col("_n") + (F.col("_n") + 1) / 2
    limit = few.withColumn("_r", mean_rank).where(F.col("_r") <= n).groupBy(*by).agg(F.min("magnitude").alias("_limit"))
    out = join_on(sized, limit, by, "left") if by else sized.withColumn("_limit", limit.scalar())
    day = F.dayofyear("began")
    return out.withColumns(
        {
            "labelled": F.coalesce(F.col("magnitude") >= F.col("_limit"), F.lit(False)),
            "duration": F.datediff("ended", "began"),
            "begin_day": day,
            "end_day": F.dayofyear("ended"),
            "begin_year": F.year("began") + day / 1000,
        }
    ).drop("_limit")


def event_medians(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median deaths, displaced and duration of floods."""
    timed = df.withColumn("duration", F.datediff("ended", "began"))
    out = None
    for c in ("dead", "displaced", "duration"):
        q = exact_quantiles(timed, c, [0.5], by).withColumnRenamed("q0", c)
        if out is None:
            out = q
        elif by:
            out = join_on(out, q, by)
        else:
            out = out.withColumn(c, q.scalar())
    return out


def event_causes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "maincause").agg(F.count(F.lit(1)).alias("events"))
