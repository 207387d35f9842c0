"""City indicators, benchmark cities, census and population series."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions.text import to_latin
from citygrain.scale import exact_quantiles, fill_along, join_on, numbered, with_totals

# Indicator names and the factors of the growth series.
POPULATION = "Total population"
EMPLOYMENT = "Employment - Total"
GDP = "GDP, real, US$ - Total"
FACTORS = {POPULATION: 1000.0, EMPLOYMENT: 1000.0, GDP: 1_000_000.0}


def years_to_long(df: DataFrame, ids: Sequence[str], value: str = "value") -> DataFrame:
    """One column per year to one row per year."""
    years = [c for c in df.columns if c not in ids and re.fullmatch(r"\d{4}", c)]
    return df.unpivot(list(ids), years, "year", value).withColumn("year", F.col("year").cast("int"))


def indicators_to_columns(df: DataFrame, names: Sequence[str], keys: Sequence[str], value: str = "value") -> DataFrame:
    """One column per named indicator."""
    return df.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("indicator") == n, F.col(value))).alias(n) for n in names]
    )


def scaled_series(df: DataFrame, indicator: str, factor: float | None = None, last_year: int = 2021) -> DataFrame:
    """Values of one indicator in units, up to a year, without nulls."""
    f = FACTORS[indicator] if factor is None else factor
    kept = df.where((F.col("indicator") == indicator) & (F.col("year") <= last_year) & F.col("value").isNotNull())
    return kept.withColumn("value", F.col("value") * f)


def has_city(cities: DataFrame, locations: DataFrame) -> DataFrame:
    """Cities whose (location, country) is in the indicator set."""
    return cities.join(locations.select("location", "country"), ["location", "country"], "left_semi")


def benchmark_cities(cities: DataFrame, candidates: DataFrame, neighbours: DataFrame, start: int = 3, least: int = 4,
                     most: int = 12, spread: float = 0.5, narrow: float = 0.4, by: Sequence[str] = ()) -> DataFrame:
    """Comparable cities of each city.

    ``cities`` and ``candidates``: location, country, population and the ``by`` columns, such as the year, that keep comparisons
    apart. ``neighbours``: country, neighbour, rank (1 is nearest, same region). A candidate is in the city's country, or in one
    of its nearest countries with a population within the spread. The countries are widened
    one by one while there are fewer than ``least``, and the spread is narrowed once when there
    are more than ``most``. Totals and the city itself do not count.

    How many candidates a country has within a spread comes from running counts over its populations, which are sorted in
    narrow classes; pairs are formed only for the countries and the spread that a city ends up with.
    """
    by = list(by)
    city = ["location", "country", *by]
    pool = candidates.where(~F.col("location").contains("Total") & (F.col("population") > 0)).select(
        F.col("location").alias("benchmark"), F.col("country").alias("neighbour"), *by, F.col("population").cast("double").alias("_p")
    )
    own = cities.select(*city, F.col("population").cast("double").alias("population"))
    near = own.join(neighbours.select("country", "neighbour", "rank"), "country")
    per_rank = (
        _same_country(own, pool, city, by).withColumn("rank", F.lit(0))
        .unionByName(_within_spread(near, pool, spread, city, by)).groupBy(*city, "rank").agg(F.sum("_n").alias("_n"))
    )
    # one row per neighbouring country: every rank is present so widening counts empty ones too
    ranks = own.select(*city).distinct()
    ranks = (
        ranks.join(neighbours.select("country", "rank").distinct(), "country").select(*city, "rank")
        .unionByName(ranks.withColumn("rank", F.lit(0)))
    )
    ranks = join_on(ranks, per_rank, [*city, "rank"], "left").na.fill(0, ["_n"])
    outward = Window.partitionBy(*city).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    reached = ranks.withColumn("_total", F.sum("_n").over(outward))
    enough = F.min(F.when((F.col("rank") >= start) & (F.col("_total") >= least), F.col("rank")))
    chosen = reached.groupBy(*city).agg(F.coalesce(enough, F.max("rank")).alias("_k"))
    found = join_on(reached, chosen, city).where(F.col("rank") == F.col("_k"))
    share = F.when(F.col("_total") <= most, F.lit(spread)).otherwise(F.lit(narrow))
    found = found.select(*city, "_k", share.alias("_share"))
    out = [*city, "benchmark", F.col("neighbour").alias("benchmark_country")]
    inside = own.join(pool.withColumn("country", F.col("neighbour")), ["country", *by])
    picked = join_on(near, found, city).where(F.col("rank") <= F.col("_k"))
    low, high = F.col("population") * (1 - F.col("_share")), F.col("population") * (1 + F.col("_share"))
    # population classes make the range an equi join
    picked = picked.withColumns({"_low": low, "_high": high}).withColumn("_size", F.explode(F.sequence(_size_class("_low"), _size_class("_high"))))
    outside = picked.join(pool.withColumn("_size", _size_class("_p")), ["neighbour", "_size", *by]).where("_p between _low and _high")
    return inside.where("benchmark <> location").select(*out).unionByName(
        outside.where("benchmark <> location").select(*out)
    )


#: Populations of a class differ by this factor at most.
CLASS = 1.05


def _size_class(column: str) -> Column:
    return F.floor(F.ln(F.greatest(F.col(column), F.lit(1e-9))) / F.ln(F.lit(CLASS)))


def _same_country(own: DataFrame, pool: DataFrame, city: list[str], by: list[str]) -> DataFrame:
    """Candidates in each city's own country, without those of its name."""
    all_of = pool.groupBy(F.col("neighbour").alias("country"), *by).agg(F.count(F.lit(1)).alias("_all"))
    named = pool.groupBy(F.col("benchmark").alias("location"), F.col("neighbour").alias("country"), *by).agg(F.count(F.lit(1)).alias("_own"))
    counted = own.select(*city).distinct().join(all_of, ["country", *by]).join(named, city, "left")
    return counted.select(*city, (F.col("_all") - F.coalesce("_own", F.lit(0))).alias("_n"))


def _within_spread(near: DataFrame, pool: DataFrame, spread: float, city: list[str], by: list[str]) -> DataFrame:
    """For each city and rank the candidates of that country within the spread, without those of the city's name.

    The ends of the range are sorted among the populations of their class; before them stand the classes below and the
    populations passed in their own.
    """
    low, high = F.col("population") * (1 - spread), F.col("population") * (1 + spread)
    ends = F.array(
        F.struct(low.alias("_v"), F.lit(0).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct(high.alias("_v"), F.lit(2).alias("_at"), F.lit(1).alias("_sign")),
    )
    asked = near.where("population is not null").select(*city, "neighbour", "rank", F.inline(ends))
    asked = asked.withColumns({"_size": _size_class("_v"), "_one": F.lit(0)})
    given = pool.select("neighbour", *by, F.col("_p").alias("_v"), _size_class("_p").alias("_size"), F.lit(1).alias("_at"), F.lit(1).alias("_one"))
    rows = given.unionByName(asked, allowMissingColumns=True)
    sizes = rows.groupBy("neighbour", *by, "_size").agg(F.sum("_one").alias("_held"))
    # a few hundred classes of a country
    below = Window.partitionBy("neighbour", *by).orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_below", F.coalesce(F.sum("_held").over(below), F.lit(0))).drop("_held")
    passed = Window.partitionBy("neighbour", *by, "_size").orderBy("_v", "_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_passed", F.sum("_one").over(passed)).where("_one = 0")
    placed = join_on(placed, sizes, ["neighbour", *by, "_size"])
    counted = placed.groupBy(*city, "rank").agg(F.sum(F.col("_sign") * (F.col("_below") + F.col("_passed"))).alias("_n"))
    named = near.join(pool.withColumnRenamed("benchmark", "location"), ["location", "neighbour", *by]).where(F.col("_p").between(low, high))
    own = named.groupBy(*city, "rank").agg((-F.count(F.lit(1))).alias("_n"))
    return counted.unionByName(own)


def benchmark_manual(candidates: DataFrame, pattern: str, extra: Sequence[str], city: str) -> DataFrame:
    """Benchmark locations by country pattern, with manual additions, without the city itself."""
    plain = candidates.where(
        F.lower("country").rlike(pattern) & (F.col("location") != F.col("country")) & ~F.col("location").contains("Total")
    ).select("location")
    spark = candidates.sparkSession
    manual = spark.createDataFrame([(e,) for e in extra], "location string")
    return plain.unionByName(manual).distinct().where(F.col("location") != city)


def with_group(df: DataFrame, city: Column | str) -> DataFrame:
    """Group label (the city, or Benchmark) with the city first."""
    own = F.col("location") == (F.lit(city) if isinstance(city, str) else city)
    return df.withColumns({"group": F.when(own, F.col("location")).otherwise("Benchmark"), "group_ord": F.when(own, 1).otherwise(2)})


def national_shares(df: DataFrame, totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A city's share of its country's population, GDP and employment, long and ordered.

    ``df`` and ``totals`` hold location, country, indicator, value of one year, or of all years with the year among
    the ``by`` columns; copies count once.
    """
    names = [POPULATION, EMPLOYMENT, GDP]
    by = list(by)
    unique = df.dropDuplicates(["location", "country", "indicator", *by])
    wide = indicators_to_columns(unique, names, ["group", "group_ord", "location", "country", *by])
    nation = indicators_to_columns(totals.dropDuplicates(["country", "indicator", *by]), names, ["country", *by])
    nation = nation.select("country", *by, *[F.col(n).alias(f"{n}_national") for n in names])

    def share(name: str) -> Column:
        return F.try_divide(F.col(name), F.col(f"{name}_national"))

    ids = ["group", "group_ord", "location", *by]
    shares = wide.join(nation, ["country", *by]).select(
        *ids, share(POPULATION).alias("Population Share"), share(GDP).alias("GDP Share"), share(EMPLOYMENT).alias("Employment Share")
    )
    long = shares.unpivot(ids, ["Population Share", "GDP Share", "Employment Share"], "indicator", "share")
    position = F.array_position(F.array(*[F.lit(n) for n in ("GDP Share", "Employment Share", "Population Share")]), F.col("indicator"))
    return long.withColumn("ord", position.cast("int")).orderBy(*by, "group_ord", "ord", "location")


def sector_shares(df: DataFrame, prefix: str, city: str, by: Sequence[str] = ()) -> DataFrame:
    """Median share of each sector per group, ordered by the city's shares with Other last; for each value of ``by`` on its own."""
    by = list(by)
    sectors = df.where(F.col("indicator").startswith(prefix) & ~F.col("indicator").contains("Total"))
    named = clean_labels(sectors, {f"^{re.escape(prefix)}": ""})
    shares = with_totals(named, ["location", "group", *by], _sum=F.sum("value")).withColumn(
        "share", F.try_divide(F.col("value"), F.col("_sum"))
    )
    medians = exact_quantiles(shares, "share", [0.5], ["group", "indicator", *by]).withColumnRenamed("q0", "share")
    own = medians.where(F.col("group") == city)
    # one row per sector
    order = Window.partitionBy(*by).orderBy(F.col("indicator") == "Other", F.desc("share"), "indicator")
    placed = own.select("indicator", *by, F.row_number().over(order).alias("ord"))
    return medians.join(placed, ["indicator", *by], "left")


def clean_labels(df: DataFrame, rules: dict[str, str], column: str = "indicator") -> DataFrame:
    """Labels after a list of pattern replacements, in order."""
    label = F.col(column)
    for pattern, replacement in rules.items():
        label = F.regexp_replace(label, pattern, replacement)
    return df.withColumn(column, F.trim(label))


def find_city(tables: Sequence[DataFrame], cities: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Rows of the first table that has the city, by case-insensitive substring, else by its other name.

    ``tables`` have ``name``; ``cities`` are (city, alternate name) run parameters.
    """
    stacked = union_tables(tables)
    out = None
    for city, alternate in cities:
        lower = F.lower("name")
        rank = F.when(F.contains(lower, F.lit(city.lower())), F.col("_table"))
        if alternate:
            rank = F.coalesce(
                rank, F.when(F.contains(lower, F.lit(alternate.lower())), F.col("_table") + len(tables))
            )
        hits = stacked.withColumn("_priority", rank).where("_priority IS NOT NULL")
        first = hits.agg(F.min("_priority").alias("p"))
        found = hits.where(F.col("_priority") == first.scalar()).withColumn("city", F.lit(city))
        out = found if out is None else out.unionByName(found)
    return out.drop("_priority", "_table")


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    out = None
    for i, t in enumerate(tables):
        numbered_table = t.withColumn("_table", F.lit(i))
        out = numbered_table if out is None else out.unionByName(numbered_table, allowMissingColumns=True)
    return out


def census_to_long(df: DataFrame) -> DataFrame:
    """Census columns to rows: year from the column name, separators removed, area in square km."""
    columns = [c for c in df.columns if "Population" in c and re.search(r"\d{4}", c)]
    long = df.unpivot(["Name", "Area"], columns, "_column", "_text")
    number = F.regexp_replace(F.col("_text").cast("string"), ",", "")
    return long.select(
        F.col("Name").alias("location"),
        F.regexp_extract("_column", r"(\d{4})", 1).cast("int").alias("year"),
        number.try_cast("long").alias("population"),
        (F.col("Area").try_cast("double") / 100).alias("area_km"),
        F.lit("census").alias("source"),
    )


def un_series(df: DataFrame, country: str, city: str) -> DataFrame:
    """Statistical-office series of a city: both sexes, accent-insensitive name pattern."""
    pattern = F.lower(to_latin(F.lit(city)))
    return (
        df.where(
            (F.col("Country or Area") == country)
            & (F.col("Sex") == "Both Sexes")
            & F.contains(F.lower(to_latin(F.col("City"))), pattern)
        )
        .select(F.col("City").alias("location"), F.col("Year").cast("int").alias("year"), F.col("Value").alias("population"))
        .withColumn("source", F.lit("statistics office"))
    )


def assemble_population(sources: Sequence[DataFrame], areas: DataFrame) -> DataFrame:
    """One population table from several sources.

    Areas join on the title-cased name and zero areas become null; area, population and country are
    filled up then down among rows of the same year and place, sources in the given order; of
    equal (location, year, population) rows the first stays.
    """
    stacked = union_tables(sources)
    known = areas.select(F.initcap("location").alias("_title"), F.col("area_km").alias("_area"))
    joined = stacked.withColumn("_title", F.initcap("location")).join(known, "_title", "left").drop("_title")
    area = F.coalesce("area_km", "_area") if "area_km" in joined.columns else F.col("_area")
    joined = joined.withColumn("area_km", F.nullif(area, F.lit(0.0))).drop("_area")
    order = [c for c in ("year", "location", "_table", "population", "area_km") if c in joined.columns]
    placed = numbered(joined, order, "_row")
    columns = [c for c in ("area_km", "population", "country") if c in placed.columns]
    filled = fill_along(placed, ["year", "location"], "_row", columns, "up")
    filled = fill_along(filled, ["year", "location"], "_row", columns, "down")
    rest = [c for c in filled.columns if c not in ("location", "year", "population", "_row", "_table")]
    return (
        filled.groupBy("location", "year", "population")
        .agg(F.min_by(F.struct(*rest), "_row").alias("_f"))
        .select("location", "year", "population", "_f.*")
    )


def latest(df: DataFrame, key: Sequence[str], year: str, value: str) -> DataFrame:
    """Newest value per key."""
    return df.where(F.col(value).isNotNull()).groupBy(*key).agg(
        F.max(year).alias(year), F.max_by(value, year).alias(value)
    )
