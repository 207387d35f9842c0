"""Age, sex, growth and built-up statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Age bands in order.
AGE_BANDS = (
    "0-4", "5-9", "10-14", "15-19", "20-24", "25-29", "30-34", "35-39", "40-44", "45-49", "50-54", "55-59", "60-64",
    "65-69", "70-74", "75-79", "80+",
)
from citygrain.functions import text as sentences


def band_order(band: Column) -> Column:
    return F.array_position(F.array(*[F.lit(b) for b in AGE_BANDS]), band).cast("int")


def banded(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts per age band and sex; 0-1 and 1-4 become 0-4. At most 34 rows per city."""
    band = F.when(F.col("age_group").isin("0-1", "1-4"), "0-4").otherwise(F.col("age_group"))
    return df.groupBy(*by, band.alias("age_group"), "sex").agg(F.sum("population").alias("count"))


def age_shares(df: DataFrame, by_sex: bool = True, by: Sequence[str] = ("city",)) -> DataFrame:
    """Percent of each band within its sex, cumulative in band order; or percent of everyone too."""
    bands = banded(df, by).withColumn("ord", band_order(F.col("age_group")))
    sex = Window.partitionBy(*by, "sex")
    within = F.try_divide(F.col("count") * 100, F.sum("count").over(sex))
    out = bands.withColumn("sexed_percent", within)
    running = sex.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("sexed_percent_cum", F.sum("sexed_percent").over(running))
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    percent = F.col("sexed_percent") if by_sex else F.try_divide(F.col("count") * 100, F.sum("count").over(whole))
    return out.withColumn("percent", percent)


def demographic_summary(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Percent under 5, 15-24, 15-64 and 60+, women 15-49 in percent of women, males per 100 females."""
    b = banded(df, by)
    order, count = band_order(F.col("age_group")), F.col("count")
    total = F.sum("count")

    def part(low: str, high: str, sex: str | None = None) -> Column:
        inside = order.between(AGE_BANDS.index(low) + 1, AGE_BANDS.index(high) + 1)
        if sex:
            inside = inside & (F.col("sex") == sex)
        return F.coalesce(F.sum(F.when(inside, count)), F.lit(0))

    women, men = F.sum(F.when(F.col("sex") == "f", count)), F.sum(F.when(F.col("sex") == "m", count))
    return b.groupBy(*by).agg(
        F.try_divide(part("0-4", "0-4") * 100, total).alias("under5"),
        F.try_divide(part("15-19", "20-24") * 100, total).alias("youth"),
        F.try_divide(part("15-19", "60-64") * 100, total).alias("working_age"),
        F.try_divide(part("60-64", "80+") * 100, total).alias("elderly"),
        F.try_divide(part("15-19", "45-49", "f") * 100, women).alias("reproductive_age"),
        F.try_divide(men * 100, women).alias("sex_ratio"),
    )


def cumulative_area(areas: DataFrame, by: Sequence[str] = ("city",), scale: float = 1.0) -> DataFrame:
    """Running total of the area settled per year; one row per city and year."""
    along = Window.partitionBy(*by).orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    return areas.withColumn("cumulative", F.sum(F.col("area") * scale).over(along))


def growth(df: DataFrame, year: str = "year", value: str = "value", by: Sequence[str] = ("city",)) -> DataFrame:
    """Absolute and relative growth to the previous year; one row per city and year."""
    previous = F.lag(value).over(Window.partitionBy(*by).orderBy(year))
    return df.withColumns(
        {"growth": F.col(value) - previous, "growth_pct": F.try_divide(F.col(value), previous) - 1}
    )


def growth_sentence(df: DataFrame, year: str = "year", value: str = "value", by: Sequence[str] = ("city",)) -> DataFrame:
    """First-to-last growth as a sentence per city."""
    ends = df.groupBy(*by).agg(
        F.min(year).alias("_y0"), F.max(year).alias("_y1"),
        F.min_by(value, year).alias("_a0"), F.max_by(value, year).alias("_a1"),
    )
    pct = F.try_divide((F.col("_a1") - F.col("_a0")) * 100, F.col("_a0"))
    text = F.format_string(sentences.GROWTH, "_a0", "_y0", "_a1", "_y1", pct)
    return ends.select(*by, text.alias("sentence"))


def sentence(df: DataFrame, template: str, *columns: str) -> DataFrame:
    """A sentence per row from a format template."""
    return df.withColumn("sentence", F.format_string(template, *columns))
