"""Breaks, bins and value domains of layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.scale import exact_quantiles, join_on

MOST_DIGITS = 5


def significant(value: Column, digits: int) -> Column:
    """Value rounded to significant digits."""
    power = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.rint(value * power) / power)


def bin_values(px: DataFrame, breaks: Sequence[float], labels: Sequence[str] | None = None, oob: str = "squish",
               digits: int | None = None, value: str = "value") -> DataFrame:
    """Bin number and label of each value; outside values are moved to the edge or dropped to null."""
    if labels is not None and len(labels) != len(breaks) - 1:
        raise ValueError("there is one label fewer than breaks")
    v = F.col(value).cast("double")
    if digits is not None:
        v = F.round(v, digits)
    low, high = F.lit(float(breaks[0])), F.lit(float(breaks[-1]))
    v = F.when(F.col(value).isNotNull(), F.greatest(low, F.least(high, v))) if oob == "squish" else F.when(v.between(low, high), v)
    number = F.lit(None).cast("int")
    for i in range(len(breaks) - 1):
        number = F.when(v >= float(breaks[i]), F.lit(i)).otherwise(number)
    names = [str(x) for x in labels] if labels is not None else [f"{breaks[i]}-{breaks[i + 1]}" for i in range(len(breaks) - 1)]
    out = px.withColumn("bin", number)
    return out.withColumn("label", F.try_element_at(F.array(*[F.lit(n) for n in names]), F.col("bin") + 1))


def pretty_breaks(df: DataFrame, n: int = 6, method: str = "quantile", center: float | None = None,
                  threshold: float | None = None, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """n rounded breaks per group as an array.

    Breaks are quantiles or equal steps, rounded to the fewest significant digits (1 to 5) at
    which every break still splits the data as wanted: the share of values up to it (or, for
    steps, its relative place) is off by at most the threshold.
    """
    threshold = 1 / (n - 1) / 4 if threshold is None else threshold
    targets = [i / (n - 1) for i in range(n)]
    data = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    if center is not None:
        data = data.unionByName(data.withColumn("_v", F.lit(float(center)) - F.col("_v")))
    if method == "quantile":
        raw = exact_quantiles(data, "_v", targets, by).select(*by, F.array(*[F.col(f"q{i}") for i in range(n)]).alias("_raw"))
    else:
        ends = data.groupBy(*by).agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        raw = ends.select(*by, F.array(*[F.col("_a") + (F.col("_b") - F.col("_a")) * t for t in targets]).alias("_raw"))

    def rounded(digits: int) -> Column:
        kept = F.transform("_raw", lambda b: significant(b, digits))
        whole = F.forall(F.slice(kept, 2, n), lambda b: b == F.rint(b))
        return F.transform(kept, lambda b, i: F.when(whole & (i == 0), F.floor(b).cast("double")).otherwise(b))

    tries = raw.select(*by, "_raw", *[rounded(d).alias(f"_t{d}") for d in range(1, MOST_DIGITS + 1)])
    if method == "quantile":
        packed = F.struct(*[f"_t{d}" for d in range(1, MOST_DIGITS + 1)])
        if by:
            placed = join_on(data, tries.drop("_raw"), by)
        else:
            placed = data.withColumn("_p", tries.select(packed).scalar()).select("_v", "_p.*")
        counts = [
            F.count_if(F.col("_v") <= F.col(f"_t{d}")[i]).alias(f"_n{d}_{i}") for d in range(1, MOST_DIGITS + 1) for i in range(n)
        ]
        shares = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("_all"), *counts)
        if by:
            tries = join_on(tries, shares, by)
        else:
            names = [c for c in shares.columns]
            tries = tries.withColumn("_s", shares.select(F.struct(*names)).scalar()).select("*", "_s.*")

        def good(d: int) -> Column:
            fits = F.lit(True)
            for i, t in enumerate(targets):
                fits = fits & (F.abs(F.col(f"_n{d}_{i}") / F.col("_all") - t) <= threshold)
            return fits
    else:

        def good(d: int) -> Column:
            off = F.zip_with(
                f"_t{d}", "_raw",
                lambda p, b: F.coalesce(F.abs(F.try_divide(p - b, F.when(b != 0, b).otherwise(p))), F.lit(0.0)),
            )
            return F.forall(off, lambda x: x <= threshold)

    chosen = F.col(f"_t{MOST_DIGITS}")
    digits = F.lit(MOST_DIGITS)
    for d in reversed(range(1, MOST_DIGITS)):
        chosen = F.when(good(d), F.col(f"_t{d}")).otherwise(chosen)
        digits = F.when(good(d), F.lit(d)).otherwise(digits)
    return tries.select(*by, chosen.alias("breaks"), digits.alias("digits"))


def value_domain(df: DataFrame, center: float | None = None, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest value, symmetric when centred on zero."""
    out = df.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    if center == 0:
        extreme = F.greatest(F.abs("low"), F.abs("high"))
        out = out.select(*by, (-extreme).alias("low"), extreme.alias("high"))
    return out


def top_slice(df: DataFrame, value: str = "value", n: int = 10, k: int = 9) -> DataFrame:
    """Rows above the k-th of n pretty breaks."""
    limit = pretty_breaks(df, n, value=value).select(F.element_at("breaks", k))
    return df.where(F.col(value) > limit.scalar())
