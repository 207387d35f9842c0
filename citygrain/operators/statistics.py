"""Small statistic tables: shares, top classes, ring segments, seasonality, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions import text as sentences
from citygrain.scale import fill_along, join_on

# Ordinals, and the thresholds of the solar text.
ORDINALS = {1: "first", 2: "second", 3: "third"}
SEASONALITY_LIMIT, FAVOURABLE, EXCELLENT = 2.5, 3.5, 4.5


def bin_shares(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Percent of each non-empty bin, with the edges read off its label. A few rows per city."""
    kept = df.where(F.col("count") > 0)
    whole = Window.partitionBy(*by)
    low = F.regexp_extract("bin", r"^(-?[\d.]+)", 1).try_cast("double")
    high = F.regexp_extract("bin", r"-(-?[\d.]+)$", 1).try_cast("double")
    return kept.withColumns(
        {"percent": F.col("count") * 100 / F.sum("count").over(whole), "low": low, "high": high}
    )


def common_bin_sentence(shares: DataFrame, what: str, unit: str, by: Sequence[str] = ("city",)) -> DataFrame:
    """The most common bin as a sentence; ties go to the lower bin."""
    best = F.max_by(F.struct("bin", "percent"), F.struct("percent", -F.col("low")))
    text = F.format_string(sentences.COMMON_BIN.format(what=what, unit=unit), "_b.bin", "_b.percent")
    return shares.groupBy(*by).agg(best.alias("_b")).select(*by, text.alias("sentence"))


def top_classes(df: DataFrame, n: int = 3, label: str = "class", count: str = "pixels",
                by: Sequence[str] = ("city",)) -> DataFrame:
    """The n largest classes with share and sentence; ties go to the smaller label."""
    kept = df.where(F.col(count) > 0)
    share = F.col(count) * 100 / F.sum(count).over(Window.partitionBy(*by))
    order = Window.partitionBy(*by).orderBy(F.desc("percent"), label)
    ranked = kept.withColumn("percent", share).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    ordinal = F.concat(F.col("rank").cast("string"), F.lit("th"))
    for k, word in ORDINALS.items():
        ordinal = F.when(F.col("rank") == k, F.lit(word)).otherwise(ordinal)
    lead = F.when(F.col("rank") == 1, F.lit("")).otherwise(F.concat(ordinal, F.lit(" ")))
    text = F.format_string(sentences.LAND_COVER_RANK, lead, F.col(label), F.col("percent"))
    return ranked.select(*by, "rank", label, "percent", text.alias("sentence"))


def class_decimals(df: DataFrame, label: str = "class", count: str = "pixels", by: Sequence[str] = ("city",)) -> DataFrame:
    """Shares as decimals rounded to four places, largest first."""
    kept = df.where(F.col(count) > 0)
    share = F.round(F.col(count) / F.sum(count).over(Window.partitionBy(*by)), 4)
    out = kept.withColumn("decimal", share)
    order = Window.partitionBy(*by).orderBy(F.desc("decimal"), label)
    return out.withColumn("ord", F.row_number().over(order)).select(*by, "ord", label, "decimal")


def ring_segments(df: DataFrame, label: str, value: str, order: str, by: Sequence[str] = ("city",)) -> DataFrame:
    """Start, end and middle of each category on a ring; labels under two percent are blank."""
    kept = df.where(F.col(value) > 0)
    share = F.col(value) / F.sum(value).over(Window.partitionBy(*by))
    along = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = kept.withColumn("decimal", share).withColumn("max", F.sum("decimal").over(along))
    before = F.coalesce(F.lag("max").over(Window.partitionBy(*by).orderBy(order)), F.lit(0.0))
    out = out.withColumn("min", before)
    text = F.when(F.col("decimal") < 0.02, F.lit("")).otherwise(F.format_string("%.1f%%", F.col("decimal") * 100))
    return out.select(
        *by, label, "decimal", "min", "max", ((F.col("max") + F.col("min")) / 2).alias("middle"), text.alias("text")
    )


def seasonality(df: DataFrame, by: Sequence[str] = ("city",)) -> DataFrame:
    """Best over worst month of solar yield, the text, and the condition of the best month."""
    ratio = F.try_divide(F.max("max"), F.min("max"))
    out = df.groupBy(*by).agg(ratio.alias("ratio"), F.max("max").alias("best"))
    text = F.when(F.col("ratio") > SEASONALITY_LIMIT, sentences.SEASONAL).otherwise(sentences.EVEN)
    level = F.when(F.col("best") >= EXCELLENT, "excellent").when(F.col("best") >= FAVOURABLE, "favourable").otherwise("low")
    return out.withColumns({"text": text, "condition": level})


def exposure_long(df: DataFrame, suffix: str, keys: Sequence[str] = ("city", "year"), match: str = "2020") -> DataFrame:
    """Wide exposure columns to long by type, with the row-wise sum of the matching ones as ``total``."""
    wanted = [c for c in df.columns if c not in keys and match in c]
    total: Column = F.lit(0.0)
    for c in wanted:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    renamed = df.select(*keys, *[F.col(c).cast("double").alias(c.replace(suffix, "")) for c in wanted], total.alias("total"))
    values = [c.replace(suffix, "") for c in wanted] + ["total"]
    return renamed.unpivot(list(keys), values, "type", "area")


def set_diff(a: DataFrame, b: DataFrame, both: bool = False) -> DataFrame:
    """Rows of the first table not in the second, and the other way round when asked."""
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in a.columns]
    first = a.alias("a").join(b.alias("b"), same, "left_anti")
    if not both:
        return first
    second = b.alias("b").join(a.alias("a"), same, "left_anti")
    return first.withColumn("side", F.lit("first")).unionByName(second.withColumn("side", F.lit("second")))


def duplicated_all(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every member of a group that occurs more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return join_on(df, repeated, keys)


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with differing columns; missing ones are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def fill_labels(lines: DataFrame, key: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """Section and slide of every content line of a text file.

    ``//// name`` starts a section and ``// name`` a slide; both are carried down, a slide only
    within its section. Marker and rule lines go, and so do blank lines at the edges of a section.
    """
    t = F.col(text)
    marked = lines.withColumns(
        {
            "section": F.nullif(F.regexp_extract(t, r"^//// *(.*)$", 1), F.lit("")),
            "slide": F.nullif(F.regexp_extract(t, r"^// *([^/].*)$", 1), F.lit("")),
        }
    )
    filled = fill_along(marked, [key], line, ["section"])
    filled = fill_along(filled.where("section IS NOT NULL"), [key, "section"], line, ["slide"])
    body = filled.where(~t.rlike("^/") & ~t.rlike("^----") & F.col("slide").isNotNull())
    # first and last line with content, per section
    edges = body.where(F.trim(text) != "").groupBy(key, "section").agg(F.min(line).alias("_a"), F.max(line).alias("_b"))
    inside = body.join(edges, [key, "section"]).where(F.col(line).between(F.col("_a"), F.col("_b")))
    return inside.select(key, "section", "slide", line, text)
