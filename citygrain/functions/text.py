"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their plain forms.
ACCENTED = "àáâãäåāăąçćčďđèéêëēęěìíîïīįłñńňòóôõöøōőřśšşťţùúûüūůűųýÿźżžÀÁÂÃÄÅĀĂĄÇĆČĎĐÈÉÊËĒĘĚÌÍÎÏĪĮŁÑŃŇÒÓÔÕÖØŌŐŘŚŠŞŤŢÙÚÛÜŪŮŰŲÝŹŻŽ"
PLAIN = "aaaaaaaaacccddeeeeeeeiiiiiilnnnoooooooorsssttuuuuuuuuyyzzzAAAAAAAAACCCDDEEEEEEEIIIIIILNNNOOOOOOOORSSSTTUUUUUUUUYZZZ"
# Letters whose plain form has two characters.
LONG_FORMS = {"ß": "ss", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "þ": "th", "Þ": "TH"}


def slug(text: Column) -> Column:
    """Lower case, blanks to underscores, quotes removed."""
    return F.lower(F.replace(F.replace(text, F.lit(" "), F.lit("_")), F.lit("'"), F.lit("")))


def to_latin(text: Column) -> Column:
    """Accented letters to plain ones."""
    out = F.translate(text, ACCENTED, PLAIN)
    for letter, plain in LONG_FORMS.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def grouped(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number.cast("long"), 0)


def plural(count: Column, word: str) -> Column:
    """The word, with an s unless the count is exactly one."""
    return F.when(count == 1, F.lit(word)).otherwise(F.lit(word + "s"))


# The sentences of the results.
COMMON_BIN = "The most common {what} range in the city is %s {unit}, with a %.2f%% frequency."
LAND_COVER_RANK = "The %shighest landcover value is %s with %.2f%% of the total land area"
SEASONAL = "Seasonality is high, making solar energy available in only some of the months"
EVEN = "Seasonality is low to moderate, making solar energy available throughout the year"
GROWTH = "The city's built-up area grew from %.2f sq. km in %d to %.2f in %d for %.2f%% growth"
