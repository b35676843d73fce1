"""Text cleaning as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the source systems.
NULL_TEXTS_CLEAN = ["", " ", "NULL", "null"]
NULL_TEXTS_DROP = ["", "NULL"]
# Fixed value: what a masked head is replaced with.
MASK = "****某"


def clean(c: Column) -> Column:
    """Null markers become null; every blank is removed from the rest."""
    return F.when(~c.isin(NULL_TEXTS_CLEAN), F.replace(c, F.lit(" "), F.lit("")))


def drop_empty(c: Column) -> Column:
    """Empty text and ``NULL`` become null."""
    return F.when(~c.isin(NULL_TEXTS_DROP), c)


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(F.trim(c)) > 0, c)


def md5_trimmed(c: Column) -> Column:
    """Hex md5 of the trimmed text; null stays null."""
    return F.md5(F.trim(c))


def mask_name(c: Column) -> Column:
    """Hide the head of a name: two characters if it is longer than three, one if it has two or three."""
    n = F.length(c)
    return (
        F.when(n > 3, F.concat(F.lit(MASK), F.substr(c, F.lit(3))))
        .when(n >= 2, F.concat(F.lit(MASK), F.substr(c, F.lit(2))))
        .otherwise(c)
    )


def chinese_only(c: Column) -> Column:
    """Keep only Chinese characters; null reads as the text ``null``."""
    return F.coalesce(F.regexp_replace(c, "[^\\u4e00-\\u9fa5]", ""), F.lit("null"))


def no_line_breaks(c: Column) -> Column:
    return F.regexp_replace(c, "[\\r\\n]", "")


def default_int(c: Column, default: int = 9) -> Column:
    """Null or empty code reads as ``default``."""
    text = c.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text.try_cast("int"))


def default_text(c: Column, default: str = "") -> Column:
    return F.coalesce(c, F.lit(default))
