"""Duty rates: from published text to a fraction, and what they cost."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("free", "ad_valorem", "compound", "specific", "unparsed")
# How a percentage is written, and what makes a rate one that needs a quantity.
PERCENT = r"^\s*(\d+(?:\.\d+)?)\s*%\s*$"
PER_UNIT = r"(?i)(cents?|¢|\$|/\s*(kg|kilo|liter|litre|doz|m2|unit))"


def parse_rate(raw: Column) -> Column:
    """struct(rate, kind).  Only free and ad valorem rates are a number; a rate that needs a quantity has none."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    percent = F.regexp_extract(text, PERCENT, 1)
    kind = (
        F.when(text == "", "unparsed")
        .when(text.rlike(r"(?i)^\s*free\s*$"), "free")
        .when(percent != "", "ad_valorem")
        .when(F.contains(text, F.lit("+")), "compound")
        .when(text.rlike(PER_UNIT), "specific")
        .otherwise("unparsed")
    )
    rate = F.when(kind == "free", F.lit(0.0)).when(kind == "ad_valorem", F.round(percent.try_cast("double") / 100, 6))
    return F.struct(rate.alias("rate"), kind.alias("kind"))


def landed_duty(value: Column, rate: Column, kind: Column, strict: bool = False) -> Column:
    """value * rate in whole cents; without a rate null, or (strict) an error: a duty that needs a quantity is never
    guessed.  Half a cent is rounded up, in decimals, so that engines agree."""
    refused = F.raise_error(F.concat(F.lit("no ad valorem duty from a rate of kind "), kind)).cast("double") if strict else F.lit(None).cast("double")
    return F.when(rate.isNull(), refused).otherwise(F.round(value.cast("decimal(18,4)") * rate.cast("decimal(12,6)"), 2).cast("double"))


def duty_status(rate: Column) -> Column:
    return F.when(rate.isNull(), "needs_quantity").otherwise("computed")
