"""Repairs of what sources publish, with notes on what was changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings that occur in published data, and what they stand for.
ENUM_FIXES = {
    "Avaliable": "Available",
    "Unvailable": "Unavailable",
    "On-Going": "Ongoing",
}


def fixed_enum(c: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ENUM_FIXES.items() for x in kv]), c), c)


def ymd_to_iso(c: Column) -> Column:
    """20151125 to 2015-11-25; anything else stays."""
    return F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")


def mdy_to_iso(c: Column) -> Column:
    """07/20/2026 to 2026-07-20; anything else stays.  No check that the day exists."""
    return F.regexp_replace(c, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2")


def month_start(c: Column) -> Column:
    """The first day of the month of a date text; null where that is no date."""
    return F.date_format(F.trunc(F.to_date(F.try_to_timestamp(c)), "MM"), "yyyy-MM-dd")


def normalize_records(records: DataFrame, ymd: tuple[str, ...] = (), mdy: tuple[str, ...] = ()) -> DataFrame:
    """Top-level texts repaired; where anything was, _normalizations lists it: enums, then dates, in order of fields."""
    texts = [f.name for f in records.schema if isinstance(f.dataType, T.StringType)]
    notes = [F.when(F.col(c).isin(list(ENUM_FIXES)), F.concat(F.lit(f"enum:{c}:"), F.col(c), F.lit("->"), fixed_enum(F.col(c)))) for c in texts]
    out = {c: fixed_enum(F.col(c)) for c in texts}
    for names, to_iso, shape, pattern in ((ymd, ymd_to_iso, "YYYYMMDD", r"^\d{8}$"), (mdy, mdy_to_iso, "MM/DD/YYYY", r"^\d{2}/\d{2}/\d{4}$")):
        for c in names:
            if c in texts:
                notes.append(F.when(F.col(c).rlike(pattern), F.lit(f"date:{c}:{shape}->ISO")))
                out[c] = to_iso(out[c])
    kept = F.array_compact(F.array(*notes)) if notes else F.array().cast("array<string>")
    return records.withColumn("_normalizations", F.when(F.size(kept) > 0, kept)).withColumns(out)
