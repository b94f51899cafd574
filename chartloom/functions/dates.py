"""FHIR dates: partial, with either separator, or ISO with a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Written-out and compact forms tried when the value does not start with a year.
OTHER_FORMATS = ("yyyyMMdd", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy")


def fhir_timestamp_sql(value: str) -> str:
    """SQL text for the UTC timestamp of a FHIR date text; null for placeholders and junk."""
    year_first = rf"trim({value}) RLIKE '^\\d{{4}}($|[-/ T])'"
    month_first = rf"trim({value}) RLIKE '^\\d{{1,2}}[-/]\\d{{4}}$'"
    month = f"substring_index(substring_index(trim({value}), '-', 1), '/', 1)"
    turned = f"concat(right(trim({value}), 4), '-', {month})"
    others = ", ".join(f"try_to_timestamp(trim({value}), '{form}')" for form in OTHER_FORMATS)
    return f"""CASE
        WHEN contains({value}, '0001-01-01') THEN NULL
        WHEN {year_first} THEN try_cast(translate(trim({value}), '/', '-') AS timestamp)
        WHEN {month_first} THEN try_cast({turned} AS timestamp)
        WHEN {value} IS NOT NULL THEN coalesce({others}) END"""


def fhir_timestamp(value: str) -> Column:
    """UTC timestamp of the FHIR date text in a column or field."""
    return F.expr(fhir_timestamp_sql(value))


def date_parts(value: str) -> Column:
    """Struct of year, month, day, date, datetime and time, all null when there is no date."""
    return stamp_parts(fhir_timestamp(value))


def stamp_parts(stamp: Column) -> Column:
    """The same struct for a value that is a timestamp already."""
    return F.struct(
        F.year(stamp).alias("year"),
        F.month(stamp).alias("month"),
        F.dayofmonth(stamp).alias("day"),
        F.date_format(stamp, "yyyy-MM-dd").alias("date"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        F.date_format(stamp, "HH:mm:ss").alias("time"),
    )
