"""Dates as epoch days.  Arithmetic is done on doubles, because half weeks and quarter
months are legal; dates appear only on output (rounded down, as a printed date is)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_of(date: Column) -> Column:
    return F.unix_date(date)


def date_of(day: Column) -> Column:
    return F.date_from_unix_date(F.floor(day).cast("int"))


def shift_date(date: Column, days: int | Column) -> Column:
    """A date moved by whole days, still a date."""
    return F.date_add(date.cast("date"), days if isinstance(days, int) else days.cast("int"))


def age_years(event: Column, year: Column, month: Column, day: Column) -> Column:
    """Age at an event; missing birth month or day count as 1, an impossible date gives null."""
    text = F.concat_ws(
        "-", year.cast("string"), F.coalesce(month, F.lit(1)).cast("string"),
        F.coalesce(day, F.lit(1)).cast("string"),
    )
    return F.datediff(event, F.try_to_date(text, "y-M-d")) / F.lit(365.25)


def parse_dates(df: DataFrame, name: str, output: str | None = None, one_order: bool = False) -> DataFrame:
    """Make a date column out of whatever type a source delivers.

    Strings are read as year-month-day, else month-day-year, else day-month-year.  Numbers are
    days since 1899-12-30 if all of them are below 100000, otherwise seconds since 1970; that
    choice belongs to the column as a whole, so it takes one aggregate over the column.
    With `one_order` a column of strings has one order of day and month too: the one that more of its values can be
    read in (month first if as many), found by one aggregate; values that only fit the other one are null.
    """
    output = output or name
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.DateType):
        return df.withColumn(output, col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(output, F.to_date(col))
    if isinstance(kind, T.StringType):
        parts = F.trim(F.regexp_replace(col, "[/.]", "-"))
        # Two-digit years first: 69-99 belong to the last century.
        century = F.when(parts.substr(1, 2) >= "69", "19").otherwise("20")
        parts = F.when(parts.rlike(r"^\d{2}-\d{1,2}-\d{1,2}$"), F.concat(century, parts)).otherwise(parts)
        formats = ("y-M-d", "yyyyMMdd", "M-d-y", "d-M-y")
        iso = parts.substr(1, 10)
        tries = [F.try_to_date(iso, "yyyy-MM-dd")] + [F.try_to_date(parts, f) for f in formats]
        if one_order:
            year_first, month_first, day_first = F.coalesce(*tries[:3]), tries[3], tries[4]
            counts = df.select(*[F.count(F.when(year_first.isNull(), c)).alias(n) for n, c in (("m", month_first), ("d", day_first))]).first()
            tries = [year_first, day_first if counts["d"] > counts["m"] else month_first]
        return df.withColumn(output, F.coalesce(*tries))
    largest = df.agg(F.max(name)).first()[0]
    if largest is None or largest < 100000:
        days = col.cast("double") - F.lit(25569)
    else:
        days = col.cast("double") / F.lit(86400)
    return df.withColumn(output, date_of(days))


def precision_category(days: Column) -> Column:
    """Name of a dating precision given in days."""
    return (
        F.when(days.isNull() | (days == 999), "non-specific")
        .when(days == -1, "week_poor-support")
        .when((days >= 0) & (days <= 7), "week")
        .when((days > 7) & (days <= 14), "two-week")
        .when((days > 14) & (days <= 21), "three-week")
        .when((days > 21) & (days <= 28), "month")
        .when((days > 28) & (days <= 56), "two-month")
        .when((days > 56) & (days <= 84), "three-month")
        .otherwise("non-specific")
    )
