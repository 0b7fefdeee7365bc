"""Numeric metrics and identifiers of the fact: exact rounding, percentages, changes, keys, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published surrogate-key formula: parts joined by '-', absent part replaced.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def round_half_up(value: Column, places: int) -> Column:
    """Round halves away from zero, after dropping the noise of floating-point sums (NaN is NULL)."""
    return F.round(value.try_cast("decimal(38,10)"), places).cast("double")


def round_quotient(value: Column, places: int) -> Column:
    """Round a quotient of two whole numbers, exactly for counts of any size.

    Its double is the one nearest to the exact quotient and carries no noise, so rounding
    the shortest decimal that names the double is exact; ten decimals first could round twice.
    """
    return F.round(value, places)


def safe_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole to 2 places, NULL unless the whole is positive."""
    return F.when(whole > 0, round_quotient(F.lit(100.0) * part / whole, 2))


def delta(current: Column, previous: Column) -> Column:
    """Change since the previous row; 0 on the first row. May be negative."""
    return F.coalesce(current - previous, F.lit(0))


def pct_change(current: Column, previous: Column) -> Column:
    return safe_pct(current - previous, previous)


def surrogate_key(*parts: Column) -> Column:
    texts = [F.coalesce(p.cast("string"), F.lit(KEY_NULL)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def location_name(province: Column, country: Column) -> Column:
    return F.coalesce(F.concat(province, F.lit(", "), country), country)


def day_name(day: Column) -> Column:
    """English day name padded with blanks to nine characters."""
    return F.rpad(F.date_format(day, "EEEE"), 9, " ")


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar parts. The week is the ISO week while the year is the calendar year."""
    return {
        "report_year": F.year(day).cast("bigint"),
        "report_month": F.month(day).cast("bigint"),
        "report_day": F.dayofmonth(day).cast("bigint"),
        "day_of_week": day_name(day),
        "week_of_year": F.weekofyear(day).cast("bigint"),
    }
