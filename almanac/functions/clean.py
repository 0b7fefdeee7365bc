"""Cleaning of raw cells: blanks, placeholders, range guards, timestamps, dates, lineage names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that the CSV reader of the original data takes for "no value"
# (the documented default list of pandas.read_csv).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Layouts of the report's update time beside the ISO layout, and how each looks.
UPDATE_TIME_LAYOUTS = {
    "M/d/yyyy H:mm": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$",
    "M/d/yy H:mm": r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}$",
    "M/d/yyyy H:mm:ss": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$",
    "M/d/yy H:mm:ss": r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}:\d{2}$",
}
DAY_LAYOUTS = {"M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$"}


def na_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(NA_TOKENS), cell)


def clean_text(text: Column) -> Column:
    """Trim spaces (only spaces; tabs stay) and turn blank text into NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def clean_text_or(text: Column, default: str) -> Column:
    return F.coalesce(clean_text(text), F.lit(default))


def zero_to_null(number: Column) -> Column:
    return F.nullif(number, F.lit(0).cast("double"))


def null_to_zero(number: Column) -> Column:
    """Absent counts become 0; negative counts are kept as they are."""
    return F.coalesce(number, F.lit(0))


def not_below_zero(rate: Column) -> Column:
    return F.when(rate >= 0, rate)


def within_percent(rate: Column) -> Column:
    return F.when(rate.between(0, 100), rate)


def to_count(cell: Column) -> Column:
    """Text to whole number; '7.0' is 7, text that is no number is NULL, a fraction is rounded (files with one are refused at load)."""
    return F.round(F.trim(cell).try_cast("decimal(38,10)"), 0).try_cast("bigint")


def is_whole(cell: Column) -> Column:
    """Whether text is a whole number: '7' and '7.0' are, '7.5' and 'many' are not."""
    value = F.trim(cell).try_cast("decimal(38,10)")
    return F.coalesce((value == F.round(value, 0)) & value.try_cast("bigint").isNotNull(), F.lit(False))


def to_rate(cell: Column) -> Column:
    """Text to double; a NaN cell is NULL, so that range guards and averages never see it."""
    value = F.trim(cell).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_utc_timestamp(cell: Column) -> Column:
    """Wall-clock text read as UTC, whatever the session's zone; NULL when no layout fits. A written zone counts."""
    text = F.trim(cell)
    timed = text.contains(":")
    zoned = timed & text.rlike(r"(?i)(?:z|[a-z]{3,}|[+-]\d{1,2}(?::?\d{2}){0,2})$")
    day = F.concat(text.try_cast("date").cast("string"), F.lit(" 00:00:00Z"))
    iso = F.when(zoned, F.try_to_timestamp(text)).when(timed, F.try_to_timestamp(F.concat(text, F.lit("Z"))))
    return F.coalesce(iso.otherwise(F.try_to_timestamp(day)), _by_layout(text, UPDATE_TIME_LAYOUTS | DAY_LAYOUTS))


def utc_day(moment: Column) -> Column:
    """The date of a timestamp in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(moment) / 86_400_000_000).cast("int"))


def to_day(cell: Column) -> Column:
    """Text, date or timestamp to date; text may carry any of the layouts."""
    text = F.trim(cell.cast("string"))
    return F.coalesce(text.try_cast("date"), utc_day(to_utc_timestamp(text)))


def _by_layout(text: Column, layouts: dict[str, str]) -> Column:
    """Parse with the layout that the text looks like: a failed parse is slow, a failed match is not."""
    chain = F
    for layout, look in layouts.items():
        chain = chain.when(text.rlike(look), F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{layout} Z")))
    return chain


def lineage_name(relation: Column) -> Column:
    """'"warehouse"."bronze"."t"' -> 'bronze.t': drop the database part and all quotes."""
    named = F.replace(relation, F.lit('"warehouse".'), F.lit(""))
    return F.replace(named, F.lit('"'), F.lit(""))


def normalize_name(name: str) -> str:
    """Header cell to column name: trimmed, lower case, spaces and slashes to underscores."""
    return name.strip().lower().translate(str.maketrans(" /", "__"))


def normalize_names(names: Iterable[str]) -> list[str]:
    """Normalise a header; two names that become one are an error, never a silent drop."""
    result = [normalize_name(n) for n in names]
    repeated = sorted({n for n in result if result.count(n) > 1})
    if repeated:
        raise ValueError(f"columns repeat after normalisation: {repeated}")
    return result


def quoted(name: str) -> str:
    """A column name of any characters, as F.col takes it."""
    return "`" + name.replace("`", "``") + "`"
