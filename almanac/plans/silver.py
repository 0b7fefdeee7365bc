"""Raw report cells to the two cleaned tables.

Inputs are bronze rows whose cells are text (the bronze dataset) or already typed
(tables loaded by other means); both are cast to the declared types here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions import clean
from almanac.sources.feeds import FEEDS, SOURCE, typed_cell

def typed(raw: DataFrame, feed: str) -> DataFrame:
    """The declared columns of a feed with their types. A column missing from all input is an error."""
    columns = FEEDS[feed]
    missing = [c for c in [*columns, SOURCE] if c not in raw.columns]
    if missing:
        raise ValueError(f"feed {feed!r} lacks the columns {missing}")
    found = {f.name: f.dataType for f in raw.schema.fields}
    cells = [_cell(name, dtype, found[name]).alias(name) for name, dtype in columns.items()]
    return raw.select(*cells, SOURCE)


def _cell(name: str, dtype: str, found: T.DataType) -> Column:
    if isinstance(found, T.StringType):
        return typed_cell(name, dtype)
    if isinstance(found, (T.FloatType, T.DoubleType)):
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        return number if dtype == "double" else F.round(number, 0).cast(dtype)
    return F.col(name).cast(dtype)


def silver_global(raw: DataFrame) -> DataFrame:
    return typed(raw, "global").select(
        F.col("fips").alias("fips_code"),
        clean.clean_text(F.col("admin2")).alias("admin2"),
        clean.clean_text(F.col("province_state")).alias("province_state"),
        clean.clean_text_or(F.col("country_region"), "Unknown").alias("country_region"),
        clean.clean_text(F.col("combined_key")).alias("location_key"),
        *_position_and_counts(),
        clean.not_below_zero(F.col("incident_rate")).alias("incident_rate_per_100k"),
        clean.within_percent(F.col("case_fatality_ratio")).alias("case_fatality_ratio_pct"),
        F.col("last_update").alias("last_updated_at"),
        *_lineage(),
    )


def silver_us(raw: DataFrame) -> DataFrame:
    counts = ["total_test_results", "people_tested", "people_hospitalized"]
    return typed(raw, "us").select(
        F.col("fips").alias("fips_code"),
        clean.clean_text(F.col("province_state")).alias("province_state"),
        clean.clean_text_or(F.col("country_region"), "US").alias("country_region"),
        "uid",
        clean.clean_text(F.col("iso3")).alias("iso3_code"),
        *_position_and_counts(),
        *[clean.null_to_zero(F.col(c)).alias(c) for c in counts],
        clean.not_below_zero(F.col("incident_rate")).alias("incident_rate_per_100k"),
        clean.within_percent(F.col("case_fatality_ratio")).alias("case_fatality_ratio_pct"),
        clean.not_below_zero(F.col("testing_rate")).alias("testing_rate_per_100k"),
        clean.within_percent(F.col("hospitalization_rate")).alias("hospitalization_rate_pct"),
        clean.within_percent(F.col("mortality_rate")).alias("mortality_rate_pct"),
        F.col("last_update").alias("last_updated_at"),
        F.col("date").alias("snapshot_date"),
        *_lineage(),
    )


def _position_and_counts() -> list[Column]:
    renamed = {"confirmed": "confirmed_cases", "deaths": "total_deaths",
               "recovered": "total_recovered", "active": "active_cases"}
    return [
        clean.zero_to_null(F.col("lat")).alias("latitude"),
        clean.zero_to_null(F.col("long_")).alias("longitude"),
        *[clean.null_to_zero(F.col(raw)).alias(name) for raw, name in renamed.items()],
    ]


def _lineage() -> list[Column]:
    return [F.current_timestamp().alias("_staged_at"), clean.lineage_name(F.col(SOURCE)).alias("_source_table")]
