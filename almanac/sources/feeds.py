"""The report feeds: which raw columns are read, and with which types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions import clean

SOURCE = "_source"  # lineage column: the relation a row came from

# Columns of the raw reports that the cleaned tables read, with their types.
GLOBAL_COLUMNS = {
    "fips": "bigint", "admin2": "string", "province_state": "string", "country_region": "string",
    "combined_key": "string", "lat": "double", "long_": "double", "confirmed": "bigint",
    "deaths": "bigint", "recovered": "bigint", "active": "bigint", "incident_rate": "double",
    "case_fatality_ratio": "double", "last_update": "timestamp",
}
US_COLUMNS = {
    "fips": "bigint", "province_state": "string", "country_region": "string", "uid": "bigint",
    "iso3": "string", "lat": "double", "long_": "double", "confirmed": "bigint", "deaths": "bigint",
    "recovered": "bigint", "active": "bigint", "total_test_results": "bigint",
    "people_tested": "bigint", "people_hospitalized": "bigint", "incident_rate": "double",
    "case_fatality_ratio": "double", "testing_rate": "double", "hospitalization_rate": "double",
    "mortality_rate": "double", "last_update": "timestamp", "date": "date",
}
FEEDS = {"global": GLOBAL_COLUMNS, "us": US_COLUMNS}

#: Columns without which a row says nothing or something wrong: a cell that does not fit leaves its row out.
REQUIRED = frozenset({
    "confirmed", "deaths", "recovered", "active", "total_test_results", "people_tested", "people_hospitalized", "date",
})

_FROM_TEXT = {
    "string": clean.na_to_null,
    "bigint": lambda c: clean.to_count(clean.na_to_null(c)),
    "double": lambda c: clean.to_rate(clean.na_to_null(c)),
    "timestamp": lambda c: clean.to_utc_timestamp(clean.na_to_null(c)),
    "date": lambda c: clean.to_day(clean.na_to_null(c)),
}


def typed_cell(name: str, dtype: str) -> Column:
    """A text cell cast to its declared type; NULL when it does not fit."""
    return _FROM_TEXT[dtype](F.col(name))
