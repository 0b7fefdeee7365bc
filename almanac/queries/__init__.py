"""Registered queries with the DuckDB SQL that must give the same rows."""

from almanac.queries import cleaning, facts, ingest, models, quality, questions, ranks  # noqa: F401
from almanac.queries.registry import ORACLES, QUERIES  # noqa: F401
