"""Registered queries: each runs an operator over whole tables, most beside a SQL twin."""

from meterlab.catalog import backtests, cleaning, exploring, features, models, series, storage  # noqa: F401
from meterlab.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
