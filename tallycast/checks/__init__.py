"""Queries over the given tables, each beside the SQL that must agree with it."""

from . import cases, forecasts, joined, series, statistics, storage, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
