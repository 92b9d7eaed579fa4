"""All named queries; importing this module registers them."""

from __future__ import annotations

from . import calendar, encoders, evaluation, functions, incremental, joins, profiling, rows, sets, statistics, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
