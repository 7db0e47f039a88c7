"""One query for each operator."""

from . import aggregates, arrays, engines, filters, joins, scalars, scans, sets, sinks
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "aggregates", "arrays", "engines", "filters", "joins", "scalars", "scans", "sets", "sinks"]
