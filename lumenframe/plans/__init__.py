"""Queries of this package's own operators, registered on import."""

from . import brightness, calls, checked, models, relations, reports, rows, schemes, sequences, signals, values, verdicts
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "brightness", "calls", "checked", "models", "relations", "reports", "rows", "schemes", "sequences", "signals", "values", "verdicts"]
