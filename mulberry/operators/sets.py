"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame

OPERATIONS = {
    "UNION": lambda a, b: a.union(b).distinct(), "UNION ALL": lambda a, b: a.unionAll(b), "INTERSECT": lambda a, b: a.intersect(b),
    "INTERSECT ALL": lambda a, b: a.intersectAll(b), "EXCEPT": lambda a, b: a.subtract(b), "EXCEPT ALL": lambda a, b: a.exceptAll(b),
}


def combine(operation: str, first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION, INTERSECT, EXCEPT, each with ALL or distinct, from left to right."""
    if operation not in OPERATIONS:
        raise ValueError(f"no such operation: {operation}")
    for other in others:
        if len(other.columns) != len(first.columns):
            raise ValueError("different numbers of columns")
        first = OPERATIONS[operation](first, other)
    return first
