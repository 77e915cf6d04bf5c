"""Evaluate costly columns once.

Catalyst pushes a filter below the projection that defines its columns and repeats
their expressions there. For keyword scans and URL rules that doubles the work, and
chained filters repeat it again. A generator over a one-element array is a point the
filter does not cross, so the columns are computed once and then filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns, each evaluated once per row."""
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
