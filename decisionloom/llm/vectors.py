"""Vectors that searches and joins take part in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null, empty nor zero and holds finite components only."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0))
