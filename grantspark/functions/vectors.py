"""Rules for vectors of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column | str) -> Column:
    """Every member is a number; false for members that are null, not a number or infinite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
