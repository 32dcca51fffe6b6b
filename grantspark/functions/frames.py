"""Frame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns evaluated exactly once per row.

    They come out of a one-row generator, so that later filters and projections refer to their values
    instead of copying long text rules through the plan.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
