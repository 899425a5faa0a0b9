"""How work is laid out: expressions evaluated once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later filters and projections can use without evaluating them again.

    The optimizer copies a column's expression into every filter pushed below
    it, which would repeat a scan of a long text. It does not look through a
    generator, so the columns come out of one with exactly one row.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))
