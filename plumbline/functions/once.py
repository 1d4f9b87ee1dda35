"""Costly expressions computed once, however often they are used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a costly value several times in one expression, computing it once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often later steps use them.

    A generator of exactly one row keeps the optimizer from copying a costly
    expression into each of its uses and from filtering on it below.
    """
    return df.select(
        "*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    )
