"""Stable row samples."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order, so that a rerun gives the same rows."""
    if not order:
        raise ValueError("a sample needs an order to be repeatable")
    return df.orderBy(*order).limit(n)
