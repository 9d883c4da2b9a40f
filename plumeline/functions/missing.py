"""NaN is a missing value, as NULL is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def no_nan(value: Column) -> Column:
    """``value`` with NaN read as NULL."""
    return F.when(~F.isnan(value), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN read as NULL in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(F.col(f"`{c}`")) for c in floats}) if floats else df
