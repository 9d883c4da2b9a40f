"""Pseudonyms, small-cell suppression and coarser precision."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..config import MIN_CELL_SIZE

# Leading characters of a tract id that name each geography.
_TRACT_PREFIX = {"county": 5, "state": 2}


def salted_hash(key: Column, salt: str) -> Column:
    """SHA-256 of ``key|salt`` as hex text; a missing key stays missing."""
    if not salt:
        raise ValueError("a non-empty salt is required to hash person keys")
    return F.when(key.isNotNull(), F.sha2(F.concat_ws("|", key, F.lit(salt)), 256))


def suppress_small(df: DataFrame, columns: Iterable[str] = ("n",),
                   threshold: int = MIN_CELL_SIZE) -> DataFrame:
    """Blank counts under the threshold in the listed columns."""
    return df.withColumns({c: F.when(F.col(c) >= threshold, F.col(c)) for c in columns})


def coarsen_date(day: Column, precision: str) -> Column:
    if precision == "day":
        return day
    if precision in ("month", "year"):
        return F.trunc(day, precision)
    raise ValueError(f"unknown date precision: {precision}")


def coarsen_geography(precision: str, *, tract: Column, zip5: Column) -> Column:
    """Geography at the asked precision: tract, zip5, county or state."""
    if precision == "tract":
        return tract
    if precision == "zip5":
        return zip5
    if precision in _TRACT_PREFIX:
        return F.substring(tract, 1, _TRACT_PREFIX[precision])
    raise ValueError(f"unknown geographic precision: {precision}")
