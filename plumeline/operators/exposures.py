"""Monthly and daily exposure series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..config import (DAILY_DEFAULT_SOURCE, DAILY_SOURCES, DAILY_VERSION, EXPOSURE_PREFIXES, EXPOSURE_VARIABLES,
                      EXPOSURE_YEARS, THRESHOLDS, Threshold)
from ..functions.missing import nan_to_null, no_nan
from .joins import join_null_safe, join_spread


def cohort_subset(exposures: DataFrame, months: DataFrame, *,
                  variables: Iterable[str] = EXPOSURE_VARIABLES,
                  years: tuple[int, int] = EXPOSURE_YEARS) -> DataFrame:
    """Exposure rows of the cohort's years and zips, for the wanted variables.

    The text year must be a real year inside ``years``; the cohort's own range
    is read first (one row), so that both limits reach the file scan as plain
    predicates.
    """
    first, last = months.agg(F.min("year"), F.max("year")).first()
    if first is None:
        return exposures.limit(0)
    low, high = max(years[0], first), min(years[1], last)
    # Text equality keeps stray forms such as '2012.0' out, as a year list would.
    wanted = nan_to_null(exposures).filter(F.col("year").isin([str(y) for y in range(low, high + 1)])
                              & F.col("variable").isin(list(variables)))
    zips = months.select(F.col("zip5").alias("geoid")).distinct()
    return join_null_safe(wanted, zips, ["geoid"], "left_semi")


def to_wide(exposures: DataFrame, *, variables: Iterable[str] = EXPOSURE_VARIABLES,
            keys: tuple[str, ...] = ("zip5", "year", "month"), names: str = "variable",
            values: str = "value", duplicates: str = "error") -> DataFrame:
    """Long to wide: one column per variable.

    One conditional aggregate per variable needs a single shuffle on the keys
    (the pivot operator would aggregate twice).  A key that occurs twice for a
    variable fails the job, or is averaged with ``duplicates='mean'``.
    """
    if duplicates not in ("error", "mean"):
        raise ValueError("duplicates must be 'error' or 'mean'")
    if "geoid" in exposures.columns:
        exposures = exposures.withColumnRenamed("geoid", "zip5")

    def cell(variable: str) -> Column:
        value = F.when(F.col(names) == variable, no_nan(F.col(values).cast("double")))
        if duplicates == "mean":
            return F.avg(value)
        repeats = F.count_if(F.col(names) == variable) > 1
        return F.when(repeats, F.raise_error(F.concat(
            F.lit(f"several {variable} values for key "),
            F.to_json(F.struct(*keys))))).otherwise(F.max(value))

    return exposures.groupBy(*keys).agg(*[cell(v).alias(v) for v in variables])


def attach_exposures(months: DataFrame, exposures_wide: DataFrame) -> DataFrame:
    """Person-months with their zip's exposures of the month (left join).

    ``year`` is text on the exposure side and becomes text in the result.  A
    NULL zip is a key like any other and may be that of most rows: the rows of a
    month without a zip are dealt to several tasks.
    """
    keyed = months.withColumns({"year": F.year("ym").cast("string"), "month": F.month("ym")})
    return join_spread(keyed, exposures_wide, ["zip5", "year", "month"], F.col("zip5").isNull())


def exposure_columns(df: DataFrame) -> list[str]:
    """Columns that carry an exposure under its public id, told by how their names begin."""
    return [c for c in df.columns if c.startswith(EXPOSURE_PREFIXES)]


def source_of(exposure_id: Column) -> Column:
    chosen = F.lit(DAILY_DEFAULT_SOURCE)
    for prefix, source in DAILY_SOURCES.items():
        chosen = F.when(exposure_id.startswith(prefix), source).otherwise(chosen)
    return chosen


def daily_long(wide: DataFrame, *, version: str = DAILY_VERSION) -> DataFrame:
    """Wide daily covariates to the long daily table, tagged and year-stamped."""
    keys = ["date", "geo_id", "geo_type"]
    wide = nan_to_null(wide)
    long = wide.unpivot(keys, [c for c in wide.columns if c not in keys], "exposure_id", "value")
    return long.select(
        F.col("date").alias("obs_date"), "geo_id", "geo_type", "exposure_id", "value",
        source_of(F.col("exposure_id")).alias("source"), F.lit(version).alias("version"),
        F.year("date").alias("year"))


def series(daily: DataFrame, *, geo_id: str, geo_type: str, exposure_id: str,
           start: str, end: str) -> DataFrame:
    """One place's daily series of one exposure, in date order."""
    return (nan_to_null(daily).filter((F.col("geo_type") == geo_type) & (F.col("exposure_id") == exposure_id)
                         & (F.col("geo_id") == geo_id)
                         & F.col("obs_date").between(F.lit(start).cast("date"),
                                                     F.lit(end).cast("date")))
            .orderBy("obs_date"))


def days_beyond(value: Column, threshold: Threshold) -> Column:
    scaled = value * threshold.unit_factor
    return F.count_if(scaled < threshold.value if threshold.below else scaled > threshold.value)


def monthly_metrics(daily: DataFrame, *, thresholds: Iterable[Threshold] = THRESHOLDS) -> DataFrame:
    """Daily series to monthly mean, sum, max, p90, available and threshold days.

    A configured metric set without a published implementation: the threshold
    columns count days beyond each limit for exposures matching its prefix and
    are NULL for the others.
    """
    keys = ["geo_id", "geo_type", "exposure_id", "ym"]
    daily = nan_to_null(daily).withColumn("ym", F.trunc("obs_date", "month"))
    value = F.col("value")
    metrics = {
        "mean": F.avg(value), "sum": F.sum(value), "max": F.max(value),
        "days_available": F.count(value),
        **{t.id: F.when(F.col("exposure_id").startswith(t.prefix), days_beyond(value, t))
           for t in thresholds},
    }
    # A month of days at most per group, so the built-in percentile holds a group easily.
    return daily.groupBy(*keys).agg(*[c.alias(n) for n, c in metrics.items()],
                                    F.percentile("value", F.lit(0.9)).alias("p90"))
