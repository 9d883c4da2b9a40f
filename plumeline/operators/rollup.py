"""Person-month exposures to the long rollup table and back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..config import FEATURES, Feature, feature_names
from ..functions.missing import no_nan
from .exposures import to_wide

# Stands in for a missing month inside join keys, so that both sides can be
# matched by plain equality and share one hash partitioning.
_NO_MONTH = "0001-01-01"


def available_features(columns: Sequence[str],
                       features: tuple[Feature, ...] = FEATURES) -> dict[str, str]:
    """Variable to exposure id for the features whose column exists."""
    found = {var: name for var, name in feature_names(features).items() if var in columns}
    if not found:
        raise ValueError("none of the configured exposure columns is present")
    return found


def exposure_rollup(person_exposures: DataFrame,
                    features: tuple[Feature, ...] = FEATURES) -> DataFrame:
    """(person, month, exposure) rows; missing values dropped, metric 'mean'.

    Variables are renamed before the unpivot, so the map needs no join.
    """
    names = available_features(person_exposures.columns, features)
    renamed = person_exposures.select("person_id", "ym",
                                      *[no_nan(F.col(v).cast("double")).alias(n) for v, n in names.items()])
    long = renamed.unpivot(["person_id", "ym"], list(names.values()), "exposure_id", "value")
    return (long.filter(F.col("value").isNotNull())
            .select("person_id", "ym", "exposure_id", F.lit("mean").alias("metric"), "value"))


def attach_rollup(months: DataFrame, rollup: DataFrame, exposure_ids: Iterable[str]) -> DataFrame:
    """Person-months with one column per rolled-up exposure (left join).

    The pivot and the join use the same two keys, so the rollup is shuffled
    once and the cohort once.
    """
    ids = list(exposure_ids)
    month_key = F.coalesce("ym", F.lit(_NO_MONTH).cast("date"))
    wide = to_wide(
        rollup.filter(F.col("metric") == "mean").select(
            "person_id", month_key.alias("month_key"), "exposure_id", "value"),
        variables=ids, keys=("person_id", "month_key"), names="exposure_id")
    return (months.withColumn("month_key", month_key)
            .join(wide, ["person_id", "month_key"], "left").drop("month_key"))


def rollup_summary(rollup: DataFrame) -> DataFrame:
    """Rows, smallest, mean and largest value of each exposure."""
    return rollup.groupBy("exposure_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min_val"),
        F.avg("value").alias("mean_val"), F.max("value").alias("max_val"))
