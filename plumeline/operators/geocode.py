"""ZIP code to census tract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .joins import join_spread


def best_tract(crosswalk: DataFrame) -> DataFrame:
    """One tract per zip: the largest residential share, then the lowest id.

    A missing share ranks last.  Written as an aggregate rather than a ranked
    window so that map tasks reduce each zip before the shuffle.
    """
    weight = F.col("res_ratio").try_cast("double")
    rank = F.struct(weight.isNull(), -weight, F.col("tract"))
    return (crosswalk.groupBy(F.col("zip").cast("string").alias("zip5"))
            .agg(F.min_by(F.col("tract").cast("string"), rank).alias("tract_geoid")))


def attach_tract(visits: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Left join of the best tract; an earlier tract column is replaced.

    Visits without a zip share one key, which is dealt to several tasks.
    """
    return join_spread(visits.drop("tract_geoid"), best_tract(crosswalk), ["zip5"], F.col("zip5").isNull())
