"""Study tables built from the adapter views with the library's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumeline.config import feature_names
from plumeline.functions import dates, privacy
from plumeline.operators import cohort, exposures, geocode, rollup
from plumeline.session import materialize

from .views import view

SALT = "check-salt"
# The driver's dates lie before the years the study configuration admits.
YEARS = (1990, 2024)
EXPOSURE_NAMES = {v: n for v, n in feature_names().items() if v in exposures.EXPOSURE_VARIABLES}
EXPOSURES = list(EXPOSURE_NAMES.values())


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "v_visit")
    return raw.select(
        "visit_id",
        privacy.salted_hash(F.col("person_key").cast("string"), SALT).alias("person_id"),
        dates.month_start(F.col("src_year"), F.col("src_month")).alias("admit_date"),
        F.col("dx1").alias("dx_primary"), "zip5", "age", "female", "race", "db_type")


def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geocode.attach_tract(visits(spark, sf_dir), view(spark, sf_dir, "v_crosswalk"))


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.person_month(cohort.add_phenotypes(geocoded(spark, sf_dir)))


def months_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person-months as the written table later stages start from."""
    return materialize(months(spark, sf_dir), "person_month")


def exposure_subset(spark: SparkSession, sf_dir: str,
                    cohort_months: DataFrame | None = None) -> DataFrame:
    return exposures.cohort_subset(view(spark, sf_dir, "v_exposure"),
                                   cohort_months or months_table(spark, sf_dir), years=YEARS)


def person_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort_months = months_table(spark, sf_dir)
    wide = exposures.to_wide(exposure_subset(spark, sf_dir, cohort_months))
    return exposures.attach_exposures(cohort_months, materialize(wide, "exposures_wide"))


def person_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.exposure_rollup(person_exposures(spark, sf_dir))


def scan_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person-months with exposures under their public ids and a numeric year."""
    return (person_exposures(spark, sf_dir).withColumnsRenamed(EXPOSURE_NAMES)
            .withColumn("year", F.col("year").cast("int")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_exposure_daily")
