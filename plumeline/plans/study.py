"""The staged study run: raw visits and exposures to association results.

Each stage reads the tables of earlier stages and writes its own, so a failed
run continues from the last finished table.  No stage writes to a folder it
reads from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EXPOSURE_YEARS, MODEL_SPECS, ModelSpec
from ..exwas import irls, scan
from ..operators import cohort, exposures, geocode, harmonize, rollup
from ..sources import tables


@dataclass(frozen=True)
class Study:
    """Where a study lives and what it is built from."""

    spark: SparkSession
    root: str
    salt: str
    crosswalk: str
    monthly_exposures: str
    crosswalk_format: str = "csv"
    years: tuple[int, int] = EXPOSURE_YEARS
    specs: tuple[ModelSpec, ...] = MODEL_SPECS
    gate: irls.Gate = irls.Gate()

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, table: str) -> DataFrame:
        return tables.read_dataset(self.spark, self.path(table))

    def save(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        tables.write_dataset(df, self.path(table), partition_by)


def silver(study: Study) -> None:
    visits = harmonize.harmonize(study.spark, study.path("bronze"), study.salt)
    study.save(visits, "silver/visit", ["year"])
    study.save(harmonize.persons(study.table("silver/visit")), "silver/person")


def geocoding(study: Study) -> None:
    crosswalk = tables.read_crosswalk(study.spark, study.crosswalk, study.crosswalk_format)
    study.save(geocode.attach_tract(study.table("silver/visit"), crosswalk),
               "silver/visit_geocoded", ["year"])


def person_months(study: Study) -> None:
    visits = cohort.add_phenotypes(study.table("silver/visit_geocoded"))
    study.save(cohort.person_month(visits), "gold/person_month", ["year"])


def monthly_exposures(study: Study) -> None:
    source = tables.read_monthly_exposures(study.spark, study.monthly_exposures)
    study.save(exposures.cohort_subset(source, study.table("gold/person_month"),
                                       years=study.years), "gold/exposures_monthly")


def joined(study: Study) -> None:
    # The subset keeps only real years; reading back must not turn them into numbers.
    monthly = study.table("gold/exposures_monthly").withColumn("year", F.col("year").cast("string"))
    wide = exposures.attach_exposures(study.table("gold/person_month"), exposures.to_wide(monthly))
    study.save(wide, "gold/person_month_exposures", ["year"])


def rolled_up(study: Study) -> None:
    long = rollup.exposure_rollup(study.table("gold/person_month_exposures"))
    study.save(long, "gold/exposure_rollup", ["exposure_id", "metric"])


def associations(study: Study) -> None:
    # Equal to the scan over the rollup, without pivoting it back first.
    results = scan.scan_joined(study.table("gold/person_month_exposures"), specs=study.specs,
                               gate=study.gate)
    study.save(results, "gold/exwas_result", ["strata", "model_spec_id"])


# In dependency order: the exposure subset needs the cohort's zips and years.
STAGES = {
    "silver": silver, "geocode": geocoding, "cohort": person_months,
    "exposures": monthly_exposures, "join": joined, "rollup": rolled_up, "exwas": associations,
}


def run(study: Study, stages: Sequence[str] = tuple(STAGES)) -> None:
    """Run the named stages in dependency order."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    for name, stage in STAGES.items():
        if name in stages:
            stage(study)
