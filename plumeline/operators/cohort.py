"""Visits to person-months."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DB_TYPES, PHENOTYPES, Phenotype
from ..functions import codes, dates


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_flag")]


def add_phenotypes(visits: DataFrame, phenotypes: Iterable[Phenotype] = PHENOTYPES,
                   split_at: date | None = None) -> DataFrame:
    """One boolean ``<name>_flag`` per phenotype, from the primary diagnosis."""
    return visits.withColumns({
        p.flag: codes.phenotype_flag("dx_primary", p, on="admit_date", split_at=split_at)
        for p in phenotypes})


def last_present(value: str, order: str = "visit_id") -> Column:
    """Value of the last row that has one; ties go to the larger value."""
    return F.max(F.when(F.col(value).isNotNull(), F.struct(order, value)))[value]


def first_present(value: str, order: str = "visit_id") -> Column:
    """Value of the first row that has one; ties go to the smaller value."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct(order, value)))[value]


def joined_distinct(value: str, known: Sequence[str], separator: str = ",") -> Column:
    """Sorted distinct non-null values as one text; no value gives ''.

    The possible values are few and known, so one boolean per value replaces a
    collected set; a value outside them fails the job instead of vanishing.
    """
    column = F.col(value)
    stray = F.max(F.when(~column.isin(list(known)), column))
    text = F.concat_ws(separator, *[F.when(F.bool_or(column == k), k) for k in sorted(known)])
    return F.when(stray.isNotNull(), F.raise_error(
        F.concat(F.lit(f"unknown {value}: "), stray))).otherwise(text)


def person_month(visits: DataFrame) -> DataFrame:
    """One row per person and admission month.

    Needs flagged visits (:func:`add_phenotypes`).  Order inside a month is
    the visit id, since visits carry no finer date.  One hash shuffle on
    (person_id, ym) after a map-side reduction, so one person holding a large
    share of all visits costs a few hundred rows per task.
    """
    flags = flag_columns(visits)
    months = visits.groupBy("person_id", F.col("admit_date").alias("ym")).agg(
        last_present("zip5").alias("zip5"),
        last_present("tract_geoid").alias("tract_geoid"),
        F.count(F.lit(1)).alias("n_visits"),
        joined_distinct("db_type", DB_TYPES).alias("db_type"),
        first_present("age").alias("age"),
        first_present("female").alias("female"),
        first_present("race").alias("race"),
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags])
    return with_calendar(months)


def with_calendar(months: DataFrame) -> DataFrame:
    return months.withColumns({
        "year": F.year("ym"),
        "month": F.month("ym"),
        "season": dates.season(F.month("ym")),
    })


def asthma_person_month(visits: DataFrame) -> DataFrame:
    """The earlier, narrower cohort: J45 only, no tract, no demographics."""
    flagged = visits.withColumn("asthma_flag", codes.starts_with_any("dx_primary", ["J45"]))
    return (flagged.groupBy("person_id", dates.month_floor(F.col("admit_date")).alias("ym"))
            .agg(last_present("zip5").alias("zip5"),
                 F.lit(None).cast("string").alias("tract_geoid"),
                 F.count(F.lit(1)).alias("n_visits"),
                 F.bool_or("asthma_flag").alias("asthma_flag"))
            .withColumn("year", F.year("ym")))


def cohort_geographies(months: DataFrame, geo_mode: str) -> DataFrame:
    """Distinct geographies of the cohort at the configured level."""
    column = "tract_geoid" if geo_mode == "tract" else "zip5"
    return months.filter(F.col(column).isNotNull()).select(F.col(column).alias("geo_id")).distinct()
