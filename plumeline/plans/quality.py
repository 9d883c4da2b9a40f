"""Quality report: one aggregate per layer of the study."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.missing import nan_to_null
from ..operators.cohort import flag_columns
from ..sources.bronze import group_by_schema


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(100 * part / F.nullif(whole, F.lit(0)), digits)


def missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def bronze_inventory(spark: SparkSession, bronze: str) -> DataFrame:
    """File groups below ``bronze``: database, files and columns."""
    rows = [(g.db_type, len(g.paths), ",".join(g.read(spark).columns))
            for g in group_by_schema(spark, bronze)]
    return spark.createDataFrame(rows, "db_type string, n_files int, columns string")


def coverage(df: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """Present rows (neither NULL nor NaN) and percent per column, in one pass."""
    df = nan_to_null(df.select(*columns))
    total = F.count(F.lit(1))
    parts = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_present"),
                      total.alias("n_rows"), percent(F.count(c), total, digits).alias("pct_present"))
             for c in columns]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def prevalence(df: DataFrame, digits: int = 2) -> DataFrame:
    """Positive rows and percent per phenotype flag, in one pass."""
    total = F.count(F.lit(1))
    parts = [F.struct(F.lit(f).alias("phenotype"), F.count_if(f).alias("n_positive"),
                      percent(F.count_if(f), total, digits).alias("pct_positive"))
             for f in flag_columns(df)]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def visit_summary(visits: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    gaps = {"dx": "dx_primary", "zip": "zip5", "tract": "tract_geoid"}
    keyed = ([F.count_if("person_key_missing").alias("person_key_missing")]
             if "person_key_missing" in visits.columns else [])
    return visits.agg(
        total.alias("n_visits"), F.count_distinct("person_id").alias("n_persons"),
        F.min("admit_date").alias("min_date"), F.max("admit_date").alias("max_date"),
        *[missing(c).alias(f"missing_{n}") for n, c in gaps.items()],
        *[percent(missing(c), total, 1).alias(f"pct_missing_{n}") for n, c in gaps.items()],
        *keyed)


def repeat_persons(visits: DataFrame) -> DataFrame:
    """Visits beyond each person's first."""
    return visits.agg((F.count("person_id") - F.count_distinct("person_id")).alias("n_repeat"))


def top_chapters(visits: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent first characters of the primary diagnosis."""
    return (visits.filter(F.col("dx_primary").isNotNull())
            .groupBy(F.substring("dx_primary", 1, 1).alias("dx_chapter"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dx_chapter").limit(k))


def cohort_summary(months: DataFrame) -> DataFrame:
    """Persons, rows, date range, mean visits and rows without any geography."""
    lost = F.count_if(F.col("tract_geoid").isNull() & F.col("zip5").isNull())
    total = F.count(F.lit(1))
    return months.agg(
        total.alias("n_records"), F.count_distinct("person_id").alias("n_persons"),
        F.min("ym").alias("min_date"), F.max("ym").alias("max_date"),
        F.round(F.avg("n_visits"), 2).alias("avg_visits"), lost.alias("missing_geo"),
        percent(lost, total, 1).alias("pct_missing_geo"))


def daily_completeness(daily: DataFrame) -> DataFrame:
    return nan_to_null(daily).groupBy("exposure_id", "geo_type").agg(
        F.count(F.lit(1)).alias("n_obs"), F.count_distinct("geo_id").alias("n_geos"),
        F.min("obs_date").alias("min_date"), F.max("obs_date").alias("max_date"),
        F.avg("value").alias("mean_val"),
        (100 * missing("value") / F.count(F.lit(1))).alias("pct_missing"))


def rollup_by_metric(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("exposure_id", "metric").agg(
        F.count(F.lit(1)).alias("n_person_months"), F.avg("value").alias("mean_val"))


def results_by_model(results: DataFrame) -> DataFrame:
    """Tests, hits and median rows per model; groups hold one row per test."""
    return results.groupBy("model_spec_id").agg(
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(F.col("p_value") < 0.05).alias("n_sig_p05"),
        F.count_if(F.col("q_value") < 0.05).alias("n_sig_q05"),
        F.median("n").alias("median_n"))


def results_by_outcome(results: DataFrame) -> DataFrame:
    return (results.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(F.col("q_value") < 0.05).alias("n_sig_q05"))
        .orderBy(F.desc("n_sig_q05"), "outcome"))


def test_summary(results: DataFrame) -> DataFrame:
    """Tests and hits under each criterion, per model and stratum."""
    return results.groupBy("model_spec_id", "strata").agg(
        F.count(F.lit(1)).alias("n_tests"),
        F.count_if(F.col("p_value") < 0.05).alias("n_sig_p05"),
        F.count_if(F.col("p_adj_fdr") < 0.05).alias("n_sig_fdr"),
        F.count_if(F.col("p_adj_bonferroni") < 0.05).alias("n_sig_bonf"))
