"""Queries on monthly and daily exposures, joins and the rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.config import EXPOSURE_VARIABLES
from plumeline.operators import exposures, ranks, rollup
from plumeline.plans import explore, quality
from plumeline.session import scratch_path
from plumeline.sources import tables

from . import inputs
from .registry import query
from .sql import with_tables
from .views import view


@query("monthly_exposure_source", with_tables("""
select variable, year, count(*) as n, min(value) as min_val, max(value) as max_val
from v_exposure group by variable, year""", "v_exposure"))
def monthly_exposure_source(spark, sf):
    """Exposure files below a folder, whose year column also holds other text."""
    root = scratch_path(spark, "monthly")
    view(spark, sf, "v_exposure").write.parquet(f"{root}/extracted/zip_monthly")
    return tables.read_monthly_exposures(spark, root).groupBy("variable", "year").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min_val"),
        F.max("value").alias("max_val"))


@query("exposure_subset", with_tables("select * from exposure_subset", "exposure_subset"))
def exposure_subset(spark, sf):
    return inputs.exposure_subset(spark, sf)


@query("exposure_wide", with_tables("select * from exposure_wide", "exposure_wide"))
def exposure_wide(spark, sf):
    return exposures.to_wide(inputs.exposure_subset(spark, sf))


@query("exposure_wide_mean", with_tables(f"""
select zip5, month, {', '.join(f"round(a_{v}, 8) as {v}" for v in ("tmax", "tmin"))} from (
  select geoid as zip5, month, avg(case when variable = 'tmax' then value end) as a_tmax,
    avg(case when variable = 'tmin' then value end) as a_tmin
  from v_exposure where year <> 'annual' group by 1, 2)""", "v_exposure"))
def exposure_wide_mean(spark, sf):
    """Repeated keys averaged: every year of a zip and month in one cell."""
    source = view(spark, sf, "v_exposure").filter(F.col("year") != "annual")
    wide = exposures.to_wide(source, variables=["tmax", "tmin"], keys=("zip5", "month"),
                             duplicates="mean")
    return wide.select("zip5", "month", F.round("tmax", 8).alias("tmax"),
                       F.round("tmin", 8).alias("tmin"))


@query("person_month_exposures", with_tables("select * from person_exposures",
                                             "person_exposures"))
def person_month_exposures(spark, sf):
    return inputs.person_exposures(spark, sf)


@query("exposure_coverage", with_tables("\nunion all ".join(
    f"select '{v}' as column_name, count({v}) as n_present, count(*) as n_rows, "
    f"round(100.0 * count({v}) / count(*), 1) as pct_present from person_exposures"
    for v in EXPOSURE_VARIABLES), "person_exposures"))
def exposure_coverage(spark, sf):
    return quality.coverage(inputs.person_exposures(spark, sf), EXPOSURE_VARIABLES)


@query("exposure_rollup", with_tables("select * from rollup", "rollup"))
def exposure_rollup(spark, sf):
    return inputs.person_rollup(spark, sf)


@query("rollup_summary", with_tables("""
select exposure_id, count(*) as n, min(value) as min_val, round(avg(value), 6) as mean_val,
  max(value) as max_val from rollup group by exposure_id""", "rollup"))
def rollup_summary(spark, sf):
    return rollup.rollup_summary(inputs.person_rollup(spark, sf)).withColumn(
        "mean_val", F.round("mean_val", 6))


@query("rollup_by_metric", with_tables("""
select exposure_id, metric, count(*) as n_person_months, round(avg(value), 6) as mean_val
from rollup group by exposure_id, metric""", "rollup"))
def rollup_by_metric(spark, sf):
    return quality.rollup_by_metric(inputs.person_rollup(spark, sf)).withColumn(
        "mean_val", F.round("mean_val", 6))


_WIDE_ROLLUP = f"""
select p.person_id, p.ym, p.zip5, p.n_visits, p.asthma_flag, {', '.join(inputs.EXPOSURES)}
from person_month p left join (
  select person_id as pid, ym as m, {', '.join(
      f"max(case when exposure_id = '{e}' then value end) as {e}" for e in inputs.EXPOSURES)}
  from rollup group by 1, 2) w on p.person_id = w.pid and p.ym is not distinct from w.m"""


@query("rollup_join", with_tables(_WIDE_ROLLUP, "rollup"))
def rollup_join(spark, sf):
    """Cohort with one column per rolled-up exposure."""
    wide = rollup.attach_rollup(inputs.months_table(spark, sf), inputs.person_rollup(spark, sf),
                                inputs.EXPOSURES)
    return wide.select("person_id", "ym", "zip5", "n_visits", "asthma_flag", *inputs.EXPOSURES)


@query("rollup_right_join", with_tables(_WIDE_ROLLUP, "rollup"))
def rollup_right_join(spark, sf):
    """The same table with the cohort on the right of the join."""
    wide = exposures.to_wide(inputs.person_rollup(spark, sf), variables=inputs.EXPOSURES,
                             keys=("person_id", "ym"), names="exposure_id")
    months = inputs.months_table(spark, sf)
    return wide.join(months, ["person_id", "ym"], "right").select(
        "person_id", "ym", "zip5", "n_visits", "asthma_flag", *inputs.EXPOSURES)


# ---- daily series --------------------------------------------------------
_WIDE_DAILY = """
select geo_id, geo_type, obs_date as date,
  max(case when exposure_id = 'click' then value end) as hms_click,
  max(case when exposure_id = 'error' then value end) as pm25_error
from v_exposure_daily group by 1, 2, 3"""


@query("daily_exposures", with_tables("""
select date as obs_date, geo_id, geo_type, 'hms_click' as exposure_id, hms_click as value,
  'hms_smoke' as source, '2024-10' as version, cast(year(date) as int) as year from wide
union all
select date, geo_id, geo_type, 'pm25_error', pm25_error, 'pm25_aqs', '2024-10',
  cast(year(date) as int) from wide""", "v_exposure_daily", extra={"wide": _WIDE_DAILY}))
def daily_exposures(spark, sf):
    """Wide daily covariates read from files, then long, tagged and dated."""
    path = scratch_path(spark, "daily")
    kind, value = F.col("exposure_id"), F.col("value")
    (view(spark, sf, "v_exposure_daily")
     .groupBy("geo_id", "geo_type", F.col("obs_date").alias("date"))
     .agg(F.max(F.when(kind == "click", value)).alias("hms_click"),
          F.max(F.when(kind == "error", value)).alias("pm25_error")).write.parquet(path))
    return exposures.daily_long(tables.read_daily_covariates(spark, path))


@query("daily_completeness", with_tables("""
select exposure_id, geo_type, count(*) as n_obs, count(distinct geo_id) as n_geos,
  min(obs_date) as min_date, max(obs_date) as max_date, round(avg(value), 6) as mean_val,
  round(100.0 * (count(*) - count(value)) / count(*), 6) as pct_missing
from v_exposure_daily group by 1, 2""", "v_exposure_daily"))
def daily_completeness(spark, sf):
    return quality.daily_completeness(inputs.daily(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("mean_val", "pct_missing")})


_NAMED_DAILY = """
select * replace (case exposure_id when 'click' then 'pm25_dust' when 'error' then 'temp_max'
    else exposure_id end as exposure_id,
  case exposure_id when 'click' then value * 1e-9 else value end as value)
from v_exposure_daily"""
_MONTHLY = """
select geo_id, geo_type, exposure_id, cast(date_trunc('month', obs_date) as date) as ym,
  round({scale} * avg(value), 8) as mean, round({scale} * sum(value), 6) as sum,
  {scale} * max(value) as max, count(value) as days_available,
  {days}, round({scale} * quantile_cont(value, 0.9), 5) as p90
from named where {where} group by 1, 2, 3, 4"""


def _threshold_days(warm: str, dust: str) -> str:
    return ",\n  ".join([
        f"{'count(*) filter (where value * 1e9 > 35.5)' if dust else 'null'}"
        " as pm25_unhealthy_sensitive",
        f"{'count(*) filter (where value * 1e9 > 55.5)' if dust else 'null'} as pm25_unhealthy",
        "cast(null as bigint) as ozone_unhealthy_sensitive",
        f"{'count(*) filter (where value > 32)' if warm else 'null'} as temp_heat_warning",
        f"{'count(*) filter (where value < 0)' if warm else 'null'} as temp_cold_warning"])


@query("daily_monthly_metrics", with_tables(
    _MONTHLY.format(scale="1e9", days=_threshold_days("", "x"), where="exposure_id = 'pm25_dust'")
    + "\nunion all "
    + _MONTHLY.format(scale="1", days=_threshold_days("x", ""), where="exposure_id = 'temp_max'")
    + "\nunion all "
    + _MONTHLY.format(scale="1", days=_threshold_days("", ""),
                      where="exposure_id not in ('pm25_dust', 'temp_max')"),
    "v_exposure_daily", extra={"named": _NAMED_DAILY}))
def daily_monthly_metrics(spark, sf):
    """Monthly metrics; two series renamed so that thresholds apply to them."""
    kind, value = F.col("exposure_id"), F.col("value")
    named = inputs.daily(spark, sf).select(
        "geo_id", "geo_type", "obs_date",
        F.when(kind == "click", "pm25_dust").when(kind == "error", "temp_max")
        .otherwise(kind).alias("exposure_id"),
        F.when(kind == "click", value * 1e-9).otherwise(value).alias("value"))
    monthly = exposures.monthly_metrics(named)
    scale = F.when(kind == "pm25_dust", 1e9).otherwise(1.0)
    return monthly.withColumns({
        "mean": F.round(scale * F.col("mean"), 8), "sum": F.round(scale * F.col("sum"), 6),
        "p90": F.round(scale * F.col("p90"), 5),
        "max": scale * F.col("max")})


@query("exposure_series", with_tables("""
select * from v_exposure_daily where geo_id = '8' and geo_type = 'zip5'
  and exposure_id = 'click' and obs_date between date '2024-01-05' and date '2024-02-20'""",
    "v_exposure_daily"))
def exposure_series(spark, sf):
    return exposures.series(inputs.daily(spark, sf), geo_id="8", geo_type="zip5",
                            exposure_id="click", start="2024-01-05", end="2024-02-20")


@query("exposure_range_stats", with_tables("""
select exposure_id, geo_type, round(avg(value), 2) as mean_val,
  round(quantile_cont(value, 0.5), 2) as median_val, round(stddev_samp(value), 2) as sd_val,
  round(min(value), 2) as min_val, round(max(value), 2) as max_val,
  count(*) - count(value) as n_missing
from v_exposure_daily group by 1, 2""", "v_exposure_daily"))
def exposure_range_stats(spark, sf):
    return explore.range_statistics(inputs.daily(spark, sf), ["exposure_id", "geo_type"])


@query("chunked_median", with_tables("""
select exposure_id, round(quantile_cont(value, 0.5), 8) as median_val
from v_exposure_daily group by 1""", "v_exposure_daily"))
def chunked_median(spark, sf):
    """The same quantile with another number of ranges."""
    return ranks.grouped_quantile(inputs.daily(spark, sf), ["exposure_id"], "value", 0.5,
                                  alias="median_val", ranges=7).withColumn(
        "median_val", F.round("median_val", 8))


@query("exposure_calendar", with_tables("""
select exposure_id, cast(year(obs_date) as int) as year, cast(month(obs_date) as int) as month,
  count(value) as n_days, round(avg(value), 6) as mean_val
from v_exposure_daily group by 1, 2, 3""", "v_exposure_daily"))
def exposure_calendar(spark, sf):
    return explore.calendar(inputs.daily(spark, sf)).withColumn("mean_val", F.round("mean_val", 6))


@query("exposure_histogram", with_tables("""
select exposure_id, bin, count(*) as n, round(any_value(lo + w * bin), 8) as bin_centre
from (select *, cast(ceil((value - lo) / w - 0.5) as int) as bin from (
  select *, min(value) over g as lo, case when max(value) over g > min(value) over g
    then (max(value) over g - min(value) over g) / 29 else 0.1 end as w
  from v_exposure_daily where value is not null window g as (partition by exposure_id)))
group by 1, 2""", "v_exposure_daily"))
def exposure_histogram(spark, sf):
    return explore.histogram(inputs.daily(spark, sf), "value", ["exposure_id"]).withColumn(
        "bin_centre", F.round("bin_centre", 8))


@query("exposure_options", with_tables(
    "select distinct exposure_id from v_exposure_daily", "v_exposure_daily"))
def exposure_options(spark, sf):
    return explore.options(inputs.daily(spark, sf), "exposure_id")
