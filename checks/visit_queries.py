"""Queries on sources, visits, geography and the cohort."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from plumeline.config import GEOGRAPHIC_PRECISION, layered_map
from plumeline.functions import dates, privacy
from plumeline.operators import cohort, geocode, harmonize, sampling
from plumeline.plans import explore, quality
from plumeline.session import scratch_path
from plumeline.sources import bronze, tables

from . import inputs
from .bronze_files import HARMONIZED_SQL, write_bronze, write_override_bronze
from .registry import query
from .sql import FLAGS, with_tables
from .views import view


@query("dataset_scan", """
select o_custkey as person_key, o_orderkey as visit_id, o_orderstatus
from orders where o_orderkey % 2 = 0 and o_orderstatus = 'F'""")
def dataset_scan(spark, sf):
    """Projection and filter reach the scan of a dataset."""
    orders = tables.read_dataset(spark, f"{sf}/orders.parquet")
    return orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0)).select(
        F.col("o_custkey").alias("person_key"), F.col("o_orderkey").alias("visit_id"),
        "o_orderstatus")


@query("bronze_visits_by_type", with_tables(
    "select db_type, count(*) as n_visits from v_visit group by db_type", "v_visit"))
def bronze_visits_by_type(spark, sf):
    """Database type of each row from the path of its file, in one mixed scan."""
    raw = (spark.read.option("recursiveFileLookup", True).schema("AGE string")
           .parquet(write_bronze(spark, sf)))
    return raw.groupBy(bronze.db_type_column(F.col("_metadata.file_path")).alias("db_type")).agg(
        F.count(F.lit(1)).alias("n_visits"))


@query("bronze_inventory", with_tables("""
select db_type, case db_type
  when 'SID' then 'YEAR,AMONTH,DMONTH,KEY,VISITLINK,DX1,DX2,DX_ADMITTING,ECODE1,ECODE2,ZIP,HOSPST,HOSPSTCO,LOS,AGE,FEMALE,RACE'
  when 'SEDD' then 'year,admit_month,key,person_key,I10_DX1,I10_DX2,I10_DX_Visit_Reason1,I10_ECODE1,zip5,state,county,duration,AGE,FEMALE,RACE'
  else 'YEAR,AMONTH,KEY,I10_DX1,DX2,dx_reason,ZIPCODE,AGE,FEMALE,RACE' end as columns,
  case db_type when 'SID' then 3 when 'SEDD' then 2 else 1 end as n_files
from v_visit group by db_type""", "v_visit"))
def bronze_inventory(spark, sf):
    return quality.bronze_inventory(spark, write_bronze(spark, sf))


@query("harmonize_visits", with_tables(HARMONIZED_SQL, "v_visit"))
def harmonize_visits(spark, sf):
    return harmonize.harmonize(spark, write_bronze(spark, sf), inputs.SALT)


@query("silver_persons", with_tables("""
select distinct person_id, cast(null as varchar) as sex, cast(null as varchar) as age_group,
  cast(null as varchar) as race, cast(null as varchar) as payer from h""", "v_visit",
    extra={"h": HARMONIZED_SQL}))
def silver_persons(spark, sf):
    return harmonize.persons(harmonize.harmonize(spark, write_bronze(spark, sf), inputs.SALT))


@query("column_overrides", with_tables("""
select visit_id, case visit_id % 3 when 0 then coalesce(dx1, '')
  when 1 then concat_ws(';', dx1, coalesce(dx2, 'Z00')) else coalesce(dx2, 'Z00') end as dx_all
from v_visit""", "v_visit"))
def column_overrides(spark, sf):
    """Per-state and per-year entries of the column map, chosen per file group."""
    root = write_override_bronze(spark, sf)
    return harmonize.harmonize(spark, root, inputs.SALT, overrides=True).select(
        "visit_id", "dx_all")


@query("padded_zip", with_tables("""
select visit_id, lpad(cast(cast(zip5 as int) % 1000 as varchar), 5, '0') as zip5
from v_visit""", "v_visit"))
def padded_zip(spark, sf):
    """Zips stored as numbers get their leading zeros back."""
    raw = view(spark, sf, "v_visit").select(
        F.col("visit_id").alias("KEY"), (F.col("zip5").cast("int") % 1000).cast("double").alias("ZIP"))
    return harmonize.normalize_visits(raw, "SID", inputs.SALT, pad_zip=True,
                                      column_map=layered_map("SID")).select(
        F.col("visit_id").cast("long").alias("visit_id"), "zip5")


@query("partitioned_sink", with_tables("""
select year, count(*) as n, cast(sum(n_visits) as bigint) as n_visits from person_month
where year >= 1997 group by year""", "person_month"))
def partitioned_sink(spark, sf):
    """Cohort written by year and read back; the year filter prunes folders."""
    path = tables.write_dataset(inputs.months(spark, sf), scratch_path(spark, "gold"), ["year"])
    return (tables.read_dataset(spark, path).filter(F.col("year") >= 1997)
            .groupBy("year").agg(F.count(F.lit(1)).alias("n"),
                                 F.sum("n_visits").alias("n_visits")))


@query("crosswalk_source", with_tables("select zip, tract, res_ratio from v_crosswalk",
                                       "v_crosswalk"))
def crosswalk_source(spark, sf):
    path = tables.write_csv(view(spark, sf, "v_crosswalk"), scratch_path(spark, "crosswalk"))
    return tables.read_crosswalk(spark, path)


def _crosswalk_as(fmt):
    def run(spark, sf):
        path = scratch_path(spark, "crosswalk")
        view(spark, sf, "v_crosswalk").write.format(fmt).save(path)
        return tables.read_crosswalk(spark, path, fmt)
    return run


for _fmt in ("json", "parquet"):
    query(f"crosswalk_{_fmt}", with_tables("select zip, tract, res_ratio from v_crosswalk",
                                           "v_crosswalk"))(_crosswalk_as(_fmt))


@query("best_tract", with_tables("select * from best_tract", "best_tract"))
def best_tract(spark, sf):
    return geocode.best_tract(view(spark, sf, "v_crosswalk"))


@query("geocode_visits", with_tables("select * from geocoded", "geocoded"))
def geocode_visits(spark, sf):
    return inputs.geocoded(spark, sf)


@query("geocode_match_rate", with_tables("""
select 'tract_geoid' as column_name, count(tract_geoid) as n_present, count(*) as n_rows,
  round(100.0 * count(tract_geoid) / count(*), 1) as pct_present from geocoded""", "geocoded"))
def geocode_match_rate(spark, sf):
    return quality.coverage(inputs.geocoded(spark, sf), ["tract_geoid"])


@query("visit_phenotypes", with_tables(
    f"select visit_id, {', '.join(FLAGS)} from flagged", "flagged"))
def visit_phenotypes(spark, sf):
    return cohort.add_phenotypes(inputs.visits(spark, sf)).select("visit_id", *FLAGS)


@query("phenotypes_by_era", with_tables("""
select visit_id, case when admit_date < date '1998-01-01'
    then coalesce(regexp_matches(dx_primary, '^493'), false)
    else coalesce(regexp_matches(dx_primary, '^J45'), false) end as asthma_flag,
  case when admit_date < date '1998-01-01'
    then coalesce(regexp_matches(dx_primary, '^25'), false)
    else coalesce(regexp_matches(dx_primary, '^E1[013]'), false) end as diabetes_flag
from visit""", "visit"))
def phenotypes_by_era(spark, sf):
    """ICD-9 prefixes before a switch date and ICD-10 prefixes from it on."""
    return cohort.add_phenotypes(inputs.visits(spark, sf), split_at=date(1998, 1, 1)).select(
        "visit_id", "asthma_flag", "diabetes_flag")


@query("person_month", with_tables("select * from person_month", "person_month"))
def person_month(spark, sf):
    return inputs.months(spark, sf)


@query("asthma_person_month", with_tables("""
select *, cast(year(ym) as int) as year from (
select person_id, cast(date_trunc('month', admit_date) as date) as ym,
  arg_max(zip5, visit_id) filter (where zip5 is not null) as zip5,
  cast(null as varchar) as tract_geoid, count(*) as n_visits,
  bool_or(coalesce(starts_with(dx_primary, 'J45'), false)) as asthma_flag
from visit group by all)""".replace("group by all", "group by 1, 2"), "visit"))
def asthma_person_month(spark, sf):
    return cohort.asthma_person_month(inputs.visits(spark, sf))


@query("cohort_summary", with_tables("""
select count(*) as n_records, count(distinct person_id) as n_persons, min(ym) as min_date,
  max(ym) as max_date, round(avg(n_visits), 2) as avg_visits,
  count(*) filter (where tract_geoid is null and zip5 is null) as missing_geo,
  round(100.0 * count(*) filter (where tract_geoid is null and zip5 is null) / count(*), 1)
    as pct_missing_geo
from person_month""", "person_month"))
def cohort_summary(spark, sf):
    return quality.cohort_summary(inputs.months(spark, sf))


_PREVALENCE = "\nunion all ".join(
    f"select '{f}' as phenotype, count(*) filter (where {f}) as n_positive, "
    f"round(100.0 * count(*) filter (where {f}) / count(*), 2) as pct_positive from {{source}}"
    for f in FLAGS)


@query("phenotype_prevalence", with_tables(_PREVALENCE.format(source="person_month"),
                                           "person_month"))
def phenotype_prevalence(spark, sf):
    return quality.prevalence(inputs.months(spark, sf))


@query("sampled_prevalence", with_tables(
    _PREVALENCE.format(source="sampled"), "person_month",
    extra={"sampled": "select * from person_month order by person_id, ym limit 1000"}))
def sampled_prevalence(spark, sf):
    """Prevalence among the first 1,000 rows, divided by the rows there are."""
    sample = sampling.first_rows(inputs.months(spark, sf), 1000, "person_id", "ym")
    return quality.prevalence(sample)



@query("cohort_tracts", with_tables(
    "select distinct tract_geoid as geo_id from person_month where tract_geoid is not null",
    "person_month"))
def cohort_tracts(spark, sf):
    return cohort.cohort_geographies(inputs.months(spark, sf), "tract")


@query("cohort_zips", with_tables(
    "select distinct zip5 as geo_id from person_month where zip5 is not null", "person_month"))
def cohort_zips(spark, sf):
    return cohort.cohort_geographies(inputs.months(spark, sf), "zip5")


@query("coarse_precision", with_tables("""
select date_trunc('year', ym)::date as period, left(tract_geoid, 5) as county,
  left(tract_geoid, 2) as state, count(*) as n
from person_month group by 1, 2, 3""", "person_month"))
def coarse_precision(spark, sf):
    """Dates to years and tracts to counties and states."""
    geo = {"tract": F.col("tract_geoid"), "zip5": F.col("zip5")}
    return (inputs.months(spark, sf)
            .groupBy(privacy.coarsen_date(F.col("ym"), "year").alias("period"),
                     privacy.coarsen_geography("county", **geo).alias("county"),
                     privacy.coarsen_geography("state", **geo).alias("state"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("suppressed_cells", with_tables("""
select tract_geoid, ym, case when count(*) >= 11 then count(*) end as n,
  case when sum(n_visits) >= 11 then cast(sum(n_visits) as bigint) end as n_visits
from person_month group by 1, 2""", "person_month"))
def suppressed_cells(spark, sf):
    geo = privacy.coarsen_geography(GEOGRAPHIC_PRECISION, tract=F.col("tract_geoid"),
                                    zip5=F.col("zip5"))
    cells = inputs.months(spark, sf).groupBy(geo.alias("tract_geoid"), "ym").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_visits").alias("n_visits"))
    return privacy.suppress_small(cells, ["n", "n_visits"])


@query("visit_summary", with_tables("""
select count(*) as n_visits, count(distinct person_id) as n_persons,
  min(admit_date) as min_date, max(admit_date) as max_date,
  count(*) - count(dx_primary) as missing_dx, count(*) - count(zip5) as missing_zip,
  count(*) - count(tract_geoid) as missing_tract,
  round(100.0 * (count(*) - count(dx_primary)) / count(*), 1) as pct_missing_dx,
  round(100.0 * (count(*) - count(zip5)) / count(*), 1) as pct_missing_zip,
  round(100.0 * (count(*) - count(tract_geoid)) / count(*), 1) as pct_missing_tract
from geocoded""", "geocoded"))
def visit_summary(spark, sf):
    return quality.visit_summary(inputs.geocoded(spark, sf))


@query("repeat_persons", with_tables("""
select count(*) - count(distinct person_id) as n_repeat from (
  select * from visit order by visit_id limit 10000)""", "visit"))
def repeat_persons(spark, sf):
    return quality.repeat_persons(sampling.first_rows(inputs.visits(spark, sf), 10_000,
                                                      "visit_id"))


@query("top_chapters", with_tables("""
select left(dx_primary, 1) as dx_chapter, count(*) as n from visit
where dx_primary is not null group by 1 order by n desc, 1 limit 10""", "visit"))
def top_chapters(spark, sf):
    return quality.top_chapters(inputs.visits(spark, sf))


@query("row_sample", with_tables("""
select visit_id, person_id, admit_date, dx_primary, zip5 from visit
order by visit_id limit 100""", "visit"))
def row_sample(spark, sf):
    return sampling.first_rows(inputs.visits(spark, sf), 100, "visit_id").select(
        "visit_id", "person_id", "admit_date", "dx_primary", "zip5")


@query("cohort_overview", with_tables("""
select count(distinct person_id) as n_persons, count(*) as n_person_months,
  min(ym) as min_date, max(ym) as max_date, count(tract_geoid) as n_with_tract,
  round(100.0 * count(tract_geoid) / count(*), 1) as pct_with_tract,
  count(zip5) as n_with_zip, round(100.0 * count(zip5) / count(*), 1) as pct_with_zip
from person_month""", "person_month"))
def cohort_overview(spark, sf):
    return explore.cohort_overview(inputs.months(spark, sf))


@query("cohort_timeline", with_tables("""
select ym, count(*) as n_person_months, count(distinct person_id) as n_persons
from person_month group by ym""", "person_month"))
def cohort_timeline(spark, sf):
    return explore.timeline(inputs.months(spark, sf))


@query("geographic_coverage", with_tables("""
select zip5, count(*) as n_person_months, count(tract_geoid) as n_with_tract
from person_month group by zip5""", "person_month"))
def geographic_coverage(spark, sf):
    return explore.geographic_coverage(inputs.months(spark, sf))


@query("calendar_fields", with_tables("""
select visit_id, cast(year(admit_date) as int) as year, cast(month(admit_date) as int) as month,
  ['winter', 'winter', 'spring', 'spring', 'spring', 'summer', 'summer', 'summer', 'fall',
   'fall', 'fall', 'winter'][cast(month(admit_date) as int)] as season
from visit""", "visit"))
def calendar_fields(spark, sf):
    """Year, month and season of each admission."""
    month = F.month("admit_date")
    return inputs.visits(spark, sf).select("visit_id", F.year("admit_date").alias("year"),
                                           month.alias("month"), dates.season(month).alias("season"))
