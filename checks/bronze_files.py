"""Raw visit files with drifting schemas, written from the visit view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumeline.session import scratch_path

from .views import view


def write_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Three source layouts below one folder, one per database type.

    SID uses upper-case ICD-9 names, SEDD ICD-10 names, and SASD has no person
    key at all.  SID stores person keys as decimals and SASD zips as doubles.
    Months may be 13, ages may be '.', stays may be '-9'.
    """
    root = f"{scratch_path(spark, 'bronze')}/2024_run"  # a year above the root says nothing
    visits = view(spark, sf_dir, "v_visit").withColumns({
        "bad_month": F.when(F.col("visit_id") % 50 == 0, 13).otherwise(F.col("src_month")),
        "age_text": F.when(F.col("visit_id") % 11 == 0, ".").otherwise(
            F.col("age").cast("int").cast("string")),
        "los_text": F.when(F.col("visit_id") % 13 == 0, "-9").otherwise(
            (F.col("visit_id") % 9).cast("string")),
        "key_gap": F.when(F.col("visit_id") % 17 != 0, F.col("person_key"))})
    # As many files as the inventory query expects.
    _sid(visits).repartition(3).write.parquet(f"{root}/UT/2012/sid_core")
    _sedd(visits).repartition(2).write.parquet(f"{root}/UT/2015/sedd_core")
    _sasd(visits).repartition(1).write.parquet(f"{root}/UT/2013/nested/SASD_core")
    return root


def _common() -> list[Column]:
    return [F.col("age_text").alias("AGE"), F.col("female").cast("string").alias("FEMALE"),
            F.col("race").alias("RACE")]


def _sid(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("db_type") == "SID").select(
        F.col("src_year").alias("YEAR"), F.col("bad_month").alias("AMONTH"),
        F.col("src_month").alias("DMONTH"), F.col("visit_id").alias("KEY"),
        F.col("key_gap").cast("decimal(12,2)").alias("VISITLINK"), F.col("dx1").alias("DX1"),
        F.col("dx2").alias("DX2"), F.col("dx2").alias("DX_ADMITTING"), F.lit("E8800").alias("ECODE1"),
        F.col("dx2").alias("ECODE2"), F.col("zip5").alias("ZIP"), F.lit("UT").alias("HOSPST"),
        F.lit("035").alias("HOSPSTCO"), F.col("los_text").alias("LOS"), *_common())


def _sedd(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("db_type") == "SEDD").select(
        F.col("src_year").alias("year"), F.col("src_month").alias("admit_month"),
        F.col("visit_id").alias("key"), F.col("person_key").cast("double").alias("person_key"),
        F.col("dx1").alias("I10_DX1"), F.col("dx2").alias("I10_DX2"),
        F.col("dx1").alias("I10_DX_Visit_Reason1"), F.col("dx2").alias("I10_ECODE1"),
        F.concat("zip5", F.lit("-0001")).alias("zip5"), F.lit("UT").alias("state"),
        F.lit("049").alias("county"), F.col("los_text").alias("duration"), *_common())


def _sasd(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("db_type") == "SASD").select(
        F.col("src_year").cast("string").alias("YEAR"),
        F.col("src_month").cast("string").alias("AMONTH"), F.col("visit_id").alias("KEY"),
        F.col("dx1").alias("I10_DX1"), F.col("dx2").alias("DX2"), F.col("dx1").alias("dx_reason"),
        F.col("zip5").cast("double").alias("ZIPCODE"), *_common())


# The same rules in SQL, on the visit view directly.
HARMONIZED_SQL = """
select visit_id,
  sha256(concat(cast(case when db_type = 'SASD' then visit_id
    when db_type = 'SID' and visit_id % 17 = 0 then visit_id
    else person_key end as varchar), '|check-salt')) as person_id,
  db_type = 'SASD' or (db_type = 'SID' and visit_id % 17 = 0) as person_key_missing,
  case when db_type = 'SID' and visit_id % 50 = 0 then null
    else make_date(src_year, src_month, 1) end as admit_date,
  case when db_type = 'SID' then make_date(src_year, src_month, 1) end as discharge_date,
  dx1 as dx_primary,
  case when db_type = 'SID' then dx2 else dx1 end as dx_admit,
  concat_ws(';', dx1, dx2) as dx_all,
  case when db_type = 'SID' then concat_ws(';', 'E8800', dx2)
    when db_type = 'SEDD' then coalesce(dx2, '') end as ecause_all,
  zip5,
  case when db_type <> 'SASD' then 'UT' end as facility_state,
  case db_type when 'SID' then '035' when 'SEDD' then '049' end as facility_county,
  case when db_type = 'SID' then case when visit_id % 13 = 0 then -9.0
    else cast(visit_id % 9 as double) end end as los_days,
  case when db_type = 'SEDD' then case when visit_id % 13 = 0 then -9.0
    else cast(visit_id % 9 as double) end end as duration_hours,
  case when visit_id % 11 = 0 then null else age end as age,
  female, race, db_type,
  case when db_type = 'SID' and visit_id % 50 = 0 then null else src_year end as year
from v_visit"""


def write_override_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Mixed-prefix diagnosis columns in folders named by state and year."""
    root = f"{scratch_path(spark, 'bronze-years')}/2024_run"
    visits = view(spark, sf_dir, "v_visit")
    for remainder, folder in enumerate(("NC/2015", "NC/2016", "CA/2017")):
        visits.filter(F.col("visit_id") % 3 == remainder).select(
            F.col("src_year").alias("YEAR"), F.col("src_month").alias("AMONTH"),
            F.col("visit_id").alias("KEY"), F.col("person_key").alias("VISITLINK"),
            F.col("dx1").alias("DX1"), F.coalesce("dx2", F.lit("Z00")).alias("I10_DX1"),
        ).write.parquet(f"{root}/{folder}/sid_core")
    return root
