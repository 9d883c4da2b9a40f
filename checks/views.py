"""Adapter views: the study's input tables derived from the driver tables.

A query and the SQL it is compared with share this input and nothing else.  Most
text runs unchanged in both engines; `v_exposure` has a Spark form of its own
with one aggregate.  Missing exposures are NULL in the SQL and NaN in Spark, as
files from other tools have them, so every reader of the views must treat the
two alike.  Dust is higher in odd nations and so is asthma, which gives the
association scan something to find.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VIEWS: dict[str, str] = {}

VIEWS["v_visit"] = """
select o_orderkey as visit_id, o_custkey as person_key,
  cast(year(o_orderdate) as int) as src_year,
  cast(month(o_orderdate) as int) as src_month,
  case when c_nationkey % 2 = 1 and o_orderkey % 35 < 4 then 'J459' else case o_orderkey % 12
    when 0 then '49390' when 1 then 'J459' when 2 then '4911' when 3 then 'J449'
    when 4 then '486' when 5 then 'J189' when 6 then '41401' when 7 then 'I639'
    when 8 then 'E119' when 9 then '650' when 10 then 'F329' else null end end as dx1,
  case when o_orderkey % 5 = 0 then 'V22' else null end as dx2,
  case when o_orderkey % 7 < 3 then 'SID' when o_orderkey % 7 < 5 then 'SEDD'
    else 'SASD' end as db_type,
  case when o_orderkey % 97 = 0 then null
    else lpad(cast(84000 + c_nationkey as string), 5, '0') end as zip5,
  case when o_custkey % 29 = 0 then null
    else cast(18 + o_custkey % 70 as double) end as age,
  cast(o_custkey % 2 as double) as female,
  case when o_custkey % 31 = 0 then null
    else cast(1 + o_custkey % 6 as double) end as race
from orders join customer on o_custkey = c_custkey"""

VIEWS["v_exposure"] = """
with g as (
  select lpad(cast(84000 + s_nationkey as string), 5, '0') as geoid,
    cast(year(l_shipdate) as string) as year,
    cast(month(l_shipdate) as int) as month,
    cast(sum(cast(round(l_discount * 100) as bigint)) as double) / (count(*) * 100) as a,
    cast(sum(cast(round(l_tax * 100) as bigint)) as double) / (count(*) * 100) as b,
    max(l_tax) as c,
    cast(sum(cast(round(l_quantity) as bigint)) as double) / (count(*) * 1000)
      + (s_nationkey % 2) * cast(0.001 as double) as d,
    max(l_extendedprice) as e, max(l_quantity) as f, min(l_quantity) as h
  from lineitem join supplier on l_suppkey = s_suppkey
  where s_nationkey <> 24
  group by s_nationkey, year(l_shipdate), month(l_shipdate))
select geoid, year, month, 'prop_light_coverage' as variable, a as value from g
union all select geoid, year, month, 'prop_med_coverage', b from g
union all select geoid, year, month, 'prop_heavy_coverage', c from g
union all select geoid, year, month, 'dusmass25', d from g
union all select geoid, year, month, 'bcsmass', e from g
union all select geoid, year, month, 'tmax',
  case when month = 7 and geoid like '%3' then null else f end from g
union all select geoid, year, month, 'tmin', h from g
union all select geoid, 'annual', month, 'tmax', f from g where year = '1996'
union all select geoid, year, month, 'not_wanted', h from g"""

VIEWS["v_crosswalk"] = """
select lpad(cast(84000 + c_nationkey as string), 5, '0') as zip,
  concat(lpad(cast(84000 + c_nationkey as string), 5, '0'), c_mktsegment) as tract,
  cast(count(*) as double) / sum(count(*)) over (partition by c_nationkey) as res_ratio
from customer where c_nationkey <> 7
group by c_nationkey, c_mktsegment"""

VIEWS["v_exposure_daily"] = """
select cast(user_id % 25 as string) as geo_id, 'zip5' as geo_type,
  cast(ts as date) as obs_date, event_type as exposure_id,
  case when count(*) > 4 then null
    else cast(sum(cast(round(value * 100) as bigint)) as double) / (count(*) * 100) end as value
from events
group by user_id % 25, cast(ts as date), event_type"""

VIEWS["v_pvalue"] = """
select p_partkey as test_id, p_brand as model_spec_id,
  case when p_partkey % 41 = 0 then null
    else cast((p_partkey * 7919) % 503 + 1 as double) / 1000 end as p_value
from part"""

_TABLES = {
    "v_visit": ("orders", "customer"),
    "v_exposure": ("lineitem", "supplier"),
    "v_crosswalk": ("customer",),
    "v_exposure_daily": ("events",),
    "v_pvalue": ("part",),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view as a DataFrame over the Parquet files of ``sf_dir``."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES[name]}
    if name == "v_exposure":
        return _exposure_view(tables["lineitem"], tables["supplier"])
    sql = VIEWS[name]
    for table in tables:
        sql = re.sub(rf"\b(from|join) {table}\b", rf"\1 {{{table}}}", sql)
    made = spark.sql(sql, **tables)
    if name == "v_exposure_daily":
        made = made.withColumn("value", F.coalesce("value", F.lit(float("nan"))))
    return made


def _exposure_view(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """``v_exposure`` with one aggregate and an inlined array for its nine branches."""

    def hundredths(column: str, scale: int, per: int) -> Column:
        whole = F.sum(F.round(F.col(column) * scale).cast("bigint")).cast("double")
        return whole / (F.count(F.lit(1)) * per)

    cells = {
        "prop_light_coverage": hundredths("l_discount", 100, 100),
        "prop_med_coverage": hundredths("l_tax", 100, 100),
        "prop_heavy_coverage": F.max("l_tax"),
        "dusmass25": hundredths("l_quantity", 1, 1000) + (F.first("s_nationkey") % 2) * F.lit(0.001),
        "bcsmass": F.max("l_extendedprice"), "tmax": F.max("l_quantity"),
        "tmin": F.min("l_quantity")}
    grouped = (lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
               .filter(F.col("s_nationkey") != 24)
               .groupBy("s_nationkey", F.year("l_shipdate").cast("string").alias("year"),
                        F.month("l_shipdate").alias("month"))
               .agg(*[c.alias(v) for v, c in cells.items()]))

    def row(variable: str, value: str, year: Column = F.col("year")) -> Column:
        return F.struct(year.alias("year"), F.lit(variable).alias("variable"),
                        F.col(value).alias("value"))

    lost = (F.col("month") == 7) & (F.col("s_nationkey") % 10 == 3)
    grouped = grouped.withColumn("gaps", F.when(lost, F.lit(float("nan"))).otherwise(F.col("tmax")))
    rows = [*[row(v, "gaps" if v == "tmax" else v) for v in cells], row("not_wanted", "tmin")]
    annual = F.when(F.col("year") == "1996", F.array(row("tmax", "tmax", F.lit("annual"))))
    return grouped.select(
        F.lpad((84000 + F.col("s_nationkey")).cast("string"), 5, "0").alias("geoid"), "month",
        F.inline(F.concat(F.array(*rows), F.coalesce(annual, F.array().cast(
            "array<struct<year:string,variable:string,value:double>>"))))).select(
        "geoid", "year", "month", "variable", "value")
