"""Raw visit files with drifting schemas to one standard visit table."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import STATE_OVERRIDES, VISIT_COLUMN_MAP, YEAR_OVERRIDES, layered_map
from ..functions import codes, dates, privacy
from ..functions.missing import no_nan
from ..sources.bronze import group_by_schema


def first_present_column(df: DataFrame, candidates: list[str]) -> Column:
    """The first candidate that exists in this schema (not a row-wise coalesce)."""
    name = next((c for c in candidates if c in df.columns), None)
    return F.lit(None).cast("string") if name is None else F.col(f"`{name}`")


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def key_text(df: DataFrame, key: Column) -> Column:
    """A key as plain digits: a whole number stored as a float or decimal loses point and exponent."""
    kind = df.select(key.alias("k")).schema["k"].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        key = no_nan(key)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = key.try_cast("decimal(38,0)")
        return F.when(key == F.floor(key), whole.cast("string")).otherwise(key.cast("string"))
    return key.cast("string")


def normalize_visits(df: DataFrame, db_type: str, salt: str, *, column_map: dict | None = None,
                     pad_zip: bool = False) -> DataFrame:
    """Standard visit columns from one schema group, in one projection.

    A row without a person key falls back to its visit id, so that missing
    keys do not merge into one person.  ``pad_zip`` restores leading zeros of
    zips that were stored as numbers.
    """
    m = column_map or layered_map(db_type)

    def pick(name: str) -> Column:
        return first_present_column(df, m.get(name, []))

    def text(name: str) -> Column:
        return pick(name).cast("string")

    reason = "dx_admitting_sid" if db_type == "SID" else "dx_reason_sed_sasd"
    causes = columns_matching(df, m["ecause_regex"])
    person_key = key_text(df, pick("person_key_candidates"))
    visit_key = key_text(df, pick("visit_id"))
    zip_text = key_text(df, pick("zip5"))
    if pad_zip:
        zip_text = F.when(F.length(zip_text) < 5, F.lpad(zip_text, 5, "0")).otherwise(zip_text)
    admitted = dates.month_start(pick("year"), pick("admit_month"))
    return df.select(
        visit_key.alias("visit_id"),
        privacy.salted_hash(F.coalesce(person_key, visit_key), salt).alias("person_id"),
        person_key.isNull().alias("person_key_missing"),
        admitted.alias("admit_date"),
        dates.month_start(pick("year"), pick("discharge_month")).alias("discharge_date"),
        text("dx_primary").alias("dx_primary"),
        text(reason).alias("dx_admit"),
        codes.join_present(columns_matching(df, m["dx_all_regex"])).alias("dx_all"),
        (codes.join_present(causes) if causes else F.lit(None).cast("string")).alias("ecause_all"),
        codes.leading(zip_text, 5).alias("zip5"),
        text("facility_state").alias("facility_state"),
        text("facility_county_candidates").alias("facility_county"),
        codes.number(pick("los_days")).alias("los_days"),
        codes.number(pick("duration_hours")).alias("duration_hours"),
        codes.number(pick("age")).alias("age"),
        codes.number(pick("sex")).alias("female"),
        codes.number(pick("race")).alias("race"),
        F.lit(db_type).alias("db_type"),
        F.year(admitted).alias("year"))


def _numeric_visit_ids(df: DataFrame, column_map: dict) -> bool:
    name = next((c for c in column_map["visit_id"] if c in df.columns), None)
    return name is not None and isinstance(df.schema[name].dataType, T.NumericType)


def harmonize(spark: SparkSession, bronze: str, salt: str, *, pad_zip: bool = False,
              column_map: dict = VISIT_COLUMN_MAP, overrides: bool = False,
              state_overrides: Mapping = STATE_OVERRIDES,
              year_overrides: Mapping = YEAR_OVERRIDES) -> DataFrame:
    """All visits below ``bronze`` as one table.

    Visit ids are whole numbers when every source stores them so, else text.
    ``overrides`` applies the per-state and per-year entries of the map, which
    are looked up by the folders below ``bronze``; a caller may bring its own.
    """
    groups = group_by_schema(spark, bronze, places=frozenset(state_overrides) if overrides else None)
    parts, whole = [], True
    for group in groups:
        raw = group.read(spark)
        m = layered_map(group.db_type, column_map, state=group.state, year=group.year,
                        state_overrides=state_overrides, year_overrides=year_overrides)
        whole = whole and _numeric_visit_ids(raw, m)
        parts.append(normalize_visits(raw, group.db_type, salt, column_map=m, pad_zip=pad_zip))
    visits = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if whole:
        visits = visits.withColumn("visit_id", F.col("visit_id").try_cast("long"))
    return visits


def persons(visits: DataFrame) -> DataFrame:
    """Distinct persons; the descriptive columns are declared but never filled."""
    blank = F.lit(None).cast("string")
    return visits.select("person_id").distinct().select(
        "person_id", blank.alias("sex"), blank.alias("age_group"), blank.alias("race"),
        blank.alias("payer"))
