from datetime import date
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from plumeline.config import LEGACY_MODEL_SPECS, MODEL_SPECS, PHENOTYPES, feature_names, layered_map
from plumeline.functions import codes, dates, effects, privacy

from conftest import rows


def test_month_start_survives_bad_parts(spark):
    df = spark.createDataFrame(
        [("2014", "3"), ("2014", "13"), ("2014", None), ("x", "1"), (None, "1")],
        "y string, m string")
    got = rows(df.select(dates.month_start(F.col("y"), F.col("m"))))
    assert got == [(date(2014, 3, 1),), (None,), (None,), (None,), (None,)]


def test_seasons(spark):
    got = [r[0] for r in rows(spark.range(1, 13).select(dates.season(F.col("id"))))]
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]


def test_prefixes_and_null_codes(spark):
    df = spark.createDataFrame([("493",), ("J459",), ("V22",), ("",), (None,), ("4",)], "dx string")
    asthma, pregnancy = PHENOTYPES[0], next(p for p in PHENOTYPES if p.name == "pregnancy")
    got = rows(df.select(codes.phenotype_flag("dx", asthma), codes.phenotype_flag("dx", pregnancy)))
    assert [g[0] for g in got] == [True, True, False, False, False, False]
    assert [g[1] for g in got] == [False, False, True, False, False, False]
    with pytest.raises(ValueError):
        codes.starts_with_any("dx", ["x'y"])


def test_code_spaces_split_at_a_date(spark):
    df = spark.createDataFrame([("493", date(2015, 9, 1)), ("J45", date(2015, 9, 1)),
                                ("493", date(2015, 10, 1)), ("J45", date(2015, 10, 1))],
                               "dx string, d date")
    flag = codes.phenotype_flag("dx", PHENOTYPES[0], on="d", split_at=date(2015, 10, 1))
    assert [r[0] for r in rows(df.select(flag))] == [True, False, False, True]


def test_salted_hash(spark):
    df = spark.createDataFrame([("7",), (None,)], "k string")
    got = rows(df.select(privacy.salted_hash(F.col("k"), "pepper")))
    assert got == [(sha256(b"7|pepper").hexdigest(),), (None,)]
    with pytest.raises(ValueError):
        privacy.salted_hash(F.col("k"), "")


def test_suppression_boundary(spark):
    df = spark.createDataFrame([(10, 10), (11, 11), (None, 5)], "n int, other int")
    assert rows(privacy.suppress_small(df)) == [(None, 10), (11, 11), (None, 5)]


def test_precision(spark):
    df = spark.createDataFrame([("49035101400", "84101", date(2014, 5, 17))],
                               "tract string, zip5 string, d date")
    geo = {"tract": F.col("tract"), "zip5": F.col("zip5")}
    picked = [privacy.coarsen_geography(p, **geo) for p in ("tract", "zip5", "county", "state")]
    days = [privacy.coarsen_date(F.col("d"), p) for p in ("day", "month", "year")]
    assert rows(df.select(*picked, *days)) == [
        ("49035101400", "84101", "49035", "49", date(2014, 5, 17), date(2014, 5, 1),
         date(2014, 1, 1))]
    with pytest.raises(ValueError):
        privacy.coarsen_geography("block", **geo)


def test_safe_numbers_and_joined_codes(spark):
    df = spark.createDataFrame([(".", "A", None), ("-9", None, None), (None, "A", "B")],
                               "n string, a string, b string")
    got = rows(df.select(codes.number(F.col("n")), codes.join_present(["a", "b"])))
    assert got == [(None, "A"), (-9.0, ""), (None, "A;B")]


def test_effect_forms(spark):
    df = spark.createDataFrame([(0.0, 0.5, 0.001234), (0.0, 0.5, 0.0)],
                               "b double, se double, p double")
    low, high = effects.odds_ratio_ci(F.col("b"), F.col("se"))
    got = rows(df.select(effects.format_ci(effects.odds_ratio(F.col("b")), low, high),
                         effects.format_scientific(F.col("p")),
                         F.round(effects.neg_log10(F.col("p")), 3)))
    assert got[0] == ("1.00 (0.38-2.66)", "1.23e-03", 2.909)
    assert got[1][2] is None


def test_configuration_layers():
    assert layered_map("SID")["dx_all_regex"] == "^(I10_)?DX[0-9]+$"
    assert layered_map("SID", year=2017)["dx_all_regex"] == "^I10_DX[0-9]+$"
    assert "dx_reason_sed_sasd" in layered_map("SEDD") and "dx_reason_sed_sasd" not in layered_map("SID")
    assert len(MODEL_SPECS) == 9 and len(PHENOTYPES) == 8 and len(LEGACY_MODEL_SPECS) == 3
    assert feature_names()["tmax"] == "temp_maximum"
    assert MODEL_SPECS[1].formula == "{outcome} ~ scale({exposure}) + year + factor(season)"
    assert all("female" not in s.covariates for s in MODEL_SPECS if s.strata != "all")
