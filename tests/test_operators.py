from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeline.config import Feature
from plumeline.operators import cohort, exposures, geocode, joins, ranks, rollup, sampling
from plumeline.plans import explore, quality

from conftest import rows

VISIT = ("visit_id long, person_id string, admit_date date, dx_primary string, zip5 string, "
         "tract_geoid string, age double, female double, race double, db_type string")


def test_person_month_takes_last_place_and_first_demographics(spark):
    day = date(2014, 7, 1)
    visits = spark.createDataFrame([
        (3, "a", day, "J45", None, None, 50.0, None, 2.0, "SID"),
        (1, "a", day, None, "84101", "T1", None, 1.0, None, "SEDD"),
        (2, "a", day, "250", "84102", None, 40.0, 0.0, 1.0, "SEDD"),
        (4, "a", None, "486", "84103", None, None, None, None, None)], VISIT)
    months = cohort.person_month(cohort.add_phenotypes(visits))
    got = {r.ym: r for r in months.collect()}
    july = got[day]
    assert (july.zip5, july.tract_geoid, july.n_visits, july.db_type) == ("84102", "T1", 3, "SEDD,SID")
    assert (july.age, july.female, july.race) == (40.0, 1.0, 1.0)
    assert july.asthma_flag and july.diabetes_flag and not july.stroke_flag
    assert (july.year, july.month, july.season) == (2014, 7, "summer")
    assert got[None].season is None and got[None].db_type == ""


def test_unknown_database_type_fails_loudly(spark):
    visits = spark.createDataFrame(
        [(1, "a", date(2014, 1, 1), None, None, None, None, None, None, "OTHER")], VISIT)
    with pytest.raises(Exception, match="unknown db_type: OTHER"):
        cohort.person_month(cohort.add_phenotypes(visits)).collect()


def test_best_tract_ties_and_missing_weights(spark):
    xw = spark.createDataFrame([
        ("1", "B", 0.5), ("1", "A", 0.5), ("1", "C", None), ("2", "D", None), ("3", "E", 0.1),
        ("3", "F", 0.9)], "zip string, tract string, res_ratio double")
    assert sorted(rows(geocode.best_tract(xw))) == [("1", "A"), ("2", "D"), ("3", "F")]


def test_attach_tract_replaces_an_older_tract(spark):
    xw = spark.createDataFrame([("1", "A", 1.0)], "zip string, tract string, res_ratio double")
    visits = spark.createDataFrame([(1, "1", "old"), (2, "9", "old"), (3, None, "old")],
                                   "visit_id int, zip5 string, tract_geoid string")
    got = geocode.attach_tract(visits, xw).select("visit_id", "tract_geoid")
    assert sorted(rows(got)) == [(1, "A"), (2, None), (3, None)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_null_safe_join_both_strategies(spark, threshold):
    left = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, k string")
    right = spark.createDataFrame([(None, 10), ("x", 20)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = joins.join_null_safe(left, right, ["k"])
        assert sorted(rows(joined.select("id", "v"))) == [(1, 10), (2, 20), (3, None)]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "GlobalLimit" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


MONTHLY = "geoid string, year string, month int, variable string, value double"


def test_subset_keeps_real_years_in_range(spark):
    months = spark.createDataFrame([(2012, "84101"), (2013, None)], "year int, zip5 string")
    source = spark.createDataFrame([
        ("84101", "2012", 1, "tmax", 1.0), ("84101", "annual", 1, "tmax", 2.0),
        ("84101", "2014", 1, "tmax", 3.0), ("84109", "2012", 1, "tmax", 4.0),
        ("84101", "2012.0", 1, "tmax", 5.0), ("84101", "2012", 1, "other", 6.0),
        (None, "2013", 1, "tmin", 7.0)], MONTHLY)
    kept = exposures.cohort_subset(source, months)
    assert sorted(r.value for r in kept.collect()) == [1.0, 7.0]
    assert exposures.cohort_subset(source, months, years=(2013, 2013)).count() == 1


def test_wide_refuses_or_averages_duplicates(spark):
    long = spark.createDataFrame([("1", "2012", 1, "tmax", 1.0), ("1", "2012", 1, "tmax", 3.0),
                                  ("1", "2012", 1, "tmin", 5.0)], MONTHLY)
    with pytest.raises(Exception, match="several tmax values"):
        exposures.to_wide(long, variables=["tmax", "tmin"]).collect()
    mean = exposures.to_wide(long, variables=["tmax", "tmin"], duplicates="mean")
    assert rows(mean) == [("1", "2012", 1, 2.0, 5.0)]


def test_exposures_join_matches_missing_zips(spark):
    months = spark.createDataFrame([("a", date(2012, 1, 1), "1"), ("b", date(2012, 1, 1), None),
                                    ("c", date(2012, 2, 1), "1")],
                                   "person_id string, ym date, zip5 string")
    wide = spark.createDataFrame([("1", "2012", 1, 1.0), (None, "2012", 1, 2.0)],
                                 "zip5 string, year string, month int, tmax double")
    got = exposures.attach_exposures(months, wide)
    assert sorted(rows(got.select("person_id", "year", "tmax"))) == [
        ("a", "2012", 1.0), ("b", "2012", 2.0), ("c", "2012", None)]


def test_rollup_round_trip_with_missing_months(spark):
    pm = spark.createDataFrame([("a", date(2012, 1, 1), 1.0, None), ("a", None, 2.0, 3.0)],
                               "person_id string, ym date, tmax double, tmin double")
    long = rollup.exposure_rollup(pm)
    assert {r[2] for r in rows(long)} == {"temp_maximum", "temp_minimum"} and long.count() == 3
    back = rollup.attach_rollup(pm.select("person_id", "ym"), long,
                                ["temp_maximum", "temp_minimum"])
    assert sorted(rows(back), key=str) == sorted(rows(pm), key=str)
    with pytest.raises(ValueError):
        rollup.exposure_rollup(pm.select("person_id", "ym"))


def test_first_feature_wins_for_a_shared_variable():
    shared = (Feature("one", "s", "v", ""), Feature("two", "s", "v", ""))
    assert rollup.available_features(["v"], shared) == {"v": "one"}


def bh(p):
    """Step-up adjustment by definition: the least q at which each p is rejected."""
    p = np.asarray(p, float)
    return np.array([min(1.0, min(x * len(p) / (p <= x).sum() for x in p if x >= value))
                     for value in p])


@pytest.mark.parametrize("options", [{"bounded": True}, {}, {"ranges": 1}, {"ranges": 9},
                                     {"ranges": 3, "block_bits": 2}, {"ranges": 2, "block_bits": 0}])
def test_fdr_matches_its_definition(spark, options):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.random(150).round(2) ** 2, "small": np.array([0.02, 0.02, 0.5]),
              "single": np.array([0.3]), "flat": np.ones(20)}
    data = [(i, g, float(p)) for g, ps in groups.items() for i, p in enumerate(ps)]
    data += [(1000, "hot", None), (1001, None, 0.04), (1002, "void", None)]
    df = spark.createDataFrame(data, "i int, g string, p_value double")
    got = {(r.g, r.i): r for r in ranks.adjust_p(df, ["g"], **options).collect()}
    assert len(got) == len(data)
    for name, ps in groups.items():
        for i, q in enumerate(bh(ps)):
            assert got[name, i].p_adj_fdr == pytest.approx(q, abs=1e-12)
            assert got[name, i].p_adj_bonferroni == pytest.approx(min(1, ps[i] * len(ps)), abs=1e-12)
    assert got["hot", 1000].p_adj_fdr is None and got["void", 1002].p_adj_bonferroni is None
    assert got[None, 1001].p_adj_fdr == pytest.approx(0.04)


def test_bonferroni_flag_counts_missing_rows(spark):
    df = spark.createDataFrame([("a", 0.02), ("a", None), ("b", 0.02)], "g string, p_value double")
    got = rows(ranks.bonferroni_flag(df, ["g"]).select("g", "bonferroni_sig"))
    assert sorted(got, key=str) == [("a", True), ("a", None), ("b", True)] or sorted(
        got, key=str) == [("a", None), ("a", True), ("b", True)]


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
def test_quantile_is_exact_in_hot_groups(spark, q):
    rng = np.random.default_rng(5)
    groups = {"hot": np.round(rng.normal(size=400), 1), "tiny": np.array([4.0, 1.0]),
              None: rng.normal(size=30)}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    for options in ({}, {"ranges": 11}):
        got = dict(rows(ranks.grouped_quantile(df, ["g"], "v", q, alias="m", **options)))
        for name, values in groups.items():
            assert got[name] == pytest.approx(np.quantile(values, q), abs=1e-12)
    whole = ranks.grouped_quantile(df, [], "v", q, alias="m", ranges=5).first()[0]
    assert whole == pytest.approx(np.quantile(np.concatenate(list(groups.values())), q), abs=1e-12)


def test_monthly_metrics_thresholds_and_units(spark):
    daily = spark.createDataFrame(
        [("1", "zip5", date(2014, 1, d), "pm25_dust", v) for d, v in
         ((1, 40e-9), (2, 60e-9), (3, 10e-9), (4, None))]
        + [("1", "zip5", date(2014, 1, 1), "temp_max", -5.0)],
        "geo_id string, geo_type string, obs_date date, exposure_id string, value double")
    got = {r.exposure_id: r for r in exposures.monthly_metrics(daily).collect()}
    dust, temp = got["pm25_dust"], got["temp_max"]
    assert (dust.days_available, dust.pm25_unhealthy_sensitive, dust.pm25_unhealthy) == (3, 2, 1)
    assert dust.temp_cold_warning is None and temp.temp_cold_warning == 1
    assert temp.temp_heat_warning == 0 and dust.p90 == pytest.approx(56e-9)


def test_sources_of_daily_series(spark):
    wide = spark.createDataFrame([(date(2014, 1, 2), "1", "zip5", 1.0, None)],
                                 "date date, geo_id string, geo_type string, hms_light double, "
                                 "pm25 double")
    got = sorted(rows(exposures.daily_long(wide).select("exposure_id", "value", "source", "year")))
    assert got == [("hms_light", 1.0, "hms_smoke", 2014), ("pm25", None, "pm25_aqs", 2014)]


def test_sample_needs_an_order(spark):
    with pytest.raises(ValueError):
        sampling.first_rows(spark.range(3), 2)
    assert rows(sampling.first_rows(spark.range(10).orderBy(F.desc("id")), 2, "id")) == [(0,), (1,)]


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(v),) for v in range(59)] + [(None,)], "v double")
    got = explore.histogram(df, "v")
    assert got.agg(F.sum("n")).first()[0] == 59
    assert {r.bin for r in got.collect()} <= set(range(30))
    same = explore.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v")
    assert rows(same.select("bin", "n")) == [(0, 2)]
    assert explore.histogram(df.filter("v is null"), "v").count() == 0


def test_quality_of_empty_tables(spark):
    empty = spark.createDataFrame([], VISIT)
    summary = quality.visit_summary(empty).first()
    assert summary.n_visits == 0 and summary.pct_missing_dx is None
    flagged = cohort.person_month(cohort.add_phenotypes(empty))
    assert quality.prevalence(flagged).count() == 8
    assert quality.cohort_summary(flagged).first().avg_visits is None


RESULT = ("outcome string, exposure_id string, model_spec_id string, strata string, n long, "
          "n_cases long, odds_ratio double, or_ci_low double, or_ci_high double, p_value double, "
          "q_value double")


def test_result_views(spark):
    results = spark.createDataFrame([
        ("a_flag", "pm25_dust", "m1", "all", 200, 20, 1.5, 1.1, 2.0, 0.001, 0.01),
        ("b_flag", "pm25_dust", "m1", "all", 200, 30, 0.9, 0.5, 1.5, 0.4, 0.6),
        ("a_flag", "unknown", "m2", "male", 100, 15, 1.0, 0.8, 1.2, 0.0, 0.0)], RESULT)
    hits = rows(explore.formatted_hits(results, 2))
    assert [(h[1], h[3], h[5]) for h in hits] == [
        ("m2", None, "1.00 (0.80-1.20)"),
        ("m1", "Dust surface mass concentration, particles <2.5 μm (kg m⁻³)", "1.50 (1.10-2.00)")]
    kept = explore.filter_results(results, model_spec_id="m1", outcome="all", q_max=0.1)
    assert rows(kept.select("label", "significant")) == [("pm25_dust → a_flag", True)]
    assert explore.filter_results(results, outcome="b_flag").count() == 1
    assert explore.filter_results(results, p_max=0.0).first().log10_p is None
    shown = explore.result_table(results)
    assert [r.p_value for r in shown.collect()] == ["0.00e+00", "1.00e-03", "4.00e-01"]
    assert rows(quality.results_by_outcome(results)) == [("a_flag", 2, 2), ("b_flag", 1, 0)]


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan"))], "g string, v double")
    assert ranks.grouped_quantile(df, [], "v", 0.5, alias="m").first()[0] is None
    assert rows(ranks.grouped_quantile(df, ["g"], "v", 0.5, alias="m").select("m")) == [(None,), (None,)]


def test_nan_is_missing(spark):
    nan = float("nan")
    wide = spark.createDataFrame([(1, date(2014, 1, 1), nan), (2, date(2014, 1, 1), 3.0)],
                                 "person_id int, ym date, tmax double")
    assert [r.value for r in rollup.exposure_rollup(wide).collect()] == [3.0]
    from plumeline.plans import explore, quality
    assert quality.coverage(wide, ["tmax"]).first().n_present == 1
    assert [r.n for r in explore.histogram(wide, "tmax").collect()] == [1]


def test_histogram_has_a_range_per_group(spark):
    from plumeline.plans import explore
    df = spark.createDataFrame([("t", float(v)) for v in range(30)] + [("d", v * 1e-9) for v in range(30)],
                               "g string, v double")
    got = explore.histogram(df, "v", ["g"]).collect()
    assert len(got) == 60 and max(r.bin_centre for r in got if r.g == "d") == pytest.approx(29e-9)


def test_strongest_results_come_first(spark):
    from plumeline.plans import explore
    df = spark.createDataFrame(
        [("m", "b", "o", 0.0, 400.0, 0.0), ("m", "a", "o", 0.0, 350.0, 0.0), ("m", "c", "o", 0.01, 2.0, 0.02)],
        "model_spec_id string, exposure_id string, outcome string, p_value double, neg_log10_p double, q_value double")
    assert [r.exposure_id for r in explore.top_hits(df, 2).collect()] == ["b", "a"]
    assert [r.log10_p for r in explore.filter_results(df).orderBy("log10_p").collect()] == [2.0, 350.0, 400.0]


UNDERFLOWN = ("outcome string, exposure_id string, model_spec_id string, strata string, n long, n_cases long, "
              "estimate double, se double, odds_ratio double, p_value double, p_adj_fdr double, neg_log10_p double, "
              "q_value double")


def underflown(spark, *_):
    """Two results, one with a p-value of zero."""
    data = [("o", e, "logit_unadjusted_male", "male", 900, 90, 0.5, 0.01, 1.6, p, p, at, p)
            for e, p, at in (("a", 0.0, 540.0), ("b", 0.01, 2.0))]
    return spark.createDataFrame(data, UNDERFLOWN)


def test_export_has_the_logarithm_of_the_stored_p(spark, monkeypatch):
    from checks import scan_queries
    monkeypatch.setattr(scan_queries, "unadjusted_scan", underflown)
    got = scan_queries.results_export(spark, "").collect()
    assert {r.exposure_id: r.log10_p for r in got} == {"a": float("inf"), "b": 2.0}


def test_filtered_results_have_the_logarithm_of_the_stored_p(spark, monkeypatch):
    from checks import scan_queries
    monkeypatch.setattr(scan_queries, "unadjusted_scan", underflown)
    got = scan_queries.filtered_results(spark, "").collect()
    assert {r.exposure_id: r.log10_p for r in got} == {"a": float("inf"), "b": 2.0}


def test_inputs_are_scanned_twice_at_most(spark, tmp_path):
    spark.range(500).selectExpr("id", "id % 3 as g", "(id % 97) / 97 as p_value").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = ranks.bonferroni(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    plan = ranks.adjust_p(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path)) == 0  # only the pass that dealt the rows to ranges has read them


def test_places_need_no_window(spark):
    from plumeline.plans import explore
    rng = np.random.default_rng(8)
    data = [(f"m{i % 3}", f"e{i}", "o", None if i % 50 == 0 else float(p), float(p))
            for i, p in enumerate(rng.random(400).round(1))]
    df = spark.createDataFrame(
        data, "model_spec_id string, exposure_id string, outcome string, p_value double, q_value double").repartition(5)
    ranked = explore.ranked(df)
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    wanted = sorted(data, key=lambda r: (r[3] is None, r[3] or 0, r[0], r[1]))
    assert [r.exposure_id for r in ranked.orderBy("place").collect()] == [r[1] for r in wanted]
    assert sorted(r.place for r in ranked.collect()) == list(range(1, 401))
    assert explore.ranked(df.limit(0)).count() == 0


def test_exposure_columns():
    from types import SimpleNamespace
    named = SimpleNamespace(columns=["ym", "temp_maximum", "pm25_dust", "hms_smoke_light", "pm2", "ozone_mean", "x_temp_"])
    assert exposures.exposure_columns(named) == ["temp_maximum", "pm25_dust", "hms_smoke_light", "ozone_mean"]
