import math

import numpy as np
import pandas as pd
import pytest

from plumeline.config import LEGACY_MODEL_SPECS, MODEL_SPECS, ModelSpec
from plumeline.exwas import design, irls, scan
from plumeline.operators.cohort import flag_columns


def row_level_glm(matrix, y, steps=25):
    """Plain row-by-row logistic regression, to compare grouped fits with."""
    beta = np.zeros(matrix.shape[1])
    for _ in range(steps):
        mu = 1 / (1 + np.exp(-matrix @ beta))
        hessian = (matrix.T * (mu * (1 - mu))) @ matrix
        beta = beta + np.linalg.solve(hessian, matrix.T @ (y - mu))
    return beta, np.sqrt(np.diag(np.linalg.inv(hessian)))


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(11)
    n = 1200
    pdf = pd.DataFrame({
        "female": rng.integers(0, 2, n).astype(float), "age": rng.integers(18, 90, n).astype(float),
        "race": rng.integers(1, 6, n).astype(float), "year": rng.integers(2012, 2015, n),
        "season": rng.choice(["fall", "spring", "summer", "winter"], n),
        "db_type": rng.choice(["SASD", "SEDD", "SEDD,SID"], n)})
    pdf["smoke"] = rng.integers(0, 2, n).astype(float)
    pdf["heat"] = rng.normal(20, 5, n).round(0)
    pdf["flat"] = 3.0
    logit = -1.5 + 0.5 * pdf.smoke + 0.05 * (pdf.heat - 20) + 0.01 * pdf.age
    pdf["asthma_flag"] = rng.random(n) < 1 / (1 + np.exp(-logit))
    pdf["rare_flag"] = np.arange(n) < 10
    pdf["enough_flag"] = np.arange(n) % 109 == 0
    pdf.loc[::37, "age"] = np.nan
    pdf.loc[::41, "heat"] = np.nan
    pdf.loc[::53, "female"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def fitted(spark, people):
    """One run over everything the cases below look at."""
    clean = people.astype(object).where(people.notna(), None)
    df = spark.createDataFrame(
        list(clean.itertuples(index=False, name=None)),
        "female double, age double, race double, year int, season string, db_type string, "
        "smoke double, heat double, flat double, asthma_flag boolean, rare_flag boolean, "
        "enough_flag boolean").repartition(3)
    one_season = ModelSpec("one_level", covariates=("season_one",))
    constant = ModelSpec("constant_year", covariates=("year_one", "year"))
    from pyspark.sql import functions as F
    df = df.withColumns({"season_one": F.lit("fall"), "year_one": F.lit(2014)})
    results = scan.adjusted(scan.fit_models(df, ["smoke", "heat", "flat"], flag_columns(df),
                                            [*MODEL_SPECS, one_season, constant]))
    return {(r.exposure_id, r.outcome, r.model_spec_id): r for r in results.collect()}


def test_binary_exposure_has_its_closed_form(people, fitted):
    table = pd.crosstab(people.smoke, people.asthma_flag).to_numpy()
    log_or = math.log(table[1, 1] * table[0, 0] / (table[1, 0] * table[0, 1]))
    r = fitted["smoke", "asthma_flag", "logit_unadjusted_overall"]
    sd = people.smoke.std()
    assert r.estimate == pytest.approx(log_or * sd, rel=1e-6)
    assert r.se == pytest.approx(math.sqrt((1 / table).sum()) * sd, rel=1e-3)
    assert r.p_value == pytest.approx(math.erfc(abs(r.z_value) / math.sqrt(2)))
    assert r.odds_ratio == pytest.approx(math.exp(r.estimate)) and r.converged


def test_full_model_equals_a_row_level_fit(people, fitted):
    rows = people[people.heat.notna()]
    z = (rows.heat - rows.heat.mean()) / rows.heat.std()
    dummies = pd.get_dummies(rows[["season", "db_type"]], drop_first=True).astype(float)
    matrix = pd.concat([pd.Series(1.0, rows.index), z, rows.year - 2013.0, dummies,
                        rows.age / 10, rows.female, rows.race], axis=1)
    keep = matrix.notna().all(axis=1)
    beta, se = row_level_glm(matrix[keep].to_numpy(), rows.asthma_flag[keep].to_numpy(float))
    r = fitted["heat", "asthma_flag", "logit_adjusted_full_overall"]
    assert (r.n, r.n_fit) == (len(rows), keep.sum()) and r.n > r.n_fit
    assert r.estimate == pytest.approx(beta[1], rel=1e-6)
    assert r.se == pytest.approx(se[1], rel=1e-3)


def test_strata_leave_out_unknown_sex(people, fitted):
    counts = {s: fitted["smoke", "asthma_flag", f"logit_unadjusted_{s}"].n
              for s in ("overall", "male", "female")}
    assert counts == {"overall": 1200, "male": int((people.female == 0).sum()),
                      "female": int((people.female == 1).sum())}


def test_tests_without_a_row(fitted):
    keys = set(fitted)
    assert not [k for k in keys if k[0] == "flat"]             # no variance
    assert not [k for k in keys if k[1] == "rare_flag"]        # 10 cases
    assert ("smoke", "enough_flag", "logit_unadjusted_overall") in keys  # 12 cases
    assert not [k for k in keys if k[2] == "one_level"]        # factor with one level


def test_constant_covariate_is_dropped_not_the_exposure(fitted):
    assert fitted["smoke", "asthma_flag", "constant_year"].n_fit == 1200


@pytest.mark.parametrize("n,cases,admitted", [(99, 40, False), (100, 40, True), (100, 10, False),
                                              (100, 11, True), (100, 89, False), (100, 88, True)])
def test_gate_boundaries(n, cases, admitted):
    assert irls.Gate().admits(n, cases) is admitted


def test_two_class_gate():
    gate = irls.TwoClassGate()
    assert gate.admits(500, 1) and not gate.admits(499, 100)
    assert not gate.admits(500, 0) and not gate.admits(500, 500)


def test_solver_keeps_the_exposure_and_drops_copies():
    rng = np.random.default_rng(1)
    x = rng.normal(size=50)
    matrix = np.column_stack([np.ones(50), x, x * 2 - 1, rng.normal(size=50)])
    beta, variance = irls.solve(matrix.T @ matrix, matrix.T @ (3 + 2 * x))
    assert beta == pytest.approx([3, 2, 0, 0], abs=1e-9)
    reduced = matrix[:, [0, 1, 3]]
    assert variance == pytest.approx(np.linalg.inv(reduced.T @ reduced)[1, 1])
    matrix[:, 1] = 4.0
    assert irls.solve(matrix.T @ matrix, matrix.T @ x) is None


def test_p_value_tail_outlives_underflow():
    p, log_p = scan.two_sided_p(1.96)
    assert p == pytest.approx(0.05, abs=1e-4) and log_p == pytest.approx(-math.log10(p))
    near, far = scan.two_sided_p(35.0), scan.two_sided_p(60.0)
    assert near[1] == pytest.approx(-math.log10(near[0]))
    # Leading term of the tail: p ~ exp(-z^2/2) / (z sqrt(pi/2)).
    leading = 1800 / math.log(10) + math.log10(60 * math.sqrt(math.pi / 2))
    assert far[0] == 0 and far[1] == pytest.approx(leading, rel=1e-5)


def test_missing_covariate_is_refused(spark):
    df = spark.createDataFrame([(2012, 1, 1.0)], "year int, month int, female double")
    with pytest.raises(ValueError, match="zip5_cluster"):
        design.usable_specs(df, [LEGACY_MODEL_SPECS[2]])
    assert design.usable_specs(df, [LEGACY_MODEL_SPECS[1]]) == [LEGACY_MODEL_SPECS[1]]


def test_every_exposure_found_is_scanned_and_bad_models_are_reported(spark):
    from datetime import date

    from plumeline.config import ModelSpec

    rng = np.random.default_rng(8)
    people = [(i, date(2014, 1, 1), float(i % 2), bool(rng.random() < 0.3)) for i in range(300)]
    months = spark.createDataFrame(people, "person_id long, ym date, female double, asthma_flag boolean")
    long = [(i, date(2014, 1, 1), e, "mean", float(rng.normal())) for i in range(300)
            for e in ("pm25_dust", "no2_mean")] + [(300, date(2014, 1, 1), "no2_mean", "mean", float("nan"))]
    rollup = spark.createDataFrame(long, "person_id long, ym date, exposure_id string, metric string, value double")
    specs = [ModelSpec("logit_plain"), ModelSpec("logit_lost", covariates=("no_such",))]
    with pytest.warns(UserWarning, match="no_such"):
        got = scan.scan(months, rollup, specs=specs).collect()
    assert sorted((r.exposure_id, r.model_spec_id, r.n) for r in got) == [
        ("no2_mean", "logit_plain", 300), ("pm25_dust", "logit_plain", 300)]
    with pytest.raises(ValueError, match="no model"):
        scan.scan(months, rollup, specs=specs[1:])
