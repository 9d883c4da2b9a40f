import numpy as np
import pandas as pd
import pytest

from plumeline.config import ModelSpec
from plumeline.exwas import scan
from plumeline.operators.cohort import flag_columns

SCHEMA = ("smoke double, heat double, fixed double, female double, age double, season string, area string, "
          "asthma_flag boolean, copd_flag boolean, rare_flag boolean")


def people(levels, n, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "smoke": rng.integers(0, 4, n) / 4, "heat": rng.normal(20, 4, n).round(0), "fixed": 0.0,
        "female": rng.integers(0, 2, n).astype(float), "age": rng.integers(2, 9, n) * 10.0,
        "season": rng.choice(["fall", "spring", "winter"], n)})
    # One level holds a third of all rows.
    area = np.where(rng.random(n) < 0.33, 0, rng.integers(0, levels, n))
    pdf["area"] = [f"a{a}" for a in area]
    pdf["fixed"] = area % 7 + 0.0
    logit = -1 + 0.6 * pdf.smoke + 0.05 * (pdf.heat - 20) + rng.normal(0, 0.5, levels)[area]
    for flag, shift in (("asthma_flag", 0), ("copd_flag", -0.7), ("rare_flag", -9)):
        pdf[flag] = rng.random(n) < 1 / (1 + np.exp(-logit - shift))
    pdf.loc[::29, "smoke"] = np.nan
    pdf.loc[::31, "age"] = np.nan
    pdf.loc[::37, "area"] = None
    pdf.loc[::41, "female"] = np.nan
    return pdf


def frame(spark, pdf):
    clean = pdf.astype(object).where(pdf.notna(), None)
    return spark.createDataFrame(list(clean.itertuples(index=False, name=None)), SCHEMA).repartition(3)


def fits(df, specs, wide_levels, exposures=("smoke", "heat", "fixed")):
    found = scan.fit_models(df, list(exposures), flag_columns(df), specs, wide_levels=wide_levels)
    return {(r.exposure_id, r.outcome, r.model_spec_id): r for r in found.collect()}


def test_absorbed_equals_indicators(spark):
    df = frame(spark, people(40, 1800, 3))
    specs = [ModelSpec("area", covariates=("area",)),
             ModelSpec("more", covariates=("age", "season", "area"), factors=frozenset({"season"})),
             ModelSpec("women", "female", ("area", "age")), ModelSpec("plain", covariates=("age", "season"))]
    dense, absorbed = fits(df, specs, 100), fits(df, specs, 12)
    # Within a level `fixed` is constant: nothing to tell beside the level.
    assert all(("fixed", "asthma_flag", s.id) not in absorbed for s in specs[:3])
    assert ("fixed", "asthma_flag", "plain") in absorbed
    shared = {k for k in dense if k[0] != "fixed" or k[2] == "plain"}
    assert set(absorbed) == shared and len(shared) >= 16
    for key in shared:
        a, b = absorbed[key], dense[key]
        assert (a.n, a.n_cases, a.n_fit, a.strata, a.converged) == (b.n, b.n_cases, b.n_fit, b.strata, b.converged)
        assert (a.estimate, a.se) == pytest.approx((b.estimate, b.se), abs=1e-6)


def test_five_thousand_levels(spark):
    pdf = people(5000, 24_000, 5).drop(columns=["copd_flag", "rare_flag"])
    pdf = pdf.assign(copd_flag=False, rare_flag=False)
    got = fits(frame(spark, pdf), [ModelSpec("area", covariates=("age", "area"))], 200, ["heat"])
    row = got["heat", "asthma_flag", "area"]
    kept = pdf[pdf.heat.notna()]
    z = (kept.heat - kept.heat.mean()) / kept.heat.std()
    use = kept.age.notna() & kept.area.notna()
    codes = pd.factorize(kept.area[use])[0]
    x, y = np.column_stack([z[use], kept.age[use] / 10 - 5]), kept.asthma_flag[use].to_numpy(float)
    n_levels = codes.max() + 1
    assert n_levels > 4500 and row.n_fit == use.sum() and row.n == len(kept)
    # The dense normal equations, level columns and all, row by row.
    eta, beta, last, steps = np.where(y > 0, 1, -1) * np.log(3), None, np.inf, 0
    mu = np.where(y > 0, 0.75, 0.25)
    while True:
        deviance = -2 * (y * np.log(mu) + (1 - y) * np.log1p(-mu)).sum()
        if abs(deviance - last) / (abs(deviance) + 0.1) < 1e-8 or steps >= 25:
            break
        last, steps = deviance, steps + 1
        w = mu * (1 - mu)
        t = w * eta + (y - mu)
        gram = np.zeros((2 + n_levels, 2 + n_levels))
        gram[:2, :2] = (x.T * w) @ x
        for j in range(2):
            gram[j, 2:] = gram[2:, j] = np.bincount(codes, w * x[:, j], n_levels)
        gram[np.arange(n_levels) + 2, np.arange(n_levels) + 2] = np.bincount(codes, w, n_levels)
        beta = np.linalg.solve(gram, np.r_[x.T @ t, np.bincount(codes, t, n_levels)])
        eta = x @ beta[:2] + beta[2 + codes]
        mu = 1 / (1 + np.exp(-eta))
    assert row.estimate == pytest.approx(beta[0], abs=1e-6)
    unit = np.zeros(2 + n_levels)
    unit[0] = 1
    assert row.se == pytest.approx(np.sqrt(np.linalg.solve(gram, unit)[0]), abs=1e-6)


def test_left_out(spark):
    df = frame(spark, people(40, 400, 7)).withColumnRenamed("season", "other")
    spec = ModelSpec("two", covariates=("area", "other"))
    with pytest.warns(UserWarning, match="several wide factors"):
        assert fits(df, [spec, ModelSpec("none")], 2, ["heat"]).keys() == {
            ("heat", o, "none") for o in ("asthma_flag", "copd_flag")}
    alone = df.filter("area = 'a0'")  # one level, counted as wide
    assert fits(alone, [ModelSpec("one", covariates=("area",))], 0, ["heat"]) == {}


@pytest.mark.parametrize("wide_levels", [12, 100])
def test_untold_tests_have_rows_on_request(spark, wide_levels):
    pdf = people(40, 900, 11).assign(smoke=0.5)
    pdf.loc[::29, "smoke"] = np.nan
    df, spec = frame(spark, pdf), ModelSpec("area", covariates=("age", "area"))
    assert not [k for k in fits(df, [spec], wide_levels) if k[0] == "smoke"]
    found = scan.fit_models(df, ["smoke", "heat"], ["asthma_flag", "rare_flag"], [spec], wide_levels=wide_levels,
                            untold=True)
    got = {(r.exposure_id, r.outcome): r for r in found.collect()}
    assert set(got) == {("smoke", "asthma_flag"), ("heat", "asthma_flag")}  # the gate still holds
    row, kept = got["smoke", "asthma_flag"], pdf[pdf.smoke.notna()]
    assert (row.n, row.n_cases) == (len(kept), kept.asthma_flag.sum())
    assert row.n_fit == (kept.age.notna() & kept.area.notna()).sum()
    assert np.isnan([row.estimate, row.se, row.z_value, row.p_value, row.odds_ratio]).all() and not row.converged
    assert got["heat", "asthma_flag"].converged
