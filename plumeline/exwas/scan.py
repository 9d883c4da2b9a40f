"""The association scan: every exposure, outcome and model in one run."""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import ExitStack
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..config import FEATURES, MODEL_SPECS, Feature, ModelSpec
from ..functions import effects
from ..functions.missing import nan_to_null
from ..operators.cohort import flag_columns
from ..operators.ranks import adjust_p
from ..operators.rollup import attach_rollup, available_features
from ..session import scratch_table
from . import absorb, design, irls

_FIT_SCHEMA = ("outcome string, exposure_id string, model_spec_id string, strata string, "
               "n long, n_cases long, n_fit long, estimate double, se double, z_value double, "
               "p_value double, neg_log10_p double, converged boolean")

_CHEAP = frozenset({"year", "month", "season", "female"})


def two_sided_p(z: float) -> tuple[float, float]:
    """Normal two-sided p-value and its -log10, which outlives underflow."""
    p = math.erfc(abs(z) / math.sqrt(2))
    if p > 1e-280:
        return p, -math.log10(p)
    squared = z * z
    series = 1 - 1 / squared + 3 / squared ** 2 - 15 / squared ** 3
    tail = -squared / 2 - math.log(abs(z) * math.sqrt(math.pi / 2)) + math.log(series)
    return p, -tail / math.log(10)


def test_grid(exposure_ids: DataFrame, outcomes: Sequence[str],
              specs: Sequence[ModelSpec]) -> DataFrame:
    """Every planned test: one row per exposure, outcome and model.

    Outcomes and models come from configuration, so they are expanded from
    literals per exposure row instead of joined.
    """
    models = F.array(*[F.struct(F.lit(s.id).alias("model_spec_id"),
                                F.lit(s.strata).alias("strata")) for s in specs])
    return (exposure_ids.select("exposure_id").distinct()
            .withColumn("outcome", F.explode(F.array(*[F.lit(o) for o in outcomes])))
            .withColumn("model", F.explode(models))
            .select("exposure_id", "outcome", "model.model_spec_id", "model.strata"))


def eligibility(wide: DataFrame, exposures: Sequence[str], outcomes: Sequence[str],
                specs: Sequence[ModelSpec] = MODEL_SPECS, gate: irls.Gate = irls.Gate()) -> DataFrame:
    """Rows, cases, exposure mean and spread of each test, and whether it is fitted."""
    strata = sorted({s.strata for s in specs})
    wide = nan_to_null(wide.select("female", *exposures, *outcomes))
    tests = (wide.select("female", *exposures, *outcomes)
             .unpivot(["female", *outcomes], list(exposures), "exposure_id", "value")
             .filter(F.col("value").isNotNull())
             .withColumn("strata", F.explode(F.array(*[F.lit(s) for s in strata]))))
    inside = F.lit(False)
    for name in strata:
        sex = design.STRATA[name]
        inside = inside | ((F.col("strata") == name)
                           & (F.lit(True) if sex is None else F.col("female") == sex))
    sums = []
    for outcome in outcomes:
        known = F.col(outcome).isNotNull()
        value = F.when(known, F.col("value"))
        sums += [F.struct(F.lit(outcome).alias("outcome"),
                          F.count(outcome).alias("n"),
                          F.coalesce(F.sum(F.col(outcome).cast("long")), F.lit(0)).alias("n_cases"),
                          F.avg(value).alias("mean_value"),
                          F.stddev_samp(value).alias("sd_value"))]
    flat = (tests.filter(inside).groupBy("strata", "exposure_id")
            .agg(F.array(*sums).alias("tests"))
            .select("strata", "exposure_id", F.inline("tests")))
    return flat.withColumn("eligible", gate.admits_column(F.col("n"), F.col("n_cases")))


def standardized(wide: DataFrame, exposure: str, outcome: str, stratum: str = "all") -> DataFrame:
    """Exposure z-scores over the rows one test uses, joined as two constants."""
    rows = (design.stratum_filter(nan_to_null(wide), stratum)
            .filter(F.col(outcome).isNotNull() & F.col(exposure).isNotNull()))
    mean, sd = rows.agg(F.avg(exposure), F.stddev_samp(exposure)).first()
    z = (F.col(exposure) - F.lit(mean)) / F.when(F.lit(sd) > 0, F.lit(sd))
    return rows.withColumn("z", z)


def _centres(patterns: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    if not names:
        return {}
    row = patterns.agg(*[e for n in names for e in (F.avg(F.col(n).cast("double")),
                                                    F.stddev_pop(F.col(n).cast("double")))]).first()
    return {n: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, n in enumerate(names)}


def fit_models(wide: DataFrame, exposures: Sequence[str], outcomes: Sequence[str],
               specs: Sequence[ModelSpec] = MODEL_SPECS, gate: irls.Gate = irls.Gate(),
               wide_levels: int = design.WIDE_LEVELS, untold: bool = False) -> DataFrame:
    """Fit every test and return the exposure term of each that has one.

    With ``untold``, a test that passes the gate and has rows to fit but no
    estimate, as with a constant exposure, gets a row too, its numbers NaN.

    Person-months are reduced to covariate patterns once and written to the
    shared folder; coarser pattern tables for simpler models derive from finer
    ones.  Every pass after that reads those tables only.  A factor of more than
    ``wide_levels`` levels is absorbed; the results are the same.
    """
    if not exposures or not outcomes:
        raise ValueError("no exposures or outcomes found")
    specs = design.usable_specs(wide, specs)
    wide = nan_to_null(wide)
    spark = wide.sparkSession
    sets = sorted({design.pattern_columns(s) for s in specs}, key=lambda s: (-len(s), sorted(s)))
    # Exposures already tell zips and months apart, so calendar columns and sex
    # hardly add patterns, while each further table costs a write and a pass.
    homes: dict[frozenset[str], frozenset[str]] = {}
    for s in sets:
        homes[s] = next((h for h in homes if s <= h and h - s <= _CHEAP and homes[h] == h), s)
    everything = sorted(frozenset().union(*sets))

    with ExitStack() as stack:
        finest = stack.enter_context(scratch_table(
            design.covariate_patterns(wide, exposures, outcomes, everything),
            "patterns"))
        centre = _centres(finest, [*exposures, *[
            c for c in everything
            if not any(c in s.covariates and design.is_factor(wide, s, c) for s in specs)]])
        built = design.build_designs(finest, specs, centre, wide_levels)
        tables, wide_tables = {}, []
        for home in dict.fromkeys(homes.values()):
            mine = [d for d in built.designs if homes[design.pattern_columns(d.spec)] == home]
            patterns = finest
            if sorted(home) != everything:
                patterns = stack.enter_context(scratch_table(
                    design.fewer_patterns(finest, exposures, outcomes, sorted(home)),
                    "patterns"))
            sex = F.col("female").cast("double") if "female" in home else F.lit(None).cast("double")

            def numeric(columns: Sequence[str]) -> list[Column]:
                return [*[((F.col(e) - centre[e][0]) / centre[e][1]).alias(f"x|{e}") for e in exposures],
                        *[built.expressions[c].alias(f"d|{c}") for c in columns], sex.alias("sex"),
                        *[F.col(f"{kind}|{o}").cast("double").alias(f"{kind}|{o}")
                          for kind in "nk" for o in outcomes]]

            narrow = [d for d in mine if d.absorbed is None]
            if narrow:
                columns = tuple(dict.fromkeys(c for d in narrow for c in d.columns))
                layout = irls.PatternLayout(tuple(exposures), columns, tuple(outcomes))
                tables[frozenset(d.spec.id for d in narrow)] = (patterns.select(*numeric(columns)), layout)
            for d in mine:
                if d.absorbed is None:
                    continue
                level = F.col(d.absorbed).cast("string").alias("level")
                # Rows of a level stand together, and a level with many may take several ranges.
                rows = patterns.select(*numeric(d.columns), level)
                rows = rows.repartitionByRange("level", F.xxhash64(*rows.drop("level").columns))
                rows = stack.enter_context(scratch_table(rows.sortWithinPartitions("level"), "by-level"))
                wide_tables.append((d, rows, irls.PatternLayout(tuple(exposures), d.columns, tuple(outcomes))))

        fits = [irls.Fit(i, d, e, o) for i, (d, e, o) in enumerate(
            (d, e, o) for d in built.designs for e in exposures for o in outcomes)]
        narrow_fits = [f for f in fits if f.design.absorbed is None]
        done = irls.fit_all(tables, narrow_fits, gate) if narrow_fits else []
        for d, rows, layout in wide_tables:
            done += absorb.fit_absorbed(rows, layout, d, [f for f in fits if f.design is d], gate)

    rows, told = [], {f.index for f in done}
    if untold:
        done += [f for f in fits if f.index not in told and f.n_fit and gate.admits(f.n, f.n_cases)]
    for fit in sorted(done, key=lambda f: f.index):
        if fit.index not in told:
            spec = fit.design.spec
            rows.append((fit.outcome, fit.exposure, spec.id, spec.strata, fit.n, fit.n_cases,
                         fit.n_fit, *[math.nan] * 5, False))
            continue
        estimate = float(fit.beta[fit.design.exposure_at]) * fit.spread
        se = math.sqrt(fit.variance) * fit.spread
        z = estimate / se
        p, log_p = two_sided_p(z)
        spec = fit.design.spec
        rows.append((fit.outcome, fit.exposure, spec.id, spec.strata, fit.n, fit.n_cases,
                     fit.n_fit, estimate, se, z, p, log_p, bool(fit.converged)))
    return with_effects(spark.createDataFrame(rows, _FIT_SCHEMA))


def with_effects(fits: DataFrame) -> DataFrame:
    estimate, se = F.col("estimate"), F.col("se")
    low, high = effects.odds_ratio_ci(estimate, se)
    return fits.withColumns({"odds_ratio": effects.odds_ratio(estimate),
                             "or_ci_low": low, "or_ci_high": high})


def adjusted(results: DataFrame) -> DataFrame:
    """Correction within model and stratum, smallest p first.

    A result table has one row per planned test, so its groups are bounded by
    configuration.  ``q_value`` repeats the FDR column under its other name.
    """
    return (adjust_p(results, ["model_spec_id", "strata"], bounded=True)
            .withColumn("q_value", F.col("p_adj_fdr"))
            .orderBy(F.desc_nulls_last("neg_log10_p"), "p_value", "model_spec_id", "exposure_id", "outcome"))


def stamped(results: DataFrame, run_id: str, run_at: datetime) -> DataFrame:
    """Results tagged with the run they came from."""
    return results.withColumns({"run_id": F.lit(run_id),
                                "run_timestamp": F.lit(run_at.isoformat()).cast("timestamp_ntz")})


def scan(months: DataFrame, rollup: DataFrame, *, specs: Sequence[ModelSpec] = MODEL_SPECS,
         features: tuple[Feature, ...] = FEATURES, gate: irls.Gate = irls.Gate()) -> DataFrame:
    """The full scan from the cohort and the exposure rollup.

    Every exposure of the rollup is tested: configured ones in their order, then
    any other by name.  Exposures become columns, so their number is a study's.
    """
    found = {r.exposure_id for r in rollup.filter(F.col("metric") == "mean")
             .select("exposure_id").distinct().collect()}
    known = [f.id for f in features if f.id in found]
    exposures = [*dict.fromkeys(known), *sorted(found - set(known))]
    wide = attach_rollup(months, rollup, exposures)
    return adjusted(fit_models(wide, exposures, flag_columns(months), specs, gate))


def scan_joined(person_exposures: DataFrame, *, specs: Sequence[ModelSpec] = MODEL_SPECS,
                features: tuple[Feature, ...] = FEATURES,
                gate: irls.Gate = irls.Gate()) -> DataFrame:
    """The same scan from person-months that already carry exposure columns.

    Skips the long rollup and its join back: the only shuffle of person-months
    is the pattern aggregate.
    """
    names = available_features(person_exposures.columns, features)
    wide = (person_exposures.withColumnsRenamed(names)
            .withColumn("year", F.col("year").cast("int")))
    return adjusted(fit_models(wide, list(names.values()), flag_columns(wide), specs, gate))
