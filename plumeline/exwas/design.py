"""From model specs to design columns, pattern tables and fits."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import ModelSpec

# A factor with more levels is absorbed, see `absorb`; its levels never reach the driver.
WIDE_LEVELS = 200

STRATA: dict[str, float | None] = {"all": None, "male": 0.0, "female": 1.0}


def stratum_filter(df: DataFrame, stratum: str) -> DataFrame:
    """Rows of one sex stratum; unknown sex belongs to 'all' only."""
    sex = STRATA[stratum]
    return df if sex is None else df.filter(F.col("female") == sex)


def problem_of(df: DataFrame, spec: ModelSpec) -> str | None:
    """Why a spec cannot be fitted on ``df``, if it cannot."""
    absent = [c for c in spec.covariates if c not in df.columns]
    if absent:
        return f"model {spec.id} needs missing columns {absent}"
    if spec.strata not in STRATA:
        return f"model {spec.id} has unknown stratum {spec.strata!r}"
    return None


def usable_specs(df: DataFrame, specs: Sequence[ModelSpec]) -> list[ModelSpec]:
    """The specs that ``df`` can serve; the others are reported and give no rows."""
    problems = {s.id: problem_of(df, s) for s in specs}
    usable = [s for s in specs if problems[s.id] is None]
    told = "; ".join(p for p in problems.values() if p)
    if not usable:
        raise ValueError(f"no model can be fitted: {told or 'none is given'}")
    if told:
        warnings.warn(f"left out: {told}", stacklevel=3)
    return usable


def is_factor(df: DataFrame, spec: ModelSpec, name: str) -> bool:
    return name in spec.factors or isinstance(df.schema[name].dataType, T.StringType)


def factor_levels(df: DataFrame, name: str, most: int = WIDE_LEVELS) -> list[str] | None:
    """Sorted levels of a categorical covariate; they become columns of the design.

    None if there are more than ``most``; no more than that are ever fetched.
    """
    rows = (df.select(F.col(name).cast("string").alias("level")).filter(F.col("level").isNotNull())
            .distinct().limit(most + 1).collect())
    return sorted(r.level for r in rows) if len(rows) <= most else None


@dataclass(frozen=True)
class Design:
    """Columns of one spec after the intercept and the exposure.

    ``factor_slices`` holds, per factor, the positions of its indicator columns
    in the full design, needed to see how many levels a fit really has.
    ``absorbed`` names the factor that is eliminated instead, if there is one.
    """

    spec: ModelSpec
    columns: tuple[str, ...]
    factor_slices: tuple[tuple[int, ...], ...]
    absorbed: str | None = None

    @property
    def width(self) -> int:
        return 2 + len(self.columns)

    @property
    def exposure_at(self) -> int:
        """Place of the exposure's coefficient: an absorbed factor takes the intercept with it."""
        return 0 if self.absorbed else 1


@dataclass(frozen=True)
class DesignColumns:
    """Expressions of every design column, shared by all specs."""

    expressions: dict[str, Column]
    designs: tuple[Design, ...]


def build_designs(df: DataFrame, specs: Sequence[ModelSpec],
                  centre: dict[str, tuple[float, float]], wide_levels: int = WIDE_LEVELS) -> DesignColumns:
    """Design columns per spec.

    Numeric covariates are centred and scaled, which changes no exposure
    estimate but keeps the normal equations well conditioned.  A factor gets
    one indicator per level but the first, or is absorbed if it has more than
    ``wide_levels`` levels.  One factor of a spec can be; a spec with a second
    one is reported and left out.
    """
    expressions: dict[str, Column] = {}
    levels: dict[str, list[str] | None] = {}
    designs = []
    for spec in specs:
        columns: list[str] = []
        slices: list[tuple[int, ...]] = []
        wide: list[str] = []
        for name in spec.covariates:
            if is_factor(df, spec, name):
                if name not in levels:
                    levels[name] = factor_levels(df, name, wide_levels)
                if levels[name] is None:
                    wide.append(name)
                    continue
                names = [f"{name}={level}" for level in levels[name][1:]]
                for column, level in zip(names, levels[name][1:]):
                    expressions[column] = (F.col(name).cast("string") == level).cast("double")
                if not names:  # keeps the NULL rows of a one-level factor visible
                    names = [f"{name}=?"]
                    expressions[names[0]] = F.when(F.col(name).isNotNull(), F.lit(0.0))
                slices.append(tuple(2 + len(columns) + i for i in range(len(names))))
                columns += names
            else:
                mean, spread = centre[name]
                expressions[name] = (F.col(name).cast("double") - mean) / spread
                columns.append(name)
        if len(wide) > 1:
            warnings.warn(f"left out: model {spec.id} has several wide factors {wide}", stacklevel=3)
            continue
        designs.append(Design(spec, tuple(columns), tuple(slices), wide[0] if wide else None))
    return DesignColumns(expressions, tuple(designs))


def pattern_columns(spec: ModelSpec) -> frozenset[str]:
    """Covariates that must stay apart for a spec, the stratum's sex included."""
    sex = {"female"} if STRATA[spec.strata] is not None else set()
    return frozenset(spec.covariates) | sex


def covariate_patterns(df: DataFrame, exposures: Sequence[str], outcomes: Sequence[str],
                       covariates: Sequence[str]) -> DataFrame:
    """Distinct (exposures, covariates) with rows and cases per outcome.

    A grouped logistic fit equals the row-level fit, so this is the only pass
    over person-months.  Rows without any exposure cannot enter a fit.
    """
    has_exposure = F.coalesce(*exposures).isNotNull()
    counts = [F.count(o).alias(f"n|{o}") for o in outcomes]
    cases = [F.coalesce(F.sum(F.col(o).cast("int")), F.lit(0)).alias(f"k|{o}") for o in outcomes]
    return df.filter(has_exposure).groupBy(*exposures, *covariates).agg(*counts, *cases)


def fewer_patterns(patterns: DataFrame, exposures: Sequence[str], outcomes: Sequence[str],
                   covariates: Sequence[str]) -> DataFrame:
    """Patterns over fewer covariates, from finer ones."""
    sums = [F.sum(f"{kind}|{o}").alias(f"{kind}|{o}") for kind in "nk" for o in outcomes]
    return patterns.groupBy(*exposures, *covariates).agg(*sums)
