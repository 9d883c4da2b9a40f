"""Reweighted least squares for many logistic models at once.

Tasks turn their share of the covariate patterns into weighted cross products
per fit; Spark sums them by fit; the driver solves one small system per fit.
The number of fits is exposures x outcomes x specs, set by the study
configuration, so the summed rows that reach the driver are few and fixed.

The iteration follows the public definition of a binomial GLM: it starts from
fitted values (y + 1/2) / 2, stops when the deviance changes by less than 1e-8
relative to itself, and gives up after 25 steps keeping the last estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from .design import STRATA, Design

TOLERANCE = 1e-8
MAX_STEPS = 25
# Share of a column's squared length, once earlier columns are projected out,
# under which the column carries no information of its own.
ALIASED = 1e-11
_SUMS_SCHEMA = "fit int, low double, high double, sums array<double>"
_EPS = np.finfo(float).eps
_ETA_LIMIT = 30.0
# Start values: fitted 3/4 for a case and 1/4 otherwise.
_START_WEIGHT = 3 / 16
_START_RESPONSE = math.log(3) + 4 / 3
_START_DEVIANCE = -2 * math.log(0.75)


@dataclass(frozen=True)
class Gate:
    """When a test is worth fitting; ``min_cases`` applies on both sides."""

    min_rows: int = 100
    min_cases: int = 11

    def admits(self, n: float, cases: float) -> bool:
        return n >= self.min_rows and self.min_cases <= cases < n - self.min_cases

    def admits_column(self, n: Column, cases: Column) -> Column:
        """The same rule on columns."""
        return (n >= self.min_rows) & (cases >= self.min_cases) & (cases < n - self.min_cases)


@dataclass(frozen=True)
class TwoClassGate(Gate):
    """The earlier gate: enough rows, and both outcome values occur."""

    min_rows: int = 500

    def admits(self, n: float, cases: float) -> bool:
        return n >= self.min_rows and 0 < cases < n

    def admits_column(self, n: Column, cases: Column) -> Column:
        return (n >= self.min_rows) & (cases > 0) & (cases < n)


@dataclass
class Fit:
    """Driver-side state of one model, a few hundred bytes."""

    index: int
    design: Design
    exposure: str
    outcome: str
    n: int = 0
    n_cases: int = 0
    n_fit: int = 0
    spread: float = 0.0
    steps: int = 0
    deviance: float = math.inf
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    variance: float = math.nan
    converged: bool = False


def solve(gram: np.ndarray, rhs: np.ndarray, lengths: np.ndarray | None = None,
          target: int = 1) -> tuple[np.ndarray, float] | None:
    """Least-squares coefficients and the unscaled variance of the exposure.

    Columns are taken in order and one that depends on the earlier ones is
    left out with coefficient 0, so a redundant covariate never displaces the
    exposure.  None if the exposure itself is redundant.  ``lengths`` are the
    squared lengths of the columns where ``gram`` has lost a part of them, and
    ``target`` is the exposure's place.
    """
    p = len(rhs)
    lengths = np.diag(gram) if lengths is None else lengths
    lower = np.zeros((p, p))
    kept: list[int] = []
    for j in range(p):
        k = len(kept)
        row = np.zeros(k)
        for i, column in enumerate(kept):
            row[i] = (gram[j, column] - lower[i, :i] @ row[:i]) / lower[i, i]
        rest = gram[j, j] - row @ row
        if gram[j, j] > 0 and rest > ALIASED * lengths[j]:
            lower[k, :k], lower[k, k] = row, math.sqrt(rest)
            kept.append(j)
    if target not in kept:
        return None
    k = len(kept)
    inverse = np.linalg.inv(lower[:k, :k])
    covariance = inverse.T @ inverse
    beta = np.zeros(p)
    beta[kept] = covariance @ rhs[kept]
    at = kept.index(target)
    return beta, covariance[at, at]


def _unpack(values: np.ndarray, width: int) -> np.ndarray:
    gram = np.zeros((width, width))
    gram[np.triu_indices(width)] = values[:width * (width + 1) // 2]
    return gram + np.triu(gram, 1).T


def _mean_and_weight(eta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fitted probability and its slope, bounded away from 0 as the GLM does."""
    odds = np.exp(np.clip(eta, -_ETA_LIMIT, _ETA_LIMIT))
    odds = np.where(eta < -_ETA_LIMIT, _EPS, np.where(eta > _ETA_LIMIT, 1 / _EPS, odds))
    mu = odds / (1 + odds)
    slope = np.where(np.abs(eta) > _ETA_LIMIT, _EPS, odds / (1 + odds) ** 2)
    return mu, slope


@dataclass(frozen=True)
class PatternLayout:
    """Column positions of the numeric pattern rows handed to the tasks."""

    exposures: tuple[str, ...]
    columns: tuple[str, ...]
    outcomes: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [*(f"x|{e}" for e in self.exposures), *(f"d|{c}" for c in self.columns), "sex",
                *(f"n|{o}" for o in self.outcomes), *(f"k|{o}" for o in self.outcomes)]


def _rows_by_model(batch, layout: PatternLayout, fits: Sequence[Fit], complete_only: bool):
    """Yield (fits, design matrix, rows, cases) per spec and exposure of a batch."""
    data = np.column_stack([
        np.asarray(batch.column(i).to_numpy(zero_copy_only=False), dtype=float)
        for i in range(batch.num_columns)])
    at = {name: i for i, name in enumerate(layout.names)}
    models: dict[tuple[str, str], list[Fit]] = {}
    for fit in fits:
        models.setdefault((fit.design.spec.id, fit.exposure), []).append(fit)
    for (_, exposure), group in models.items():
        design = group[0].design
        x = data[:, at[f"x|{exposure}"]]
        keep = ~np.isnan(x)
        sex = STRATA[design.spec.strata]
        if sex is not None:
            keep &= data[:, at["sex"]] == sex
        covariates = data[:, [at[f"d|{c}"] for c in design.columns]]
        if complete_only:
            keep &= ~np.isnan(covariates).any(axis=1)
        if not keep.any():
            continue
        matrix = np.column_stack([np.ones(keep.sum()), x[keep], covariates[keep]])
        rows = data[np.ix_(keep, [at[f"n|{f.outcome}"] for f in group])]
        cases = data[np.ix_(keep, [at[f"k|{f.outcome}"] for f in group])]
        yield group, matrix, rows, cases


def _start_sums(fits: Sequence[Fit], layout: PatternLayout, slots: int):
    """Task function: counts, exposure moments and unweighted cross products."""

    def run(batches: Iterator) -> Iterator:
        sums = {f.index: np.zeros(slots) for f in fits}
        low = {f.index: math.inf for f in fits}
        high = {f.index: -math.inf for f in fits}
        for batch in batches:
            for group, matrix, rows, cases in _rows_by_model(batch, layout, fits, False):
                x = matrix[:, 1]
                usable = ~np.isnan(matrix).any(axis=1)
                full = matrix[usable]
                upper = np.triu_indices(matrix.shape[1])
                moments = np.vstack([np.ones_like(x), x, x * x]) @ rows
                for j, fit in enumerate(group):
                    present = x[rows[:, j] > 0]
                    if present.size:
                        low[fit.index] = min(low[fit.index], present.min())
                        high[fit.index] = max(high[fit.index], present.max())
                    out = sums[fit.index]
                    out[:4] += [moments[0, j], cases[:, j].sum(), moments[1, j], moments[2, j]]
                    width = fit.design.width
                    out[4:4 + width] += full.T @ cases[usable, j]
                    gram = (full.T * rows[usable, j]) @ full
                    out[4 + width:4 + width + len(upper[0])] += gram[upper]
        yield _as_batch(sums, {i: (low[i], high[i]) for i in sums})

    return run


def _step_sums(fits: Sequence[Fit], layout: PatternLayout, slots: int):
    """Task function: deviance and weighted cross products at the current betas."""

    def run(batches: Iterator) -> Iterator:
        sums = {f.index: np.zeros(slots) for f in fits}
        for batch in batches:
            for group, matrix, rows, cases in _rows_by_model(batch, layout, fits, True):
                eta = matrix @ np.column_stack([f.beta for f in group])
                mu, slope = _mean_and_weight(eta)
                weight = rows * slope * slope / (mu * (1 - mu))
                deviance = -2 * (cases * np.log(mu) + (rows - cases) * np.log1p(-mu))
                response = weight * eta + slope / (mu * (1 - mu)) * (cases - rows * mu)
                rhs = matrix.T @ response
                upper = np.triu_indices(matrix.shape[1])
                for j, fit in enumerate(group):
                    out = sums[fit.index]
                    width = fit.design.width
                    out[0] += deviance[:, j].sum()
                    out[1:1 + width] += rhs[:, j]
                    gram = (matrix.T * weight[:, j]) @ matrix
                    out[1 + width:1 + width + len(upper[0])] += gram[upper]
        yield _as_batch(sums, {i: (0.0, 0.0) for i in sums})

    return run


def _as_batch(sums: dict[int, np.ndarray], ends: dict[int, tuple[float, float]]):
    import pyarrow as pa

    keys = list(sums)
    columns = [pa.array(keys, pa.int32()),
               pa.array([ends[k][0] for k in keys], pa.float64()),
               pa.array([ends[k][1] for k in keys], pa.float64()),
               pa.array([sums[k] for k in keys], pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, names=["fit", "low", "high", "sums"])


def _collect_sums(tables: dict, fits: Sequence[Fit], kernel, slots_of) -> dict[int, tuple]:
    """One distributed pass over every pattern table that still has open fits.

    Fits of one design width are summed together, so that no narrow model
    carries the numbers of a wide one through the shuffle.
    """
    sums: DataFrame | None = None
    widths: dict[int, DataFrame] = {}
    for covariates, (patterns, layout) in tables.items():
        mine = [f for f in fits if f.design.spec.id in covariates]
        for width in {f.design.width for f in mine}:
            alike = [f for f in mine if f.design.width == width]
            part = patterns.mapInArrow(kernel(alike, layout, slots_of(width)), _SUMS_SCHEMA)
            widths[width] = widths[width].union(part) if width in widths else part
    for part in widths.values():
        summed = part.groupBy("fit").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                         Summarizer.sum(array_to_vector("sums")).alias("sums"))
        sums = summed if sums is None else sums.union(summed)
    return {r[0]: (r[1], r[2], r[3].toArray()) for r in sums.collect()}


def fit_all(tables: dict, fits: Sequence[Fit], gate: Gate) -> list[Fit]:
    """Run every admissible fit to convergence and return those with a result.

    ``tables`` maps the spec ids served by a pattern table to that table and
    its layout.  Finished fits leave the later passes.
    """
    open_fits = []
    start = _collect_sums(tables, fits, _start_sums,
                          lambda w: 4 + w + w * (w + 1) // 2)
    for fit in fits:
        low, high, s = start[fit.index]
        n, cases, total, squares = s[:4]
        width = fit.design.width
        to_cases = s[4:4 + width]
        gram = _unpack(s[4 + width:], width)
        fit.n, fit.n_cases, fit.n_fit = round(n), round(cases), round(gram[0, 0])
        if not gate.admits(n, cases) or not low < high or fit.n_fit == 0:
            continue
        if any(_levels_present(gram, slice_) < 2 for slice_ in fit.design.factor_slices):
            continue
        fit.spread = math.sqrt(max(0.0, squares - total * total / n) / (n - 1))
        step = solve(_START_WEIGHT * gram,
                     _START_WEIGHT * _START_RESPONSE * (2 * to_cases - gram[0]))
        if step is not None:
            fit.beta, fit.variance = step
            fit.deviance, fit.steps = _START_DEVIANCE * fit.n_fit, 1
            open_fits.append(fit)

    done: list[Fit] = []
    while open_fits:
        passed = _collect_sums(tables, open_fits, _step_sums,
                               lambda w: 1 + w + w * (w + 1) // 2)
        still_open = []
        for fit in open_fits:
            s, width = passed[fit.index][2], fit.design.width
            deviance = s[0]
            fit.converged = abs(deviance - fit.deviance) / (abs(deviance) + 0.1) < TOLERANCE
            if fit.converged or fit.steps >= MAX_STEPS:
                done.append(fit)
                continue
            step = solve(_unpack(s[1 + width:], width), s[1:1 + width])
            if step is not None and np.isfinite(step[0]).all():
                fit.beta, fit.variance = step
                fit.deviance, fit.steps = deviance, fit.steps + 1
                still_open.append(fit)
        open_fits = still_open
    return done


def _levels_present(gram: np.ndarray, indicators: tuple[int, ...]) -> int:
    counts = gram[0, list(indicators)]
    return int((counts > 0).sum()) + int(gram[0, 0] - counts.sum() > 0)
