"""Logistic fits with one factor of any number of levels, eliminated inside Spark.

A factor with thousands of levels would make systems with thousands of columns.
Its block of the normal equations is diagonal, though: with the other columns'
block A, the cross block B and the diagonal D, the other coefficients solve

    (A - B D^-1 B') beta = r - B D^-1 s

and a level's own effect is then (s - B' beta) / D.  Tasks sum one row per level
and fit, Spark adds them up by level, and one more aggregate gives a system as
narrow as the model without the factor, the only thing that the driver sees.
The effects of the levels stay a table and are joined to the patterns for the
next step.  The steps are those of `irls`, so is the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_table
from . import irls
from .design import STRATA, Design
from .irls import Fit, Gate, PatternLayout

# Sums of a fit at a level: deviance, weight, response, then by column the cross
# products with the level and the responses, then products of the columns.
_LEVEL_SCHEMA = "fit int, level string, sums array<double>"
_EFFECT_SCHEMA = "fit int, level string, effect double"


def _level_sums(fits: Sequence[Fit], layout: PatternLayout, start: bool):
    """Task function: one row per fit and level of each batch."""
    places = {fit.index: i for i, fit in enumerate(fits)}
    by_exposure: dict[str, list[Fit]] = {}
    for fit in fits:
        by_exposure.setdefault(fit.exposure, []).append(fit)
    at = {name: i for i, name in enumerate(layout.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.column_stack([np.asarray(batch.column(name).to_numpy(zero_copy_only=False), dtype=float)
                                    for name in layout.names])
            coded = batch.column("level").dictionary_encode()
            codes = coded.indices.to_numpy()
            effects = None if start else np.asarray(
                batch.column("effects").flatten(), dtype=float).reshape(batch.num_rows, -1)
            for exposure, group in by_exposure.items():
                design = group[0].design
                matrix = data[:, [at[f"x|{exposure}"], *(at[f"d|{c}"] for c in design.columns)]]
                keep = ~np.isnan(matrix).any(axis=1)
                sex = STRATA[design.spec.strata]
                if sex is not None:
                    keep &= data[:, at["sex"]] == sex
                kept = np.flatnonzero(keep)
                if not len(kept):
                    continue
                kept = kept[np.argsort(codes[kept], kind="stable")]
                matrix, code = matrix[kept], codes[kept]
                starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                levels = coded.dictionary.take(pa.array(code[starts]))
                weight = data[np.ix_(kept, [at[f"n|{f.outcome}"] for f in group])]
                response = data[np.ix_(kept, [at[f"k|{f.outcome}"] for f in group])]
                deviance = np.zeros_like(weight)
                if not start:
                    rows, cases = weight, response
                    eta = matrix @ np.column_stack([f.beta for f in group])
                    eta += effects[np.ix_(kept, [places[f.index] for f in group])]
                    mu, slope = irls._mean_and_weight(eta)
                    weight = rows * slope * slope / (mu * (1 - mu))
                    deviance = -2 * (cases * np.log(mu) + (rows - cases) * np.log1p(-mu))
                    response = weight * eta + slope / (mu * (1 - mu)) * (cases - rows * mu)
                u, v = np.triu_indices(matrix.shape[1])
                products = matrix[:, u] * matrix[:, v]
                for j, fit in enumerate(group):
                    w, z = weight[:, j:j + 1], response[:, j:j + 1]
                    sums = np.add.reduceat(np.hstack(
                        [deviance[:, j:j + 1], w, z, w * matrix, z * matrix, w * products]), starts, axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(starts), fit.index, np.int32)), levels,
                         pa.array(list(sums), pa.list_(pa.float64()))], names=["fit", "level", "sums"])

    return run


def _unpacked(batch: pa.RecordBatch, start: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fits, sums as of a step, rows per fit and level) of level sums with any weight."""
    fits = batch.column("fit").to_numpy()
    sums = np.asarray(batch.column("sums").flatten(), dtype=float).reshape(batch.num_rows, -1)
    present = sums[:, 1] > 0
    fits, sums = fits[present], sums[present]
    rows = sums[:, 1].copy()
    if start:  # from counts and cases to the first weights and responses
        p = _width(sums.shape[1])
        sums = irls._START_WEIGHT * sums
        for response, weight in ((2, 1), (slice(3 + p, 3 + 2 * p), slice(3, 3 + p))):
            sums[:, response] = irls._START_RESPONSE * (2 * sums[:, response] - sums[:, weight])
    return fits, sums, rows


def _width(slots: int) -> int:
    """Number of columns p whose sums take 3 + 2p + p(p + 1)/2 places."""
    return int(round((np.sqrt(25 + 8 * (slots - 3)) - 5) / 2))


def _eliminated(start: bool):
    """Task function: per fit the reduced system, with what the driver needs beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            fits, sums, rows = _unpacked(batch, start)
            p = _width(sums.shape[1]) if len(sums) else 0
            u, v = np.triu_indices(p)
            for fit in np.unique(fits).tolist():
                mine = sums[fits == fit]
                weight, response = mine[:, 1], mine[:, 2]
                cross, right, gram = mine[:, 3:3 + p], mine[:, 3 + p:3 + 2 * p], mine[:, 3 + 2 * p:]
                share = cross / weight[:, None]
                out = np.concatenate((
                    [mine[:, 0].sum(), len(mine), rows[fits == fit].sum()],
                    (right - share * response[:, None]).sum(axis=0), cross.sum(axis=0),
                    gram[:, u == v].sum(axis=0), (gram - share[:, u] * cross[:, v]).sum(axis=0)))
                totals[fit] = totals[fit] + out if fit in totals else out
        if totals:
            yield irls._as_batch(totals, {k: (0.0, 0.0) for k in totals})

    return run


def _effects(betas: dict[int, np.ndarray], start: bool):
    """Task function: the effect of each level under the new coefficients."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array([f in betas for f in batch.column("fit").to_pylist()], pa.bool_()))
            present = np.asarray(batch.column("sums").flatten(), dtype=float).reshape(
                batch.num_rows, -1)[:, 1] > 0 if batch.num_rows else np.zeros(0, bool)
            fits, sums, _ = _unpacked(batch, start) if batch.num_rows else (np.zeros(0, np.int32),) * 3
            effects = np.zeros(len(fits))
            for fit in np.unique(fits).tolist():
                mine, beta = fits == fit, betas[fit]
                effects[mine] = (sums[mine, 2] - sums[mine, 3:3 + len(beta)] @ beta) / sums[mine, 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fits, pa.int32()), batch.column("level").filter(pa.array(present)), pa.array(effects)],
                names=["fit", "level", "effect"])

    return run


def _by_level(effects: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """One row per level with the effects of ``fits`` in order; fits come from configuration."""
    entries = F.map_from_entries(F.collect_list(F.struct("fit", "effect")))
    order = F.array(*[F.lit(f.index) for f in fits])
    return effects.groupBy("level").agg(entries.alias("known")).select("level", F.transform(
        order, lambda i: F.coalesce(F.try_element_at("known", i), F.lit(float("nan")))).alias("effects"))


def _solved(values: np.ndarray, p: int) -> tuple[np.ndarray, float] | None:
    """Coefficients without the factor and the variance of the exposure, which comes first."""
    rhs, lengths = values[3:3 + p], values[3 + 2 * p:3 + 3 * p]
    return irls.solve(irls._unpack(values[3 + 3 * p:], p), rhs, lengths, target=0)


def fit_absorbed(patterns: DataFrame, layout: PatternLayout, design: Design, fits: Sequence[Fit],
                 gate: Gate) -> list[Fit]:
    """Run every admissible fit of one spec whose factor ``level`` is absorbed.

    ``patterns`` holds the columns of ``layout`` and ``level``; rows without a
    level count as rows and cases, not as fitted ones.  A factor left with one
    level gives no result, nor does an exposure that is constant within each
    level: it tells nothing beside the level.
    """
    bare = replace(design, columns=(), factor_slices=())
    numeric = patterns.select(*[c for c in layout.names if not c.startswith("d|")])
    counts = irls._collect_sums(
        {frozenset({design.spec.id}): (numeric, replace(layout, columns=()))},
        [replace(f, design=bare) for f in fits], irls._start_sums, lambda w: 4 + w + w * (w + 1) // 2)
    open_fits = []
    for fit in fits:
        low, high, s = counts[fit.index]
        n, cases, total, squares = s[:4]
        fit.n, fit.n_cases = round(n), round(cases)
        if gate.admits(n, cases):
            fit.spread = math.sqrt(max(0.0, squares - total * total / n) / (n - 1)) if low < high else 0.0
            open_fits.append(fit)  # a constant exposure only to count its fitted rows
    p, done, start = 1 + len(design.columns), [], True
    known = patterns.filter("level is not null")
    with ExitStack() as stack:
        rows = known
        while open_fits:
            sums = rows.mapInArrow(_level_sums(open_fits, layout, start), _LEVEL_SCHEMA)
            sums = sums.groupBy("fit", "level").agg(
                vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
            with scratch_table(sums, "levels") as levels:
                reduced = levels.mapInArrow(_eliminated(start), irls._SUMS_SCHEMA).groupBy("fit").agg(
                    Summarizer.sum(array_to_vector("sums")).alias("sums"))
                found = {r.fit: r.sums.toArray() for r in reduced.collect()}  # a row per fit
                still_open = []
                for fit in open_fits:
                    values = found.get(fit.index)
                    if values is None:
                        continue
                    if start:
                        fit.n_fit = round(values[2])
                        seen = values[3 + p:3 + 2 * p] / irls._START_WEIGHT
                        if not fit.spread or values[1] < 2 or any(
                                _one_level(seen, values[2], s) for s in design.factor_slices):
                            continue
                        deviance = irls._START_DEVIANCE * fit.n_fit
                    else:
                        deviance = values[0]
                        fit.converged = abs(deviance - fit.deviance) / (abs(deviance) + 0.1) < irls.TOLERANCE
                        if fit.converged or fit.steps >= irls.MAX_STEPS:
                            done.append(fit)
                            continue
                    step = _solved(values, p)
                    if step is not None and np.isfinite(step[0]).all():
                        fit.beta, fit.variance = step
                        fit.deviance, fit.steps = deviance, fit.steps + 1
                        still_open.append(fit)
                open_fits = still_open
                if open_fits:
                    effects = levels.mapInArrow(_effects({f.index: f.beta for f in open_fits}, start), _EFFECT_SCHEMA)
                    # Written, so that the join has plain shuffles on both sides and can split a hot level.
                    effects = stack.enter_context(scratch_table(_by_level(effects, open_fits), "effects"))
                    rows = known.join(effects, "level")
            start = False
    return done


def _one_level(seen: np.ndarray, rows: float, indicators: tuple[int, ...]) -> bool:
    """Does another factor, whose indicators count from the intercept, have one level only?"""
    counts = seen[[i - 1 for i in indicators]]
    return int((counts > 0).sum()) + int(rows - counts.sum() > 0.5) < 2
