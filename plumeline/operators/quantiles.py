"""Exact quantiles of groups of any size by narrowing histograms.

A quantile lies between two neighbouring ranks.  Each pass counts a group's rows
in equal-width bins of the interval that holds both, and the bin of the ranks is
the next interval: a thousandth of it.  Only counts are shuffled, a row per group
and bin from each task, so neither the number of rows nor of distinct values
matters.  Values are put in order only where few are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .joins import join_spread
from .ranks import _value, beside_aggregates, group_key

BINS = 1024
# An interval with at most this many rows is put in order in one array.
FEW = 4096


def _bin(bins: int) -> Column:
    """Bin of ``_val`` in [lo, hi]: the ends have their own, so every pass narrows.

    Halved before they are subtracted, as the width of the largest interval of
    doubles is not a double; an infinite end leaves one bin for all between.
    """
    low, value = F.col("lo") / 2, F.col("_val")
    width = (F.col("hi") / 2 - low) / (bins - 2)
    usable = (width > 0) & (width < F.lit(float("inf")))
    between = F.when(usable, F.least(F.lit(bins - 2), F.floor((value / 2 - low) / width) + 1)).otherwise(F.lit(1))
    return F.when(value == F.col("lo"), 0).when(value == F.col("hi"), bins - 1).otherwise(between)


def _inside(rows: DataFrame, state: DataFrame) -> DataFrame:
    return join_spread(rows, state, ["_grp"], F.lit(True), "inner").filter(F.col("_val").between(F.col("lo"), F.col("hi")))


def _narrowed(rows: DataFrame, state: DataFrame, bins: int) -> DataFrame:
    """The next interval of each group: the bin of both ranks, or two values where a bin ends between them."""
    ranks = ["low", "high", "share"]
    counts = _inside(rows, state).groupBy("_grp", *ranks, _bin(bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_val").alias("least"), F.max("_val").alias("most"))
    earlier = Window.partitionBy("_grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def holds(rank: str) -> Column:
        return (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("n"))

    def of(condition: Column, column: str) -> Column:
        return F.max(F.when(condition, F.col(column)))

    low, high = holds("low"), holds("high")
    picked = placed.filter(low | high).groupBy("_grp", *ranks).agg(
        of(low & high, "n").alias("n"), of(low, "before").alias("before"), of(low, "least").alias("least"),
        of(low, "most").alias("most"), of(high, "least").alias("next"))
    apart = F.col("n").isNull()
    lo, hi = F.when(apart, F.col("most")).otherwise(F.col("least")), F.when(apart, F.col("next")).otherwise(F.col("most"))
    return picked.select(
        "_grp", *[(F.col(r) - F.col("before")).alias(r) for r in ("low", "high")], "share",
        lo.alias("lo"), hi.alias("hi"), F.col("n").alias("inside"), (apart | (lo == hi)).alias("known"))


def narrowed_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, *, alias: str,
                      extra: Mapping[str, Column] | None = None, bins: int = BINS, few: int = FEW) -> DataFrame:
    """Exact interpolated quantile per group, next to other aggregates.

    A group without a value has a NULL quantile; NaN is missing.  Passes follow
    the spread of the values, not their number: one or two where they lie
    evenly, more where most crowd in a thousandth of their range.
    """
    if bins < 3:
        raise ValueError("narrowing needs a bin between its two end bins")
    keys = list(keys)
    rows = df.select(group_key(keys).alias("_grp"), _value(value).alias("_val"))
    rows = materialize(rows.filter(F.col("_val").isNotNull()), "values")  # read once per pass
    place = (F.col("inside") - 1) * F.lit(float(q))
    state = rows.groupBy("_grp").agg(F.count(F.lit(1)).alias("inside"), F.min("_val").alias("lo"),
                                     F.max("_val").alias("hi"))
    state = state.select("_grp", F.floor(place).alias("low"), F.ceil(place).alias("high"),
                         (place - F.floor(place)).alias("share"), "lo", "hi", "inside",
                         (F.col("lo") == F.col("hi")).alias("known"))
    wide = ~F.col("known") & (F.col("inside") > few)
    ended = []
    while True:
        state = materialize(state, "interval")
        ended.append(state.filter(~wide))
        state = state.filter(wide)
        if state.isEmpty():
            break
        state = _narrowed(rows, state, bins)
    ended = reduce(DataFrame.unionByName, ended)
    listed = _inside(rows, ended.filter(~F.col("known"))).groupBy("_grp", "low", "high", "share").agg(
        F.sort_array(F.collect_list("_val")).alias("values"))
    listed = listed.select("_grp", "share", *[
        F.get("values", F.col(rank).cast("int")).alias(end) for rank, end in (("low", "lo"), ("high", "hi"))])
    found = ended.filter("known").select("_grp", "share", "lo", "hi").unionByName(listed)
    between = F.when(F.col("share") == 0, F.col("lo")).otherwise(
        (1 - F.col("share")) * F.col("lo") + F.col("share") * F.col("hi"))
    quantiles = found.select(*[F.col(f"_grp.{k}").alias(k) for k in keys], between.alias(alias))
    return beside_aggregates(df, keys, quantiles, extra)
