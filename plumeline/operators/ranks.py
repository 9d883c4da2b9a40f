"""Exact ranks, quantiles and p-value adjustment over groups of any size.

A window over a group sorts the whole group in one task.  Ranks are therefore
built in two levels, whatever the size: the distinct values are cut into ranges
by (group, value) as a global sort would cut them, ranked inside each range, and
shifted by the counts of the group's earlier ranges.  The number of ranges
follows the session's shuffle partitions, and the result is exact wherever the
cuts fall.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.missing import no_nan
from ..session import materialize
from .joins import join_null_safe


# Rows of a sorted range that are ranked together.
BLOCK_BITS = 16


def group_key(keys: Sequence[str]) -> Column:
    """All keys as one struct: NULL fields compare equal, so joins keep them."""
    return F.struct(*keys) if keys else F.lit(0)


def _value(value: str) -> Column:
    return no_nan(F.col(value).cast("double"))


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """Distinct values per group with counts: ``_grp, _val, cnt, before, total, part``.

    ``before`` is the number of rows of the group with a smaller value and
    ``total`` its number of present rows.  ``ranges`` fixes the number of
    ranges (for tests).
    """
    rows = df.select(group_key(keys).alias("_grp"), _value(value).alias("_val"))
    distinct = rows.filter(F.col("_val").isNotNull()).groupBy("_grp", "_val").agg(
        F.count(F.lit(1)).alias("cnt"))
    cut = (distinct.repartitionByRange(ranges, "_grp", "_val") if ranges
           else distinct.repartitionByRange("_grp", "_val"))
    # Written with its range number, which is then a value and no longer a place.
    cut = materialize(cut.withColumn("part", F.spark_partition_id()), "ranks")

    by_part = Window.partitionBy("_grp").orderBy("part")
    sizes = cut.groupBy("_grp", "part").agg(F.sum("cnt").alias("part_cnt"))
    sizes = sizes.select(
        "_grp", "part",
        F.coalesce(F.sum("part_cnt").over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("earlier"),
        F.sum("part_cnt").over(Window.partitionBy("_grp")).alias("total"))
    inside = Window.partitionBy("_grp", "part").orderBy("_val").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # The window below needs rows by (group, range) anyway, so the join shares its shuffle.
    return cut.join(sizes, ["_grp", "part"]).select(
        "_grp", "_val", "cnt", "part", "total",
        (F.col("earlier") + F.sum("cnt").over(inside) - F.col("cnt")).alias("before"))


def _in_blocks(df: DataFrame, keys: Sequence[str], value: str, ranges: int | None, block_bits: int) -> DataFrame:
    """The rows with ``_grp``, ``_val``, ``_at`` (a number in order of both) and ``_block``.

    One shuffle by ranges of group and value, sorted side by side; a hash of the
    row spreads equal values, so no value needs a task of its own.  A block is
    the next 2**block_bits rows of a range at most.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rows = df.withColumns({"_grp": group_key(keys), "_val": _value(value), "_salt": F.xxhash64(*hashed)})
    order = ["_grp", "_val", "_salt"]
    cut = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    # Numbered as sorted, the range in the upper bits; written, so that the number is a value.
    cut = cut.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).drop("_salt")
    return materialize(cut, "ranges").withColumn("_block", F.shiftright("_at", block_bits))


def _adjust_blocks(df: DataFrame, keys: Sequence[str], p: str, fdr: str, bonferroni: str | None,
                   ranges: int | None, block_bits: int) -> DataFrame:
    """Step-up adjustment in sorted blocks: ranks from the counts of earlier blocks, minima from later ones.

    The two tables between the passes have a row per group and block.  Rows of
    one value may differ in rank here: the smallest adjusted value from the row
    on includes that of the last of them, which is the one all of them get.
    """
    cut = _in_blocks(df, keys, p, ranges, block_bits)
    unit = ["_grp", "_block"]
    by_block = Window.partitionBy("_grp").orderBy("_block")
    counts = cut.filter(F.col("_val").isNotNull()).groupBy(*unit).agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    counts = counts.select(
        *unit, "first", F.sum("n").over(Window.partitionBy("_grp")).alias("total"),
        F.coalesce(F.sum("n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    rank = F.col("earlier") + F.col("_at") - F.col("first") + 1
    placed = cut.join(counts, unit, "left").withColumn("_scaled", F.col("_val") * F.col("total") / rank)
    later = placed.groupBy(*unit).agg(F.min("_scaled").alias("least"))
    later = later.select(*unit, F.min("least").over(
        by_block.rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    down = Window.partitionBy(*unit).orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.col("_val").isNotNull()
    out = {fdr: F.when(known, F.least(F.lit(1.0), F.min("_scaled").over(down), F.col("later")))}
    if bonferroni:
        out[bonferroni] = F.when(known, F.least(F.lit(1.0), F.col("_val") * F.col("total")))
    return placed.join(later, unit).select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in out.items()])


def _adjust_small(df: DataFrame, keys: Sequence[str], p: str, fdr: str,
                  bonferroni: str | None) -> DataFrame:
    group = Window.partitionBy(*keys)
    value = _value(p)
    total = F.count(value).over(group)
    rank = F.count(value).over(group.orderBy(value.asc_nulls_last()))  # ties share the top rank
    df = df.withColumns({"__total": total, "__scaled": value * total / rank})
    down = group.orderBy(value.desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = {fdr: F.when(value.isNotNull(), F.least(F.lit(1.0), F.min("__scaled").over(down)))}
    if bonferroni:
        out[bonferroni] = F.when(value.isNotNull(), F.least(F.lit(1.0), value * F.col("__total")))
    return df.withColumns(out).drop("__total", "__scaled")


def adjust_p(df: DataFrame, keys: Sequence[str], *, p: str = "p_value", fdr: str = "p_adj_fdr",
             bonferroni: str | None = "p_adj_bonferroni", bounded: bool = False,
             ranges: int | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Benjamini-Hochberg and Bonferroni adjustment inside each group.

    The number of tests is the number of present p-values; a missing p-value
    stays missing.  ``bounded`` says the caller knows each group is small by
    configuration (a scan of a fixed number of models), where windows do.  Else
    the rows are dealt to ranges once and adjusted where they are.
    """
    if bounded:
        return _adjust_small(df, keys, p, fdr, bonferroni)
    return _adjust_blocks(df, keys, p, fdr, bonferroni, ranges, block_bits)


def bonferroni(df: DataFrame, keys: Sequence[str], *, p: str = "p_value",
               alias: str = "p_adj_bonferroni") -> DataFrame:
    """Bonferroni alone needs no ranks: a count per group, joined back."""
    sizes = df.groupBy(*keys).agg(F.count(_value(p)).alias("__tests"))
    value = _value(p)
    return join_null_safe(df, sizes, list(keys)).withColumn(
        alias, F.when(value.isNotNull(), F.least(F.lit(1.0), value * F.col("__tests")))).drop("__tests")


def bonferroni_flag(df: DataFrame, keys: Sequence[str], *, p: str = "p_value",
                    alias: str = "bonferroni_sig", level: float = 0.05) -> DataFrame:
    """Is p under ``level`` divided by the group's number of rows, NULLs included?"""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return join_null_safe(df, sizes, list(keys)).withColumn(
        alias, _value(p) < level / F.col("__rows")).drop("__rows")


def beside_aggregates(df: DataFrame, keys: list[str], quantiles: DataFrame,
                      extra: Mapping[str, Column] | None) -> DataFrame:
    """``extra`` aggregates of every group, joined with what is known of groups that have a value."""
    counted = [*[c.alias(n) for n, c in (extra or {}).items()], F.count(F.lit(1)).alias("__n")]
    if keys:
        return join_null_safe(df.groupBy(*keys).agg(*counted).drop("__n"), quantiles, keys)
    return df.agg(*counted).join(F.broadcast(quantiles), F.lit(True), "left").drop("__n")  # one row on either side


def grouped_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, *, alias: str,
                     extra: Mapping[str, Column] | None = None, ranges: int | None = None) -> DataFrame:
    """Exact interpolated quantile per group, next to other aggregates.

    Read off the ranks, so a group may be of any size; a group without a value
    has a NULL quantile.
    """
    keys = list(keys)
    position = (F.col("total") - 1) * q
    low, high = F.floor(position), F.ceil(position)

    def at(rank: Column) -> Column:
        inside = (F.col("before") <= rank) & (rank < F.col("before") + F.col("cnt"))
        return F.max(F.when(inside, F.col("_val")))

    picked = ranked_values(df, keys, value, ranges).groupBy("_grp").agg(
        at(low).alias("lo"), at(high).alias("hi"), F.max(position - low).alias("part_of"))
    quantiles = picked.select(
        *([F.col(f"_grp.{k}").alias(k) for k in keys]),
        F.when(F.col("part_of") == 0, F.col("lo"))
        .otherwise((1 - F.col("part_of")) * F.col("lo") + F.col("part_of") * F.col("hi")).alias(alias))
    return beside_aggregates(df, keys, quantiles, extra)
