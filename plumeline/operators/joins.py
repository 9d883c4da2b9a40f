"""Joins in which a NULL key matches a NULL key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Tasks that the rows of one hot key are dealt to.
SPREAD = 64


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; keys appear once.

    How the sides meet is left to Spark, which knows their bytes when the query
    runs and splits a skewed key.
    """
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    matches = reduce(lambda a, b: a & b,
                     [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    joined = left.join(renamed, matches, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(
        *[f"__right_{k}" for k in keys])


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], hot: Column, how: str = "left",
                parts: int = SPREAD) -> DataFrame:
    """`join_null_safe` whose hot keys are dealt over ``parts`` tasks.

    ``hot`` is a condition on the key columns.  A left row with such a key goes
    to the part that a hash of the whole row names, a right row to all parts, so
    the right side must have few rows per hot key.  The left row alone decides
    its part: a repeated task deals as the first one did.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would return right rows once per part")
    hot = F.coalesce(hot, F.lit(False))
    hashed = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    part = F.when(hot, F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    every = F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return join_null_safe(left.withColumn("__part", part), right.withColumn("__part", F.explode(every)),
                          [*keys, "__part"], how).drop("__part")
