"""Narrowing quantiles and joins of hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeline.operators import joins, quantiles
from plumeline.plans import explore, quality

from conftest import rows


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


GROUPS = {
    "normal": np.random.default_rng(5).normal(size=300),
    "ties": np.repeat([1.0, 2.0, 5.0], [60, 61, 3]),
    "crowded": np.r_[np.random.default_rng(6).random(200), 1e12, -1e12],
    "one": np.array([7.0]),
    "two": np.array([4.0, 1.0]),
    "constant": np.full(50, 3.5),
    "wide": np.array([-1.7e308, 1.7e308, 0.0, 1e-320, 2e-320, 5.0] * 4),
    None: np.random.default_rng(7).integers(0, 9, 90).astype(float),
}


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 1.0])
def test_narrowing_finds_the_exact_quantile(spark, q):
    data = [(g, float(v)) for g, vs in GROUPS.items() for v in vs] + [("void", None), ("normal", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    got = dict(rows(quantiles.narrowed_quantile(df, ["g"], "v", q, alias="m", bins=5, few=4)))
    assert got.pop("void") is None
    assert got.keys() == GROUPS.keys()
    for name, values in GROUPS.items():
        v, at = np.sort(values), (len(values) - 1) * q
        lo, hi, share = v[int(np.floor(at))], v[int(np.ceil(at))], at - np.floor(at)
        assert got[name] == pytest.approx(lo if share == 0 else (1 - share) * lo + share * hi, rel=1e-12), name


def test_narrowing_without_groups_and_without_rows(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("v"))
    assert quantiles.narrowed_quantile(df, [], "v", 0.5, alias="m", few=3, extra={"top": F.max("v")}).first() == (
        1999.0, 999.5)
    assert quantiles.narrowed_quantile(df.limit(0), [], "v", 0.5, alias="m").first()[0] is None
    keyed = df.withColumn("g", F.lit("a")).limit(0)
    assert quantiles.narrowed_quantile(keyed, ["g"], "v", 0.5, alias="m").count() == 0


def test_infinite_values_have_places(spark):
    df = spark.createDataFrame([(float(v),) for v in ("-inf", "inf", "3", "4", "9")] * 3, "v double")
    assert quantiles.narrowed_quantile(df, [], "v", 0.5, alias="m", bins=3, few=1).first()[0] == 4.0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_returns_what_the_plain_join_returns(spark, how):
    left = spark.createDataFrame([(i, None if i % 2 else f"k{i % 7}") for i in range(60)] + [(1, None)], "id int, k string")
    right = spark.createDataFrame([(None, 10), ("k2", 20), ("k2", 21)], "k string, v int")
    spread = joins.join_spread(left, right, ["k"], F.col("k").isNull(), how, parts=5)
    plain = joins.join_null_safe(left, right, ["k"], how)
    assert spread.columns == plain.columns
    assert sorted(rows(spread), key=str) == sorted(rows(plain), key=str)


def test_spread_join_deals_a_hot_key_to_many_tasks(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 10 < 6, F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([(None, 10)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.join_spread(left, right, ["k"], F.col("k").isNull())
        tasks = joined.filter("v = 10").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in tasks) == 1600 and max(r["count"] for r in tasks) < 900
    with pytest.raises(ValueError):
        joins.join_spread(left, right, ["k"], F.col("k").isNull(), "full")


def test_distinct_persons_do_not_expand_rows(spark):
    months = spark.createDataFrame([("a", None, None, "1", 1)], "person_id string, ym date, tract_geoid string, zip5 string, "
                                   "n_visits int")
    for report in (explore.cohort_overview, explore.timeline, quality.cohort_summary):
        assert "Expand" not in plan(report(months))
