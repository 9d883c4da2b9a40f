"""Queries behind the result, exposure and cohort views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import FEATURES, Feature
from ..functions import effects
from ..functions.missing import nan_to_null
from ..operators.joins import join_null_safe
from ..operators.quantiles import narrowed_quantile
from ..session import materialize
from .quality import percent

HISTOGRAM_BINS = 30


def strength(results: DataFrame) -> Column:
    """-log10 of p; the stored one where there is one, as it outlives an underflowed p."""
    plain = effects.neg_log10(F.col("p_value"))
    return F.coalesce("neg_log10_p", plain) if "neg_log10_p" in results.columns else plain


def strongest_first(results: DataFrame) -> list[Column]:
    """Order by p, by its logarithm where p itself is zero, then by name."""
    order = [F.col("p_value").asc_nulls_last()]
    if "neg_log10_p" in results.columns:
        order = [F.col("neg_log10_p").desc_nulls_last(), *order]
    return [*order, *[F.col(c) for c in ("model_spec_id", "exposure_id", "outcome")]]


def filter_results(results: DataFrame, *, model_spec_id: str | None = None,
                   outcome: str | None = None, q_max: float = 1.0,
                   p_max: float | None = None, published: bool = False) -> DataFrame:
    """Results under the given limits, with plotting columns.

    ``published`` takes ``log10_p`` from the p-value itself, infinite where that
    has underflowed to zero, instead of the logarithm that outlives it.
    """
    kept = results.filter(F.col("q_value") <= q_max)
    if model_spec_id:
        kept = kept.filter(F.col("model_spec_id") == model_spec_id)
    if p_max is not None:
        kept = kept.filter(F.col("p_value") <= p_max)
    if outcome and outcome != "all":
        kept = kept.filter(F.col("outcome") == outcome)
    return kept.withColumns({
        "log10_p": effects.published_log10(F.col("p_value")) if published else strength(results),
        "significant": effects.significant(F.col("q_value")),
        "label": effects.pair_label(F.col("exposure_id"), F.col("outcome"))})


def result_table(results: DataFrame) -> DataFrame:
    """Display form of results, smallest p first."""
    return (results.orderBy(*strongest_first(results))
            .select("outcome", "exposure_id", "n", "n_cases",
                    *[F.round(c, 3).alias(c) for c in ("odds_ratio", "or_ci_low", "or_ci_high")],
                    effects.format_scientific(F.col("p_value")).alias("p_value"),
                    F.round("q_value", 4).alias("q_value")))


def ranked(results: DataFrame) -> DataFrame:
    """Results with their place, strongest first.

    Ranges of the order are sorted side by side; a row's place is its number in
    its range and the rows of all earlier ranges, of which there are as many as
    shuffle partitions.
    """
    order = strongest_first(results)
    cut = results.repartitionByRange(*order).sortWithinPartitions(*order)
    # Numbered as sorted: the upper bits are the range, the lower ones the row in it.
    cut = materialize(cut.withColumn("_at", F.monotonically_increasing_id()), "places")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(cut.groupBy(part.cast("int")).count().collect())
    earlier = [0]
    for i in range(max(sizes, default=-1) + 1):
        earlier.append(earlier[-1] + sizes.get(i, 0))
    offset = F.get(F.array(*[F.lit(n).cast("bigint") for n in earlier]), part.cast("int"))
    return cut.withColumn("place", (offset + row + 1).cast("int")).drop("_at")


def export_table(results: DataFrame) -> DataFrame:
    """Every column of filtered results, unrounded, strongest first."""
    return results.orderBy(*strongest_first(results))


def top_hits(results: DataFrame, k: int, *, q_below: float | None = None) -> DataFrame:
    """The k smallest p-values, optionally among significant results only."""
    if q_below is not None:
        results = results.filter(F.col("q_value") < q_below)
    return results.orderBy(*strongest_first(results)).limit(k)


def with_labels(results: DataFrame, features: Sequence[Feature] = FEATURES) -> DataFrame:
    """Exposure descriptions, joined from the configured feature list."""
    spark = results.sparkSession
    labels = spark.createDataFrame([(f.id, f.description) for f in features],
                                   "exposure_id string, exposure_label string")
    return results.join(F.broadcast(labels), "exposure_id", "left")


def formatted_hits(results: DataFrame, k: int = 10) -> DataFrame:
    """The k strongest results with labels and display forms, in order."""
    hits = with_labels(top_hits(results, k)).orderBy(*strongest_first(results))
    ci = effects.format_ci(F.col("odds_ratio"), F.col("or_ci_low"), F.col("or_ci_high"))
    return (hits.select("strata", "model_spec_id", "outcome", "exposure_label", "n_cases",
                        ci.alias("or_ci"),
                        effects.format_scientific(F.col("p_value")).alias("p_value")))


def histogram(df: DataFrame, value: str, by: Sequence[str] = (),
              bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width counts over each group's range, the end bins centred on the ends."""
    present = nan_to_null(df.select(value, *by)).filter(F.col(value).isNotNull())
    ends = present.groupBy(*by).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    ranged = join_null_safe(present, ends, list(by)) if by else present.join(F.broadcast(ends))  # one row
    span = F.col("__high") - F.col("__low")
    width = F.when(span > 0, span / (bins - 1)).otherwise(F.lit(0.1))
    low = F.col("__low")
    at = F.ceil((F.col(value) - low) / width - 0.5).cast("int")
    return (ranged.groupBy(at.alias("bin"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.first(low).alias("__low"), F.first(width).alias("__width"))
            .withColumn("bin_centre", F.col("__low") + F.col("bin") * F.col("__width"))
            .drop("__low", "__width"))


def odds_ratio_histogram(results: DataFrame) -> DataFrame:
    """Counts of log10 odds ratios by significance."""
    scaled = results.withColumns({"log10_or": F.log10("odds_ratio"),
                                  "significant": effects.significant(F.col("q_value"))})
    return histogram(scaled, "log10_or", ["significant"])


def options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def range_statistics(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, median, spread, ends and missing days of a daily series."""
    series, value = nan_to_null(series), F.col("value")
    stats = narrowed_quantile(series, list(by), "value", 0.5, alias="median_val", extra={
        "mean_val": F.avg(value), "sd_val": F.stddev_samp(value), "min_val": F.min(value),
        "max_val": F.max(value), "n_missing": F.count_if(value.isNull())})
    rounded = ["mean_val", "median_val", "sd_val", "min_val", "max_val"]
    return stats.select(*by, *[F.round(c, 2).alias(c) for c in rounded], "n_missing")


def cohort_overview(months: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return months.agg(
        F.count_distinct("person_id").alias("n_persons"), total.alias("n_person_months"),
        F.min("ym").alias("min_date"), F.max("ym").alias("max_date"),
        F.count("tract_geoid").alias("n_with_tract"),
        percent(F.count("tract_geoid"), total, 1).alias("pct_with_tract"),
        F.count("zip5").alias("n_with_zip"),
        percent(F.count("zip5"), total, 1).alias("pct_with_zip"))


def timeline(months: DataFrame) -> DataFrame:
    """Person-months and persons by calendar month."""
    return months.groupBy("ym").agg(F.count(F.lit(1)).alias("n_person_months"),
                                    F.count_distinct("person_id").alias("n_persons"))


def geographic_coverage(months: DataFrame) -> DataFrame:
    return months.groupBy("zip5").agg(
        F.count(F.lit(1)).alias("n_person_months"),
        F.count("tract_geoid").alias("n_with_tract"))


def calendar(daily: DataFrame) -> DataFrame:
    """Days and mean value of each exposure by year and month."""
    return nan_to_null(daily).groupBy("exposure_id", F.year("obs_date").alias("year"),
                         F.month("obs_date").alias("month")).agg(
        F.count("value").alias("n_days"), F.avg("value").alias("mean_val"))
