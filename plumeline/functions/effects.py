"""Effect sizes, significance and their display forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Z95 = 1.96


def odds_ratio(estimate: Column) -> Column:
    return F.exp(estimate)


def odds_ratio_ci(estimate: Column, se: Column) -> tuple[Column, Column]:
    return F.exp(estimate - Z95 * se), F.exp(estimate + Z95 * se)


def linear_ci(estimate: Column, se: Column) -> tuple[Column, Column]:
    return estimate - Z95 * se, estimate + Z95 * se


def neg_log10(p: Column) -> Column:
    """-log10 of a p-value; an underflowed zero has no finite value and is NULL."""
    return F.when(p > 0, -F.log10(p))


def published_log10(p: Column) -> Column:
    """-log10 of the p-value as stored, as the public result views have it: infinite for an underflowed zero."""
    return F.coalesce(neg_log10(p), F.when(p == 0, F.lit(float("inf"))))


def significant(q: Column, level: float = 0.05) -> Column:
    return q < level


def pair_label(exposure: Column, outcome: Column) -> Column:
    return F.concat(exposure, F.lit(" → "), outcome)


def format_ci(value: Column, low: Column, high: Column) -> Column:
    return F.format_string("%.2f (%.2f-%.2f)", value, low, high)


def format_scientific(value: Column, digits: int = 2) -> Column:
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}e", value))
