"""Month-grain dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(year: Column, month: Column) -> Column:
    """First day of the month, or NULL where year or month is not usable."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def month_floor(day: Column) -> Column:
    return F.trunc(day, "month")


def season(month: Column) -> Column:
    return (F.when(month.isin(12, 1, 2), "winter")
            .when(month.isin(3, 4, 5), "spring")
            .when(month.isin(6, 7, 8), "summer")
            .when(month.isin(9, 10, 11), "fall"))
