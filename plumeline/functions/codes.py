"""Diagnosis codes and other text fields."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, functions as F

from ..config import Phenotype


def starts_with_any(code: str, prefixes: Iterable[str]) -> Column:
    """True if the column begins with any prefix; NULL codes give false.

    Prefixes of one length become one hashed ``IN`` set over a substring, so
    the cost per row does not grow with the number of prefixes.
    """
    by_length: dict[int, list[str]] = {}
    for prefix in prefixes:
        if not prefix.isalnum():
            raise ValueError(f"not a code prefix: {prefix!r}")
        by_length.setdefault(len(prefix), []).append(f"'{prefix}'")
    tests = [f"substring(`{code}`, 1, {length}) in ({', '.join(group)})"
             for length, group in sorted(by_length.items())]
    return F.expr(f"coalesce({' or '.join(tests) or 'false'}, false)")


def phenotype_flag(code: str, phenotype: Phenotype, *, on: str | None = None,
                   split_at: date | None = None) -> Column:
    """Does the primary diagnosis belong to the phenotype?

    By default both code spaces are tried on every visit.  ``split_at`` keeps
    ICD-9 prefixes for visits before that date and ICD-10 prefixes from it on,
    which separates codes such as ``V22`` that exist in both.
    """
    if split_at is None:
        return starts_with_any(code, phenotype.icd9 + phenotype.icd10)
    if on is None:
        raise ValueError("split_at needs the visit date")
    return (F.when(F.col(on) < F.lit(split_at), starts_with_any(code, phenotype.icd9))
            .otherwise(starts_with_any(code, phenotype.icd10)))


def join_present(columns: list[str], separator: str = ";") -> Column:
    """Non-null values of a row joined in column order; no value gives ''."""
    return F.concat_ws(separator, *[F.col(f"`{c}`").cast("string") for c in columns])


def leading(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def number(value: Column) -> Column:
    """Text to double; anything unreadable becomes NULL instead of failing."""
    return value.try_cast("double")
