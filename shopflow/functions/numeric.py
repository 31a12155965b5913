"""Arithmetic column functions: age, shares, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopflow.constants import BAND_20_TO_30, BAND_30_PLUS, BAND_UNDER_20
from shopflow.functions.time import parse_date

DAYS_PER_YEAR = 365


def age_years(birthday: Column, as_of: Column | str) -> Column:
    """Whole 365-day years from ``birthday`` (yyyy-MM-dd) to ``as_of``,
    truncated toward zero; NULL when the birthday does not parse."""
    as_of_d = parse_date(F.lit(as_of)) if isinstance(as_of, str) else as_of.cast("date")
    days = F.datediff(as_of_d, parse_date(birthday))
    # (days - days % 365) is a multiple of 365 rounded toward zero, so the
    # division is exact and the cast does not round
    return ((days - days % DAYS_PER_YEAR) / DAYS_PER_YEAR).cast("int")


def share_pct(n: Column, total: Column) -> Column:
    """Percentage with one decimal: round(n * 1000 / total) / 10; 0 when the
    total is 0 (the reference's round of NaN)."""
    ratio = F.try_divide(n.cast("double") * 1000.0, total.cast("double"))
    return F.coalesce(F.round(ratio) / 10.0, F.lit(0.0))


def remainder_pct(*shares: Column) -> Column:
    """100 minus the other shares, rounded to one decimal (no float noise)."""
    rest = F.lit(100.0)
    for s in shares:
        rest = rest - s
    return F.round(rest, 1)


def age_band(age: Column) -> Column:
    return (F.when(age < 20, F.lit(BAND_UNDER_20))
            .when(age < 30, F.lit(BAND_20_TO_30))
            .otherwise(F.lit(BAND_30_PLUS)))
