"""Ratios in exact decimals, rounded half up, so that no result depends on the
order in which a shuffle delivers its rows. Arguments are SQL expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _share(part: str, whole: str, digits: int) -> Column:
    quotient = f"{part} / nullif(cast({whole} as decimal(18,0)), 0)"
    return F.expr(f"round(cast({quotient} as decimal(18,6)), {digits})")


def ratio(total: str, count: str, digits: int) -> Column:
    """total / count, NULL when count is zero."""
    return _share(f"cast({total} as decimal(28,2))", count, digits)


def percent(part: str, whole: str, digits: int) -> Column:
    """part of whole in percent, NULL when whole is zero."""
    return _share(f"cast({part} as decimal(18,0)) * 100", whole, digits)


def hours(minutes: str) -> Column:
    return F.expr(f"round(cast({minutes} / 60 as decimal(18,6)), 1)")
