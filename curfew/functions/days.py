"""Distinct days as bits of long integers.

A closed range of days fits in a few words; ``bit_or`` folds them in a hash
aggregate, so days are counted beside other measures without a distinct.
"""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_WORD = 63


def _words(start: date, end: date) -> range:
    return range((end - start).days // DAYS_PER_WORD + 1)


def day_bits(day: str, start: date, end: date, name: str, where: str = "true") -> list[Column]:
    """Aggregates holding the set of days within start..end, one per word."""
    found = []
    for word in _words(start, end):
        first = word * DAYS_PER_WORD
        last = min(DAYS_PER_WORD - 1, (end - start).days - first)
        place = f"datediff({day}, DATE '{start:%Y-%m-%d}') - {first}"
        inside = f"{place} BETWEEN 0 AND {last} AND ({where})"
        found.append(F.expr(f"bit_or(if({inside}, shiftleft(1L, {place}), 0L)) AS {name}__{word}"))
    return found


def merged_day_bits(start: date, end: date, name: str) -> list[Column]:
    return [F.expr(f"bit_or({name}__{word}) AS {name}__{word}") for word in _words(start, end)]


def day_count(start: date, end: date, name: str) -> Column:
    counts = " + ".join(f"bit_count({name}__{word})" for word in _words(start, end))
    return F.expr(f"cast({counts} as bigint)")
