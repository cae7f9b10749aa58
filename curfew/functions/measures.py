"""Counts of distinct players next to sums and averages, without expansion.

Several conditional distinct counts of one column make Catalyst copy each row
once per count. Here rows are first folded to one per group and player
(combined before the shuffle, so a player holding a third of all rows is one
row per task), then folded to one per group. Nothing is copied or collected.
Values and conditions are SQL expressions over the rows.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curfew.functions.numbers import ratio

PLAYER = "player_id"


class Measure(NamedTuple):
    """Aggregates per player by suffix, and how their names combine to the result."""

    per_player: dict[str, str]
    overall: Callable[..., Column]


def players(where: str = "true") -> Measure:
    """Distinct players with at least one row that meets the condition."""
    return Measure(
        {"met": f"max(if({where}, 1, 0))"},
        lambda met: F.expr(f"cast(coalesce(sum(if({PLAYER} is not null, {met}, 0)), 0) as bigint)"),
    )


def rows(where: str = "true") -> Measure:
    return Measure({"n": f"count_if({where})"}, lambda n: F.expr(f"cast(coalesce(sum({n}), 0) as bigint)"))


def total(value: str) -> Measure:
    return Measure({"sum": f"sum({value})"}, lambda part: F.sum(part))


def mean(value: str, digits: int) -> Measure:
    return Measure(
        {"sum": f"sum({value})", "n": f"count({value})"},
        lambda part, n: ratio(f"sum({part})", f"sum({n})", digits),
    )


def lowest(value: str) -> Measure:
    return Measure({"low": f"min({value})"}, lambda part: F.min(part))


def highest(value: str) -> Measure:
    return Measure({"high": f"max({value})"}, lambda part: F.max(part))


def rollup_players(df: DataFrame, keys: list[str], **measures: Measure) -> DataFrame:
    """One row per group with the named measures; one row in all without keys."""
    partial, overall = [], []
    for name, measure in measures.items():
        stored = [f"{name}__{suffix}" for suffix in measure.per_player]
        partial += [F.expr(f"{sql} AS {column}") for column, sql in zip(stored, measure.per_player.values())]
        overall.append(measure.overall(*stored).alias(name))
    return df.groupBy(*keys, PLAYER).agg(*partial).groupBy(*keys).agg(*overall)
