"""Classes, wordings and display forms of a session's values.

Arguments are SQL expressions over the rows.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from curfew.functions import fixed_values as V


def _text(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def _case(branches: Iterable[tuple[str, str]], otherwise: str) -> Column:
    listed = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return F.expr(f"CASE {listed} ELSE {otherwise} END")


def _classes(value: str, compare: str, bounds, otherwise: str) -> Column:
    return _case([(f"{value} {compare} {bound}", _text(name)) for bound, name in bounds], _text(otherwise))


def record_class(seconds: str) -> Column:
    """Five classes closed above, for record counts."""
    return _classes(seconds, "<=", V.RECORD_CLASSES, V.RECORD_CLASS_ELSE)


def dashboard_class(minutes: str) -> Column:
    """Six classes open above."""
    return _classes(minutes, "<", V.DASHBOARD_CLASSES, V.DASHBOARD_CLASS_ELSE)


def minor_class(minutes: str) -> Column:
    """Seven lettered classes open above."""
    return _classes(minutes, "<", V.MINOR_CLASSES, V.MINOR_CLASS_ELSE)


def histogram_class(minutes: str) -> Column:
    """Smallest listed bound that holds the value; NULL above the last."""
    return _case([(f"{minutes} <= {bound}", str(bound)) for bound in V.HISTOGRAM_BOUNDS], "NULL")


def recharge_class(amount: str) -> Column:
    paid = [(f"{amount} <= {bound}", _text(name)) for bound, name in V.RECHARGE_CLASSES]
    return _case([(f"{amount} = 0", _text(V.RECHARGE_ZERO)), *paid], _text(V.RECHARGE_CLASS_ELSE))


def risk_text(label: str, vocabulary: str) -> Column:
    """Wording of a label; labels outside the vocabulary give its default."""
    words = [(f"{label} = {value}", _text(word)) for value, word in V.RISK_WORDING[vocabulary].items()]
    return _case(words, _text(V.RISK_WORDING_ELSE.get(vocabulary)))


def yes_no(condition: str) -> Column:
    return _case([(condition, _text(V.YES))], _text(V.NO))


def night_flag(hour: str) -> Column:
    curfew = f"{hour} >= {V.NIGHT_FROM_HOUR} OR {hour} < {V.NIGHT_UNTIL_HOUR}"
    return _case([(curfew, _text(V.NIGHT))], _text(V.NOT_NIGHT))


def duration_text(minutes: str) -> Column:
    return F.expr(
        f"concat(cast(floor({minutes} / 60) as int), '{V.HOURS_UNIT}', "
        f"cast(floor({minutes} % 60) as int), '{V.MINUTES_UNIT}')"
    )


def intervention_tier(days: str) -> Column:
    return _classes(days, ">=", V.TIERS, V.TIER_ELSE)


def clock_text(time: str) -> Column:
    return F.expr(f"coalesce(date_format({time}, 'HH:mm'), '{V.MISSING}')")


def hour_axis(hour: str) -> Column:
    return F.expr(f"concat(lpad({hour}, 2, '0'), ':00')")


def risk_badge(label: str) -> Column:
    word = f"CASE {label} WHEN 3 THEN '{V.RISK_BADGE[3]}' WHEN 2 THEN '{V.RISK_BADGE[2]}' ELSE '{V.RISK_BADGE[1]}' END"
    return F.expr(f"coalesce(concat('Lv', {label}, ' ', {word}), '{V.MISSING}')")


def amount_text(amount: str) -> Column:
    return F.expr(
        f"coalesce(concat('{V.CURRENCY}', cast(round({amount}, 0) as decimal(20,0))), '{V.MISSING}')"
    )


def custom_order(column: str, values: list[str]) -> Column:
    """Sort key by position in a list; values not listed come first."""
    return F.expr(f"array_position(array({', '.join(map(_text, values))}), {column})")
