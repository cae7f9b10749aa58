"""Conditions on a session, as SQL."""

from curfew.functions import fixed_values as V

MINOR = "is_minor = 1"
AT_RISK = "risk_label > 0"
PAYING = "is_paying_player = 1"
CURFEW_BREACH = f"is_minor = 1 AND risk_label IN ({V.CURFEW}, {V.SEVERE})"
LABELS = [V.NORMAL, V.OVERTIME, V.CURFEW, V.SEVERE]
OTHER_LABEL = f"risk_label IS NULL OR risk_label NOT IN ({V.NORMAL}, {V.OVERTIME}, {V.CURFEW}, {V.SEVERE})"


def label_is(label: int) -> str:
    return f"risk_label = {label}"
