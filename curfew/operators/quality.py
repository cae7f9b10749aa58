"""Checks of the fact table as rows: check_name, failing_rows, status.

Any number of checks over the report day share one scan. Checks over all days
and the check for repeated sessions are passes of their own, made only when
asked for.
"""

import re
from collections.abc import Iterable
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curfew.functions import fixed_values as V
from curfew.functions.conditions import AT_RISK, MINOR
from curfew.functions.measures import Measure, players, rollup_players, rows, total
from curfew.sources.warehouse import on_day

PASS, WARN, FAIL, INFO = "PASS", "WARN", "FAIL", "INFO"
SMALL_AMOUNT, HUGE_AMOUNT, MIN_TABLE_ROWS = 1, 50000, 1000
EXPECTED_DEVICES = ("android",)


class Check(NamedTuple):
    """Result rows of one check: name -> count, and the status of a count above 0."""

    status: str
    found: dict[str, str]


# Rows that meet a condition, by the name the checks use.
ROW_CONDITIONS = {
    "all_rows": "true",
    "no_player": "player_id IS NULL OR player_id = ''",
    "bad_label": "risk_label NOT IN (0, 1, 2, 3)",
    "labelled": "risk_label IN (0, 1, 2, 3)",
    "bad_account": f"account_type NOT IN ('{V.MINOR}', '{V.ADULT}')",
    "negative_seconds": "online_duration < 0",
    "negative_amount": "recharge_amount < 0",
    "zero_seconds": "online_duration = 0",
    "no_seconds": "online_duration <= 0",
    "longest": f"online_duration = {V.MAX_SESSION_SECONDS}",
    "hour_0": "login_hour = 0",
    "hour_23": "login_hour = 23",
    "small_amount": f"recharge_amount > 0 AND recharge_amount <= {SMALL_AMOUNT}",
    "over_limit": f"online_duration > {V.MAX_SESSION_SECONDS}",
    "minor_mismatch":
        f"(account_type = '{V.MINOR}' AND is_minor = 0) OR (account_type = '{V.ADULT}' AND is_minor = 1)",
    "night_mismatch":
        f"is_minor = 1 AND risk_label = {V.CURFEW} "
        f"AND NOT (login_hour >= {V.NIGHT_FROM_HOUR} OR login_hour < {V.NIGHT_UNTIL_HOUR})",
    "reserved_ip": f"login_ip RLIKE r'{V.RESERVED_IP_IN_FACT}'",
    "no_label": "risk_label IS NULL",
    "no_minor_flag": "is_minor IS NULL",
    "no_minutes": "online_duration_min IS NULL",
    "huge_amount": f"recharge_amount > {HUGE_AMOUNT}",
    **{f"device_{name}": f"device_type = '{name}'" for name in EXPECTED_DEVICES},
}
# Players with a row that meets a condition.
PLAYER_CONDITIONS = {"players": "true", "risk_players": AT_RISK, "minor_players": MINOR}


def _measures(checks: list["Check"]) -> dict[str, Measure]:
    """The counts that the given checks name, and no others."""
    named = set(re.findall(r"\w+", " ".join(text for check in checks for text in check.found.values())))
    measures = {name: rows(text) for name, text in ROW_CONDITIONS.items() if name in named}
    measures.update({name: players(text) for name, text in PLAYER_CONDITIONS.items() if name in named})
    if "amount_sum" in named:
        measures["amount_sum"] = total("recharge_amount")
    return measures


def _none_of(device: str) -> str:
    return f"if(device_{device} = 0, 1, 0)"


# Results are expressions over the measures above.
DAY_CHECKS = {
    "partition_nonempty": Check(FAIL, {"partition_nonempty": "if(all_rows = 0, 1, 0)"}),
    "player_null": Check(FAIL, {"player_null": "no_player"}),
    "label_domain": Check(FAIL, {"label_domain": "bad_label"}),
    "account_domain": Check(FAIL, {"account_domain": "bad_account"}),
    "duration_negative": Check(FAIL, {"duration_negative": "negative_seconds"}),
    "recharge_negative": Check(FAIL, {"recharge_negative": "negative_amount"}),
    "duration_zero": Check(INFO, {"duration_zero": "zero_seconds"}),
    "duration_not_positive": Check(WARN, {"duration_not_positive": "no_seconds"}),
    "duration_max": Check(INFO, {"duration_max": "longest"}),
    "hour_edges": Check(INFO, {"hour_edge_0": "hour_0", "hour_edge_23": "hour_23"}),
    "small_recharge": Check(INFO, {"small_recharge": "small_amount"}),
    "over_limit": Check(FAIL, {"over_limit": "over_limit"}),
    "minor_consistent": Check(FAIL, {"minor_consistent": "minor_mismatch"}),
    "night_consistent": Check(FAIL, {"night_consistent": "night_mismatch"}),
    "reserved_ip": Check(FAIL, {"reserved_ip": "reserved_ip"}),
    "rows_vs_players": Check(FAIL, {"rows_vs_players": "if(all_rows <= players, 1, 0)"}),
    "label_sum": Check(FAIL, {"label_sum": "all_rows - labelled"}),
    "recharge_total": Check(FAIL, {"recharge_total": "if(amount_sum < 0, 1, 0)"}),
    "device_domain": Check(FAIL, {"device_domain": " + ".join(map(_none_of, EXPECTED_DEVICES))}),
    "nulls": Check(WARN, {
        "null_risk_label": "no_label",
        "null_is_minor": "no_minor_flag",
        "null_online_duration_min": "no_minutes",
    }),
    "recharge_huge": Check(WARN, {"recharge_huge": "huge_amount"}),
    "cardinalities": Check(INFO, {
        "cardinality_players": "players",
        "cardinality_at_risk": "risk_players",
        "cardinality_minors": "minor_players",
    }),
}
OTHER_CHECKS = ["future_dt", "min_volume", "duplicates"]


def check_names() -> list[str]:
    return [*DAY_CHECKS, *OTHER_CHECKS]


def _as_rows(one_row: DataFrame, checks: list[Check]) -> DataFrame:
    """Unpivot one row of counts into a row per result."""
    entries = []
    for check in checks:
        for name, expression in check.found.items():
            count = F.expr(expression).cast("bigint")
            status = F.lit(INFO) if check.status == INFO else F.when(count > 0, check.status).otherwise(PASS)
            entries.append(F.struct(
                F.lit(name).alias("check_name"), count.alias("failing_rows"), status.alias("status")
            ))
    return one_row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def _duplicates(fact: DataFrame, day: date) -> DataFrame:
    """Pairs of player and login time that occur more than once."""
    pairs = on_day(fact, day).groupBy("player_id", "login_time").agg(F.count(F.lit(1)).alias("n"))
    found = pairs.agg(F.count_if(F.col("n") > 1).alias("pairs"))
    return _as_rows(found, [Check(FAIL, {"duplicates": "pairs"})])


def _whole_table(per_day: DataFrame, today: date, wanted: list[str]) -> DataFrame:
    found = per_day.agg(
        F.coalesce(F.sum(F.when(F.col("dt") > F.lit(today), F.col("n"))), F.lit(0)).alias("future"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )
    checks = {
        "future_dt": Check(FAIL, {"future_dt": "future"}),
        "min_volume": Check(FAIL, {"min_volume": f"if(n <= {MIN_TABLE_ROWS}, 1, 0)"}),
    }
    return _as_rows(found, [checks[name] for name in wanted])


def dq_report(fact: DataFrame, day: date, today: date, wanted: Iterable[str] | None = None,
              per_day: DataFrame | None = None) -> DataFrame:
    """The wanted checks, all of them by default. ``per_day`` has the rows of each day as dt and n where they
    are known, as by ``warehouse.rows_per_day``; else they are counted."""
    wanted = check_names() if wanted is None else list(wanted)
    unknown = set(wanted) - set(check_names())
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    parts = []
    of_day = {name: check for name, check in DAY_CHECKS.items() if name in wanted}
    if of_day:
        one_row = rollup_players(on_day(fact, day), [], **_measures(list(of_day.values())))
        parts.append(_as_rows(one_row, list(of_day.values())))
    of_table = [name for name in ["future_dt", "min_volume"] if name in wanted]
    if of_table:
        if per_day is None:
            per_day = fact.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
        parts.append(_whole_table(per_day, today, of_table))
    if "duplicates" in wanted:
        parts.append(_duplicates(fact, day))
    return reduce(DataFrame.unionByName, parts)
