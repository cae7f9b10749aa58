"""Typing and grading of raw rows, the same on batch and stream."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import rules

_LOWER = ["account_type", "device_type"]
_UPPER = ["game_id"]
_TRIMMED = ["login_ip", "login_period", "game_region"]


def std_text(name: str) -> Column:
    text = F.trim(F.col(name))
    if name in _LOWER:
        text = F.lower(text)
    elif name in _UPPER:
        text = F.upper(text)
    return text.alias(name)


def std_times(name: str) -> Column:
    return rules.parse_time(F.col(name)).alias(name)


def std_number(name: str) -> Column:
    kinds = {"online_duration": "bigint", "match_count": "int",
             "recharge_amount": schema.MONEY, "item_consumption": "bigint"}
    return F.col(name).try_cast(kinds[name]).alias(name)


def standardize(raw: DataFrame) -> DataFrame:
    """Typed columns in place of the 13 texts; further columns pass through."""
    typed = {name: std_text(name) for name in [*_LOWER, *_UPPER, *_TRIMMED]}
    typed.update({name: std_times(name) for name in ["login_time", "logout_time"]})
    typed.update({
        name: std_number(name)
        for name in ["online_duration", "match_count", "recharge_amount", "item_consumption"]
    })
    return raw.withColumns(typed)


def derive(typed: DataFrame) -> DataFrame:
    """Add the columns computed from a session's own values, and its grade."""
    login, seconds = F.col("login_time"), F.col("online_duration")
    basic = typed.withColumns({
        "login_date": F.to_date(login),
        "login_hour": F.hour(login),
        "login_dayofweek": rules.iso_weekday(login),
        "online_duration_min": rules.minutes(seconds),
        "is_night_login": rules.is_night_login(F.col("login_period")),
        "is_minor": rules.is_minor(F.col("account_type")),
        "is_heavy_gamer": rules.is_heavy_gamer(seconds),
        "is_paying_player": rules.is_paying_player(F.col("recharge_amount")),
    })
    grade = rules.risk_label(F.col("is_minor"), seconds, F.col("login_hour"))
    return basic.withColumn("risk_label", grade)


def with_event_day(fact: DataFrame, batch_day: date | Column | None = None) -> DataFrame:
    """Day of a row: that of its login, or the day of the batch if one or a column of them is given."""
    day = F.to_date("login_time") if batch_day is None else F.lit(batch_day)
    return fact.withColumn("dt", day)


def to_facts(cleaned: DataFrame, batch_day: date | Column | None = None) -> DataFrame:
    """Cleaned raw rows as facts in declared column order, provenance last."""
    kept = [name for name, _ in schema.PROVENANCE_DDL if name in cleaned.columns]
    fact = with_event_day(derive(standardize(cleaned)), batch_day)
    return fact.select(*schema.FACT_COLUMNS, *kept, "dt")
