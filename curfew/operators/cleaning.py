"""Cleaning of raw rows: required fields, length, time order, address, copies."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import fixed_values as V
from curfew.functions import rules
from curfew.functions.numbers import percent

REQUIRED = ["player_id", "login_time", "logout_time", "online_duration"]
STEPS = ["required", "duration", "time_order", "ip"]


def has_required(trimmed: bool = True) -> Column:
    met = F.lit(True)
    for name in REQUIRED:
        value = F.trim(F.col(name)) if trimmed else F.col(name)
        met = met & F.col(name).isNotNull() & (value != "")
    return met


def has_valid_duration() -> Column:
    """Whole seconds within the bounds; a length that is no whole number is refused."""
    seconds = F.col("online_duration").try_cast("int")
    return seconds.between(V.MIN_SESSION_SECONDS, V.MAX_SESSION_SECONDS)


def has_time_order() -> Column:
    return rules.parse_time(F.col("login_time")) < rules.parse_time(F.col("logout_time"))


def has_valid_ip() -> Column:
    return rules.is_valid_ip(F.col("login_ip"))


def clean_required(raw: DataFrame) -> DataFrame:
    return raw.filter(has_required())


def clean_duration(raw: DataFrame) -> DataFrame:
    return raw.filter(has_valid_duration())


def clean_time_order(raw: DataFrame) -> DataFrame:
    return raw.filter(has_time_order())


def clean_ip(raw: DataFrame) -> DataFrame:
    return raw.filter(has_valid_ip())


def clean_dedup(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct set of the 13 raw fields, and of ``keys`` beside them.

    Copies fold before the shuffle, so a row repeated any number of times sends
    one row per task. Columns beside the raw fields keep their least value,
    which is the same on every run and every retry.
    """
    others = [name for name in raw.columns if name not in [*schema.RAW_FIELDS, *keys]]
    if not others:
        return raw.distinct()
    kept = raw.groupBy(*schema.RAW_FIELDS, *keys).agg(*[F.min(name).alias(name) for name in others])
    return kept.select(*raw.columns)


def clean(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All rules; the order of the filters does not change what is left. Copies that differ in ``keys`` stay."""
    return clean_dedup(raw.filter(has_required() & has_valid_duration() & has_time_order() & has_valid_ip()), keys)


def first_failed_rule() -> Column:
    """The rule that drops a row first, NULL for rows that pass them all."""
    def fails(condition):
        return ~F.coalesce(condition, F.lit(False))

    return (
        F.when(fails(has_required()), "required")
        .when(fails(has_valid_duration()), "duration")
        .when(fails(has_time_order()), "time_order")
        .when(fails(has_valid_ip()), "ip")
    )


def clean_funnel(raw: DataFrame) -> DataFrame:
    """Rows in, rows left after each rule in order, rows kept, share removed.

    One pass: equal rows fold to one with a count, so the rules are weighed by
    the count and the copies are what is left of it.
    """
    folded = (
        raw.groupBy(*schema.RAW_FIELDS).agg(F.count(F.lit(1)).alias("copies"))
        .select("copies", first_failed_rule().alias("rule"))
    )
    passed = F.col("rule").isNull()
    counts = folded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        *[F.coalesce(F.sum(F.when(F.col("rule") == step, F.col("copies"))), F.lit(0)).alias(f"failed_{step}")
          for step in STEPS],
        F.count_if(passed).alias("rows_kept"),
    )
    left, columns = F.col("rows_before"), {}
    for step in STEPS:
        left = left - F.col(f"failed_{step}")
        columns[f"after_{step}"] = left
    removed = F.col("rows_before") - F.col("rows_kept")
    return counts.select(
        "rows_before",
        *[f"failed_{step}" for step in STEPS],
        *[column.alias(name) for name, column in columns.items()],
        "rows_kept",
        (left - F.col("rows_kept")).alias("removed_copies"),
        removed.alias("rows_removed"),
        percent("rows_before - rows_kept", "rows_before", 2).alias("removed_pct"),
    )


def clean_sql_path(raw: DataFrame) -> DataFrame:
    """The lighter rules: no trimming, no address rule, copies stay.

    Times are compared as text, which agrees with time order in the fixed format.
    """
    return raw.filter(
        F.col("player_id").isNotNull() & (F.col("player_id") != "")
        & F.col("login_time").isNotNull() & F.col("logout_time").isNotNull()
        & F.col("online_duration").try_cast("bigint").between(V.MIN_SESSION_SECONDS, V.MAX_SESSION_SECONDS)
        & (F.col("login_time") < F.col("logout_time"))
    )
