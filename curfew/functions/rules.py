"""Rules that derive the columns of a session. Native expressions only, shared
by the batch and the streaming path."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import fixed_values as V


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def is_valid_ip(ip: Column) -> Column:
    """Dotted quad outside the reserved blocks; private ranges are valid."""
    address = F.trim(ip)
    well_formed = address.rlike(V.IPV4) & ~address.rlike(V.RESERVED_IP)
    return F.coalesce(well_formed, F.lit(False))


def is_curfew_hour(hour: Column) -> Column:
    return (hour >= V.NIGHT_FROM_HOUR) | (hour < V.NIGHT_UNTIL_HOUR)


def exceeds_limit(seconds: Column) -> Column:
    return seconds > V.MINOR_LIMIT_SECONDS


def risk_label(is_minor: Column, seconds: Column, hour: Column) -> Column:
    """Grade of a session: one point for overtime, two for curfew, minors only.

    Anything but an explicit 0 in ``is_minor`` is graded; an unknown length or
    hour adds nothing.
    """
    points = V.OVERTIME * flag(exceeds_limit(seconds)) + V.CURFEW * flag(is_curfew_hour(hour))
    return F.when(is_minor == 0, V.NORMAL).otherwise(points).cast("int")


def is_minor(account_type: Column) -> Column:
    return flag(account_type == V.MINOR)


def is_night_login(login_period: Column) -> Column:
    """By the name of the period (00-06), not by the curfew hours."""
    return flag(login_period == V.NIGHT)


def is_heavy_gamer(seconds: Column) -> Column:
    return flag(exceeds_limit(seconds))


def is_paying_player(amount: Column) -> Column:
    return flag(amount > 0)


def minutes(seconds: Column) -> Column:
    return F.round(seconds.cast("decimal(18,6)") / 60, 1).cast(schema.MINUTES)


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(V.TIME_FORMAT))


def login_period(hour: Column, classes: int = 3) -> Column:
    if classes == 4:
        return (
            F.when(hour.between(0, 5), V.SMALL_HOURS)
            .when(hour.between(6, 11), V.MORNING)
            .when(hour.between(12, 17), V.AFTERNOON)
            .otherwise(V.LATE)
        )
    return (
        F.when(hour.between(6, 17), V.DAYTIME)
        .when(hour.between(18, 23), V.EVENING)
        .otherwise(V.NIGHT)
    )
