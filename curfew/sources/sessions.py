"""Sessions read out of the ``events`` table: as typed facts and as raw text.

Both are projections of one scan. A filter on ``dt`` reaches the file scan as a
range of the event time, and only the columns a query names are read.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import fixed_values as V
from curfew.functions import rules


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def _player(user_id: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(user_id.cast("string"), 8, "0"))


def _game(event_id: Column) -> Column:
    return F.concat(F.lit("GAME_"), F.lpad((event_id % 10 + 1).cast("string"), 3, "0"))


def _amount() -> Column:
    paid = F.col("value").cast(schema.MONEY)
    return F.when(F.col("event_type") == "purchase", paid).otherwise(F.lit(0).cast(schema.MONEY))


def _address(event_id: Column) -> Column:
    return F.concat(
        F.lit("10.0."), (event_id % 256).cast("string"), F.lit("."), (event_id % 250 + 1).cast("string")
    )


def facts(events: DataFrame) -> DataFrame:
    """The fact of SURVEY section 1.2 with its day ``dt``."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    duration = (event_id * 7919) % 21601
    base = events.select(
        _player(user_id).alias("player_id"),
        F.when(user_id % 10 < 3, V.MINOR).otherwise(V.ADULT).alias("account_type"),
        _game(event_id).alias("game_id"),
        F.col("ts").cast("timestamp").alias("login_time"),
        duration.alias("online_duration"),
        (event_id % 16).cast("int").alias("match_count"),
        _amount().alias("recharge_amount"),
        (event_id % 200).alias("item_consumption"),
        _address(event_id).alias("login_ip"),
        _pick(V.REGIONS, event_id % 12).alias("game_region"),
        _pick(V.DEVICES, event_id % 3).alias("device_type"),
    )
    login, seconds = F.col("login_time"), F.col("online_duration")
    hour = F.hour(login)
    period = rules.login_period(hour)
    minor = rules.is_minor(F.col("account_type"))
    return base.select(
        "player_id", "account_type", "game_id", "login_time",
        F.timestamp_add("SECOND", seconds.cast("int"), login).alias("logout_time"),
        F.to_date(login).alias("login_date"),
        hour.alias("login_hour"),
        rules.iso_weekday(login).alias("login_dayofweek"),
        "online_duration",
        rules.minutes(seconds).alias("online_duration_min"),
        "match_count", "recharge_amount", "item_consumption", "login_ip",
        period.alias("login_period"),
        rules.is_night_login(period).alias("is_night_login"),
        "game_region", "device_type",
        minor.alias("is_minor"),
        rules.is_heavy_gamer(seconds).alias("is_heavy_gamer"),
        rules.is_paying_player(F.col("recharge_amount")).alias("is_paying_player"),
        rules.risk_label(minor, seconds, hour).alias("risk_label"),
        F.to_date(login).alias("dt"),
    )


def raw_rows(events: DataFrame) -> DataFrame:
    """Raw text rows with known damage, one in 97 of them twice; ``dt`` as yyyyMMdd."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    login = F.col("ts").cast("timestamp")
    seconds = (event_id * 7919) % 21601
    delta = F.when(event_id % 131 == 0, -seconds).otherwise(seconds).cast("int")
    duration = (
        F.when(event_id % 103 == 0, "abc")
        .when(event_id % 107 == 0, "-5")
        .when(event_id % 109 == 0, "21601")
        .otherwise(seconds.cast("string"))
    )
    address = (
        F.when(event_id % 113 == 0, "127.0.0.1")
        .when(event_id % 127 == 0, "300.1.1.1")
        .otherwise(_address(event_id))
    )
    copies = F.sequence(F.lit(1), F.when(event_id % 97 == 0, 2).otherwise(1))
    return events.select(
        F.when(event_id % 101 == 0, "").otherwise(_player(user_id)).alias("player_id"),
        F.when(user_id % 10 < 3, " Minor").otherwise(V.ADULT).alias("account_type"),
        _game(event_id).alias("game_id"),
        F.date_format(login, V.TIME_FORMAT).alias("login_time"),
        F.date_format(F.timestamp_add("SECOND", delta, login), V.TIME_FORMAT).alias("logout_time"),
        duration.alias("online_duration"),
        (event_id % 16).cast("string").alias("match_count"),
        _amount().cast("string").alias("recharge_amount"),
        (event_id % 200).cast("string").alias("item_consumption"),
        address.alias("login_ip"),
        rules.login_period(F.hour(login)).alias("login_period"),
        _pick(V.REGIONS, event_id % 12).alias("game_region"),
        _pick(V.DEVICES, event_id % 3).alias("device_type"),
        F.date_format(login, V.DAY_FORMAT).alias("dt"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def day_range(events: DataFrame) -> tuple[date | None, date | None]:
    """First and newest day, from the least and greatest time alone."""
    found = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    return tuple(value.date() if value else None for value in found)


def newest_day(events: DataFrame) -> date | None:
    return day_range(events)[1]
