"""Multi-day analysis: risk by day, minors, night logins, streaks, cross tables."""

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curfew.functions import classes
from curfew.functions import fixed_values as V
from curfew.functions.conditions import AT_RISK, CURFEW_BREACH, MINOR, PAYING, label_is
from curfew.functions.days import day_bits, day_count, merged_day_bits
from curfew.functions.measures import highest, mean, players, rollup_players, rows, total
from curfew.functions.numbers import hours, percent, ratio
from curfew.operators.daily import players_per_label
from curfew.operators.dashboard import MINUTES, few, severity_order, share_of_total, top
from curfew.sources.warehouse import in_range, on_day


def daily_risk(fact: DataFrame, first: date, last: date) -> DataFrame:
    grouped = rollup_players(
        in_range(fact, first, last), ["dt"],
        active_players=players(), at_risk_players=players(AT_RISK), **players_per_label("label_"),
    )
    return few(grouped).withColumns({
        "at_risk_pct": percent("at_risk_players", "active_players", 2),
        "severe_pct": percent("label_3", "active_players", 2),
    }).orderBy("dt")


def daily_minor_risk(fact: DataFrame, first: date, last: date) -> DataFrame:
    grouped = rollup_players(
        in_range(fact, first, last).filter(MINOR), ["dt"],
        active_minors=players(), **players_per_label("label_"),
        avg_online_min=mean(MINUTES, 0),
        max_online_min=highest(MINUTES),
        paying=players(PAYING),
        total_recharge=total("recharge_amount"),
    )
    return few(grouped).withColumns({
        "max_online_min": F.round("max_online_min", 0),
        "paying_pct": percent("paying", "active_minors", 2),
    }).drop("paying").orderBy("dt")


def minor_duration_dist(fact: DataFrame, day: date) -> DataFrame:
    classed = on_day(fact, day).filter(MINOR).withColumn(
        "duration_range", classes.minor_class(MINUTES)
    )
    grouped = rollup_players(
        classed, ["duration_range"],
        player_count=players(), record_count=rows(), **players_per_label("label_"),
    )
    return share_of_total(grouped, "player_count", 2).orderBy("duration_range")


def curfew_breaches(fact: DataFrame, first: date, last: date) -> DataFrame:
    """Sessions of minors labelled 2 or 3 in a closed range of days."""
    return in_range(fact, first, last).filter(CURFEW_BREACH)


def night_totals(fact: DataFrame, first: date, last: date) -> DataFrame:
    """Curfew breaches of every minor in a closed range of days.

    Folded by player, game and device in a hash aggregate, then by player; the
    usual device is that of the longest session, the first by name on a tie.
    """
    parts = curfew_breaches(fact, first, last).groupBy("player_id", "game_id", "device_type").agg(
        F.count(F.lit(1)).alias("logins"),
        F.sum(MINUTES).alias("minutes"),
        F.count(MINUTES).alias("timed_rows"),
        F.max(MINUTES).alias("longest"),
        F.sum("recharge_amount").alias("recharge"),
        F.max("dt").alias("latest"),
        *day_bits("dt", first, last, "days"),
        *day_bits("dt", first, last, "severe", label_is(V.SEVERE)),
    )
    by_player = parts.groupBy("player_id").agg(
        F.sum("logins").alias("night_logins"),
        F.sum("minutes").alias("minutes"),
        F.sum("timed_rows").alias("timed_rows"),
        F.sum("recharge").alias("total_recharge"),
        F.count_distinct("game_id").alias("game_count"),
        F.max("latest").alias("latest_violation"),
        F.min_by("device_type", F.struct(-F.col("longest"), "device_type")).alias("usual_device"),
        *merged_day_bits(first, last, "days"),
        *merged_day_bits(first, last, "severe"),
    )
    return by_player.select(
        "player_id",
        day_count(first, last, "days").alias("violation_days"),
        "night_logins",
        ratio("minutes", "timed_rows", 0).alias("avg_online_min"),
        hours("minutes").alias("total_hours"),
        "total_recharge",
        day_count(first, last, "severe").alias("severe_days"),
        "game_count", "latest_violation", "usual_device",
    )


def night_order() -> list:
    return [F.desc("night_logins"), F.desc("total_hours"), F.col("player_id")]


def night_topn(fact: DataFrame, first: date, last: date, n: int = 100) -> DataFrame:
    return top(night_totals(fact, first, last), night_order(), n)


def night_export(fact: DataFrame, first: date, last: date, n: int = 500) -> DataFrame:
    return top(curfew_breaches(fact, first, last), severity_order(), n).select(
        "dt", "player_id", "game_id", "login_time", "logout_time", MINUTES,
        classes.duration_text(MINUTES).alias("duration_text"),
        "login_ip", "device_type", "game_region", "match_count", "recharge_amount",
        classes.risk_text("risk_label", "night_export").alias("risk_type"),
        classes.yes_no(label_is(V.SEVERE)).alias("is_severe"),
        classes.yes_no(PAYING).alias("is_paying"),
    )


def cross_analysis(fact: DataFrame, day: date) -> DataFrame:
    keys = ["account_type", "login_period", "risk_label", "device_type"]
    grouped = rollup_players(
        on_day(fact, day), keys,
        player_count=players(), record_count=rows(),
        avg_online_min=mean(MINUTES, 0),
        avg_match_count=mean("match_count", 1),
        avg_recharge=mean("recharge_amount", 2),
        total_recharge=total("recharge_amount"),
        paying=total("is_paying_player"),
    )
    periods = [V.DAYTIME, V.EVENING, V.NIGHT]
    return grouped.withColumns({
        "risk_level": classes.risk_text("risk_label", "cross"),
        "paying_pct": percent("paying", "record_count", 2),
    }).orderBy(
        "account_type", classes.custom_order("login_period", periods), "risk_label", "device_type"
    ).drop("paying", "risk_label")


def today_snapshot(fact: DataFrame, now: datetime) -> DataFrame:
    """Figures of the day of ``now``, with players that logged in half an hour ago or later."""
    recent = f"login_time >= TIMESTAMP '{now - timedelta(minutes=30):%Y-%m-%d %H:%M:%S.%f}'"
    found = rollup_players(
        on_day(fact, now.date()), [],
        total_active=players(), minor_active=players(MINOR), at_risk_count=players(AT_RISK),
        severe_count=players(label_is(V.SEVERE)),
        avg_online_min=mean(MINUTES, 0),
        total_recharge=total("recharge_amount"),
        active_last_30m=players(recent),
        overtime_count=players(label_is(V.OVERTIME)),
        curfew_count=players(label_is(V.CURFEW)),
    )
    rate = percent("severe_count", "minor_active", 2)
    return found.withColumn("minor_severe_pct", rate)


def longest_session(fact: DataFrame) -> DataFrame:
    """The longest session of every player, whole.

    The filter on the row number lets each task keep one row per player before
    the shuffle, so a player with very many sessions is no burden.
    """
    order = Window.partitionBy("player_id").orderBy(F.desc(MINUTES), "login_time", "game_id")
    return fact.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == 1).drop("rn")


def streak_islands(days: DataFrame) -> DataFrame:
    """Runs of consecutive days per player, from distinct (player_id, dt) rows.

    A window holds one row per day of a player, however many sessions there are.
    """
    order = Window.partitionBy("player_id").orderBy("dt")
    keyed = days.withColumn("island", F.date_sub("dt", F.row_number().over(order)))
    return keyed.groupBy("player_id", "island").agg(
        F.count(F.lit(1)).alias("consecutive_days"),
        F.min("dt").alias("streak_start"),
        F.max("dt").alias("streak_end"),
    ).drop("island")


def severe_sessions(fact: DataFrame, first: date) -> DataFrame:
    return fact.filter(F.col("dt") >= F.lit(first)).filter(f"{MINOR} AND {label_is(V.SEVERE)}")


def severe_islands(fact: DataFrame, first: date, min_days: int = 3) -> DataFrame:
    days = severe_sessions(fact, first).select("player_id", "dt").distinct()
    return streak_islands(days).filter(F.col("consecutive_days") >= min_days)


def streak_join(streaks: DataFrame, fact: DataFrame) -> DataFrame:
    """Severe sessions that lie within a streak of their player. Give the fact of
    the days in question, not of all days.

    Streaks are spelled out by day, so the range becomes a key: a player's rows
    spread over the days, both sides are shuffled for the join alone, and
    adaptive execution can split what is still large. Streaks known to be small
    at run time are broadcast.
    """
    days = streaks.withColumn("dt", F.explode(F.sequence("streak_start", "streak_end")))
    sessions = fact.filter(f"{MINOR} AND {label_is(V.SEVERE)}").select(
        "player_id", "dt", "login_time", "game_id", MINUTES, "recharge_amount"
    )
    return days.join(sessions, ["player_id", "dt"]).select(
        *streaks.columns, "dt", "login_time", "game_id", MINUTES, "recharge_amount"
    )


def streak_join_by_player(streaks: DataFrame, fact: DataFrame) -> DataFrame:
    """The same for two tables in buckets by player, which are joined where they lie.

    The player is the only key and the days are a range, so that the buckets fit. A player with a third of
    all rows is joined in one task; ``streak_join`` splits it.
    """
    sessions = fact.filter(f"{MINOR} AND {label_is(V.SEVERE)}").select(
        F.col("player_id").alias("player"), "dt", "login_time", "game_id", MINUTES, "recharge_amount")
    within = F.col("dt").between(F.col("streak_start"), F.col("streak_end"))
    return streaks.join(sessions, (F.col("player_id") == F.col("player")) & within).select(
        *streaks.columns, "dt", "login_time", "game_id", MINUTES, "recharge_amount"
    )


def severe_streak_totals(fact: DataFrame, first: date, min_days: int = 3) -> DataFrame:
    """Players graded severe on consecutive days, with totals over the streak.

    Sessions fold to one row per player, day and game first. Islands, totals
    and distinct games then all come from those rows, kept by player: no join
    back to the sessions.
    """
    by_game = severe_sessions(fact, first).groupBy("player_id", "dt", "game_id").agg(
        F.sum(MINUTES).alias("minutes"),
        F.count(MINUTES).alias("timed_rows"),
        F.sum("recharge_amount").alias("recharge"),
    )
    by_day = Window.partitionBy("player_id").orderBy("dt")
    keyed = by_game.withColumn("island", F.date_sub("dt", F.dense_rank().over(by_day)))
    found = keyed.groupBy("player_id", "island").agg(
        F.min("dt").alias("streak_start"),
        F.max("dt").alias("streak_end"),
        F.sum("minutes").alias("minutes"),
        F.sum("timed_rows").alias("timed_rows"),
        F.sum("recharge").alias("total_recharge"),
        F.count_distinct("game_id").alias("game_count"),
    )
    days = (F.datediff("streak_end", "streak_start") + 1).cast("bigint")
    return found.withColumn("consecutive_days", days).filter(F.col("consecutive_days") >= min_days).select(
        "player_id", "consecutive_days", "streak_start", "streak_end",
        ratio("minutes", "timed_rows", 0).alias("avg_online_min"),
        "total_recharge", "game_count",
        classes.intervention_tier("consecutive_days").alias("tier"),
    )


def streak_order() -> list:
    return [F.desc("consecutive_days"), F.desc("total_recharge"), F.col("player_id"), F.col("streak_start")]


def severe_streaks(fact: DataFrame, first: date, min_days: int = 3, n: int = 200) -> DataFrame:
    return top(severe_streak_totals(fact, first, min_days), streak_order(), n)
