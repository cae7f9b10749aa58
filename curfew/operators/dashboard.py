"""The dashboard's data sets. Each takes the fact and the report day."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curfew.functions import classes
from curfew.functions import fixed_values as V
from curfew.functions.conditions import AT_RISK, CURFEW_BREACH, MINOR, label_is
from curfew.functions.days import day_bits, day_count
from curfew.functions.measures import lowest, mean, players, rollup_players, rows, total
from curfew.functions.numbers import hours, percent, ratio
from curfew.sources.warehouse import last_days, of_player, on_day

MINUTES = "online_duration_min"


def few(grouped: DataFrame) -> DataFrame:
    """A grouped result of few rows in one partition, for a fixed set of keys such
    as classes, labels, hours or days. Ordering it or summing over it then takes
    neither a sample nor a shuffle. Rows were folded in every task before."""
    return grouped.coalesce(1)


def share_of_total(grouped: DataFrame, value: str, digits: int, name: str = "pct") -> DataFrame:
    """Share of each row in the sum over all rows.

    For grouped results of a fixed number of classes: the window has one
    partition, which holds those few rows.
    """
    return few(grouped).withColumn(name, percent(value, f"sum({value}) OVER ()", digits))


def kpi_today(fact: DataFrame, day: date) -> DataFrame:
    return rollup_players(
        on_day(fact, day), [],
        total_active=players(),
        minor_active=players(MINOR),
        at_risk_count=players(AT_RISK),
        severe_count=players(label_is(V.SEVERE)),
        total_recharge=total("recharge_amount"),
        avg_online_min=mean(MINUTES, 0),
    )


def duration_dist(fact: DataFrame, day: date) -> DataFrame:
    return duration_dist_with_order(fact, day).orderBy("shortest").drop("shortest")


def duration_dist_with_order(fact: DataFrame, day: date) -> DataFrame:
    """With the shortest session of each class, by which the classes are ordered."""
    classed = on_day(fact, day).withColumn("duration_range", classes.dashboard_class(MINUTES))
    grouped = rollup_players(
        classed, ["duration_range"],
        player_count=players(), record_count=rows(), shortest=lowest(MINUTES),
    )
    return share_of_total(grouped, "player_count", 1)


def risk_trend(fact: DataFrame, day: date, days: int = 7) -> DataFrame:
    grouped = rollup_players(
        last_days(fact, day, days), ["dt"],
        dau=players(),
        level1_count=players(label_is(V.OVERTIME)),
        level2_count=players(label_is(V.CURFEW)),
        level3_count=players(label_is(V.SEVERE)),
        risky=players(AT_RISK),
        minors=players(MINOR),
        risky_minors=players(f"{AT_RISK} AND {MINOR}"),
    )
    return few(grouped).select(
        F.col("dt").alias("stat_date"), "dau", "level1_count", "level2_count", "level3_count",
        percent("risky", "dau", 1).alias("risk_rate_pct"),
        percent("risky_minors", "minors", 1).alias("minor_risk_rate_pct"),
    ).orderBy("stat_date")


def payment_analysis(fact: DataFrame, day: date) -> DataFrame:
    return payment_analysis_with_order(fact, day).orderBy("account_type", "smallest").drop("smallest")


def payment_analysis_with_order(fact: DataFrame, day: date) -> DataFrame:
    amount = "recharge_amount"
    classed = on_day(fact, day).withColumn("recharge_range", classes.recharge_class(amount))
    return rollup_players(
        classed, ["account_type", "recharge_range"],
        player_count=players(), total_amount=total(amount), avg_amount=mean(amount, 2),
        smallest=lowest(amount),
    )


def period_stats(fact: DataFrame, day: date) -> DataFrame:
    grouped = rollup_players(
        on_day(fact, day), ["login_hour"],
        adult_active=players(f"account_type = '{V.ADULT}'"),
        minor_active=players(f"account_type = '{V.MINOR}'"),
        total_active=players(),
    )
    return few(grouped).select(
        F.col("login_hour").alias("hour_of_day"), "adult_active", "minor_active", "total_active",
        classes.night_flag("login_hour").alias("night_flag"),
    ).orderBy("hour_of_day")


def player_risk_totals(fact: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Totals of every minor at risk over the last days, one row per player.

    Days are counted as bits, which leaves games as the only distinct count:
    rows fold by player and game, then by player, and none is copied.
    """
    start = date.fromordinal(day.toordinal() - days + 1)
    risky = last_days(fact, day, days).filter(f"{MINOR} AND {AT_RISK}")
    by_player = risky.groupBy("player_id").agg(
        F.sum(MINUTES).alias("minutes"),
        F.count(MINUTES).alias("timed_rows"),
        F.sum("recharge_amount").alias("total_recharge"),
        F.max("risk_label").alias("max_risk_level"),
        F.count_distinct("game_id").alias("game_count"),
        *day_bits("dt", start, day, "days"),
    )
    return by_player.select(
        "player_id",
        day_count(start, day, "days").alias("active_days"),
        hours("minutes").alias("total_hours"),
        ratio("minutes", "timed_rows", 0).alias("avg_daily_min"),
        "total_recharge", "max_risk_level", "game_count",
    )


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows; order by columns that leave no ties."""
    return df.orderBy(*order).limit(n)


def rank_index(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows with their 1-based position, counted over those n rows only."""
    return top(df, order, n).withColumn("rank_index", F.row_number().over(Window.orderBy(*order)))


def numbered(groups: DataFrame, order: list) -> DataFrame:
    """All rows with their 1-based position; for results of few groups, whatever their number."""
    return groups.withColumn("rank_index", F.row_number().over(Window.orderBy(*order)))


def ranking_order() -> list:
    return [F.desc("max_risk_level"), F.desc("total_hours"), F.col("player_id")]


def hours_order() -> list:
    return [F.desc("total_hours"), F.col("player_id")]


def risk_ranking(fact: DataFrame, day: date, days: int = 7, n: int = 10) -> DataFrame:
    return top(player_risk_totals(fact, day, days), ranking_order(), n)


def risk_ranking_by_hours(fact: DataFrame, day: date, days: int = 7, n: int = 10) -> DataFrame:
    return top(player_risk_totals(fact, day, days), hours_order(), n)


def ranking_table(fact: DataFrame, day: date, days: int = 7, n: int = 10) -> DataFrame:
    """The ranking as displayed: position, badge, whole amounts."""
    return rank_index(player_risk_totals(fact, day, days), ranking_order(), n).select(
        "rank_index", "player_id", "active_days", "total_hours", "avg_daily_min",
        classes.amount_text("total_recharge").alias("recharge_text"),
        classes.risk_badge("max_risk_level").alias("risk_badge"),
    )


def _online_min():
    return F.round(MINUTES, 0).alias("online_min")


def violation_rows(fact: DataFrame, day: date, days: int = 2) -> DataFrame:
    return last_days(fact, day, days).filter(AT_RISK)


def severity_order() -> list:
    return [F.desc("risk_label"), F.desc(MINUTES), *map(F.col, ["player_id", "login_time", "game_id"])]


def violation_columns(rows: DataFrame, *others: str) -> DataFrame:
    return rows.select(
        *others,
        F.col("dt").alias("stat_date"), "player_id", "game_id", "login_time", "logout_time",
        _online_min(), "login_ip", "device_type", "game_region",
        classes.risk_text("risk_label", "violation").alias("risk_type"),
        "recharge_amount", "match_count",
    )


def violation_detail(fact: DataFrame, day: date, n: int = 100) -> DataFrame:
    return violation_columns(top(violation_rows(fact, day), severity_order(), n))


def violation_ranked(fact: DataFrame, day: date, n: int = 100) -> DataFrame:
    return violation_columns(rank_index(violation_rows(fact, day), severity_order(), n), "rank_index")


def _session_columns(vocabulary: str):
    return [
        "dt", "player_id", "login_time", "logout_time", _online_min(), "login_hour", "device_type",
        "game_region", "game_id", "recharge_amount",
        classes.risk_text("risk_label", vocabulary).alias("risk_desc"),
    ]


def _newest_longest():
    return [F.desc("dt"), F.desc(MINUTES), *map(F.col, ["player_id", "login_time", "game_id"])]


def minor_night_detail(fact: DataFrame, day: date, days: int = 7) -> DataFrame:
    return last_days(fact, day, days).filter(CURFEW_BREACH).orderBy(*_newest_longest()).select(
        *_session_columns("minor_night")
    )


def player_detail(fact: DataFrame, player_id: str, day: date, days: int = 7) -> DataFrame:
    return of_player(last_days(fact, day, days), player_id).orderBy(*_newest_longest()).select(
        *_session_columns("player")
    )


def drilldown(fact: DataFrame, ranking: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Sessions of all ranked players at once.

    A ranking with a limit is known to be small and gets broadcast; one without
    is joined by its size at run time.
    """
    return last_days(fact, day, days).join(ranking.select("player_id"), "player_id", "left_semi").orderBy(
        *_newest_longest()
    ).select(*_session_columns("player"))
