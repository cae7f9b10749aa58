"""Statistics of a day and checks of a load."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import classes, rules
from curfew.functions import fixed_values as V
from curfew.functions.conditions import AT_RISK, LABELS, MINOR, OTHER_LABEL, PAYING, label_is
from curfew.functions.measures import mean, players, rollup_players, rows, total
from curfew.functions.numbers import percent, ratio
from curfew.operators.dashboard import MINUTES, few, share_of_total
from curfew.sources.raw import day_key
from curfew.sources.warehouse import on_day

def players_per_label(prefix: str) -> dict:
    return {f"{prefix}{label}": players(label_is(label)) for label in LABELS}


def daily_stats(fact: DataFrame, day: date) -> DataFrame:
    """The daily aggregate row; empty when the day has no rows."""
    return stats_by_day(on_day(fact, day))


def stats_by_day(fact: DataFrame) -> DataFrame:
    """The daily aggregate rows of all days that have rows."""
    grouped = rollup_players(
        fact, ["dt"],
        dau=players(),
        total_records=rows(),
        paying_players=players(PAYING),
        total_players=players(),
        total_recharge=total("recharge_amount"),
        minor_players=players(MINOR),
        **players_per_label("risk_label_"),
        seconds=total("online_duration"),
        timed_rows=rows("online_duration IS NOT NULL"),
    )
    average = ratio("seconds", "timed_rows * 60", 1)
    kinds = dict(schema.DAILY_STATS_DDL)
    stats = grouped.withColumns({
        "avg_online_min": average,
        "total_recharge": F.coalesce("total_recharge", F.lit(0)),
    })
    names = [name for name in schema.DAILY_STATS_COLUMNS if name != "etl_time"]
    return stats.select(*[F.col(name).cast(kinds[name]).alias(name) for name in names], "dt")


def duration_records(fact: DataFrame, day: date) -> DataFrame:
    classed = on_day(fact, day).groupBy(
        classes.record_class("online_duration").alias("duration_range")
    ).agg(F.count(F.lit(1)).alias("record_count"))
    return share_of_total(classed, "record_count", 1).orderBy("duration_range")


def paying_stats(fact: DataFrame, day: date) -> DataFrame:
    found = rollup_players(
        on_day(fact, day), [],
        paying_players=players(PAYING), total_players=players(), total_recharge=total("recharge_amount"),
    )
    return found.select(
        "paying_players", "total_players",
        percent("paying_players", "total_players", 1).alias("paying_rate_pct"),
        "total_recharge",
        ratio("total_recharge", "paying_players", 2).alias("arppu"),
    )


def _label_rows(one_row: DataFrame, whole: str, keep: list[str]) -> DataFrame:
    """Turn per-label counts of one row into a row per label that occurs.

    Labels outside 0..3 share a last row without label.
    """
    per_label = [
        F.struct(F.lit(label).cast("int").alias("risk_label"), F.col(f"label_{label}").alias("player_count"))
        for label in LABELS
    ]
    other = F.struct(F.lit(None).cast("int").alias("risk_label"), F.col("label_other").alias("player_count"))
    return (
        one_row.withColumn("entry", F.explode(F.array(*per_label, other)))
        .select("entry.*", whole, *keep)
        .filter(F.col("player_count") > 0)
        .withColumn("risk_text", classes.risk_text("risk_label", "job"))
        .withColumn("pct", percent("player_count", whole, 1))
        .orderBy(F.asc_nulls_last("risk_label"))
    )


def label_players(fact: DataFrame, day: date) -> DataFrame:
    """Players per label and their share of all players.

    A player may carry several labels, so shares need not add up to 100.
    """
    found = rollup_players(
        on_day(fact, day), [],
        total_players=players(), label_other=players(OTHER_LABEL), **players_per_label("label_"),
    )
    return _label_rows(found, "total_players", [])


def label_records(fact: DataFrame, day: date) -> DataFrame:
    counted = on_day(fact, day).groupBy("risk_label").agg(F.count(F.lit(1)).alias("record_count"))
    texts = counted.withColumn("risk_text", classes.risk_text("risk_label", "job"))
    return share_of_total(texts, "record_count", 1).orderBy("risk_label")


def minor_records_at_risk(fact: DataFrame, day: date) -> DataFrame:
    found = on_day(fact, day).filter(MINOR).agg(
        F.count(F.lit(1)).alias("minor_records"), F.expr(f"count_if({AT_RISK}) AS risk_records")
    )
    return found.withColumn("risk_pct", percent("risk_records", "minor_records", 1))


def minor_profile(fact: DataFrame, day: date) -> DataFrame:
    """Labels of minors with their share, next to the minors' number and mean."""
    found = rollup_players(
        on_day(fact, day).filter(MINOR), [],
        minor_players=players(), label_other=players(OTHER_LABEL), **players_per_label("label_"),
        seconds=total("online_duration"),
        timed_rows=rows("online_duration IS NOT NULL"),
    )
    average = ratio("seconds", "timed_rows * 60", 1)
    return _label_rows(found.withColumn("avg_online_min", average), "minor_players", ["avg_online_min"])


def ods_check(raw: DataFrame, day: date) -> DataFrame:
    folded = raw.filter(F.col("dt") == day_key(day)).groupBy("dt", "player_id", "game_id").agg(
        F.count(F.lit(1)).alias("n"))
    return folded.groupBy("dt").agg(
        F.sum("n").alias("record_count"),
        F.count_distinct("player_id").alias("unique_players"),
        F.count_distinct("game_id").alias("unique_games"),
    )


def dwd_quality_pct(fact: DataFrame, day: date) -> DataFrame:
    is_night, is_minor = F.col("is_night_login"), F.col("is_minor")
    sums = on_day(fact, day).groupBy("dt").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(is_minor).alias("minors"),
        F.sum(is_night).alias("nights"),
        F.count_if((is_minor == 1) & (is_night == 1)).alias("minor_nights"),
        F.sum("is_heavy_gamer").alias("heavy"),
        F.sum("is_paying_player").alias("paying"),
        F.sum(MINUTES).alias("minutes"),
        F.count(MINUTES).alias("timed_rows"),
        F.sum("recharge_amount").alias("total_recharge"),
    )
    return sums.select(
        "dt", "record_count",
        percent("minors", "record_count", 1).alias("minor_pct"),
        percent("nights", "record_count", 1).alias("night_pct"),
        percent("minor_nights", "minors", 1).alias("minor_night_pct"),
        percent("heavy", "record_count", 1).alias("heavy_pct"),
        ratio("minutes", "timed_rows", 1).alias("avg_online_min"),
        percent("paying", "record_count", 1).alias("paying_pct"),
        "total_recharge",
    )


def _average(name: str, digits: int) -> Column:
    return ratio(f"sum({name})", f"count({name})", digits)


def slice_overview(fact: DataFrame, day: date) -> DataFrame:
    return on_day(fact, day).groupBy("dt", "account_type", "login_period").agg(
        F.count(F.lit(1)).alias("cnt"),
        _average(MINUTES, 1).alias("avg_online_min"),
        _average("recharge_amount", 2).alias("avg_recharge"),
        _average("match_count", 1).alias("avg_matches"),
    ).orderBy("account_type", "login_period")


def sync_check(fact: DataFrame, day: date) -> DataFrame:
    found = rollup_players(
        on_day(fact, day), [],
        synced_rows=rows(), synced_players=players(), minor_count=total("is_minor"),
        at_risk_count=rows(AT_RISK),
    )
    return found.withColumn("sync_date", F.lit(day_key(day)))


def risk_summary(fact: DataFrame, day: date) -> DataFrame:
    found = rollup_players(
        on_day(fact, day), ["risk_label"],
        record_count=rows(), player_count=players(), avg_online_min=mean(MINUTES, 0),
        total_recharge=total("recharge_amount"),
    )
    return few(found).withColumn(
        "risk_desc", classes.risk_text("risk_label", "summary")
    ).orderBy("risk_label")


def daily_overview(fact: DataFrame) -> DataFrame:
    return few(rollup_players(
        fact, ["dt"],
        total_rows=rows(), players=players(), minors=players(MINOR), at_risk=players(AT_RISK),
    )).orderBy("dt")


def label_distribution(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("risk_label").agg(F.count(F.lit(1)).alias("cnt"))
    return few(counted).withColumn(
        "label", classes.risk_text("risk_label", "distribution")
    ).orderBy("risk_label")


def recent_volume(fact: DataFrame, today: date, days: int = 7) -> DataFrame:
    """From ``days`` days ago on, newest first."""
    recent = fact.filter(F.col("dt") >= F.date_sub(F.lit(today), days))
    return few(rollup_players(recent, ["dt"], row_count=rows(), players=players())).orderBy(F.desc("dt"))


def daily_report(fact: DataFrame, day: date) -> DataFrame:
    return rollup_players(
        on_day(fact, day), [],
        record_count=rows(), active_players=players(), minor_players=players(MINOR),
        at_risk_players=players(AT_RISK), severe_players=players(label_is(V.SEVERE)),
        total_recharge=total("recharge_amount"), avg_online_min=mean(MINUTES, 0),
    )


def load_summary(fact: DataFrame, day: date) -> DataFrame:
    """Counters of one load: accounts, labels, length histogram, payments."""
    bucket = classes.histogram_class(MINUTES)
    is_minor = rules.is_minor(F.col("account_type"))
    paid = F.col("recharge_amount") > 0
    found = on_day(fact, day).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(is_minor == 1).alias("minor_records"),
        F.count_if(is_minor == 0).alias("adult_records"),
        *[F.expr(f"count_if({label_is(label)}) AS risk_{label}") for label in LABELS],
        *[F.count_if(bucket == bound).alias(f"upto_{bound}_min") for bound in V.HISTOGRAM_BOUNDS],
        F.count_if(paid).alias("paying_records"),
        F.coalesce(F.sum(F.when(paid, F.col("recharge_amount"))), F.lit(0)).alias("total_recharge"),
    )
    return found.withColumns({
        "minor_pct": percent("minor_records", "total_records", 1),
        "adult_pct": percent("adult_records", "total_records", 1),
        "paying_pct": percent("paying_records", "total_records", 1),
    })


def raw_log_summary(raw: DataFrame) -> DataFrame:
    """Counters of raw rows: accounts, night logins, night logins of minors."""
    is_minor = rules.flag(F.lower(F.trim("account_type")) == V.MINOR) == 1
    is_night = F.trim("login_period") == V.NIGHT
    found = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~is_minor).alias("adult_rows"),
        F.count_if(is_minor).alias("minor_rows"),
        F.count_if(is_night).alias("night_rows"),
        F.count_if(is_minor & is_night).alias("minor_night_rows"),
    )
    return found.withColumns({
        "adult_pct": percent("adult_rows", "total_rows", 1),
        "minor_pct": percent("minor_rows", "total_rows", 1),
        "night_pct": percent("night_rows", "total_rows", 1),
        "minor_night_pct": percent("minor_night_rows", "minor_rows", 1),
    })


def short_long_split(fact: DataFrame, day: date, minutes: int = 60) -> DataFrame:
    split = F.when(F.col(MINUTES) < minutes, "short").otherwise("long")
    return on_day(fact, day).groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("record_count"))


def _roster(seen: DataFrame, day: date, idle_days: int) -> DataFrame:
    folded = seen.groupBy("player_id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_active").alias("last_active")
    )
    return folded.filter(F.col("last_active") >= F.date_sub(F.lit(day), idle_days))


def _sightings(fact: DataFrame) -> DataFrame:
    known = fact.filter(F.col("player_id").isNotNull())
    return known.select("player_id", F.col("dt").alias("first_seen"), F.col("dt").alias("last_active"))


def player_roster(fact: DataFrame, day: date, idle_days: int = 14) -> DataFrame:
    """First and last day of every player still active in the last days, from all history."""
    return _roster(_sightings(fact.filter(F.col("dt") <= F.lit(day))), day, idle_days)


def roster_after_day(roster: DataFrame, fact: DataFrame, day: date, idle_days: int = 14) -> DataFrame:
    """The roster of the day before brought up to ``day``; reads that day's rows only.

    A player dropped as idle who comes back counts as first seen on return.
    """
    today = _sightings(on_day(fact, day))
    return _roster(roster.select(*today.columns).unionByName(today), day, idle_days)
