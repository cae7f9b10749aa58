"""Streaming forms of the session rules and counts. Rules are those of the batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curfew import schema
from curfew.functions import fixed_values as V
from curfew.functions import rules
from curfew.functions.conditions import AT_RISK, LABELS, label_is
from curfew.operators import cleaning, standardize


def stream_facts(raw: DataFrame) -> DataFrame:
    """Row rules, typing and grading; no state is kept."""
    valid = raw.filter(
        cleaning.has_required() & cleaning.has_valid_duration()
        & cleaning.has_time_order() & cleaning.has_valid_ip()
    )
    return standardize.to_facts(valid)


def stream_alerts(facts: DataFrame) -> DataFrame:
    """Severe sessions, as they arrive."""
    return facts.filter(label_is(V.SEVERE))


def stream_dedup(raw: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop copies of a raw row that arrive within the lateness bound.

    State holds the rows of that bound only; rows that come later than it are
    dropped too. ``sinks.stream_dedup_load`` keeps them.
    """
    timed = raw.withColumn("event_time", rules.parse_time(F.col("login_time")))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(schema.RAW_FIELDS)


def _windows(facts: DataFrame, size: str, slide: str, lateness: str, *flags) -> DataFrame:
    """One row per window and player: number of rows, and which flags were met.

    The first of two aggregates that follow each other in one query. A player's
    rows meet in state as one row per window, so exact distinct counts need no
    set of players anywhere.
    """
    timed = facts.withWatermark("login_time", lateness)
    return timed.groupBy(F.window("login_time", size, slide), "player_id").agg(
        F.count(F.lit(1)).alias("n"), *flags
    )


def stream_active_30m(
    facts: DataFrame, size: str = "30 minutes", slide: str = "5 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    """Distinct players and rows per sliding window, exact; emitted when a window closes.

    Windows that are still open are not among the rows: ``active_so_far`` has them.
    """
    counted = _windows(facts, size, slide, lateness).groupBy("window").agg(
        F.count("player_id").alias("active_players"), F.sum("n").alias("row_count")
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "active_players", "row_count",
    )


def stream_daily_risk(facts: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Distinct players per day and label, exact; emitted when the lateness has passed.

    Days that are still open are not among the rows: ``sinks.stream_risk_counts`` has them.
    """
    def seen(condition, name):
        return F.expr(f"max(if({condition}, 1, 0)) AS {name}")

    flags = [seen(label_is(label), f"label_{label}") for label in LABELS]
    per_player = _windows(facts, "1 day", "1 day", lateness, *flags, seen(AT_RISK, "at_risk"))
    known = F.col("player_id").isNotNull()

    def count(name, alias):
        return F.sum(F.when(known, F.col(name)).otherwise(0)).alias(alias)

    counted = per_player.groupBy("window").agg(
        F.count("player_id").alias("active_players"),
        count("at_risk", "at_risk_players"),
        *[count(f"label_{label}", f"label_{label}") for label in LABELS],
    )
    return counted.select(F.to_date("window.start").alias("dt"), *[
        name for name in counted.columns if name != "window"
    ])


PANES = "pane timestamp_ntz, bucket bigint, players binary, n bigint"


def player_panes(facts: DataFrame, slide: str = "5 minutes") -> DataFrame:
    """Rows per pane and player. A pane is the stretch between two starts of windows, so a
    session is in one pane, however many windows overlap."""
    pane = F.window("login_time", slide).getField("start").cast("timestamp_ntz").alias("pane")
    return facts.filter("login_time is not null").groupBy(pane, "player_id").agg(F.count(F.lit(1)).alias("n"))


def pane_bitmaps(numbered: DataFrame) -> DataFrame:
    """Panes with their players as bits, from rows with the place (bucket, bit) of the player."""
    return numbered.groupBy("pane", "bucket").agg(F.bitmap_construct_agg("bit").alias("players"), F.sum("n").alias("n"))


def merged_panes(panes: DataFrame) -> DataFrame:
    return panes.groupBy("pane", "bucket").agg(F.bitmap_or_agg("players").alias("players"), F.sum("n").alias("n"))


def active_so_far(panes: DataFrame, size: str = "30 minutes", slide: str = "5 minutes") -> DataFrame:
    """Distinct players and rows of every window that has rows, from the panes of all time.
    A window must be so many whole panes long."""
    length, step = (panes.sparkSession.sql(f"SELECT CAST(INTERVAL {text} AS INTERVAL SECOND)").first()[0] for text in (
        "'%s' %s" % tuple(size.split()), "'%s' %s" % tuple(slide.split())))
    if length % step:
        raise ValueError(f"a window of {size} is no whole number of panes of {slide}")
    starts = F.transform(F.sequence(F.lit(0), F.lit(length // step - 1)), lambda k: F.col("pane") - k * F.lit(step))
    windows = panes.select(F.explode(starts).alias("window_start"), "bucket", "players", "n")
    buckets = windows.groupBy("window_start", "bucket").agg(F.bitmap_or_agg("players").alias("players"), F.sum("n").alias("n"))
    counted = buckets.groupBy("window_start").agg(
        F.sum(F.bitmap_count("players")).alias("active_players"), F.sum("n").alias("row_count"))
    return counted.select("window_start", (F.col("window_start") + F.lit(length)).alias("window_end"), "active_players", "row_count")


RISK_FLAGS = {"at_risk": AT_RISK, **{f"label_{label}": label_is(label) for label in LABELS}}
MET = ["active", *RISK_FLAGS]
RISK_DAYS = "dt date, bucket bigint, " + ", ".join(f"{name} binary" for name in MET)
RISK_COUNTS = "dt date, " + ", ".join(f"{name} bigint" for name in ["active_players", "at_risk_players", *list(RISK_FLAGS)[1:]])


def player_days(facts: DataFrame) -> DataFrame:
    """What a batch knows of each player's day: which labels were met."""
    day = F.to_date("login_time").alias("dt")
    return facts.filter("login_time is not null").groupBy(day, "player_id").agg(
        *[F.expr(f"max(if({condition}, 1, 0)) AS {name}") for name, condition in RISK_FLAGS.items()])


def day_bitmaps(numbered: DataFrame) -> DataFrame:
    """Days with the players of each label as bits, from rows with the place (bucket, bit) of the player."""
    flags = {"active": F.lit(True), **{name: F.col(name) == 1 for name in RISK_FLAGS}}
    return numbered.groupBy("dt", "bucket").agg(
        *[F.bitmap_construct_agg(F.when(met, F.col("bit"))).alias(name) for name, met in flags.items()])


def merged_days(days: DataFrame) -> DataFrame:
    return days.groupBy("dt", "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in MET])


def risk_counts(days: DataFrame) -> DataFrame:
    """Distinct players per day and label, from the bitmaps of whole days."""
    names = {"active": "active_players", "at_risk": "at_risk_players"}
    return days.groupBy("dt").agg(*[F.sum(F.bitmap_count(name)).alias(names.get(name, name)) for name in MET])
