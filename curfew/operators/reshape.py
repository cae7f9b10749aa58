"""Results shaped for charts: zero-filled grids, parallel arrays, edges, gaps.

Every array here is collected from a result of a fixed number of rows.
"""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curfew.functions import classes
from curfew.functions import fixed_values as V
from curfew.operators import dashboard

HOURS = 24


def hour_fill(stats: DataFrame) -> DataFrame:
    """All 24 hours of ``period_stats``, zeros where an hour has no row.

    The statistics are broadcast: a row per hour at most.
    """
    hours = stats.sparkSession.range(HOURS).select(F.col("id").cast("int").alias("hour_of_day"))
    counts = ["adult_active", "minor_active", "total_active"]
    return hours.join(F.broadcast(stats.select("hour_of_day", *counts)), "hour_of_day", "left").select(
        "hour_of_day", *[F.coalesce(name, F.lit(0)).alias(name) for name in counts]
    )


def payment_grid(spark: SparkSession, payments: DataFrame) -> DataFrame:
    """Six ranges for adults and for all others, zeros where there is no row.

    The folded payments are broadcast: a row per cell of the grid at most.
    """
    cells = [
        F.struct(F.lit(account).alias("account"), F.lit(place).alias("place"), F.lit(name).alias("recharge_range"))
        for account in [V.ADULT, V.MINOR]
        for place, name in enumerate(V.RECHARGE_ORDER)
    ]
    grid = spark.range(1).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    account = F.when(F.col("account_type") == V.ADULT, V.ADULT).otherwise(V.MINOR)
    folded = payments.groupBy(account.alias("account"), "recharge_range").agg(
        F.sum("player_count").alias("player_count"), F.sum("total_amount").alias("total_amount")
    )
    return grid.join(F.broadcast(folded), ["account", "recharge_range"], "left").select(
        "account", "place", "recharge_range",
        F.coalesce("player_count", F.lit(0)).alias("player_count"),
        F.coalesce("total_amount", F.lit(0)).alias("total_amount"),
    )


def missing_dates(fact: DataFrame, today: date, interior: bool = False) -> DataFrame:
    """Days without rows strictly between the newest loaded day and today.

    Takes anything with a ``dt``: the fact, or the list of its partitions.
    ``interior`` also reports the gaps between the oldest and the newest day.
    """
    loaded = fact.select("dt").distinct()
    newest = F.max("dt")
    first = F.min("dt") if interior else F.date_add(newest, 1)
    last = F.lit(today - timedelta(days=1))
    calendar = loaded.agg(first.alias("first")).filter(F.col("first") <= last).select(
        F.explode(F.sequence("first", last)).alias("dt")
    )
    return calendar.join(loaded, "dt", "left_anti").orderBy("dt")


def layer_reconcile(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows per day in two layers and their difference; ``dt`` is a date in both."""
    left = first.groupBy("dt").agg(F.count(F.lit(1)).alias("rows_a"))
    right = second.groupBy("dt").agg(F.count(F.lit(1)).alias("rows_b"))
    rows_a, rows_b = F.coalesce("rows_a", F.lit(0)), F.coalesce("rows_b", F.lit(0))
    return dashboard.few(left.join(right, "dt", "full_outer")).select(
        "dt", rows_a.alias("rows_a"), rows_b.alias("rows_b"), (rows_b - rows_a).alias("row_diff")
    ).orderBy("dt")


def _series(order: str, value: str, where: Column | None = None) -> Column:
    """Values in the order of another column, as one array."""
    entry = F.struct(F.col(order).alias("k"), F.col(value).alias("v"))
    if where is not None:
        entry = F.when(where, entry)
    return F.transform(F.sort_array(F.collect_list(entry)), lambda pair: pair["v"])


def kpi_payload(fact: DataFrame, day: date) -> DataFrame:
    return dashboard.kpi_today(fact, day).select(
        F.lit(day).alias("dt"),
        F.col("total_active").alias("totalActive"),
        F.col("minor_active").alias("minorActive"),
        F.col("at_risk_count").alias("atRiskCount"),
        F.col("severe_count").alias("severeCount"),
        F.col("total_recharge").alias("totalRecharge"),
        F.col("avg_online_min").alias("avgOnlineMin"),
    )


def duration_payload(fact: DataFrame, day: date) -> DataFrame:
    return dashboard.duration_dist_with_order(fact, day).agg(
        _series("shortest", "duration_range").alias("names"),
        _series("shortest", "player_count").alias("values"),
        _series("shortest", "pct").alias("pcts"),
    )


def trend_payload(fact: DataFrame, day: date, days: int = 7) -> DataFrame:
    trend = dashboard.risk_trend(fact, day, days).withColumn("category", F.col("stat_date").cast("string"))
    return trend.agg(
        _series("stat_date", "category").alias("categories"),
        _series("stat_date", "dau").alias("dau"),
        _series("stat_date", "level1_count").alias("level1"),
        _series("stat_date", "level2_count").alias("level2"),
        _series("stat_date", "level3_count").alias("level3"),
        _series("stat_date", "risk_rate_pct").alias("riskRate"),
        _series("stat_date", "minor_risk_rate_pct").alias("minorRiskRate"),
    )


def payment_payload(fact: DataFrame, day: date) -> DataFrame:
    grid = payment_grid(fact.sparkSession, dashboard.payment_analysis(fact, day))
    adult, other = F.col("account") == V.ADULT, F.col("account") == V.MINOR
    return grid.agg(
        _series("place", "recharge_range", adult).alias("categories"),
        _series("place", "player_count", adult).alias("adultCount"),
        _series("place", "total_amount", adult).alias("adultAmount"),
        _series("place", "player_count", other).alias("minorCount"),
        _series("place", "total_amount", other).alias("minorAmount"),
    )


def period_payload(fact: DataFrame, day: date) -> DataFrame:
    filled = hour_fill(dashboard.period_stats(fact, day))
    return filled.agg(
        _series("hour_of_day", "hour_of_day").alias("hours"),
        _series("hour_of_day", "adult_active").alias("adultActive"),
        _series("hour_of_day", "minor_active").alias("minorActive"),
    )


def rows_total(ranked: DataFrame) -> DataFrame:
    """Rows of a ranked (so limited) result as one array in order, and their number."""
    names = [name for name in ranked.columns if name != "rank_index"]
    entry = F.struct("rank_index", F.struct(*names).alias("v"))
    return ranked.agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda pair: pair["v"]).alias("data"),
        F.count(F.lit(1)).alias("total"),
    )


def with_total(result: DataFrame) -> DataFrame:
    """Rows of a result of any size, their number on each; nothing is collected."""
    return result.withColumn("total", result.agg(F.count(F.lit(1))).scalar())


def flow_edges(spark: SparkSession, payments: DataFrame) -> DataFrame:
    """Edges from account type to recharge range, where there are players."""
    source = F.when(F.col("account") == V.ADULT, V.ADULT_NODE).otherwise(V.MINOR_NODE)
    return payment_grid(spark, payments).filter(F.col("player_count") > 0).orderBy("place", "account").select(
        source.alias("source"), F.col("recharge_range").alias("target"), F.col("player_count").alias("value")
    )


def display_fields(fact: DataFrame) -> DataFrame:
    """Display forms of a session: clock, axis label, badge, whole amount."""
    return fact.select(
        "player_id", "login_time",
        classes.clock_text("login_time").alias("clock"),
        classes.hour_axis("login_hour").alias("hour_label"),
        classes.risk_badge("risk_label").alias("badge"),
        classes.amount_text("recharge_amount").alias("amount"),
    )
