"""Queries next to their SQL where one player holds a third of all rows, some
rows have no player, and some rows occur many times."""

import numpy as np
import oracle_check
import pandas as pd
import pytest
from curfew.operators import analysis
from curfew.plans import queries
from curfew.plans.oracles import ORACLES

# user ids that end in 0, 1 or 2 belong to minors
HOT_MINOR = 12
LOOKING_AT_PLAYERS = [
    "kpi_today", "risk_trend", "duration_dist", "payment_analysis", "period_stats", "risk_ranking", "daily_stats",
    "daily_risk", "daily_minor_risk", "minor_duration_dist", "night_topn", "cross_analysis", "today_snapshot",
    "severe_streaks", "streak_join", "streak_islands", "label_players", "minor_profile", "paying_stats", "ods_check",
    "player_roster", "drilldown", "rows_with_total", "violation_detail", "night_export", "dq_report", "clean_dedup",
    "clean_all", "clean_funnel", "replace_day", "daily_job_stats", "stream_active_30m", "stream_daily_risk",
    "stream_dedup", "roster_after_day",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    ids = np.arange(6000)
    spread = (ids * 48271) % 301
    users = pd.array(np.where(ids % 3 == 0, HOT_MINOR, spread), dtype="Int64")
    users[ids % 200 == 1] = pd.NA
    kinds = np.array(["signup", "purchase", "error", "view", "click"])
    frame = pd.DataFrame({
        "event_id": ids.astype("int64"),
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(ids * 432 + ids % 60, unit="s"),
        "user_id": users,
        "event_type": kinds[ids % 5],
        "value": (ids % 20000) / 10,
        "props": "{}",
    })
    copied = frame[frame["event_id"] == 300]
    frame = pd.concat([frame, *[copied] * 2000], ignore_index=True)
    frame["ts"] = frame["ts"].astype("datetime64[us]")
    frame.to_parquet(root / "events.parquet", index=False)
    return str(root)


@pytest.fixture(scope="module")
def connection(folder):
    return oracle_check.tables(folder)


@pytest.mark.parametrize("name", LOOKING_AT_PLAYERS)
def test_skewed_rows_give_the_same_answer(spark, connection, folder, name):
    result = queries.QUERIES[name](spark, folder)
    assert oracle_check.compare(result, connection, ORACLES[name]) is None


def test_a_hot_partition_of_the_streak_join_is_split(spark, folder):
    """With broadcast off and small thresholds, adaptive execution splits the player's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = queries.fact(spark, folder).repartition(16)
        first = queries.report_day(spark, folder).replace(day=1)
        joined = analysis.streak_join(analysis.severe_islands(fact, first), fact)
        rows = len(joined.collect())
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in text
    expected = analysis.streak_join(analysis.severe_islands(fact, first), fact).count()
    assert rows == expected > 0
