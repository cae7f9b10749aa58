"""What the plans of the registered queries may and may not contain."""

import re

import pytest
from conftest import SMALL
from curfew.plans import queries

ONE_DAY = ["kpi_today", "duration_dist", "payment_analysis", "period_stats", "daily_stats", "cross_analysis",
           "dq_player_null", "violation_detail", "risk_ranking", "risk_trend", "daily_risk", "night_topn"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONE_DAY)
def test_days_reach_the_scan(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


@pytest.mark.parametrize("name", ["kpi_today", "risk_trend", "period_stats", "daily_stats", "daily_risk",
                                  "daily_minor_risk", "minor_duration_dist", "cross_analysis", "dq_report"])
def test_distinct_players_copy_no_rows(spark, name):
    assert "Expand" not in plan(queries.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["risk_ranking", "violation_detail", "night_export", "severe_streaks", "night_topn"])
def test_limits_are_taken_in_every_task(spark, name):
    assert "TakeOrderedAndProject" in plan(queries.QUERIES[name](spark, SMALL))


def test_columns_are_pruned(spark):
    text = plan(queries.QUERIES["label_distribution"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


def test_the_longest_session_is_chosen_before_the_shuffle(spark):
    text = plan(queries.QUERIES["longest_session"](spark, SMALL))
    assert text.rindex("WindowGroupLimit") > text.rindex("Exchange")


def test_streak_join_keys_on_player_and_day(spark):
    text = plan(queries.QUERIES["streak_join"](spark, SMALL))
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[player_id#\d+, dt#\d+\]", text)
