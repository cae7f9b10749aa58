"""Reports over small hand-written facts."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import DAY, NOW, rows, values
from curfew.operators import analysis, daily, dashboard, quality, reshape
from curfew.plans.dashboard_api import Dashboard
from curfew.sources import warehouse


def at(day: int, hour: int = 12, minute: int = 0) -> str:
    return f"2024-01-{day:02d} {hour:02d}:{minute:02d}:00"


@pytest.fixture
def fact(facts_of):
    return facts_of(
        {"player_id": "M1", "login_time": at(10, 23), "online_duration": 15000, "recharge_amount": "10.00"},
        {"player_id": "M1", "login_time": at(10, 12), "online_duration": 15000, "game_id": "GAME_002"},
        {"player_id": "M2", "login_time": at(10, 7), "online_duration": 1200, "device_type": "pc"},
        {"player_id": "M3", "login_time": at(10, 12), "online_duration": 1800, "recharge_amount": "30"},
        {"player_id": "A1", "account_type": "adult", "login_time": at(10, 23), "online_duration": 21600,
         "recharge_amount": "1000.01"},
        {"player_id": "A1", "account_type": "adult", "login_time": at(9, 3), "online_duration": 60},
        {"player_id": "M1", "login_time": at(4, 23), "online_duration": 100},
        {"player_id": "M1", "login_time": at(3, 23), "online_duration": 100},
    )


def test_kpi(fact):
    assert rows(dashboard.kpi_today(fact, DAY)) == [(4, 3, 2, 1, Decimal("1040.01"), Decimal("182"))]


def test_kpi_of_an_empty_day(fact):
    assert rows(dashboard.kpi_today(fact, date(2024, 2, 1))) == [(0, 0, 0, 0, None, None)]


def test_duration_dist_shares_the_sum_of_players(fact):
    assert rows(dashboard.duration_dist(fact, DAY)) == [
        ("<30分钟", 1, 1, Decimal("25.0")), ("30~60分钟", 1, 1, Decimal("25.0")), ("4小时以上(超限)", 2, 3, Decimal("50.0"))]


def test_trend_covers_seven_days_and_has_no_rate_without_minors(fact):
    found = dashboard.risk_trend(fact, DAY).collect()
    assert [row["stat_date"].day for row in found] == [4, 9, 10]
    assert found[1]["minor_risk_rate_pct"] is None and float(found[1]["risk_rate_pct"]) == 0
    assert (float(found[2]["risk_rate_pct"]), float(found[2]["minor_risk_rate_pct"])) == (50.0, 66.7)


def test_payments_and_periods(fact):
    found = rows(dashboard.payment_analysis(fact, DAY))
    assert found[0][:3] == ("adult", "1000元以上", 1) and found[1][:3] == ("minor", "未付费", 2)
    assert found[2] == ("minor", "1~30元", 2, Decimal("40.00"), Decimal("20.00"))
    assert rows(dashboard.period_stats(fact, DAY)) == [
        (7, 0, 1, 1, "夜间"), (12, 0, 2, 2, "非夜间"), (23, 1, 1, 2, "夜间")]


def test_ranking(fact):
    found = rows(dashboard.risk_ranking(fact, DAY))
    assert found[0] == ("M1", 2, Decimal("8.4"), Decimal("167"), Decimal("10.00"), 3, 2)
    assert [row[0] for row in found] == ["M1", "M2"]
    assert len(rows(dashboard.risk_ranking(fact, DAY, n=1))) == 1


def test_details(fact):
    assert values(dashboard.violation_detail(fact, DAY), "risk_type") == ["重度沉迷", "夜间违规", "超时预警"]
    assert values(dashboard.minor_night_detail(fact, DAY), "player_id") == ["M1", "M2", "M1"]
    assert values(dashboard.player_detail(fact, "A1", DAY), "risk_desc") == ["正常", "正常"]
    assert dashboard.drilldown(fact, dashboard.risk_ranking(fact, DAY), DAY).count() == 4


def test_daily_stats(fact):
    found = daily.daily_stats(fact, DAY).first()
    assert (found["dau"], found["total_records"], found["paying_players"], found["minor_players"]) == (4, 5, 3, 3)
    assert [found[f"risk_label_{k}"] for k in range(4)] == [2, 1, 1, 1]
    assert float(found["avg_online_min"]) == 182.0
    assert daily.daily_stats(fact, date(2024, 2, 1)).count() == 0


def test_label_players_share_all_players(fact):
    found = daily.label_players(fact, DAY).collect()
    assert [(row["risk_label"], row["player_count"], float(row["pct"])) for row in found] == [
        (0, 2, 50.0), (1, 1, 25.0), (2, 1, 25.0), (3, 1, 25.0)]
    assert [row["risk_text"] for row in daily.minor_profile(fact, DAY).collect()][0] == "正常玩家"


def test_unknown_labels_are_reported(fact):
    from pyspark.sql import functions as F
    odd = fact.withColumn("risk_label", F.when(F.col("player_id") == "M2", 9).otherwise(F.col("risk_label")))
    found = daily.label_players(odd, DAY).collect()[-1]
    assert (found["risk_label"], found["risk_text"], found["player_count"]) == (None, "未知", 1)


def test_snapshot_counts_the_last_half_hour(facts_of):
    fact = facts_of(
        {"player_id": "M1", "login_time": at(10, 11, 50)}, {"player_id": "M2", "login_time": at(10, 11, 49)},
        {"player_id": "M3", "login_time": at(10, 12, 20)}, {"player_id": "M4", "login_time": at(9, 12, 20)})
    found = analysis.today_snapshot(fact, NOW).first()
    assert (found["total_active"], found["active_last_30m"]) == (3, 2)


def streak(player, days, **others):
    return [{"player_id": player, "login_time": at(day, 23), "online_duration": 20000, **others} for day in days]


def test_streaks_by_length_gap_and_tier(facts_of):
    fact = facts_of(
        *streak("two", [1, 2]), *streak("three", [1, 2, 3]), *streak("five", range(1, 6)), *streak("seven", range(1, 8)),
        *streak("gap", [1, 2, 3, 5, 6, 7, 8]), *streak("three", [2, 2], game_id="GAME_009", recharge_amount="5"),
        *streak("adult", range(1, 10), account_type="adult"))
    found = rows(analysis.severe_streaks(fact, date(2024, 1, 1)))
    assert [(row[0], row[1], row[7]) for row in found] == [
        ("seven", 7, "⼀级干预(7天+)"), ("five", 5, "二级干预(5-6天)"), ("gap", 4, "三级干预(3-4天)"),
        ("three", 3, "三级干预(3-4天)"), ("gap", 3, "三级干预(3-4天)")]
    three = found[3]
    assert (three[2].day, three[3].day, three[5], three[6]) == (1, 3, Decimal("10.00"), 2)
    islands = analysis.severe_islands(fact, date(2024, 1, 1))
    joined = analysis.streak_join(islands, fact)
    assert joined.filter("player_id = 'three'").count() == 5 and joined.filter("player_id = 'gap'").count() == 7
    assert analysis.severe_streaks(fact, date(2024, 1, 1), min_days=5).count() == 2


def test_streak_crosses_months(facts_of):
    days = ["2024-01-30", "2024-01-31", "2024-02-01"]
    fact = facts_of(*[{"login_time": f"{d} 23:00:00", "online_duration": 20000} for d in days])
    assert rows(analysis.severe_islands(fact, date(2024, 1, 1)))[0][1] == 3


def test_night_totals_take_the_device_of_the_longest_session(facts_of):
    fact = facts_of(
        {"login_time": at(8, 23), "online_duration": 600, "device_type": "pc"},
        {"login_time": at(9, 23), "online_duration": 6000, "device_type": "ios"},
        {"login_time": at(9, 22), "online_duration": 6000, "device_type": "android", "game_id": "GAME_002"},
        {"login_time": at(10, 12), "online_duration": 21000, "device_type": "pc"},
        {"login_time": at(10, 2), "online_duration": 20000, "device_type": "web"})
    found = analysis.night_topn(fact, date(2024, 1, 1), DAY).first()
    assert (found["violation_days"], found["night_logins"], found["severe_days"], found["game_count"]) == (3, 4, 1, 2)
    assert (found["usual_device"], found["latest_violation"]) == ("web", DAY)
    assert analysis.night_topn(fact, date(2024, 1, 1), date(2024, 1, 9)).first()["usual_device"] == "android"


def test_longest_session_keeps_whole_rows(fact):
    found = analysis.longest_session(fact)
    assert found.columns == fact.columns
    assert {row["player_id"]: row["online_duration"] for row in found.collect()} == {
        "M1": 15000, "M2": 1200, "M3": 1800, "A1": 21600}


def test_roster_drops_idle_players(fact):
    assert set(values(daily.player_roster(fact, DAY + timedelta(days=14)), "player_id")) == {"M1", "M2", "M3", "A1"}
    assert set(values(daily.player_roster(fact, DAY + timedelta(days=15)), "player_id")) == set()


def test_roster_day_by_day_equals_roster_of_history(fact):
    first, last = date(2024, 1, 3), DAY + timedelta(days=2)
    roster = daily.player_roster(fact, first)
    for ahead in range(1, (last - first).days + 1):
        roster = daily.roster_after_day(roster, fact, first + timedelta(days=ahead))
    assert sorted(rows(roster)) == sorted(rows(daily.player_roster(fact, last)))


def test_missing_dates(fact):
    assert [d.day for d in values(reshape.missing_dates(fact, date(2024, 1, 14)), "dt")] == [11, 12, 13]
    assert rows(reshape.missing_dates(fact, date(2024, 1, 11))) == []
    assert rows(reshape.missing_dates(fact, DAY)) == []
    assert [d.day for d in values(reshape.missing_dates(fact, date(2024, 1, 11), interior=True), "dt")] == [5, 6, 7, 8]


def test_reconcile_keeps_days_of_either_layer(fact):
    late, early = fact.filter("dt >= DATE'2024-01-09'"), fact.filter("dt < DATE'2024-01-10'")
    assert [(row[0].day, *row[1:]) for row in rows(reshape.layer_reconcile(late, early))] == [
        (3, 0, 1, 1), (4, 0, 1, 1), (9, 1, 1, 0), (10, 5, 0, -5)]


def test_grid_counts_every_other_account_as_minor(facts_of, spark):
    fact = facts_of({"player_id": "a", "account_type": "adult"}, {"player_id": "b", "account_type": "guest"},
                    {"player_id": "c"}, {"player_id": "d", "account_type": None})
    grid = reshape.payment_grid(spark, dashboard.payment_analysis(fact, DAY))
    assert grid.count() == 12
    assert rows(grid.filter("player_count > 0").orderBy("account").select("account", "player_count")) == [
        ("adult", 1), ("minor", 3)]
    edges = reshape.flow_edges(spark, dashboard.payment_analysis(fact, DAY))
    assert rows(edges) == [("成人账号", "未付费", 1), ("未成年账号", "未付费", 3)]


def test_dashboard_payloads(fact):
    board = Dashboard(fact)
    assert board.day == DAY
    assert board.kpi().first()["totalActive"] == 4
    assert board.duration().first()["names"] == ["<30分钟", "30~60分钟", "4小时以上(超限)"]
    assert board.trend().first()["categories"] == ["2024-01-04", "2024-01-09", "2024-01-10"]
    payment = board.payment().first()
    assert payment["adultCount"] == [0, 0, 0, 0, 0, 1] and payment["minorCount"] == [2, 2, 0, 0, 0, 0]
    period = board.period().first()
    assert period["hours"] == list(range(24)) and period["adultActive"][23] == 1 and sum(period["minorActive"]) == 4
    ranking = board.risk_ranking().first()
    assert ranking["total"] == 2 and [row["player_id"] for row in ranking["data"]] == ["M1", "M2"]
    assert [row["risk_type"] for row in board.violations().first()["data"]] == ["重度沉迷", "夜间违规", "超时预警"]
    assert values(board.minor_night(), "total") == [3, 3, 3]
    assert values(board.player("A1"), "total") == [2, 2]


def test_cross_analysis_orders_periods_by_list(facts_of):
    fact = facts_of(*[{"login_period": p} for p in ["夜间", "傍晚", "白天", "别的"]])
    assert values(analysis.cross_analysis(fact, DAY), "login_period") == ["别的", "白天", "傍晚", "夜间"]


def test_scans(fact):
    assert warehouse.newest_day(fact) == DAY
    assert warehouse.on_days(fact, [DAY, date(2024, 1, 3)]).count() == 6
    assert warehouse.in_range(fact, date(2024, 1, 3), date(2024, 1, 9)).count() == 3
    assert warehouse.last_days(fact, DAY, 2).count() == 6


def status(report):
    return {row["check_name"]: (row["failing_rows"], row["status"]) for row in report.collect()}


def test_checks_pass_on_good_rows(facts_of):
    good = facts_of(*[{"player_id": f"P{i % 4}", "login_time": at(10, i), "device_type": "android"} for i in range(8, 20)])
    found = status(quality.dq_report(good, DAY, DAY))
    assert {name for name, (_, state) in found.items() if state not in ("PASS", "INFO")} == {"min_volume"}
    assert found["cardinality_players"] == (4, "INFO") and found["hour_edge_0"] == (0, "INFO")


@pytest.mark.parametrize("check, broken, expected", [
    ("player_null", "player_id = ''", (12, "FAIL")),
    ("label_domain", "risk_label = 4", (12, "FAIL")),
    ("account_domain", "account_type = 'guest'", (12, "FAIL")),
    ("duration_negative", "online_duration = -1", (12, "FAIL")),
    ("recharge_negative", "recharge_amount = -1", (12, "FAIL")),
    ("recharge_total", "recharge_amount = -1", (1, "FAIL")),
    ("duration_not_positive", "online_duration = 0", (12, "WARN")),
    ("over_limit", "online_duration = 21601", (12, "FAIL")),
    ("minor_consistent", "is_minor = 0", (12, "FAIL")),
    ("night_consistent", "risk_label = 2", (12, "FAIL")),
    ("reserved_ip", "login_ip = '169.254.0.1'", (12, "FAIL")),
    ("label_sum", "risk_label = NULL", (12, "FAIL")),
    ("device_domain", "device_type = 'pc'", (1, "FAIL")),
    ("null_risk_label", "risk_label = NULL", (12, "WARN")),
    ("recharge_huge", "recharge_amount = 50001", (12, "WARN")),
    ("duplicates", "login_time = TIMESTAMP'2024-01-10 09:00:00'", (4, "FAIL")),
    ("future_dt", "dt = DATE'2024-01-11'", (12, "FAIL")),
])
def test_checks_fail_on_broken_rows(facts_of, check, broken, expected):
    from pyspark.sql import functions as F
    good = facts_of(*[{"player_id": f"P{i % 4}", "login_time": at(10, i)} for i in range(8, 20)])
    name, value = broken.split(" = ")
    bad = good.withColumn(name, F.expr(f"cast({value} as {dict(good.dtypes)[name]})"))
    assert status(quality.dq_report(bad, DAY, DAY))[check] == expected


def test_checks_of_an_empty_day(facts_of):
    found = status(quality.dq_report(facts_of({}), date(2024, 2, 1), DAY))
    assert found["partition_nonempty"] == (1, "FAIL") and found["rows_vs_players"] == (1, "FAIL")


def test_unknown_check_is_refused(facts_of):
    with pytest.raises(ValueError):
        quality.dq_report(facts_of({}), DAY, DAY, ["nope"])


