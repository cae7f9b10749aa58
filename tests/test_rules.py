from decimal import Decimal

import pytest
from conftest import values
from curfew.functions import classes, rules, sql_functions
from pyspark.sql import functions as F


def graded(spark, rows):
    df = spark.createDataFrame(rows, "is_minor int, seconds bigint, hour int, expected int")
    label = rules.risk_label(F.col("is_minor"), F.col("seconds"), F.col("hour"))
    return df.withColumn("label", label)


def test_risk_label_boundaries(spark):
    grid = []
    for seconds in [-1, 0, 14400, 14401, 21600, 21601]:
        for hour in [0, 7, 8, 21, 22, 23]:
            over, night = seconds > 14400, hour in (0, 7, 22, 23)
            grid.append((1, seconds, hour, over + 2 * night))
            grid.append((0, seconds, hour, 0))
    df = graded(spark, grid)
    assert df.filter("label <> expected").count() == 0
    assert df.filter("label IS NULL").count() == 0
    assert sorted({row["label"] for row in df.collect()}) == [0, 1, 2, 3]


def test_risk_label_takes_unknown_as_not_met(spark):
    df = graded(spark, [(1, None, 23, 2), (1, 20000, None, 1), (1, None, None, 0), (None, 20000, 23, 3)])
    assert df.filter("label <> expected").count() == 0


@pytest.mark.parametrize("ip, valid", [
    ("192.168.1.5", True), ("10.0.0.1", True), (" 8.8.8.8 ", True), ("223.255.255.255", True),
    ("00.1.2.3", True),  # has the shape, and the reserved prefix is '0.' only
    ("10.1.2", False), ("0.1.2.3", False), ("127.0.0.1", False), ("169.254.1.1", False), ("169.253.1.1", True),
    ("224.0.0.1", False), ("239.1.1.1", False), ("240.1.1.1", False), ("255.255.255.255", False),
    ("256.1.1.1", False), ("1.2.3.4.5", False), ("a.b.c.d", False), ("", False), ("  ", False), (None, False),
])
def test_ip(spark, ip, valid):
    sql_functions.register(spark)
    df = spark.createDataFrame([(ip,)], "ip string")
    assert df.select(rules.is_valid_ip(F.col("ip"))).first()[0] is valid
    assert df.selectExpr("is_valid_ip(ip)").first()[0] is valid


def test_sql_function_grades_like_the_rule(spark):
    sql_functions.register(spark)
    df = graded(spark, [(m, s, h, 0) for m in (0, 1, None) for s in (None, 14400, 14401) for h in (None, 7, 8, 22)])
    assert df.filter("NOT label <=> compute_risk_label(is_minor, seconds, hour)").count() == 0


def test_minutes_round_half_up(spark):
    df = spark.createDataFrame([(3,), (9,), (0,), (21600,), (None,)], "s bigint")
    got = values(df.select(rules.minutes(F.col("s")).alias("m")), "m")
    assert got == [Decimal("0.1"), Decimal("0.2"), Decimal("0.0"), Decimal("360.0"), None]


def test_weekday_and_period(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS d, 0 AS h UNION ALL SELECT DATE'2024-01-07', 6 "
                   "UNION ALL SELECT DATE'2024-01-02', 18 UNION ALL SELECT DATE'2024-01-03', 17")
    got = df.orderBy("d").select(
        rules.iso_weekday(F.col("d")), rules.login_period(F.col("h")), rules.login_period(F.col("h"), 4)
    ).collect()
    assert [tuple(row) for row in got] == [
        (1, "夜间", "凌晨"), (2, "傍晚", "晚上"), (3, "白天", "下午"), (7, "白天", "上午")]


def classed(spark, kind, build, inputs):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(inputs)], f"i int, v {kind}")
    return values(df.select("i", build("v").alias("c")).orderBy("i"), "c")


def test_length_classes(spark):
    assert classed(spark, "bigint", classes.record_class, [0, 3600, 3601, 14400, 14401, None]) == [
        "0-1小时", "0-1小时", "1-2小时", "3-4小时", "4小时以上", "4小时以上"]
    minutes = [Decimal(x) for x in ["29.9", "30", "239.9", "240", "299.9", "300", "360", "360.1"]]
    assert classed(spark, "decimal(10,1)", classes.dashboard_class, minutes) == [
        "<30分钟", "30~60分钟", "3~4小时", *["4小时以上(超限)"] * 5]
    assert classed(spark, "decimal(10,1)", classes.minor_class, minutes) == [
        "A: <30分钟", "B: 30~60分钟", "E: 3~4小时", "F: 4~5小时(超限)", "F: 4~5小时(超限)", *["G: 5小时以上(严重超限)"] * 3]
    assert classed(spark, "decimal(10,1)", classes.histogram_class, minutes) == [30, 30, 240, 240, 360, 360, 360, None]


def test_recharge_classes(spark):
    amounts = [Decimal(x) for x in ["0", "0.01", "30", "30.01", "100", "300", "1000", "1000.01", "-1"]] + [None]
    assert classed(spark, "decimal(12,2)", classes.recharge_class, amounts) == [
        "未付费", "1~30元", "1~30元", "30~100元", "30~100元", "100~300元", "300~1000元", "1000元以上", "1~30元", "1000元以上"]


def test_wordings(spark):
    labels = [0, 1, 2, 3, 9, None]
    assert classed(spark, "int", lambda v: classes.risk_text(v, "job"), labels)[4:] == ["未知", "未知"]
    assert classed(spark, "int", lambda v: classes.risk_text(v, "violation"), labels) == [
        None, "超时预警", "夜间违规", "重度沉迷", None, None]
    assert classed(spark, "int", lambda v: classes.risk_text(v, "night_export"), labels)[:2] == ["其他", "其他"]
    assert classed(spark, "int", classes.risk_badge, [1, 2, 3, None]) == ["Lv1 预警", "Lv2 违规", "Lv3 重度", "--"]


def test_display_forms(spark):
    assert classed(spark, "decimal(10,1)", classes.duration_text, [Decimal("61.9"), Decimal("0"), Decimal("360")]) == [
        "1小时1分钟", "0小时0分钟", "6小时0分钟"]
    assert classed(spark, "decimal(12,2)", classes.amount_text, [Decimal("12.50"), Decimal("12.49"), None]) == [
        "¥13", "¥12", "--"]
    assert classed(spark, "int", classes.hour_axis, [0, 9, 23]) == ["00:00", "09:00", "23:00"]
    assert classed(spark, "int", classes.intervention_tier, [3, 4, 5, 6, 7, 30]) == [
        *["三级干预(3-4天)"] * 2, *["二级干预(5-6天)"] * 2, *["⼀级干预(7天+)"] * 2]
    assert classed(spark, "string", lambda v: classes.custom_order(v, ["白天", "傍晚", "夜间"]), ["夜间", "白天", "x"]) == [3, 1, 0]
