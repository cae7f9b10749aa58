import re
from datetime import date, timedelta

import pytest
from conftest import rows
from curfew.functions.days import day_bits, day_count, merged_day_bits
from curfew.functions.measures import highest, lowest, mean, players, rollup_players, total
from curfew.functions.measures import rows as row_count
from pyspark.sql import functions as F


@pytest.fixture
def sessions(spark):
    """A third of all rows belongs to one player, some rows to none."""
    return spark.range(3000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('P', id % 97) END")
        .alias("player_id"),
        F.expr("cast(id % 7 AS int)").alias("k"),
        F.expr("cast(id % 4 AS int)").alias("risk_label"),
        F.expr("if(id % 11 = 0, NULL, cast(id % 101 AS decimal(10,1)))").alias("m"),
    )


def both(df, keys):
    folded = rollup_players(
        df, keys, n=row_count(), p=players(), p2=players("risk_label = 2"), s=total("m"), a=mean("m", 2),
        lo=lowest("m"), hi=highest("m"), bad=row_count("risk_label > 1"))
    direct = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("player_id").alias("p"),
        F.count_distinct(F.when(F.col("risk_label") == 2, F.col("player_id"))).alias("p2"),
        F.sum("m").alias("s"), F.round(F.avg("m").cast("decimal(18,6)"), 2).alias("a"),
        F.min("m").alias("lo"), F.max("m").alias("hi"), F.count_if(F.col("risk_label") > 1).alias("bad"))
    return folded, direct


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "risk_label"]])
def test_folding_equals_direct_counts(sessions, keys):
    folded, direct = both(sessions, keys)
    assert sorted(rows(folded), key=repr) == sorted(rows(direct), key=repr)


def test_nothing_gives_one_row_of_zeros(sessions):
    found = rollup_players(sessions.filter("k > 100"), [], n=row_count(), p=players(), s=total("m"), a=mean("m", 0))
    assert rows(found) == [(0, 0, None, None)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_copied_and_rows_fold_before_the_shuffle(sessions):
    folded, direct = both(sessions, ["k"])
    assert "Expand" in plan(direct)
    text = plan(folded)
    assert "Expand" not in text and "SortAggregate" not in text
    first_exchange = text.rindex("Exchange hashpartitioning")
    assert "partial_max" in text[first_exchange:]


def test_day_bits_count_distinct_days_of_any_range(spark):
    start, end = date(2024, 1, 1), date(2024, 12, 31)
    df = spark.range(2000).select(
        F.expr("id % 5").alias("k"), F.expr("date_add(DATE'2023-12-01', cast(pmod(id * 37, 450) AS int))").alias("dt"))
    inside = df.filter(F.col("dt").between(F.lit(start), F.lit(end)))
    expected = sorted(rows(inside.groupBy("k").agg(F.count_distinct("dt"))))
    half = df.groupBy("k", F.expr("dayofweek(dt)").alias("w")).agg(*day_bits("dt", start, end, "days"))
    found = half.groupBy("k").agg(*merged_day_bits(start, end, "days")).select("k", day_count(start, end, "days"))
    assert sorted(rows(found)) == expected
    assert len(re.findall("days__", str(half.columns))) == (end - start + timedelta(days=1)).days // 63 + 1
