from conftest import DAY, line, rows
from curfew import schema
from curfew.operators import cleaning, daily, standardize
from curfew.sources import raw as raw_source
from pyspark.sql import functions as F
import pytest


def test_required_fields(raw_of):
    broken = [{name: value} for name in cleaning.REQUIRED for value in (None, "", "  ")]
    assert cleaning.clean_required(raw_of({}, *broken, {"account_type": None})).count() == 2


@pytest.mark.parametrize("text, kept", [
    ("-1", False), ("0", True), ("14400", True), ("21600", True), ("21601", False), ("abc", False), (" 60 ", True)])
def test_duration(raw_of, text, kept):
    assert cleaning.clean_duration(raw_of({"online_duration": text})).count() == int(kept)


def test_time_order_is_strict(raw_of):
    same = "2024-01-10 12:00:00"
    df = raw_of({}, {"logout_time": same}, {"logout_time": "2024-01-10 11:59:59"}, {"login_time": "bad"},
                {"login_time": "2024-01-10"})
    assert cleaning.clean_time_order(df).count() == 1


def test_dedup_looks_at_raw_text_and_keeps_one_of_the_rest(raw_of):
    df = raw_of({}, {}, {"account_type": " Minor"}).withColumn("source_file", F.lit("b")).unionByName(
        raw_of({}).withColumn("source_file", F.lit("a")))
    kept = cleaning.clean_dedup(df)
    assert kept.columns == df.columns
    assert sorted(row["source_file"] for row in kept.collect()) == ["a", "b"]


def test_funnel_adds_up(raw_of):
    df = raw_of(
        {}, {}, {}, {"player_id": ""}, {"online_duration": "abc", "player_id": None}, {"online_duration": "abc"},
        {"logout_time": "2024-01-10 12:00:00", "login_ip": "127.0.0.1"}, {"login_ip": "127.0.0.1"}, {"game_id": "x"})
    found = cleaning.clean_funnel(df).first().asDict()
    assert found["rows_before"] == 9 and found["failed_required"] == 2 and found["failed_duration"] == 1
    assert found["failed_time_order"] == 1 and found["failed_ip"] == 1
    assert found["after_ip"] == 4 and found["removed_copies"] == 2 and found["rows_kept"] == 2
    assert found["rows_kept"] == cleaning.clean(df).count()
    assert float(found["removed_pct"]) == 77.78


def test_funnel_of_nothing(raw_of, spark):
    found = cleaning.clean_funnel(spark.createDataFrame([], schema.RAW)).first()
    assert found["rows_before"] == 0 and found["rows_kept"] == 0 and found["removed_pct"] is None


def test_sql_path_keeps_copies_and_bad_addresses(raw_of):
    df = raw_of({}, {}, {"login_ip": "x"}, {"player_id": " "}, {"player_id": ""}, {"online_duration": "-5"})
    assert cleaning.clean_sql_path(df).count() == 4


def test_standardize(raw_of):
    fact = standardize.to_facts(raw_of({
        "account_type": " Minor", "game_id": " game_007", "device_type": "IOS ", "login_ip": " 8.8.8.8 ",
        "login_time": "2024-01-10 22:00:00", "online_duration": "14401", "recharge_amount": "12.5",
        "match_count": "many", "login_period": "傍晚"})).first()
    assert (fact["account_type"], fact["game_id"], fact["device_type"], fact["login_ip"]) == (
        "minor", "GAME_007", "ios", "8.8.8.8")
    assert fact["match_count"] is None and float(fact["recharge_amount"]) == 12.5
    assert (fact["is_minor"], fact["is_heavy_gamer"], fact["is_paying_player"], fact["is_night_login"]) == (1, 1, 1, 0)
    assert (fact["risk_label"], fact["login_hour"], fact["login_dayofweek"], fact["dt"]) == (3, 22, 3, DAY)


def test_batch_day_replaces_login_day(raw_of):
    other = DAY.replace(day=11)
    fact = standardize.to_facts(raw_of({}), other).first()
    assert fact["dt"] == other and fact["login_date"] == DAY


def write_log(folder, key, lines):
    import os

    os.makedirs(f"{folder}/dt={key}")
    with open(f"{folder}/dt={key}/game.log", "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def text(**changes):
    return "|".join(value or "" for value in line(**changes).values())


def test_scan_skips_comments_and_reads_empty_as_null(spark, folder):
    header = ["# 字段说明: " + "|".join("abcdefghijklm"), "# ===="]
    write_log(folder, "20240110", [*header, text(), text(login_ip=None), '{"user_id":"x"}', text(game_id='G"1')])
    write_log(folder, "20240111", [text(player_id="P2")])
    found = raw_source.ods_scan_day(spark, folder, DAY)
    assert found.count() == 4 and found.columns == [*schema.RAW_FIELDS, "dt"]
    assert found.filter("login_ip IS NULL").count() == 2
    assert found.filter("""game_id = 'G"1'""").count() == 1
    assert raw_source.ods_scan(spark, folder).count() == 5
    assert raw_source.ods_scan_day(spark, folder, DAY.replace(day=20)).count() == 0
    assert raw_source.ods_scan_days(spark, folder, DAY, DAY.replace(day=30)).count() == 5
    # a line of another format has one field and falls to the required-field rule
    assert cleaning.clean_required(found).count() == 3
    assert daily.ods_check(raw_source.ods_scan(spark, folder), DAY).first()["record_count"] == 4


def test_scan_of_a_day_lists_no_other_day(spark, folder):
    write_log(folder, "20240110", [text()])
    write_log(folder, "20240111", [text()])
    files = raw_source.ods_scan_day(spark, folder, DAY).inputFiles()
    assert len(files) == 1 and "dt=20240110" in files[0]


def test_provenance_survives_dedup(spark, folder):
    write_log(folder, "20240110", [text(), text()])
    stamped = raw_source.with_provenance(raw_source.ods_scan_day(spark, folder, DAY))
    fact = standardize.to_facts(cleaning.clean(stamped)).collect()
    assert len(fact) == 1 and fact[0]["source_file"].endswith("dt=20240110/game.log")
    assert fact[0]["etl_time"] is not None


def test_tolerant_load(spark, folder):
    good = [text(player_id=f"P{i}") for i in range(99)]
    logs, target = f"{folder}/logs", f"{folder}/loaded"
    write_log(logs, "20240110", [*good, text(match_count="many")])
    assert raw_source.tolerant_load(spark, logs, target, 0.01).count() == 99
    with pytest.raises(raw_source.LoadRejected):
        raw_source.tolerant_load(spark, logs, target, 0.005)
    share = raw_source.rejected_share(raw_source.read_marked(spark, logs))
    assert rows(share) == [(100, 1, 0.01)]


def test_lines_of_wrong_width_are_rejected(spark, folder):
    write_log(folder, "20240110", [text(), "a|b", text() + "|more"])
    marked = raw_source.read_marked(spark, folder)
    assert marked.filter("rejected").count() == 2
