from datetime import date, timedelta

import pytest
from conftest import DAY, line, rows, values
from curfew import schema, session
from curfew.operators import daily, reshape
from curfew.plans import daily_cycle, daily_job
from curfew.sinks import ledger, tables
from curfew.sources import raw as raw_source
from curfew.sources import warehouse
from pyspark.sql import functions as F
from test_cleaning import text, write_log

BEFORE = DAY - timedelta(days=1)


@pytest.fixture
def fact(facts_of):
    return facts_of(*[
        {"player_id": f"P{i % 5}", "login_time": f"2024-01-{8 + i % 3:02d} {i % 24:02d}:00:00"} for i in range(60)])


def content(df):
    return sorted(rows(df.select(*schema.FACT_COLUMNS, "dt")), key=repr)


def test_writing_twice_changes_nothing(spark, fact, folder):
    tables.write_dwd(fact, folder)
    first = content(warehouse.scan(spark, folder))
    tables.write_dwd(fact, folder)
    tables.write_dwd(warehouse.on_day(fact, DAY), folder, DAY)
    assert content(warehouse.scan(spark, folder)) == first == content(fact)


def test_a_day_replaced_by_fewer_rows_and_by_none(spark, fact, folder):
    tables.write_dwd(fact, folder)
    tables.replace_day(warehouse.on_day(fact, DAY).filter("player_id = 'P1'"), folder, DAY)
    written = warehouse.scan(spark, folder)
    assert set(values(warehouse.on_day(written, DAY), "player_id")) == {"P1"}
    assert warehouse.on_day(written, BEFORE).count() == 20
    tables.replace_day(fact.filter("false"), folder, DAY)
    assert warehouse.scan(spark, folder).count() == 40
    assert warehouse.scan_day(spark, folder, DAY).count() == 0


def test_rows_of_another_day_are_refused_and_nothing_changes(spark, fact, folder):
    tables.write_dwd(fact, folder)
    with pytest.raises(Exception, match="outside of the replaced day"):
        tables.replace_day(fact, folder, DAY)
    assert content(warehouse.scan(spark, folder)) == content(fact)


def test_stats_are_one_row_after_any_number_of_runs(spark, fact, folder):
    for _ in range(2):
        tables.write_daily_stats(daily.daily_stats(fact, DAY), folder, DAY)
    assert spark.read.orc(folder).count() == 1
    tables.write_daily_stats(daily.daily_stats(fact.filter("false"), DAY), folder, DAY)
    assert spark.read.schema(schema.ddl([*schema.DAILY_STATS_DDL, ("dt", "date")])).orc(folder).count() == 0


def test_serving_types_and_overflow(spark, fact, folder):
    tables.publish_serving(fact, folder, DAY)
    kinds = dict(spark.read.orc(folder).dtypes)
    assert kinds["risk_label"] == "tinyint" and kinds["match_count"] == "smallint"
    too_many = fact.withColumn("match_count", F.lit(40000))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        tables.publish_serving(too_many, folder, DAY)


def test_bulk_publish_writes_listed_days_only(spark, fact, folder):
    tables.publish_serving_bulk(fact, folder, [DAY, BEFORE])
    assert {d for d in values(spark.read.orc(folder).select("dt").distinct(), "dt")} == {DAY, BEFORE}


def test_export(spark, fact, folder):
    tables.export_delimited(fact, f"{folder}/out", DAY)
    lines = values(spark.read.text(f"{folder}/out"), "value")
    assert len(lines) == 20 and all(len(entry.split("\t")) == len(schema.FACT_COLUMNS) for entry in lines)


def test_a_large_day_is_split_and_small_days_merge(spark, fact, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20kb")
    try:
        many = spark.range(40000).repartition(16).select(
            F.concat(F.lit("P"), F.expr("id % 100")).alias("player_id"), F.expr("timestamp_seconds(id)").alias("login_time"),
            F.expr("if(id % 100 = 0, DATE'2024-01-01', DATE'2024-01-02')").alias("dt"))
        tables.write_days(many, folder)
        files = spark.read.orc(folder).select("dt", F.col("_metadata.file_path").alias("f")).distinct()
        per_day = dict(rows(files.groupBy("dt").count()))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert per_day[date(2024, 1, 1)] == 1 and per_day[date(2024, 1, 2)] > 3


@pytest.fixture
def table(spark, folder):
    name = "tests_" + folder.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    yield f"{name}.facts"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_bucketed_table_day_by_day(spark, fact, table, folder):
    tables.create_fact_table(spark, table, f"{folder}/t", buckets=3)
    for day in [DAY, BEFORE, DAY]:
        tables.write_table_day(warehouse.on_day(fact, day), table, day, bucketed=True)
    assert spark.table(table).count() == 40
    assert warehouse.newest_partition(spark, table) == DAY
    described = dict((row[0], row[1]) for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect())
    assert described["Num Buckets"] == "3" and described["Bucket Columns"] == "[`player_id`]"
    tables.write_table_day(fact.filter("false"), table, DAY)
    assert spark.table(table).count() == 20


def test_retention_keeps_the_last_days(spark, fact, table, folder):
    tables.create_fact_table(spark, table, buckets=0)
    for back in range(3):
        day = DAY - timedelta(days=back)
        tables.write_table_day(warehouse.on_day(fact, day), table, day)
    assert tables.retention(spark, table, DAY, 1) == [DAY - timedelta(days=2)]
    assert tables.retention(spark, table, DAY, 1) == []
    assert spark.table(table).count() == 40


def test_retention_deletes_the_files_of_a_table_with_its_own_folder(spark, fact, table, folder):
    tables.create_fact_table(spark, table, f"{folder}/t")
    tables.write_table_days(fact, table)
    before = spark.table(table).count()
    old = tables.retention(spark, table, DAY, 1)
    assert old and not [day for day in warehouse.folder_days(spark, f"{folder}/t") if day in old]
    left = spark.table(table).count()
    spark.sql(f"MSCK REPAIR TABLE {table}")
    assert spark.table(table).count() == left < before


def test_retention_of_a_folder(spark, folder):
    layers = layers_of(folder)
    days = warehouse.folder_days(spark, layers.raw)
    assert BEFORE in days and DAY in days
    assert tables.retention_folder(spark, layers.raw, DAY, 0) == sorted(day for day in days if day < DAY)
    assert set(warehouse.folder_days(spark, layers.raw)) == {day for day in days if day >= DAY}
    assert warehouse.folder_days(spark, f"{folder}/none") == {} and warehouse.newest_folder_day(spark, f"{folder}/none") is None


def test_a_table_day_refuses_other_days(spark, fact, table):
    tables.create_fact_table(spark, table)
    with pytest.raises(Exception, match="row outside of the replaced day"):
        tables.write_table_day(fact, table, DAY)


def test_added_column_is_null_in_older_days(spark, fact, table, folder):
    tables.create_fact_table(spark, table, buckets=0, with_label=False)
    tables.write_table_day(warehouse.on_day(fact, BEFORE), table, BEFORE)
    tables.add_column(spark, table, "risk_label", "int")
    tables.add_column(spark, table, "risk_label", "int")
    tables.write_table_day(warehouse.on_day(fact, DAY), table, DAY)
    found = spark.table(table)
    assert found.filter("dt = DATE'2024-01-09' AND risk_label IS NOT NULL").count() == 0
    assert found.filter("dt = DATE'2024-01-10' AND risk_label IS NULL").count() == 0


LAYOUT = "player_id string, n int"


def marked(spark, *entries):
    return spark.createDataFrame(entries, f"{LAYOUT}, rejected boolean")


def test_a_label_loads_once(spark, folder):
    batch = marked(spark, ("a", 1, False), ("b", 2, False), ("c", None, True))
    assert ledger.labelled_load(batch, folder, "one", 0.5)
    assert not ledger.labelled_load(batch, folder, "one", 0.5)
    assert ledger.labelled_load(batch, folder, "two", 0.5)
    assert ledger.loaded_rows(spark, folder, LAYOUT).count() == 4
    assert sorted(rows(ledger.loads(spark, folder))) == [(2, 1, "one"), (2, 1, "two")]


def test_a_refused_load_is_invisible_and_may_come_again(spark, folder):
    bad = marked(spark, ("a", 1, False), ("b", None, True))
    with pytest.raises(raw_source.LoadRejected):
        ledger.labelled_load(bad, folder, "one", 0.3)
    assert not ledger.is_loaded(spark, folder, "one")
    assert ledger.labelled_load(marked(spark, ("a", 1, False)), folder, "one", 0.3)
    assert rows(ledger.loaded_rows(spark, folder, LAYOUT).select("player_id", "n")) == [("a", 1)]


def test_two_writers_of_one_label(spark, folder):
    """Both see the label free; one gets the claim, and its rows alone are there."""
    from concurrent.futures import ThreadPoolExecutor

    def load(k):
        batch = marked(spark, *[(f"w{k}", i, False) for i in range(500)])
        try:
            return ledger.labelled_load(batch, folder, "one")
        except ledger.LabelTaken:
            return None

    with ThreadPoolExecutor(4) as pool:
        outcomes = list(pool.map(load, range(4)))
    assert outcomes.count(True) == 1 and outcomes.count(False) + outcomes.count(None) == 3
    found = ledger.loaded_rows(spark, folder, LAYOUT)
    assert found.count() == 500 and found.select("player_id").distinct().count() == 1


def test_a_dead_claim_is_taken_over_and_a_late_writer_changes_nothing(spark, folder):
    first = ledger.claim(spark, folder, "one")
    with pytest.raises(ledger.LabelTaken):
        ledger.labelled_load(marked(spark, ("a", 1, False)), folder, "one")
    assert ledger.labelled_load(marked(spark, ("b", 1, False)), folder, "one", patience=0)
    # The first writer lives after all: its entry is refused by the file system.
    assert not warehouse.create_text(spark, f"{folder}/entries/one.json", f'{{"attempt": {first}}}')
    assert values(ledger.loaded_rows(spark, folder, LAYOUT), "player_id") == ["b"]


def test_tolerant_load_in_one_pass_shows_nothing_after_a_refusal(spark, folder):
    write_log(f"{folder}/raw", "20240110", [text(), text(online_duration="abc"), text(player_id="P2")])
    target = f"{folder}/loaded"
    reads = []
    listener = spark.sparkContext._jsc.sc().statusTracker()
    with pytest.raises(raw_source.LoadRejected, match="1 of 3"):
        raw_source.tolerant_load(spark, f"{folder}/raw", target, 0.2)
    assert not warehouse.folder_exists(spark, target) and warehouse.names(spark, folder) == ["raw"]
    spark.sparkContext.setJobGroup("tolerant", "one pass")
    found = raw_source.tolerant_load(spark, f"{folder}/raw", target, 0.4)
    reads = listener.getJobIdsForGroup("tolerant")
    spark.sparkContext.setJobGroup("", "")
    assert len(reads) == 1
    assert sorted(values(found, "player_id")) == ["P1", "P2"] and found.columns[-1] == "dt"
    with pytest.raises(raw_source.LoadRejected):
        raw_source.tolerant_load(spark, f"{folder}/raw", target, 0.2)
    assert spark.read.parquet(target).count() == 2


def test_counts_from_footers_read_no_row(spark, fact, folder):
    tables.write_dwd(fact, folder)
    counts = warehouse.footer_counts(spark, folder)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [dt]" in plan
    assert sorted(rows(warehouse.rows_per_day(spark, folder))) == sorted(rows(fact.groupBy("dt").count()))


def test_a_lookup_reads_one_bucket(spark, fact, table, folder):
    buckets = tables.buckets_for(fact, 3)
    tables.create_fact_table(spark, table, f"{folder}/t", buckets)
    tables.write_table_days(fact, table, bucketed=True)
    found = warehouse.of_player(spark.table(table), "P3")
    # A lone scan leaves the files of other buckets out as well, but its plan only says so without this setting.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = warehouse.of_player(spark.table(table), "P3")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert f"SelectedBucketsCount: 1 out of {buckets}" in plan
    assert "PushedFilters: [IsNotNull(player_id), EqualTo(player_id,P3)]" in plan
    assert found.count() == 12


def test_bucketed_tables_join_where_they_lie(spark, fact, table, folder):
    from curfew.operators import analysis

    tables.create_fact_table(spark, table, f"{folder}/t", 4)
    tables.write_table_days(fact, table, bucketed=True)
    streaks = table.replace(".facts", ".streaks")
    days = spark.table(table).select("player_id", "dt").distinct()
    tables.write_bucketed(analysis.streak_islands(days), streaks, f"{folder}/s", tables.bucket_count(spark, table))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = analysis.streak_join_by_player(spark.table(streaks), spark.table(table))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        plain = analysis.streak_join(analysis.streak_islands(fact.select("player_id", "dt").distinct()), fact)
        assert sorted(rows(joined)) == sorted(rows(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_days_in_one_run_are_those_of_one_run_each(spark, folder):
    layers = layers_of(folder)
    write_log(f"{folder}/raw", "20240108", [text(online_duration="abc")])
    write_log(f"{folder}/raw", "20240111", [text(), text()])
    apart = daily_job.Layers.under(layers.raw, f"{folder}/apart")
    days = [date(2024, 1, d) for d in (8, 9, 10, 11, 12)]
    for lateness in (None, 3):
        loaded = daily_job.run_days(spark, layers, days, lateness)
        assert loaded == [day for day in days if daily_job.run(spark, apart, day, lateness)]
        for kind in ("facts", "stats"):
            both = [spark.read.orc(getattr(where, kind)) for where in (layers, apart)]
            assert sorted(rows(both[0].drop("etl_time")), key=repr) == sorted(rows(both[1].drop("etl_time")), key=repr)


def layers_of(folder):
    write_log(f"{folder}/raw", "20240109", [text(login_time="2024-01-09 10:00:00", logout_time="2024-01-09 11:00:00")])
    write_log(f"{folder}/raw", "20240110", [
        "# comment", text(), text(), text(login_ip="127.0.0.1"), text(player_id="P2", online_duration=20000),
        text(player_id="late", login_time="2024-01-09 20:00:00", logout_time="2024-01-09 21:00:00")])
    return daily_job.Layers.under(f"{folder}/raw", f"{folder}/warehouse")


def test_job_by_batch_day(spark, folder):
    layers = layers_of(folder)
    for _ in range(2):
        assert daily_job.run(spark, layers, DAY)
    assert sorted(values(warehouse.scan(spark, layers.facts), "player_id")) == ["P1", "P2", "late"]
    stats = spark.read.orc(layers.stats).collect()
    assert len(stats) == 1 and stats[0]["total_records"] == 3 and stats[0]["risk_label_1"] == 1
    assert not daily_job.run(spark, layers, DAY + timedelta(days=5))


def test_job_by_login_day_finds_late_logs_and_moves_no_other_day(spark, folder):
    layers = layers_of(folder)
    for day in [BEFORE, DAY, BEFORE]:
        assert daily_job.run(spark, layers, day, lateness_days=3)
    found = warehouse.scan(spark, layers.facts)
    assert sorted(values(warehouse.on_day(found, BEFORE), "player_id")) == ["P1", "late"]
    assert sorted(values(warehouse.on_day(found, DAY), "player_id")) == ["P1", "P2"]


def test_job_clears_a_day_whose_rows_all_fail_now(spark, folder):
    import shutil

    layers = layers_of(folder)
    daily_job.run(spark, layers, DAY)
    shutil.move(f"{layers.raw}/dt=20240110/game.log", f"{folder}/old.log")
    with open(f"{layers.raw}/dt=20240110/new.log", "w", encoding="utf-8") as file:
        file.write(text(online_duration="abc") + "\n")
    assert daily_job.run(spark, layers, DAY)
    assert warehouse.scan(spark, layers.facts).count() == 0
    layout = schema.ddl([*schema.DAILY_STATS_DDL, ("dt", "date")])
    assert spark.read.schema(layout).orc(layers.stats).count() == 0


def test_reduce_tasks_follow_the_bytes_scanned(spark, folder, monkeypatch):
    layers = layers_of(folder)
    raw = raw_source.ods_scan(spark, layers.raw)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        assert session.size_shuffles(spark, raw) == session.size_shuffles(spark) == 24
        monkeypatch.setattr(session, "PARTITION_BYTES", 10)
        assert session.size_shuffles(spark, raw) > 50
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        one_day = raw_source.ods_scan_day(spark, layers.raw, BEFORE)
        few = session.size_shuffles(spark, one_day)
        assert few < session.size_shuffles(spark, raw)
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        nothing = raw_source.ods_scan_day(spark, layers.raw, DAY + timedelta(days=50))
        assert session.size_shuffles(spark, nothing) == 24
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def same_shuffles(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_job_command(spark, folder, capsys, same_shuffles):
    layers_of(folder)
    arguments = ["--raw", f"{folder}/raw", "--warehouse", f"{folder}/warehouse"]
    assert daily_job.main(["20240110", *arguments]) == 0
    assert "rows_before" not in capsys.readouterr().out
    assert daily_job.main(["20240110", *arguments, "--funnel"]) == 0
    assert "rows_before" in capsys.readouterr().out
    assert daily_job.main(["20240120", *arguments]) == 1
    with pytest.raises(SystemExit):
        daily_job.main(["2024-01-10", *arguments])


def test_job_between_tables(spark, folder, table):
    layers = layers_of(folder)
    names = daily_job.Tables(table.replace(".facts", ".raw"), table, table.replace(".facts", ".stats"))
    raw_source.create_raw_table(spark, names.raw, layers.raw)
    tables.create_fact_table(spark, names.facts, buckets=2)
    tables.create_stats_table(spark, names.stats)
    for _ in range(2):
        assert daily_job.run_tables(spark, names, DAY)
    assert not daily_job.run_tables(spark, names, DAY + timedelta(days=9))
    assert sorted(values(spark.table(names.facts), "player_id")) == ["P1", "P2", "late"]
    assert spark.table(names.facts).filter("source_file LIKE '%dt=20240110/game.log' AND etl_time IS NOT NULL").count() == 3
    assert values(spark.table(names.stats), "total_records") == [3]


def test_raw_table_discovers_days(spark, folder, table):
    layers = layers_of(folder)
    name = table.replace(".facts", ".raw")
    raw_source.create_raw_table(spark, name, layers.raw)
    raw_source.add_day(spark, name, DAY)
    assert spark.table(name).count() == 5
    raw_source.discover_days(spark, name)
    assert sorted(values(spark.sql(f"SHOW PARTITIONS {name}"), "partition")) == ["dt=20240109", "dt=20240110"]
    assert spark.table(name).count() == 6
    assert line()["player_id"] == "P1"


def test_first_cycle_of_an_empty_warehouse(spark, folder):
    done = daily_cycle.run_cycle(spark, daily_job.Layers.under(f"{folder}/raw", f"{folder}/w"), f"{folder}/s", DAY)
    assert done.loaded == [] and rows(done.sync) == [] and done.checks.count() > 0


def test_cycle_takes_up_a_day_whose_files_came_late(spark, folder):
    layers, serving = layers_of(folder), f"{folder}/serving"
    later = date(2024, 1, 12)
    write_log(f"{folder}/raw", "20240112", [text(login_time="2024-01-12 10:00:00", logout_time="2024-01-12 11:00:00")])
    assert later in daily_cycle.run_cycle(spark, layers, serving, later).loaded
    write_log(f"{folder}/raw", "20240111", [text(login_time="2024-01-11 10:00:00", logout_time="2024-01-11 11:00:00")])
    assert daily_cycle.run_cycle(spark, layers, serving, date(2024, 1, 13)).loaded == [date(2024, 1, 11)]


def test_cycle_catches_up_publishes_and_checks(spark, folder):
    layers, serving = layers_of(folder), f"{folder}/serving"
    first = daily_cycle.run_cycle(spark, layers, serving, BEFORE)
    assert first.loaded == [BEFORE]
    write_log(f"{folder}/raw", "20240112", [text(login_time="2024-01-12 10:00:00", logout_time="2024-01-12 11:00:00")])
    found = daily_cycle.run_cycle(spark, layers, serving, date(2024, 1, 12))
    assert found.loaded == [DAY, date(2024, 1, 12)]
    assert rows(found.sync) == [(DAY, 3, 3, 0), (date(2024, 1, 12), 1, 1, 0)]
    assert found.report.first()["record_count"] == 1
    assert [row["row_count"] for row in found.volume.collect()] == [1, 3, 1]
    checks = {row["check_name"]: row["status"] for row in found.checks.collect()}
    assert checks["partition_nonempty"] == "PASS" and checks["min_volume"] == "FAIL"
    again = daily_cycle.run_cycle(spark, layers, serving, date(2024, 1, 12))
    assert again.loaded == [date(2024, 1, 12)] and spark.read.orc(serving).count() == 5


def test_missing_dates_from_partitions(spark, fact, table):
    tables.create_fact_table(spark, table, buckets=0)
    tables.write_table_day(warehouse.on_day(fact, BEFORE), table, BEFORE)
    days = warehouse.partition_days(spark, table)
    assert values(reshape.missing_dates(days, DAY + timedelta(days=1)), "dt") == [DAY]
