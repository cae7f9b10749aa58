import os
import time
from datetime import date, datetime

import pytest
from conftest import rows, values
from curfew import schema, session
from curfew.operators import standardize
from curfew.sinks import packing
from curfew.sources import warehouse
from curfew.streaming import operators, sinks, sources
from pyspark.sql import functions as F
from test_cleaning import text


@pytest.fixture
def feed(folder):
    """Drop a log file into the watched folder; each becomes a batch of its own."""
    os.makedirs(f"{folder}/in")
    clock = [time.time() - 1000]

    def write(*lines):
        clock[0] += 10
        path = f"{folder}/in/{int(clock[0])}.log"
        with open(path, "w", encoding="utf-8") as file:
            file.write("\n".join(lines) + "\n")
        os.utime(path, (clock[0], clock[0]))

    return write


def login(player, when, **others):
    return text(player_id=player, login_time=f"2024-01-10 {when}", logout_time="2024-01-12 00:00:00", **others)


@pytest.fixture
def run(spark, folder):
    """Run a stream over what is there, one file a batch, and read its sink."""
    def go(build, name="out"):
        stream = build(sources.stream_source(spark, f"{folder}/in", max_files=1))
        query = sinks.append_files(stream, f"{folder}/{name}", f"{folder}/{name}_checkpoint")
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{folder}/{name}"), query

    return go


def test_source_reads_each_file_once(feed, run):
    feed("# comment", login("a", "10:00:00"), login("b", "10:00:00"))
    assert run(lambda s: s)[0].count() == 2
    feed(login("c", "10:00:00"))
    arrived, query = run(lambda s: s)
    assert sorted(values(arrived, "player_id")) == ["a", "b", "c"]
    assert sum(progress.numInputRows for progress in query.recentProgress) == 1


def test_enrich(feed, run):
    feed(login("a", "10:00:00"))
    row = run(lambda s: sources.stream_enrich(s, "h1"))[0].first()
    assert row["host"] == "h1" and row["arrival_time"] is not None


def test_grading_is_that_of_the_batch(spark, feed, run, folder):
    lines = [login(f"p{i}", f"{i % 24:02d}:00:00", online_duration=i * 600) for i in range(48)]
    feed(*lines, login("bad", "10:00:00", online_duration="abc"))
    facts, _ = run(operators.stream_facts)
    batch = spark.read.schema(schema.RAW).option("sep", "|").csv(f"{folder}/in")
    expected = standardize.to_facts(batch.filter("online_duration <> 'abc' AND online_duration <= 21600"))
    assert sorted(rows(facts)) == sorted(rows(expected))
    alerts, _ = run(lambda s: operators.stream_alerts(operators.stream_facts(s)), "alerts")
    assert alerts.count() == facts.filter("risk_label = 3").count() > 0


def test_active_players_in_sliding_windows_are_exact_and_late_rows_are_dropped(feed, run):
    feed(login("a", "10:01:00"), login("a", "10:02:00"), login("b", "10:07:00"))
    feed(login("c", "11:00:00"))
    feed(login("c", "11:01:00"))
    feed(login("a", "10:03:00"), login("d", "10:58:00"))  # the first is too late by now
    feed(login("e", "12:00:00"))
    found, _ = run(lambda s: operators.stream_active_30m(operators.stream_facts(s)))
    by_start = {row["window_start"]: (row["active_players"], row["row_count"]) for row in found.collect()}
    assert by_start[datetime(2024, 1, 10, 10, 0)] == (2, 3)
    assert by_start[datetime(2024, 1, 10, 9, 35)] == (1, 2)
    assert by_start[datetime(2024, 1, 10, 10, 35)] == (2, 3)
    assert max(by_start) <= datetime(2024, 1, 10, 11, 20)
    assert len(by_start) == found.count()


def test_daily_risk_takes_late_rows_within_the_bound(feed, run):
    feed(login("a", "23:00:00", online_duration=20000), login("a", "23:30:00", online_duration=60))
    feed(text(player_id="x", login_time="2024-01-11 12:00:00", logout_time="2024-01-11 13:00:00"))
    feed(login("b", "01:00:00"), login("a", "12:00:00"))
    feed(text(player_id="y", login_time="2024-01-13 12:00:00", logout_time="2024-01-13 13:00:00"))
    found, _ = run(lambda s: operators.stream_daily_risk(operators.stream_facts(s)))
    by_day = {row["dt"].day: row for row in found.collect()}
    ten = by_day[10]
    assert (ten["active_players"], ten["at_risk_players"]) == (2, 2)
    assert [ten[f"label_{k}"] for k in range(4)] == [1, 0, 2, 1]
    assert set(by_day) == {10, 11}


def test_dedup_within_the_lateness_bound(feed, run):
    feed(login("a", "10:00:00"), login("a", "10:00:00"), login("a", "10:00:00", game_id="g2"))
    feed(login("a", "10:00:00"), login("b", "10:30:00"))
    found, _ = run(lambda s: operators.stream_dedup(s).drop("event_time"))
    assert sorted(values(found, "player_id")) == ["a", "a", "b"]


def test_microbatches_load_once_however_often_they_run(spark, feed, folder):
    feed(login("a", "10:00:00"), login("b", "10:00:00"))
    feed(login("c", "10:00:00"))
    layout = schema.ddl([(name, "string") for name in schema.RAW_FIELDS])
    for attempt, streams in [("first", 1), ("first", 1), ("other", 2)]:  # another stream adds to the first
        stream = sources.stream_source(spark, f"{folder}/in", max_files=1)
        sinks.stream_microbatch_load(stream, f"{folder}/out", f"{folder}/{attempt}").awaitTermination()
        loaded = sinks.loaded_per_batch(spark, f"{folder}/out", layout).drop("stream_id")
        assert sorted(rows(loaded)) == sorted([(0, 2), (1, 1)] * streams)


def test_dedup_load_keeps_late_distinct_rows(spark, feed, folder):
    feed(login("a", "10:00:00"), login("a", "10:00:00"), login("b", "23:00:00"))
    feed(login("a", "10:00:00"), text(player_id="c", login_time="2024-01-20 10:00:00", logout_time="2024-01-20 11:00:00"))
    feed(login("late", "00:10:00"), login("b", "23:00:00"), login("n", "10:00:00", login_ip=None))
    feed(login("n", "10:00:00", login_ip=None), login("odd", "25:00:00"))
    feed(login("odd", "25:00:00"), login("late", "00:10:00"))
    for checkpoint in ["one", "one", "two"]:
        stream = sources.stream_source(spark, f"{folder}/in", max_files=1)
        sinks.stream_dedup_load(stream, f"{folder}/out", f"{folder}/{checkpoint}").awaitTermination()
        assert sorted(values(spark.read.parquet(f"{folder}/out"), "player_id")) == ["a", "b", "c", "late", "n", "odd"]


def facts_stream(spark, folder):
    return operators.stream_facts(sources.stream_source(spark, f"{folder}/in", max_files=1))


def run_counts(spark, folder):
    """Both tables of current counts, brought up to date with the files that are there."""
    facts = facts_stream(spark, folder)
    sinks.stream_active_counts(facts, f"{folder}/active", f"{folder}/active_ck").awaitTermination()
    sinks.stream_risk_counts(facts, f"{folder}/risk", f"{folder}/risk_ck").awaitTermination()
    active = operators.active_so_far(sinks.active_table(spark, f"{folder}/active").read())
    risk = sinks.risk_table(spark, f"{folder}/risk").read(kind="counts")
    return ({row["window_start"]: (row["active_players"], row["row_count"]) for row in active.collect()},
            {row["dt"].day: row for row in risk.collect()})


def files_under(folder):
    return {os.path.join(top, name): os.path.getsize(os.path.join(top, name))
            for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")}


def test_counts_so_far_hold_open_windows_and_late_rows(spark, feed, folder):
    feed(login("a", "10:01:00"), login("b", "10:07:00"))
    feed(text(player_id="x", login_time="2024-01-12 12:00:00", logout_time="2024-01-12 13:00:00"))
    feed(login("a", "10:03:00", online_duration=20000), login("d", "10:58:00"))
    by_start, by_day = run_counts(spark, folder)
    assert by_start[datetime(2024, 1, 10, 10, 0)] == (2, 3) and by_start[datetime(2024, 1, 12, 12, 0)] == (1, 1)
    assert by_start[datetime(2024, 1, 10, 9, 35)] == (1, 2) and by_start[datetime(2024, 1, 10, 10, 5)] == (1, 1)
    assert {day: row["active_players"] for day, row in by_day.items()} == {10: 3, 12: 1}
    assert [by_day[10][f"label_{k}"] for k in range(4)] == [3, 1, 0, 0] and by_day[10]["at_risk_players"] == 1
    # What a player adds to a day costs a bit: the same players again change no size, and a late file only its day.
    feed(login("a", "10:04:00"), login("b", "10:08:00"), login("d", "10:57:00"))
    assert run_counts(spark, folder)[0][datetime(2024, 1, 10, 10, 0)] == (2, 5)


def test_a_batch_rewrites_only_the_days_it_touches(spark, feed, folder):
    for day in range(1, 5):
        feed(text(player_id="a", login_time=f"2024-01-0{day} 12:00:00", logout_time=f"2024-01-0{day} 13:00:00"))
    run_counts(spark, folder)
    before = files_under(f"{folder}/risk")
    feed(text(player_id="late", login_time="2024-01-03 12:00:00", logout_time="2024-01-03 13:00:00"))
    _, by_day = run_counts(spark, folder)
    after = files_under(f"{folder}/risk")
    assert {day: row["active_players"] for day, row in by_day.items()} == {1: 1, 2: 1, 3: 2, 4: 1}
    written = {path for path in after if path not in before and "/players/" not in path and "/staged/" not in path}
    assert written and all("span=2024-01-03" in path for path in written)


def test_counts_do_not_grow_with_batches(spark, feed, folder):
    """Five more batches of the same players in the same hour: as many files and bytes as after two."""
    for minute in range(2):
        feed(*[login(f"p{i}", f"10:{minute:02d}:00") for i in range(40)])
    run_counts(spark, folder)
    before = {name: files_under(f"{folder}/{name}/rows") for name in ("active", "risk")}
    for minute in range(2, 7):
        feed(*[login(f"p{i}", f"10:{minute % 5:02d}:30") for i in range(40)])
    by_start, by_day = run_counts(spark, folder)
    assert by_start[datetime(2024, 1, 10, 10, 0)] == (40, 7 * 40) and by_day[10]["active_players"] == 40
    for name in ("active", "risk"):
        after = files_under(f"{folder}/{name}/rows")
        assert len(after) <= 2 * len(before[name]) and sum(after.values()) < 2.5 * sum(before[name].values())
        assert len(os.listdir(f"{folder}/{name}/manifest")) <= 4  # two, and their checksums


def test_closed_days_become_one_span_and_take_late_rows(spark, feed, folder):
    feed(login("a", "10:00:00"), login("b", "11:00:00"), login("c", "12:00:00"))
    feed(text(player_id="x", login_time="2024-01-13 12:00:00", logout_time="2024-01-13 13:00:00"))
    feed(text(player_id="y", login_time="2024-01-13 12:01:00", logout_time="2024-01-13 13:00:00"))
    run_counts(spark, folder)
    table = sinks.active_table(spark, f"{folder}/active")
    assert set(table.manifest()["spans"]) == {"2024-01-10", "2024-01-13-12"}
    feed(login("late", "11:01:00"))
    by_start, _ = run_counts(spark, folder)
    assert set(table.manifest()["spans"]) == {"2024-01-10", "2024-01-13-12"}
    assert by_start[datetime(2024, 1, 10, 11, 0)] == (2, 2) and by_start[datetime(2024, 1, 10, 12, 0)] == (1, 1)


def test_a_batch_that_runs_again_counts_once(spark, feed, folder, monkeypatch):
    """The process stops after the rows and their manifest are there, and before the stream knows it; and once
    before the manifest is."""
    feed(login("a", "10:00:00"))
    run_counts(spark, folder)
    feed(login("a", "10:01:00"), login("b", "10:02:00"))
    commit = sinks.SpanTable.commit

    def stop_after(self, manifest):
        commit(self, manifest)
        raise RuntimeError("stopped after the commit")

    def stop_before(self, manifest):
        raise RuntimeError("stopped before the commit")

    for stop in (stop_before, stop_after):
        monkeypatch.setattr(sinks.SpanTable, "commit", stop)
        with pytest.raises(Exception, match="stopped"):
            sinks.stream_active_counts(facts_stream(spark, folder), f"{folder}/active", f"{folder}/active_ck").awaitTermination()
    seen = operators.active_so_far(sinks.active_table(spark, f"{folder}/active").read())
    assert {row["window_start"]: row["row_count"] for row in seen.collect()}[datetime(2024, 1, 10, 10, 0)] == 3
    monkeypatch.setattr(sinks.SpanTable, "commit", commit)
    by_start, by_day = run_counts(spark, folder)
    assert by_start[datetime(2024, 1, 10, 10, 0)] == (2, 3) and by_day[10]["active_players"] == 2


def test_another_stream_into_the_same_counts_is_refused(spark, feed, folder):
    feed(login("a", "10:00:00"))
    run_counts(spark, folder)
    with pytest.raises(Exception, match="belongs to another stream"):
        sinks.stream_risk_counts(facts_stream(spark, folder), f"{folder}/risk", f"{folder}/other_ck").awaitTermination()


def test_players_are_numbered_without_gaps_and_merged(spark, folder, monkeypatch):
    from curfew.sinks import spans

    monkeypatch.setattr(spans, "LOOSE_PLAYERS", 3)
    table = spans.SpanTable(spark, f"{folder}/t", operators.RISK_DAYS)
    manifest = table.manifest()
    for batch in range(5):
        ids = spark.createDataFrame([(f"p{k}",) for k in range(batch * 5 + 7)] + [("p1",), (None,)], "player_id string").repartition(3)
        manifest = {**table.number_players(batch, ids, manifest), "batch": batch}
    assert len(manifest["players"]) <= 4
    known = rows(table.players(manifest))
    assert sorted(number for _, number in known) == list(range(1, 28)) and len({player for player, _ in known}) == 27


def test_windows_need_whole_panes(spark):
    with pytest.raises(ValueError, match="whole number"):
        operators.active_so_far(spark.createDataFrame([], operators.PANES), "30 minutes", "7 minutes")


def test_state_decides_what_it_can_and_lives_through_a_restart(spark, feed, folder):
    """Only copies and late rows are looked up among the written ones; the state is there after a restart."""
    own = session.stream_session(spark, 2)

    def run_once():
        stream = sources.stream_source(own, f"{folder}/in", max_files=1)
        query = sinks.stream_dedup_load(stream, f"{folder}/out", f"{folder}/ck")
        query.awaitTermination()
        return query.lastProgress.stateOperators[0]

    feed(login("a", "10:00:00"), login("b", "10:10:00"), login("a", "10:00:00"))
    feed(login("c", "10:30:00"), login("b", "10:10:00"))
    state = run_once()
    assert state.numRowsTotal == 3 and any(name.startswith("rocksdb") for name in state.customMetrics)
    feed(login("a", "10:00:00"), login("d", "10:40:00"))
    for player in ("far", "far2"):  # rows are late once the batch before last has moved the watermark
        feed(text(player_id=player, login_time="2024-01-20 10:00:00", logout_time="2024-01-20 11:00:00"))
    feed(login("late", "10:00:00"), login("c", "10:30:00"), login("e", "25:00:00"))
    run_once()
    written = spark.read.parquet(f"{folder}/out")
    assert {(row["player_id"], row["looked_up"]) for row in written.collect()} == {
        ("a", False), ("b", False), ("c", False), ("d", False), ("far", False), ("far2", False), ("late", True), ("e", True)}
    assert written.count() == 8


def test_progress_of_many_batches_and_a_restart(spark, feed, folder, request):
    """More batches than a query remembers."""
    name = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(name, "5")
    request.addfinalizer(lambda: spark.conf.unset(name))
    for k in range(11):
        feed(login(f"p{k}", "10:00:00"), *[login(f"q{k}", "10:00:00")] * (k % 2))
    progress = sinks.ProgressTable(spark, f"{folder}/progress")
    spark.streams.addListener(progress)
    try:
        for extra in (0, 7):
            for k in range(extra):
                feed(login(f"r{k}", "10:00:00"))
            query = sinks.append_files(sources.stream_source(spark, f"{folder}/in", max_files=1), f"{folder}/out", f"{folder}/ck")
            query.awaitTermination()
            assert progress.rows_read(query) == 11 + 5 + extra
    finally:
        spark.streams.removeListener(progress)
    assert progress.read().count() == 18 and len(query.recentProgress) <= 5


def test_fanout_reads_once_and_repeats_only_the_failed_sink(spark, feed, folder):
    feed(login("a", "10:00:00"))
    feed(login("b", "10:00:00"))
    down, reads = [True], spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: reads.add(1) or x, "string").asNondeterministic()
    stream = sources.stream_source(spark, f"{folder}/in", max_files=1).withColumn("player_id", count("player_id"))
    given = {"good": [], "bad": []}

    def sink(name):
        write = sinks.into_batches(f"{folder}/{name}")

        def load(batch, batch_id):
            given[name].append(batch_id)
            if name == "bad" and down[0] and batch_id == 1:
                raise RuntimeError("sink is down")
            write(batch, batch_id)

        return load

    def start():
        both = {"bad": sink("bad"), "good": sink("good")}
        sinks.stream_fanout(stream, both, f"{folder}/state", f"{folder}/ck").awaitTermination()

    with pytest.raises(Exception, match="sinks without batch 1"):
        start()
    assert reads.value == 2
    down[0] = False
    start()
    assert given == {"good": [0, 1], "bad": [0, 1, 1]}
    for name in given:
        assert sorted(values(spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/{name}"), "player_id")) == ["a", "b"]


def test_independent_sinks(spark, feed, folder):
    feed(login("a", "10:00:00"))
    stream = sources.stream_source(spark, f"{folder}/in")

    def broken(s, checkpoint):
        def fail(batch, batch_id):
            raise RuntimeError("sink is down")

        return s.writeStream.foreachBatch(fail).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    queries = sinks.independent_sinks(stream, {
        "good": lambda s, checkpoint: sinks.append_files(s, f"{folder}/good", checkpoint), "bad": broken,
    }, f"{folder}/checkpoints")
    queries["good"].awaitTermination()
    with pytest.raises(Exception, match="sink is down"):
        queries["bad"].awaitTermination()
    assert spark.read.parquet(f"{folder}/good").count() == 1


def test_dated_files_roll_by_rows_and_read_back_as_raw(spark, feed, folder):
    feed(*[login(f"p{i}", "10:00:00", login_ip=None) for i in range(25)])
    stream = sources.stream_enrich(sources.stream_source(spark, f"{folder}/in"), "h")
    sinks.stream_dated_files(stream, f"{folder}/logs", f"{folder}/ck", seconds=None, roll_rows=10).awaitTermination()
    days = [name for name in os.listdir(f"{folder}/logs") if name.startswith("dt=")]
    assert len(days) == 1 and len(days[0]) == len("dt=20240110")
    texts = [name for name in os.listdir(f"{folder}/logs/{days[0]}") if name.endswith(".txt")]
    assert len(texts) == 3
    from curfew.sources import raw as raw_source
    assert raw_source.ods_scan(spark, f"{folder}/logs").filter("login_ip IS NULL").count() == 25


def test_packing_keeps_each_row_once(spark, feed, folder, monkeypatch):
    """Before, during and after; a broken attempt shows nothing; files have the wanted size."""
    for k in range(4):
        feed(*[login(f"p{k}-{i}", "10:00:00", login_ip=None) for i in range(20)])
    stamped = sources.stream_source(spark, f"{folder}/in", max_files=1).withColumn(
        "arrival_time", F.to_timestamp(F.when(F.startswith("player_id", F.lit("p3")), "2024-01-11 01:00:00").otherwise("2024-01-10 10:00:00")))
    sinks.stream_dated_files(stamped, f"{folder}/logs", f"{folder}/ck", seconds=None).awaitTermination()
    logs, packed = f"{folder}/logs", f"{folder}/packed"
    seen = lambda: sorted(values(packing.scan(spark, logs, packed), "player_id"))
    everyone = sorted(f"p{k}-{i}" for k in range(4) for i in range(20))
    assert seen() == everyone
    put = warehouse.put_text

    def stop(*args):
        raise RuntimeError("stopped before the manifest")

    monkeypatch.setattr(warehouse, "put_text", stop)
    with pytest.raises(RuntimeError, match="before the manifest"):
        packing.pack_days(spark, logs, packed, date(2024, 1, 11))
    assert seen() == everyone
    monkeypatch.setattr(warehouse, "put_text", put)
    size = warehouse.folder_bytes(spark, f"{logs}/dt=20240110")
    assert packing.pack_days(spark, logs, packed, date(2024, 1, 11), size // 2 + 1) == [date(2024, 1, 10)]
    assert packing.pack_days(spark, logs, packed, date(2024, 1, 11)) == []
    assert seen() == everyone
    pack = packing.packs(spark, packed)["20240110"]
    assert os.listdir(f"{packed}/rows/dt=20240110") == [f"pack={pack}"]
    files = [os.path.getsize(f"{packed}/rows/dt=20240110/pack={pack}/{n}") for n in os.listdir(f"{packed}/rows/dt=20240110/pack={pack}") if n.endswith(".txt")]
    assert len(files) == 2 and max(files) < 1.2 * min(files)


def test_arrival_check(spark, feed, run):
    feed(login("marker-1", "10:00:00"), login("b", "10:00:00"))
    arrived, _ = run(lambda s: s)
    assert rows(sinks.stream_arrival_check(arrived, F.col("player_id") == "marker-1")) == [(2, 1, True)]
    assert rows(sinks.stream_arrival_check(arrived, F.col("player_id") == "other")) == [(2, 0, False)]


def test_lines_of_a_topic_split_into_fields(spark):
    lines = spark.createDataFrame([(bytearray(login("a", "10:00:00", login_ip=None), "utf-8"),)], "value binary")
    row = sources.split_line(lines).first()
    odd = spark.createDataFrame([("# comment",), ("",), ('"q' + "|x" * 12,)], "value string")
    assert values(sources.split_line(odd), "player_id") == ['"q']
    assert row["player_id"] == "a" and row["login_ip"] is None and row["device_type"] == "ios"


def test_topic_without_connector_says_so(spark, folder):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.stream_kafka_source(spark, "host:9092", "topic")
