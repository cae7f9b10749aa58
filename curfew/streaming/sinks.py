"""Sinks of streams. Each writes a batch in a way that repeating it changes nothing."""

import hashlib
import json
from collections.abc import Callable
from datetime import date, timedelta
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from curfew import schema
from curfew.functions import fixed_values as V
from curfew.functions import rules
from curfew.sinks.spans import SpanTable
from curfew.sources import warehouse
from curfew.streaming import operators

ROLL_SECONDS = 600
ROLL_ROWS = 100_000


def _line() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(name), F.lit("")) for name in schema.RAW_FIELDS])


def paced(writer: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """A batch every so many seconds, or all that is there and then stop."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def append_files(stream: DataFrame, path: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append")
    return paced(writer.option("path", path).option("checkpointLocation", checkpoint), seconds).start()


def stream_kafka_sink(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, seconds: int | None = ROLL_SECONDS
) -> StreamingQuery:
    """The raw line to a topic; needs the Kafka connector on the class path."""
    writer = (
        stream.select(_line().alias("value")).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("kafka.acks", "1").option("kafka.compression.type", "snappy")
        .option("checkpointLocation", checkpoint)
    )
    return paced(writer, seconds).start()


def stream_dated_files(
    stream: DataFrame, root: str, checkpoint: str, seconds: int | None = ROLL_SECONDS, roll_rows: int = ROLL_ROWS
) -> StreamingQuery:
    """Raw lines as text under dt=yyyyMMdd of their arrival, new files each period."""
    dated = stream.select(
        _line().alias("value"), F.date_format("arrival_time", V.DAY_FORMAT).alias("dt")
    )
    writer = (
        dated.writeStream.format("text").partitionBy("dt").outputMode("append")
        .option("maxRecordsPerFile", roll_rows)
        .option("path", root).option("checkpointLocation", checkpoint)
    )
    return paced(writer, seconds).start()


def independent_sinks(
    stream: DataFrame, sinks: dict[str, Callable[[DataFrame, str], StreamingQuery]], checkpoint_root: str
) -> dict[str, StreamingQuery]:
    """Every row to every sink. Each sink is a query with its own checkpoint, so
    one that fails or lags holds up no other; the source is read once for each."""
    return {name: start(stream, f"{checkpoint_root}/{name}") for name, start in sinks.items()}


def stream_fanout(
    stream: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], root: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Every row to every sink, from one reading of the source.

    A batch is kept while its sinks write it, each on its own. A sink that has written it
    leaves a mark under ``root``. If one fails the others still get the batch, then the query
    stops; when it starts again only sinks without a mark are given the batch once more. A sink
    must replace what a broken attempt of the same batch has written.
    """
    key = stream_key(checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, failed = batch.sparkSession, []
        mark = lambda name: f"{root}/marks/{key}/{name}/{batch_id}"
        open_sinks = [name for name in sinks if not warehouse.folder_exists(spark, mark(name))]
        kept = batch.persist()
        try:
            for name in open_sinks:
                try:
                    sinks[name](kept, batch_id)
                    warehouse.put_text(spark, mark(name), "")
                except Exception as error:
                    failed.append((name, error))
        finally:
            kept.unpersist()
        if failed:
            raise RuntimeError(f"sinks without batch {batch_id}: {[name for name, _ in failed]}") from failed[0][1]
        # The batch before this one is known to the stream by now, so its marks are needed no more.
        for name in sinks:
            warehouse.delete_folder(spark, f"{root}/marks/{key}/{name}/{batch_id - 1}")

    return paced(stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint), seconds).start()


def into_batches(root: str) -> Callable[[DataFrame, int], None]:
    """A sink with a folder for each batch."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def stream_microbatch_load(
    stream: DataFrame, root: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Load batch by batch; a batch run again replaces what it wrote before.

    Batches are numbered within a stream, which is known by its checkpoint, so
    another stream into the same root adds to it.
    """
    stream_id = stream_key(checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/stream_id={stream_id}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def stream_key(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


DEDUP_DDL = "row_key string, looked_up boolean, login_day string, stream_id string, batch_id bigint"


def stream_dedup_load(stream: DataFrame, root: str, checkpoint: str, lateness: str = "1 hour",
                      seconds: int | None = None) -> StreamingQuery:
    """Load raw rows, each distinct row once, however late it or its copy arrives.

    State holds the rows of the last ``lateness``. A row that it passes as new is new: had an equal one
    come before, it would still be in the state, since equal rows have equal times of login. What state does
    not pass is a copy, or behind the watermark, or has no readable time; only these rows (``looked_up``) are
    compared with the written ones of the same days of login. So is a row of a day that another
    stream has written to, whose rows this state has not seen.

    A batch run again replaces what it wrote and does not look at it. One stream writes to a root at a
    time. Give it a stream of ``session.stream_session``, whose state is in RocksDB.
    """
    stream_id = stream_key(checkpoint)
    layout = f"{schema.ddl([(name, 'string') for name in schema.RAW_FIELDS])}, {DEDUP_DDL}"
    fields = list(schema.RAW_FIELDS)
    timed = stream.select(*fields, rules.parse_time(F.col("login_time")).alias("event_time"))
    passed = timed.filter("event_time is not null").withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(fields)
    both = passed.select(*fields, F.lit(True).alias("passed")).unionByName(stream.select(*fields, F.lit(False).alias("passed")))

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        whole = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
        day = F.coalesce(F.to_date(rules.parse_time(F.col("login_time"))).cast("string"), F.lit("none"))
        folded = batch.groupBy(*fields).agg(F.max("passed").alias("passed"))
        new = staged(folded.withColumns({"row_key": whole, "login_day": day}), f"{root}/_staged")
        days = {row["login_day"]: row["late"] for row in new.groupBy("login_day").agg(F.max(~F.col("passed")).alias("late")).collect()}
        others = [day for day in days if set(warehouse.names(spark, f"{root}/login_day={day}")) - {f"stream_id={stream_id}"}]
        new = new.withColumn("looked_up", ~F.col("passed") | F.col("login_day").isin(others)).drop("passed")
        folders = existing(spark, root, [day for day, late in days.items() if late or day in others])
        if folders:
            known = spark.read.schema(layout).option("basePath", root).parquet(*folders)
            earlier = known.filter((F.col("stream_id") != stream_id) | (F.col("batch_id") != batch_id))
            doubtful = new.filter("looked_up").join(earlier.select("login_day", "row_key"), ["login_day", "row_key"], "left_anti")
            new = new.filter("not looked_up").unionByName(doubtful)
        placed = new.withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id)})
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "login_day", "stream_id", "batch_id").parquet(root)

    writer = both.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def existing(spark: SparkSession, root: str, days: list[str]) -> list[str]:
    """Folders of those of the days that have one."""
    folders = [f"{root}/login_day={day}" for day in days]
    return [folder for folder in folders if warehouse.folder_exists(spark, folder)]


def active_table(spark: SparkSession, root: str, writer: str | None = None) -> SpanTable:
    return SpanTable(spark, root, operators.PANES, writer)


def stream_active_counts(facts: DataFrame, root: str, checkpoint: str, slide: str = "5 minutes", open_days: int = 1,
                         seconds: int | None = None) -> StreamingQuery:
    """Keep the players of each pane of ``slide`` as bitmaps; ``operators.active_so_far`` counts windows of them.

    A span is an hour while its day is open and the whole day once the newest row is
    ``open_days`` days ahead, so files do not stay small. Late rows go into
    their span like all others, whether it is closed or not.
    """
    key = stream_key(checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = active_table(spark, root, key)
        before = table.manifest(before=batch_id)
        panes = staged(operators.player_panes(batch, slide), f"{root}/staged")
        numbered = table.number_players(batch_id, panes.select("player_id"), before)
        seen = {row[0] for row in panes.select(F.date_format("pane", "yyyy-MM-dd-HH")).distinct().collect()}
        newest = max([hour[:10] for hour in seen] + [before["newest"] or ""])
        closed = before["closed_before"] or ""
        if newest:
            closed = max(closed, str(date.fromisoformat(newest) - timedelta(days=open_days)))
        day = F.to_date("pane").cast("string")
        span = F.when(day < closed, day).otherwise(F.date_format("pane", "yyyy-MM-dd-HH"))
        hours = [s for s in before["spans"] if len(s) > 10 and s[:10] < closed]
        touched = {hour[:10] if hour[:10] < closed else hour for hour in [*seen, *hours]}
        delta = operators.pane_bitmaps(table.with_numbers(panes, numbered))
        table.replace(batch_id, delta, numbered, operators.merged_panes, span, touched, hours,
                      newest=newest or None, closed_before=closed or None)

    return paced(facts.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint), seconds).start()


def risk_table(spark: SparkSession, root: str, writer: str | None = None) -> SpanTable:
    return SpanTable(spark, root, operators.RISK_DAYS, writer, {"counts": (operators.RISK_COUNTS, operators.risk_counts)})


def stream_risk_counts(facts: DataFrame, root: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Keep the current distinct players per day and label: a batch rewrites the days that it touches, and no others.

    ``risk_table(..).read(kind="counts")`` is the table, one row a day. Late rows change their day.
    """
    key = stream_key(checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        table = risk_table(batch.sparkSession, root, key)
        before = table.manifest(before=batch_id)
        days = staged(operators.player_days(batch), f"{root}/staged")
        numbered = table.number_players(batch_id, days.select("player_id"), before)
        delta = operators.day_bitmaps(table.with_numbers(days, numbered))
        touched = {str(row[0]) for row in days.select("dt").distinct().collect()}
        table.replace(batch_id, delta, numbered, operators.merged_days, F.col("dt").cast("string"), touched)

    writer = facts.writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def staged(rows: DataFrame, folder: str) -> DataFrame:
    """The folded rows of a batch, written once and read by every step that needs them."""
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def loaded_per_batch(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """Rows by stream and batch."""
    loaded = spark.read.schema(f"{layout}, stream_id string, batch_id bigint").parquet(root)
    return loaded.groupBy("stream_id", "batch_id").agg(F.count(F.lit(1)).alias("loaded_rows"))


def stream_arrival_check(arrived: DataFrame, marker: Column) -> DataFrame:
    """One row: rows that arrived, rows that carry the marker, whether there is one."""
    return arrived.agg(
        F.count(F.lit(1)).alias("arrived_rows"), F.count_if(marker).alias("marked_rows")
    ).withColumn("marker_arrived", F.col("marked_rows") > 0)


PROGRESS_DDL = "query string, batch bigint, input_rows bigint"


class ProgressTable(StreamingQueryListener):
    """Writes what each batch of each query has read, so that nothing is forgotten however many batches there are
    and however often a query starts again: one small file per batch, which a repeated batch replaces.

        table = ProgressTable(spark, root)
        spark.streams.addListener(table)
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.ended = spark, root, {}

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = Event()

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        entry = {"query": str(seen.id), "batch": seen.batchId, "input_rows": seen.numInputRows}
        # A batch that waits for data reports no rows under the number of the batch to come.
        if seen.numInputRows:
            warehouse.put_text(self.spark, f"{self.root}/{seen.id}/{seen.batchId:012d}.json", json.dumps(entry))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last progress of an ended query is written."""
        if not self.ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError(f"no end of query {query.id} seen")

    def read(self) -> DataFrame:
        if not warehouse.folder_exists(self.spark, self.root):
            return self.spark.createDataFrame([], PROGRESS_DDL)
        return self.spark.read.schema(PROGRESS_DDL).option("recursiveFileLookup", "true").json(self.root)

    def rows_read(self, query: StreamingQuery) -> int:
        """Rows a query has read since its checkpoint began."""
        self.wait_for(query)
        return self.read().filter(F.col("query") == str(query.id)).agg(F.coalesce(F.sum("input_rows"), F.lit(0))).first()[0]
