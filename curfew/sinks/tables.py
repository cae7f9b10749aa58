"""Writing the layers. Every write replaces whole days, so a rerun changes nothing."""

import math
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from curfew import schema
from curfew.session import UNKNOWN_BYTES
from curfew.sources.warehouse import delete_folder, folder_days, on_day, on_days, partition_days

# Lookups by player and game skip stripes by bloom filter.
BLOOM_COLUMNS = "player_id,game_id"
BUCKET_BYTES, LEAST_BUCKETS = 256 * 1024 * 1024, 4


def compact_output(fact: DataFrame) -> DataFrame:
    """Partitions of even size along days: small days merge, a large day splits."""
    return fact.hint("rebalance", "dt")


def _orc(rows: DataFrame) -> DataFrameWriter:
    writer = rows.write.mode("overwrite").format("orc")
    if "player_id" in rows.columns:
        writer = writer.option("orc.bloom.filter.columns", BLOOM_COLUMNS)
    return writer


def write_days(rows: DataFrame, root: str, compact: bool = True) -> None:
    """Replace exactly the days that occur in ``rows``.

    New files are put in place when the job commits, so a task that is lost or
    run twice leaves nothing behind. Rows that come out of a shuffle by size
    already can do without ``compact``.
    """
    if compact:
        rows = compact_output(rows)
    if "player_id" in rows.columns:
        rows = rows.sortWithinPartitions("dt", "player_id", "login_time")
    _orc(rows).partitionBy("dt").option("partitionOverwriteMode", "dynamic").save(root)


def only_day(rows: DataFrame, day: date) -> DataFrame:
    """The rows, of which one of another day fails the job that reads them."""
    other = F.concat(F.lit("row outside of the replaced day: "), F.coalesce(F.col("dt").cast("string"), F.lit("NULL")))
    refused = F.raise_error(other).cast("date")
    return rows.withColumn("dt", F.when(F.col("dt") == F.lit(day), F.col("dt")).otherwise(refused))


def clear_day(rows: DataFrame, root: str, day: date) -> None:
    """Replace one day by no rows, in the layout of ``rows``."""
    _orc(rows.limit(0).drop("dt")).save(f"{root}/dt={day:%Y-%m-%d}")


def write_day(rows: DataFrame, root: str, day: date, compact: bool = False) -> None:
    """Replace one day by ``rows``, also by none; rows of other days are refused."""
    checked = only_day(rows, day)
    written = Observation()
    write_days(checked.observe(written, F.count(F.lit(1)).alias("n")), root, compact)
    if written.get["n"] == 0:
        clear_day(rows, root, day)


def write_dwd(fact: DataFrame, root: str, day: date | None = None) -> None:
    """One day of the fact, or all days that occur in it."""
    if day is None:
        write_days(fact, root)
    else:
        write_day(fact, root, day)


def stamped(stats: DataFrame) -> DataFrame:
    """Daily statistics with their processing time, columns in declared order."""
    return stats.withColumn("etl_time", F.current_timestamp()).select(*schema.DAILY_STATS_COLUMNS, "dt")


def write_daily_stats(stats: DataFrame, root: str, day: date) -> None:
    write_day(stamped(stats), root, day)


def write_daily_stats_of_days(stats: DataFrame, root: str) -> None:
    """The daily rows of many days in one job."""
    write_days(stamped(stats), root)


def replace_day(rows: DataFrame, root: str, day: date) -> None:
    """What a deletion of the day's rows followed by a load comes to, in one step."""
    write_day(rows, root, day, compact=True)


def to_serving(fact: DataFrame) -> DataFrame:
    """Narrow types of the serving copy; a value that does not fit is an error."""
    return fact.withColumns({
        name: F.col(name).cast(kind) for name, kind in schema.SERVING_TYPES.items() if name in fact.columns
    })


def publish_serving(fact: DataFrame, root: str, day: date) -> None:
    write_day(to_serving(on_day(fact, day)), root, day)


def publish_serving_bulk(fact: DataFrame, root: str, days: Iterable[date]) -> None:
    """Many days in one job."""
    write_days(to_serving(on_days(fact, days)), root)


def export_delimited(fact: DataFrame, path: str, day: date) -> None:
    """One day as tab-separated text, times as text, in as many files as tasks."""
    times = ["login_time", "logout_time", "login_date", "etl_time"]
    texts = {name: F.col(name).cast("string") for name in times if name in fact.columns}
    on_day(fact, day).withColumns(texts).drop("dt").write.mode("overwrite").option("sep", "\t").csv(path)


def _create(spark: SparkSession, table: str, columns, root: str | None, clustered: str, options: str) -> None:
    location = f"LOCATION '{root}'" if root else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema.ddl(columns)}, dt date) USING orc "
        f"PARTITIONED BY (dt) {clustered} {location} OPTIONS ('compression' = 'snappy'{options})"
    )


def create_fact_table(spark: SparkSession, table: str, root: str | None = None, buckets: int = 0,
                      with_label: bool = True) -> None:
    """Day partitions, buckets by player sorted by login, bloom filters.

    ``buckets`` holds per day: choose it so that a bucket of a day stays near
    256 MB. With 0 the table has no buckets, which suits days with a player of
    very many rows, as splitting then follows size instead of the player.
    """
    columns = [c for c in [*schema.FACT_DDL, *schema.PROVENANCE_DDL] if with_label or c[0] != "risk_label"]
    clustered = f"CLUSTERED BY (player_id) SORTED BY (login_time) INTO {buckets} BUCKETS" if buckets else ""
    _create(spark, table, columns, root, clustered, f", 'orc.bloom.filter.columns' = '{BLOOM_COLUMNS}'")


def buckets_for(rows: DataFrame, days: int) -> int:
    """Buckets for a table of ``rows`` over so many days: a power of two that keeps a bucket of a day near
    ``BUCKET_BYTES``, ``LEAST_BUCKETS`` at least. Powers of two let tables of different counts be joined."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = size / max(days, 1) / BUCKET_BYTES if size < UNKNOWN_BYTES else LEAST_BUCKETS
    return max(LEAST_BUCKETS, 1 << max(0, math.ceil(math.log2(max(wanted, 1)))))


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(described["data_type"]) if described else 0


def write_bucketed(rows: DataFrame, table: str, root: str, buckets: int) -> None:
    """A table of rows by player beside the fact, in as many buckets, so that the two are joined where they lie.

    A player with a third of all rows has a third of them in one bucket, whose task of the join is as long
    as that; a join by player and day of tables without buckets splits it. Use it where no player dominates.
    """
    ordered = rows.repartition(buckets, "player_id")
    ordered.write.mode("overwrite").format("orc").bucketBy(buckets, "player_id").sortBy("player_id").option(
        "path", root).saveAsTable(table)


def create_stats_table(spark: SparkSession, table: str, root: str | None = None) -> None:
    _create(spark, table, schema.DAILY_STATS_DDL, root, "", "")


def write_table_day(rows: DataFrame, table: str, day: date, bucketed: bool = False) -> None:
    """Replace one day of a catalog table, also by nothing; rows of other days are refused.

    Columns go by name; those of the table that the rows lack become NULL. For a
    bucketed table rows are first brought together by player, so that a task
    writes to few buckets; a player of very many rows is split over tasks.
    """
    spark = rows.sparkSession
    columns = [
        name if name in rows.columns else f"CAST(NULL AS {kind}) AS {name}"
        for name, kind in spark.table(table).dtypes if name != "dt"
    ]
    hint = "/*+ REBALANCE(player_id) */" if bucketed else ""
    # The day itself is a constant of the insert; the filter keeps its check in the plan.
    checked = only_day(rows, day).filter(F.col("dt").isNotNull())
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (dt = DATE '{day:%Y-%m-%d}') "
        f"SELECT {hint} {', '.join(columns)} FROM {{rows}}",
        rows=checked,
    )


def write_table_days(rows: DataFrame, table: str, bucketed: bool = False) -> None:
    """Replace in a catalog table exactly the days that occur in ``rows``, in one job."""
    have = set(rows.columns)
    columns = [
        F.col(name) if name in have else F.lit(None).cast(kind).alias(name)
        for name, kind in rows.sparkSession.table(table).dtypes
    ]
    rows = rows.hint("rebalance", "dt", "player_id") if bucketed else compact_output(rows)
    rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)


def add_column(spark: SparkSession, table: str, name: str, kind: str) -> None:
    """Add a column unless the table has it; older days read it as NULL."""
    if name not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind})")


def retention(spark: SparkSession, table: str, day: date, keep_days: int) -> list[date]:
    """Delete the days older than ``keep_days`` before ``day``; returns them.

    Works on the catalog's list of days; no data is read. A table with a folder of
    its own keeps its files when a day is dropped from the catalog, so the folder
    of the day is deleted too; a repair of the table does not bring it back. Days
    may be keyed as dates or, as in raw tables, as yyyyMMdd.
    """
    limit = day - timedelta(days=keep_days)
    listed = partition_days(spark, table, with_key=True).filter(F.col("dt") < F.lit(limit))
    old = sorted((row["dt"], row["key"]) for row in listed.collect())
    for _, key in old:
        spec = f"PARTITION (dt = '{key}')"
        described = spark.sql(f"DESCRIBE FORMATTED {table} {spec}").filter("col_name = 'Location'")
        location = described.first()["data_type"]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
        delete_folder(spark, location)
    return [dt for dt, _ in old]


def retention_folder(spark: SparkSession, root: str, day: date, keep_days: int) -> list[date]:
    """The same for a folder of days without a table: raw logs, facts, serving copy, daily rows."""
    old = sorted((dt, path) for dt, path in folder_days(spark, root).items() if dt < day - timedelta(days=keep_days))
    for _, path in old:
        delete_folder(spark, path)
    return [dt for dt, _ in old]
