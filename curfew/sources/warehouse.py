"""Scans of the fact table. ``dt`` stays a bare column compared with literals, so
every scan lists only the day directories it needs."""

from collections.abc import Iterable
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curfew import schema


def scan(spark: SparkSession, root: str) -> DataFrame:
    """The fact kept as a partitioned directory, by its declared schema."""
    columns = [*schema.FACT_DDL, *schema.PROVENANCE_DDL, ("dt", "date")]
    return spark.read.schema(schema.ddl(columns)).orc(root)


def scan_serving(spark: SparkSession, root: str) -> DataFrame:
    """The serving copy, in its narrower types."""
    columns = [(name, schema.SERVING_TYPES.get(name, kind)) for name, kind in schema.FACT_DDL]
    return spark.read.schema(schema.ddl([*columns, *schema.PROVENANCE_DDL, ("dt", "date")])).orc(root)


def scan_day(spark: SparkSession, root: str, day: date) -> DataFrame:
    """One day of the directory, listing that day's files only."""
    columns = [*schema.FACT_DDL, *schema.PROVENANCE_DDL, ("dt", "date")]
    reader = spark.read.schema(schema.ddl(columns)).option("basePath", root)
    return reader.orc(f"{root}/dt={day:%Y-%m-%d}")


def catalog_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def orc_dir_scan(spark: SparkSession, path: str, day: date) -> DataFrame:
    """One day's directory read on its own, its day given as a constant."""
    columns = [*schema.FACT_DDL, *schema.PROVENANCE_DDL]
    return spark.read.schema(schema.ddl(columns)).orc(path).withColumn("dt", F.lit(day))


def on_day(fact: DataFrame, day: date) -> DataFrame:
    return fact.filter(F.col("dt") == F.lit(day))


def in_range(fact: DataFrame, first: date, last: date) -> DataFrame:
    return fact.filter(F.col("dt").between(F.lit(first), F.lit(last)))


def on_days(fact: DataFrame, days: Iterable[date]) -> DataFrame:
    return fact.filter(F.col("dt").isin(list(days)))


def last_days(fact: DataFrame, day: date, days: int) -> DataFrame:
    """The ``days`` days that end with ``day``."""
    return fact.filter(F.col("dt").between(F.date_sub(F.lit(day), days - 1), F.lit(day)))


def of_player(fact: DataFrame, player_id: str) -> DataFrame:
    return fact.filter(F.col("player_id") == player_id)


def latest_day(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("dt").alias("latest_dt"))


def newest_day(fact: DataFrame) -> date | None:
    """Report day for the scans above, as a literal. Reads ``dt`` only."""
    return latest_day(fact).first()["latest_dt"]


def parse_key(key: str) -> date | None:
    """The day of a folder or partition, keyed as a date or as yyyyMMdd."""
    for form in ("%Y-%m-%d", "%Y%m%d"):
        try:
            return datetime.strptime(key, form).date()
        except ValueError:
            pass
    return None


def partition_days(spark: SparkSession, table: str, with_key: bool = False) -> DataFrame:
    """Days of a table by its catalog, keyed as dates or as yyyyMMdd; no file is touched."""
    key = F.regexp_extract("partition", "dt=([0-9-]+)", 1)
    day = F.coalesce(key.try_cast("date"), F.try_to_timestamp(key, F.lit("yyyyMMdd")).cast("date"))
    day = F.when(F.length(key) == 8, F.try_to_timestamp(key, F.lit("yyyyMMdd")).cast("date")).otherwise(day)
    columns = [day.alias("dt"), key.alias("key")]
    return spark.sql(f"SHOW PARTITIONS {table}").select(*columns[: 1 + with_key])


def file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def folder_days(spark: SparkSession, root: str) -> dict[date, str]:
    """Days of a folder and their paths, by its list of directories; no file is opened.
    Empty where there is no folder."""
    system, path = file_system(spark, root)
    if not system.exists(path):
        return {}
    names = [(s.getPath().getName(), s.getPath().toString()) for s in system.listStatus(path) if s.isDirectory()]
    days = {parse_key(name[3:]): where for name, where in names if name.startswith("dt=")}
    return {day: where for day, where in days.items() if day}


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds; nothing where there is none."""
    system, path = file_system(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def read_text(spark: SparkSession, file: str) -> str:
    system, path = file_system(spark, file)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, file: str, content: str) -> None:
    """A small ASCII file, in place at once: written beside and renamed."""
    system, path = file_system(spark, file)
    beside = file_system(spark, f"{file}.new")[1]
    stream = system.create(beside, True)
    stream.writeBytes(content)
    stream.close()
    system.delete(path, False)
    if not system.rename(beside, path):
        raise OSError(f"could not put {file} in place")


def create_text(spark: SparkSession, file: str, content: str) -> bool:
    """A small ASCII file that must not exist yet; False if it does. The file system lets one writer through."""
    system, path = file_system(spark, file)
    system.mkdirs(path.getParent())
    try:
        stream = system.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    stream.writeBytes(content)
    stream.close()
    return True


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files of a folder."""
    system, path = file_system(spark, folder)
    return system.getContentSummary(path).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    system, where = file_system(spark, path)
    system.delete(where, True)


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put a finished folder in the place of another; both are renames."""
    system, source = file_system(spark, new)
    place, old = (file_system(spark, x)[1] for x in (target, f"{new}.old"))
    system.mkdirs(place.getParent())
    if system.exists(place):
        system.rename(place, old)
    if not system.rename(source, place):
        raise OSError(f"could not put {target} in place")
    system.delete(old, True)


def newest_folder_day(spark: SparkSession, root: str) -> date | None:
    """The newest day of a folder, without a look at its files."""
    return max(folder_days(spark, root), default=None)


def count_session(spark: SparkSession) -> SparkSession:
    """A session whose ORC scans answer counts by day from file footers and directories."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,parquet,text")
    own.conf.set("spark.sql.orc.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """dt and n, the rows of each day of a folder, from the footers of its files: no row is read."""
    columns = [*schema.FACT_DDL, *schema.PROVENANCE_DDL, ("dt", "date")]
    days = count_session(spark).read.schema(schema.ddl(columns)).orc(root)
    return days.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def rows_per_day(spark: SparkSession, root: str) -> DataFrame:
    """``footer_counts`` in the session given: a row a day, so its size is that of the calendar."""
    return spark.createDataFrame([tuple(row) for row in footer_counts(spark, root).collect()], "dt date, n bigint")


def newest_partition(spark: SparkSession, table: str) -> date | None:
    return newest_day(partition_days(spark, table))
