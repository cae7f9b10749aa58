"""Raw session logs: bar-separated text in one directory per day."""

import uuid
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curfew import schema
from curfew.functions import rules
from curfew.sources import warehouse

# Plain fields: no quoting, '#' opens a comment line, an empty field is NULL.
TEXT_OPTIONS = {"sep": "|", "comment": "#", "quote": "", "nullValue": "", "mode": "PERMISSIVE"}
REJECTED = "rejected_line"


def day_key(day: date) -> str:
    return day.strftime("%Y%m%d")


def _layout() -> T.StructType:
    return T.StructType([*schema.RAW.fields, T.StructField("dt", T.StringType())])


def ods_scan(spark: SparkSession, root: str, days: str = "*") -> DataFrame:
    """Days under ``root`` whose key matches a glob; only their files are listed."""
    reader = spark.read.schema(_layout()).options(**TEXT_OPTIONS).option("basePath", root)
    return reader.csv(f"{root}/dt={days}")


def ods_scan_days(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """A closed range of days; days without a directory have no rows."""
    return ods_scan_list(spark, root, [first + timedelta(days=back) for back in range((last - first).days + 1)])


def ods_scan_list(spark: SparkSession, root: str, days: Iterable[date]) -> DataFrame:
    """The listed days; those without a directory have no rows."""
    keys = [day_key(day) for day in days]
    try:
        return ods_scan(spark, root, f"{{{','.join(keys)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _layout())


def ods_scan_day(spark: SparkSession, root: str, day: date) -> DataFrame:
    return ods_scan_days(spark, root, day, day)


def with_provenance(scanned: DataFrame) -> DataFrame:
    """Add the processing time and the file of each row; apply right at the scan."""
    return scanned.withColumns(
        {"etl_time": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def create_raw_table(spark: SparkSession, table: str, root: str) -> None:
    options = ", ".join(f"'{key}' '{value}'" for key, value in TEXT_OPTIONS.items())
    columns = schema.ddl([(name, "string") for name in [*schema.RAW_FIELDS, "dt"]])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING csv OPTIONS ({options}) "
        f"PARTITIONED BY (dt) LOCATION '{root}'"
    )


def add_day(spark: SparkSession, table: str, day: date) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt = '{day_key(day)}')")


def discover_days(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def rejected_row() -> Column:
    """A line that does not hold typed values where the fact needs them."""
    def unreadable(name, kind):
        return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()

    wrong = F.col(REJECTED).isNotNull()
    for name, kind in [
        ("online_duration", "bigint"), ("match_count", "int"),
        ("recharge_amount", schema.MONEY), ("item_consumption", "bigint"),
    ]:
        wrong = wrong | unreadable(name, kind)
    for name in ["login_time", "logout_time"]:
        wrong = wrong | (F.col(name).isNotNull() & rules.parse_time(F.col(name)).isNull())
    return wrong


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with ``rejected`` set on those that cannot be typed."""
    layout = T.StructType(
        [*schema.RAW.fields, T.StructField(REJECTED, T.StringType()), T.StructField("dt", T.StringType())]
    )
    lines = (
        spark.read.schema(layout).options(**TEXT_OPTIONS)
        # a line of the wrong width shows only when all of its fields are parsed
        .option("columnPruning", "false").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    )
    return lines.withColumn("rejected", rejected_row())


def rejected_share(marked: DataFrame) -> DataFrame:
    """One row: lines read, lines rejected, share rejected."""
    counted = marked.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("rejected").alias("rejected_rows")
    )
    share = F.col("rejected_rows") / F.nullif(F.col("total_rows"), F.lit(0))
    return counted.withColumn("rejected_ratio", F.coalesce(share, F.lit(0.0)))


class LoadRejected(ValueError):
    """More rows of a load were rejected than it tolerates."""


def tolerant_load(spark: SparkSession, path: str, target: str, max_ratio: float) -> DataFrame:
    """Load the rows that can be typed into the folder ``target``, or LoadRejected when too many lines are bad.

    One pass: the lines are counted while the good ones are written beside the target. Only a load that
    is within the limit is put in place, by one rename, so after a refusal the target is as it was.
    """
    marked, counted = read_marked(spark, path), Observation()
    watched = marked.observe(counted, F.count(F.lit(1)).alias("total"), F.count_if("rejected").alias("bad"))
    beside = f"{target}.{uuid.uuid4().hex}"
    try:
        watched.filter(~F.col("rejected")).drop("rejected", REJECTED).write.parquet(beside)
        found = counted.get
        if found["total"] and found["bad"] / found["total"] > max_ratio:
            raise LoadRejected(f"{found['bad']} of {found['total']} rows rejected, limit {max_ratio:.0%}")
        warehouse.replace_folder(spark, beside, target)
    finally:
        warehouse.delete_folder(spark, beside)
    return spark.read.schema(_layout()).parquet(target)


def write_raw_lines(rows: DataFrame, root: str, append: bool = False) -> None:
    """Lay rows out as a collector does: text lines under dt=yyyyMMdd."""
    fields = [F.coalesce(F.col(name), F.lit("")) for name in schema.RAW_FIELDS]
    rows.select(F.concat_ws("|", *fields).alias("value"), "dt").write.mode(
        "append" if append else "errorifexists").partitionBy("dt").text(root)

