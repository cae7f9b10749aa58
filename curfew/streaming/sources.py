"""Streams of raw session logs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curfew import schema
from curfew.sources.raw import TEXT_OPTIONS


def stream_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New files of a log folder, read once each; the checkpoint remembers which."""
    reader = spark.readStream.schema(schema.RAW).options(**TEXT_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", "true").csv(folder)


def split_line(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw fields of lines in one text or binary column, by the rules of the files:
    comment and empty lines are no rows."""
    line = F.col(column).cast("string")
    parsed = F.from_csv(line, schema.ddl([(name, "string") for name in schema.RAW_FIELDS]), TEXT_OPTIONS)
    rows = lines.filter(~F.startswith(line, F.lit(TEXT_OPTIONS["comment"])) & (F.trim(line) != ""))
    return rows.select(parsed.alias("fields")).select("fields.*")


def stream_kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Raw fields of a topic's messages; needs the Kafka connector on the class path."""
    messages = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest").load()
    )
    return split_line(messages)


def stream_enrich(stream: DataFrame, host: str) -> DataFrame:
    """Stamp arrival time and host on each row."""
    return stream.withColumns({"arrival_time": F.current_timestamp(), "host": F.lit(host)})
