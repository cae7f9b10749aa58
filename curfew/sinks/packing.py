"""Packing the small files of closed days of a log folder.

    <packed>/rows/dt=yyyyMMdd/pack=<id>     files of even size
    <packed>/manifest/<yyyyMMdd>.json       the pack that stands for the day

A collector or a stream leaves a file for each period and task. Once a day is closed its lines are
written again in as many files as its bytes need, and a manifest, put in place by one rename,
makes the pack stand for the day. A reader takes the days of manifests from their packs and all
others from the log folder, so it sees each line once before, during and after the packing. A pack
without a manifest is of a broken attempt: nobody reads it and the next attempt deletes it. The log folder itself is left
as it is; ``tables.retention_folder`` deletes its days when they are old enough.
"""

import json
import math
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curfew import schema
from curfew.sources import raw as raw_source
from curfew.sources import warehouse

TARGET_BYTES = 128 * 1024 * 1024


def packs(spark: SparkSession, packed: str) -> dict[str, str]:
    """Keys of the packed days, and the pack of each."""
    names = [n for n in warehouse.names(spark, f"{packed}/manifest") if n.endswith(".json")]
    return {n.removesuffix(".json"): json.loads(warehouse.read_text(spark, f"{packed}/manifest/{n}"))["pack"] for n in names}


def pack_days(spark: SparkSession, root: str, packed: str, before: date, target_bytes: int = TARGET_BYTES) -> list[date]:
    """Pack the days before ``before`` that are not packed yet; returns them."""
    done = packs(spark, packed)
    days = sorted(day for day in warehouse.folder_days(spark, root) if day < before and raw_source.day_key(day) not in done)
    for day in days:
        key = raw_source.day_key(day)
        for name in warehouse.names(spark, f"{packed}/rows/dt={key}"):
            warehouse.delete_folder(spark, f"{packed}/rows/dt={key}/{name}")
        pack = uuid.uuid4().hex
        # The folder as a whole is read, since a stream's log of its files says which of them count.
        lines = spark.read.schema("value string, dt string").text(root).filter(F.col("dt") == key).select("value")
        files = max(1, math.ceil(warehouse.folder_bytes(spark, f"{root}/dt={key}") / target_bytes))
        lines.repartition(files).write.text(f"{packed}/rows/dt={key}/pack={pack}")
        warehouse.put_text(spark, f"{packed}/manifest/{key}.json", json.dumps({"pack": pack, "files": files}))
    return days


def scan(spark: SparkSession, root: str, packed: str) -> DataFrame:
    """Raw rows of all days, packed ones from their packs."""
    done = packs(spark, packed)
    layout = f"{schema.ddl([(name, 'string') for name in schema.RAW_FIELDS])}, dt string"
    rows = spark.read.schema(layout).options(**raw_source.TEXT_OPTIONS).csv(root).filter(~F.col("dt").isin(list(done)))
    if not done:
        return rows
    folders = [f"{packed}/rows/dt={key}/pack={pack}" for key, pack in done.items()]
    reader = spark.read.schema(f"{layout}, pack string").options(**raw_source.TEXT_OPTIONS).option("basePath", f"{packed}/rows")
    return rows.unionByName(reader.csv(folders).drop("pack"))
