"""Loads that carry a label: each label is loaded once, whole or not at all, whoever tries.

    claims/<label>/<n>.json     the n-th try of a label
    rows/load_label=<label>/attempt=<n-id>/rejected=..
    entries/<label>.json        the label is loaded, and by which try

A try first claims its number by creating a file that must not exist yet, which a file system
grants to one writer only. Its rows go into a folder of its own, good and rejected apart, and are
counted in the pass that writes them. The label is then entered, again by a file
that must not exist yet, and only rows of entered tries are visible. So two writers of one label
never mix their rows, and one entry stands. While a claim is fresh no other try begins; a
claim older than ``patience`` seconds is taken for dead and the next number may be claimed. If
its writer lives after all, whoever enters first has loaded the label, and the other one learns that
it was loaded before.
"""

import json
import time
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curfew.sources import warehouse
from curfew.sources.raw import LoadRejected

LEDGER_DDL = "loaded_rows bigint, rejected_rows bigint, load_label string, attempt string"
PATIENCE = 6 * 3600


class LabelTaken(RuntimeError):
    """Another writer is loading this label just now."""


def _place(root: str, kind: str, label: str) -> str:
    return f"{root}/{kind}/{quote(label, safe='')}"


def entries(spark: SparkSession, root: str) -> DataFrame:
    """Entered labels with their counts and the try that counts; none where nothing was loaded yet."""
    if not warehouse.folder_exists(spark, f"{root}/entries"):
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).json(f"{root}/entries")


def loads(spark: SparkSession, root: str) -> DataFrame:
    return entries(spark, root).drop("attempt")


def is_loaded(spark: SparkSession, root: str, label: str) -> bool:
    return warehouse.folder_exists(spark, f"{_place(root, 'entries', label)}.json")


def claim(spark: SparkSession, root: str, label: str, patience: float = PATIENCE) -> int:
    """The number of a try that is this writer's alone; LabelTaken while another's is fresh."""
    folder = _place(root, "claims", label)
    tries = sorted(int(name.removesuffix(".json")) for name in warehouse.names(spark, folder) if name.endswith(".json"))
    if tries:
        last = json.loads(warehouse.read_text(spark, f"{folder}/{tries[-1]:06d}.json") or "{}")
        if last.get("open", True) and time.time() - last.get("at", time.time()) < patience:
            raise LabelTaken(label)
    number = tries[-1] + 1 if tries else 0
    if not warehouse.create_text(spark, f"{folder}/{number:06d}.json", json.dumps({"at": time.time(), "by": uuid.uuid4().hex, "open": True})):
        raise LabelTaken(label)
    return number


def give_up(spark: SparkSession, root: str, label: str, number: int) -> None:
    """A try that ended without an entry: the label may be tried again at once."""
    warehouse.put_text(spark, f"{_place(root, 'claims', label)}/{number:06d}.json", json.dumps({"at": time.time(), "open": False}))


def labelled_load(marked: DataFrame, root: str, label: str, max_ratio: float = 0.0, patience: float = PATIENCE) -> bool:
    """Load rows that carry a boolean ``rejected``; False if the label was loaded before. LabelTaken
    if another writer is at it."""
    spark = marked.sparkSession
    if is_loaded(spark, root, label):
        return False
    number = claim(spark, root, label, patience)
    # A folder that is this try's alone even where a file system lets two writers claim one number.
    attempt = f"{number}-{uuid.uuid4().hex}"
    path = f"{_place(root, 'rows', label).replace('/rows/', '/rows/load_label=')}/attempt={attempt}"
    entered = False
    try:
        counted = Observation()
        watched = marked.observe(
            counted, F.count_if(~F.col("rejected")).alias("loaded_rows"), F.count_if("rejected").alias("rejected_rows"))
        watched.write.mode("overwrite").partitionBy("rejected").parquet(path)
        counts = counted.get
        seen = counts["loaded_rows"] + counts["rejected_rows"]
        if seen and counts["rejected_rows"] / seen > max_ratio:
            raise LoadRejected(f"{counts['rejected_rows']} of {seen} rows rejected, limit {max_ratio:.0%}")
        entry = {**counts, "load_label": label, "attempt": attempt}
        entered = warehouse.create_text(spark, f"{_place(root, 'entries', label)}.json", json.dumps(entry))
        return entered
    finally:
        if not entered:
            warehouse.delete_folder(spark, path)
            give_up(spark, root, label, number)


def loaded_rows(spark: SparkSession, root: str, layout: str) -> DataFrame:
    """Accepted rows of all entered labels; the list of labels is broadcast if small."""
    stored = spark.read.schema(f"{layout}, load_label string, attempt string, rejected boolean").parquet(f"{root}/rows")
    known = entries(spark, root).select("load_label", "attempt")
    return stored.filter(~F.col("rejected")).join(known, ["load_label", "attempt"], "left_semi").drop("rejected", "attempt")
