"""Written steps, shipped code and Arrow columns, shared by the operators."""

import ctypes
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from curfew.llm import words
from curfew.session import shared_folder
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A sieve has 16 bits for each value, and this power of two at most.
SIEVE_BITS = 27
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they
    can import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_curfew_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="curfew-"), "curfew_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("curfew", os.path.relpath(path, package)))
    context.addPyFile(target)
    context._curfew_shipped = True


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Within it, a finished action deletes its shuffle files at once."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 22):
    """Within it, actions hand rows to the workers by ``size`` bytes, however long the texts are, unless the session
    has a size of its own."""
    if spark.conf.get(BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: later steps neither
    repeat the work nor depend on the executors that did it."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder)
    rows._written_to = folder
    return rows


def freed(*rows: DataFrame | None) -> None:
    """Delete what ``written`` has written for these rows. Whatever is made of them must be written itself by then.
    The plans and task records of the steps are garbage too; the driver is asked to collect them before its heap grows."""
    for df in rows:
        folder = getattr(df, "_written_to", None)
        if folder:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    for df in rows:
        if df is not None:
            df.sparkSession._jvm.System.gc()
            break


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def pieces(offsets: np.ndarray, limit: int = 1 << 21):
    """Row ranges of at most ``limit`` bytes, or of one row that is longer."""
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Return freed memory of a worker to the system, which its allocators otherwise hold while it waits for a task."""
    pa.default_memory_pool().release_unused()
    # Only glibc has it.
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def thrifty(function):
    """The same function of batches, which gives back what its task has freed when it ends."""

    def give(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return give


class OnWorker:
    """Something that a worker builds from broadcast data on first use and keeps for
    its later tasks, one at a time per builder. Once something else is built, only what
    the running task has used stays."""

    kept: dict = {}

    def __init__(self, spark: SparkSession, data, build):
        self.key, self.shared, self.build = uuid.uuid4().hex, spark.sparkContext.broadcast(data), build

    @staticmethod
    def forget() -> None:
        """Free what earlier operators have built on this worker."""
        OnWorker.kept.clear()
        give_back()

    def free(self) -> None:
        """Drop the data from the driver and the executors; whatever needs it must be written by then."""
        self.shared.unpersist()

    def get(self):
        name = self.build.__qualname__
        context = TaskContext.get()
        task = context.taskAttemptId() if context else None
        key, built, _ = OnWorker.kept.get(name, (None, None, None))
        if key != self.key:
            built = None
            OnWorker.kept.pop(name, None)
            for other in [n for n, (*_, used) in OnWorker.kept.items() if used != task]:
                del OnWorker.kept[other]
            built = self.build(self.shared.value)
        OnWorker.kept[name] = (self.key, built, task)
        return built


class Sieve:
    """A bit by hash for each of some values. Values without a bit are none of them; a few others pass as well, which
    the join that follows drops."""

    def __init__(self, data: tuple[np.ndarray, int]):
        self.cells, self.bits = data

    @staticmethod
    def slots(values: np.ndarray, bits: int) -> np.ndarray:
        return (words.mix(values.view(np.uint64)) >> np.uint64(64 - bits)).view(np.int64)

    def has(self, values: np.ndarray) -> np.ndarray:
        slot = self.slots(values, self.bits)
        return (self.cells.take(slot >> 6) >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def sieve(values: DataFrame) -> OnWorker:
    """A ``Sieve`` of the one bigint column of ``values``, so that tasks drop most other rows before an exchange."""
    bits = min(SIEVE_BITS, max(16, (16 * values.count()).bit_length()))

    def cells(batches):
        for batch in batches:
            slot = np.sort(Sieve.slots(batch.column(0).to_numpy(zero_copy_only=False), bits))
            cell, first = np.unique(slot >> 6, return_index=True)
            if len(cell):
                held = np.bitwise_or.reduceat(np.uint64(1) << (slot & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(held.view(np.int64))], names=["cell", "bits"])

    found = values.mapInArrow(cells, "cell bigint, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return OnWorker(values.sparkSession, (out, bits), Sieve)


def slot_sums(slot_bits: int, block_bits: int):
    """From (word, n, block): the counters of each block of them."""

    def give(batches):
        total, blocks, size = np.zeros(1 << slot_bits, np.uint32), set(), 1 << block_bits
        for batch in batches:
            word, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            np.add.at(total, (word >> np.uint64(64 - slot_bits)).view(np.int64), n.astype(np.uint32))
            blocks.update(np.unique(batch.column(2).to_numpy()).tolist())
        for block in sorted(blocks):
            part = total[block * size : (block + 1) * size].astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.binary())], names=["block", "sums"])

    return give


def counters(counts: DataFrame, slot_bits: int = 23, block_bits: int = 12) -> np.ndarray:
    """Of ``counts`` (word, n): sums of n by the first ``slot_bits`` of the word, a hash."""
    block = F.shiftrightunsigned("word", 64 - slot_bits + block_bits).alias("block")
    sums = counts.select("word", "n", block).repartition("block").mapInArrow(slot_sums(slot_bits, block_bits), "block bigint, sums binary")
    out = np.zeros(1 << slot_bits, np.uint32)
    for r in sums.toArrow().to_pylist():
        out[r["block"] << block_bits :][: 1 << block_bits] = np.frombuffer(r["sums"], "<u4")
    return out


def counted(hashed: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The counter of each word, 1 at least."""
    out = np.ones(len(hashed), np.int64)
    if len(slots):
        out = np.maximum(out, slots.take((hashed >> np.uint64(65 - len(slots).bit_length())).view(np.int64)))
    return out


class Places:
    """Where hashes are in an ordered array of distinct ones: by their first bits, then one by one, as few share them."""

    def __init__(self, known: np.ndarray):
        self.known, self.bits = known, max(1, min(22, len(known).bit_length()))
        self.first = np.searchsorted(known, np.arange((1 << self.bits) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - self.bits))
        self.first = np.append(self.first, len(known)).astype(np.int32)

    def of(self, hashed: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if it is not there."""
        out = np.full(len(hashed), -1, np.int64)
        if not len(self.known):
            return out
        cell = (hashed >> np.uint64(64 - self.bits)).view(np.int64)
        at, end = self.first.take(cell), self.first.take(cell + 1)
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], hashed[left]
        while len(left):
            found = self.known.take(at)
            same = found == wanted
            out[left[same]] = at[same]
            at += 1
            more = (found < wanted) & (at < end)
            left, at, end, wanted = left[more], at[more], end[more], wanted[more]
        return out


def may_be_in(found: OnWorker, value: Column) -> Column:
    """Whether a bigint passes a sieve."""

    def passes(values: pa.Array) -> pa.Array:
        return pa.array(found.get().has(values.to_numpy(zero_copy_only=False)))

    return F.arrow_udf(passes, "boolean").asNondeterministic()(value)


def hash_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, and never more: those with the least hashes of ``key``. Only
    rows under a threshold that the count of all rows gives are ordered."""
    total = rows.count()
    bits = F.xxhash64(key).bitwiseAND(F.lit((1 << 30) - 1))
    if total > size:
        rows = rows.filter(bits < F.lit(int((1 << 30) * min(1.0, 1.05 * size / total))))
    return written(rows.orderBy(F.xxhash64(key), *rows.columns).limit(size))
