"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows
of all benchmark items, scanning each text once.

Normalised text is A-Z lowered, words of digits, letters and characters beyond
ASCII, each between single blanks. A pattern is a window of consecutive item words
with its blanks, so it can match only at word bounds. Matches are found in the
normalised text and mapped back to code points of the original.

The patterns are counted before they are collected: while they stay under
``BLOCK_BYTES`` there is one automaton; beyond, the patterns are dealt by hash into
blocks of that size and the rows pass one scan per block in turn.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
from curfew.llm import steps
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
BLOCK_BYTES = 32 << 20

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NORMAL = bytes(b + 32 if 0x41 <= b < 0x5B else b if WORD_BYTES[b] else 0x20 for b in range(256))

SPAN = "struct<first:int,last:int,begin:int,end:int>"
FOUND = f"struct<n_words:bigint,spans:array<{SPAN}>,items:array<bigint>>"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching word ranges as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pattern, its number of words, and the ids of the items that hold it."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("pattern", T.BinaryType()), T.StructField("size", T.IntegerType())])))
    def patterns(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            found = normal_words((text or "").encode())
            size = min(window, len(found))
            runs = {b" " + b" ".join(found[i : i + size]) + b" " for i in range(len(found) - size + 1)} if size else ()
            out.append([{"pattern": run, "size": size} for run in sorted(runs)])
        return pa.array(out, pa.list_(pa.struct([("pattern", pa.binary()), ("size", pa.int32())])))

    rows = benchmark.select("item_id", F.explode(patterns("text")).alias("w"))
    return rows.groupBy("w.pattern", "w.size").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def automaton(patterns: list[tuple[bytes, int, list[int]]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for pattern, size, items in patterns:
        machine.add_word(pattern.decode("latin-1"), (size, items))
    machine.make_automaton()
    return machine


def scan_text(machine: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, ranges of hit words, and items found."""
    found = normal_words(text)
    if not found or not len(machine):
        return len(found), [], set()
    line = b" " + b" ".join(found) + b" "
    spans, items, blanks = [], set(), None
    for end, (size, ids) in machine.iter(line.decode("latin-1")):
        if blanks is None:
            blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        last = int(np.searchsorted(blanks, end)) - 1
        spans.append((last - size + 1, last))
        items.update(ids)
    return len(found), merged(spans), items


def code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where ranges of words begin and end in the original, in code points."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], WORD_BYTES[data], [False]])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(before[starts[first]]), int(before[ends[last]])) for first, last in spans]


def blocks_of(windows: DataFrame, block_bytes: int) -> list[list[tuple[bytes, int, list[int]]]]:
    """The patterns in blocks whose size is bounded: the total is asked for first,
    and one block is collected at a time."""
    windows = steps.written(windows)
    total = windows.agg(F.sum(F.length("pattern"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    for block in range(count):
        part = windows.filter(F.pmod(F.xxhash64("pattern"), F.lit(count)) == block) if count > 1 else windows
        yield [(bytes(r.pattern), r.size, list(r.items)) for r in part.toLocalIterator()]


def scan_with(machine: steps.OnWorker):
    """A function of texts and what earlier blocks found in them."""

    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        data, offsets = steps.text_buffers(texts)
        data, rows = data.tobytes(), []
        patterns = machine.get()
        for k, found in enumerate(before.to_pylist()):
            row = data[offsets[k] : offsets[k + 1]]
            n_words, spans, items = scan_text(patterns, row)
            if found:
                spans = merged(spans + [(s["first"], s["last"]) for s in found["spans"]])
                items |= set(found["items"])
            places = code_points(row, spans) if spans else []
            rows.append((n_words, [(*s, *p) for s, p in zip(spans, places, strict=True)], sorted(items)))
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), span_array([r[1] for r in rows]),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["n_words", "spans", "items"])

    return scan


def scanned(docs: DataFrame, text: str | Column, benchmark: DataFrame, into: str, window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column ``into``: number of words, hit spans and item ids.

    Spans are maximal ranges of hit words with their code points in the original.
    A null text has no words; an item without words, or a benchmark without items,
    hits nothing; windows of an item with a null id hit but name no item.
    """
    spark = docs.sparkSession
    steps.ship(spark)
    column = F.col(text) if isinstance(text, str) else text
    out = docs.withColumn(into, F.lit(None).cast(FOUND))
    for patterns in blocks_of(item_windows(benchmark, window), block_bytes):
        machine = steps.OnWorker(spark, patterns, automaton)
        out = out.withColumn(into, F.arrow_udf(scan_with(machine), FOUND).asNondeterministic()(column, F.col(into)))
    return out


def span_array(rows: list[list[tuple[int, int, int, int]]]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.array([s for r in rows for s in r], np.int32).reshape(-1, 4)
    fields = [pa.array(flat[:, k]) for k in range(4)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["first", "last", "begin", "end"]))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and the spans in code points."""
    found = scanned(docs.select("doc_id", "text"), "text", benchmark, "found", window, block_bytes)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)
    names = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.transform("found.spans", lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"))).alias("spans"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without any hit word."""
    name = steps.fresh("found", docs.columns)
    return scanned(docs, "text", benchmark, name, window).filter(F.size(f"{name}.spans") == 0).drop(name)
