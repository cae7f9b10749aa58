"""Removal of passages that an earlier document holds, found by difference-cover anchors.

A passage is a window of ``WINDOW`` words. Anchors are hashes of ``ANCHOR`` words taken
only where the position modulo ``PERIOD`` lies in a difference cover: for any two
positions some common shift below the period brings both into the cover, so two equal
windows always share an aligned anchor within them. Anchors that only one text holds
are done with; around the others the windows are hashed whole, which extends the
match to both sides, and each window looks for the smallest doc_id that holds it.

Both times equal hashes meet by an exchange and are read as a sorted stream, a few at a
time. Before it, every Arrow batch settles what it can tell by itself and sends one
row for a hash that many of its documents share. Texts that occur again as a whole
take part once. Windows are compared by 96 bits of hash.

Rows are documents. A null doc_id is neither earlier nor later than any other; rows
with equal doc_ids do not remove from each other. A null text has no words.
"""

import numpy as np
import pyarrow as pa
from curfew.llm import steps, words
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 50
PERIOD = 31
#: Every residue modulo 31 is a difference of two of these.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
SECOND_BASE = np.uint64(0xC6BC279692B5C323)

ANCHOR_ROWS = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("pos", pa.int32()), ("sure", pa.bool_())])
WINDOW_ROWS = pa.schema([
    ("key", pa.int64()), ("check", pa.int32()), ("doc", pa.int64()), ("who", pa.int32()), ("start", pa.int32()),
    ("sure", pa.bool_()),
])


def sql(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


def hashed_rows(texts: pa.Array):
    """Word hashes of a few rows at a time: first row, first word of each row, hashes."""
    data, offsets = steps.text_buffers(texts)
    for first, last in steps.pieces(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        found = words.find(part, cuts)
        yield first, found, words.hashes(part, found)


def batch_of(schema: pa.Schema, *columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.ascontiguousarray(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def anchors(batches):
    """From (node, text): anchors by hash; those that two texts of the batch share are
    sure, and one row goes on to tell other batches."""
    in_cover = np.zeros(PERIOD, bool)
    in_cover[list(COVER)] = True
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        _, once = np.unique(nodes, return_index=True)
        fresh = np.zeros(len(nodes), bool)
        fresh[once] = True
        keys, owners, places = [], [], []
        for first, found, hashed in hashed_rows(batch.column(1)):
            at, row = words.window_rows(found, ANCHOR)
            pos = at - found.first[row]
            taken = in_cover[pos % PERIOD] & (found.counts[row] >= WINDOW) & fresh[first + row]
            keys.append(words.windows(hashed, ANCHOR)[at[taken]])
            owners.append(nodes[first + row[taken]])
            places.append(pos[taken])
        if not keys:
            continue
        key, node, pos = signed(np.concatenate(keys)), np.concatenate(owners), np.concatenate(places)
        if not len(key):
            continue
        order = np.lexsort((node, key))
        key, node, pos = key[order], node[order], pos[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        shared = node[start] != node[start + size - 1]
        sure = np.repeat(shared, size)
        own = signed(words.mix(node.view(np.uint64)))
        yield batch_of(ANCHOR_ROWS, np.where(sure, own, key), node, pos, sure)
        tell = start[shared]
        yield batch_of(ANCHOR_ROWS, key[tell], node[tell], np.full(len(tell), -1), np.zeros(len(tell), bool))


def shared_anchors(batches):
    """From rows sorted by key and node: (node, pos) of the anchors of two texts or more."""
    schema = pa.schema([("node", pa.int64()), ("pos", pa.int32())])
    held = np.zeros((3, 0), np.int64)
    for batch in batches:
        key, node, pos = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
        sure = batch.column(3).to_numpy(zero_copy_only=False)
        if sure.any():
            yield batch_of(schema, node[sure], pos[sure])
        rows = np.concatenate([held, np.stack([key, node, pos])[:, ~sure]], 1)
        if not rows.shape[1]:
            continue
        key, node, pos = rows
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        shared = node[start] != node[start + size - 1]
        out = np.repeat(shared, size) & (pos >= 0)
        if out.any():
            yield batch_of(schema, node[out], pos[out])
        last = rows[:, start[-1] :]
        if shared[-1]:
            held = last[:, [0, -1]].copy()
            held[2] = -1
        else:
            held = np.unique(last, axis=1)


def windows(batches):
    """From (doc, who, text, positions of shared anchors): the windows around these
    anchors by hash; those that a smaller doc of the batch holds are sure."""
    for batch in batches:
        doc = batch.column(0).to_numpy()
        who = batch.column(1).to_numpy()
        marks = batch.column(3)
        cut = np.append(0, np.cumsum(np.asarray(marks.value_lengths())))
        mark = marks.flatten().to_numpy()
        parts = []
        for first, found, hashed in hashed_rows(batch.column(2)):
            at, row = words.window_rows(found, WINDOW)
            if not len(at):
                continue
            is_anchor = np.zeros(len(hashed) + PERIOD + 1, np.int32)
            few = np.diff(cut)[first : first + len(found.counts)]
            is_anchor[mark[cut[first] : cut[first] + few.sum()] + np.repeat(found.first[:-1], few)] = 1
            before = np.append(0, np.cumsum(is_anchor))
            taken = before[at + PERIOD] > before[at]
            at, row = at[taken], row[taken]
            one = words.windows(hashed, WINDOW)[at]
            two = words.windows(hashed, WINDOW, SECOND_BASE)[at]
            parts.append((signed(one), (two >> np.uint64(32)).astype(np.uint32).view(np.int32), doc[first + row],
                          who[first + row], at - found.first[row]))
        if not parts:
            continue
        key, check, docs, whos, start = (np.concatenate(c) for c in zip(*parts))
        if not len(key):
            continue
        order = np.lexsort((docs, check, key))
        key, check, docs, whos, start = (c[order] for c in (key, check, docs, whos, start))
        new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))
        least = docs[np.flatnonzero(new)][np.cumsum(new) - 1]
        sure = docs > least
        own = signed(words.mix(docs.astype(np.int64).view(np.uint64)))
        yield batch_of(WINDOW_ROWS, np.where(sure, own, key), check, docs, whos, start, sure)


def covered_windows(batches):
    """From rows sorted by key, check and doc: windows that a smaller doc holds."""
    schema = pa.schema([("doc", pa.int64()), ("who", pa.int32()), ("start", pa.int32())])
    held = None
    for batch in batches:
        key, check, doc, who, start = (batch.column(k).to_numpy() for k in range(5))
        sure = batch.column(5).to_numpy(zero_copy_only=False)
        if sure.any():
            yield batch_of(schema, doc[sure], who[sure], start[sure])
        key, check, doc, who, start = (c[~sure] for c in (key, check, doc, who, start))
        if not len(key):
            continue
        new = np.append(True, (key[1:] != key[:-1]) | (check[1:] != check[:-1]))
        first = np.flatnonzero(new)
        least = doc[first].copy()
        if held is not None and held[:2] == (key[0], check[0]):
            least[0] = held[2]
        held = (key[-1], check[-1], least[-1])
        out = doc > least[np.cumsum(new) - 1]
        if out.any():
            yield batch_of(schema, doc[out], who[out], start[out])


def kept_words(texts: pa.Array, starts: pa.Array, copy: pa.Array) -> pa.Array:
    rows = []
    for text, begin, whole in zip(texts.to_pylist(), starts.to_pylist(), copy.to_pylist(), strict=True):
        own = (text or "").encode().split()
        gone = np.zeros(len(own) + 1, np.int64)
        if whole and len(own) >= WINDOW:
            gone[0], gone[-1] = 1, -1
        for k in begin or ():
            gone[k] += 1
            gone[k + WINDOW] -= 1
        out = np.cumsum(gone)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], out, [0]])))
        spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]
        kept = b" ".join(word for word, removed in zip(own, out) if not removed) if spans else b" ".join(own)
        rows.append({"n_words": len(own), "n_removed": int(out.sum()), "kept": kept.decode(), "spans": spans})
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])
    return pa.array(rows, kind)


def low_bits(node: Column) -> Column:
    return node.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def removals(docs: DataFrame) -> DataFrame:
    """doc_id and who (bits of the text's hash) of documents that lose words: the first
    words of the windows that a smaller doc_id holds, or ``copy`` if it holds all."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("node")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    found = rows.select("node", "text").mapInArrow(anchors, sql(ANCHOR_ROWS))
    ordered = found.repartition("key").sortWithinPartitions("key", "node")
    flags = steps.written(
        ordered.mapInArrow(shared_anchors, "node bigint, pos int")
        .groupBy("node").agg(F.collect_set("pos").alias("marks")))
    who = low_bits(F.col("node")).alias("who")
    slim = rows.select("doc_id", "node", F.length("text").alias("size"), F.hash("text").alias("again"))
    slim = steps.written(slim)
    firsts = slim.groupBy("node", "size", "again").agg(F.min("doc_id").alias("least"))
    copies = slim.join(firsts, ["node", "size", "again"]).filter("doc_id > least").select("doc_id", who)
    marked = firsts.join(flags, "node").select(F.col("least").alias("doc_id"), "node", "marks")
    near = (
        rows.join(marked, ["doc_id", "node"]).select("doc_id", who, "text", "marks")
        .mapInArrow(windows, sql(WINDOW_ROWS))
        .repartition("key").sortWithinPartitions("key", "check", "doc")
        .mapInArrow(covered_windows, "doc bigint, who int, start int")
        .groupBy(F.col("doc").alias("doc_id"), "who").agg(F.collect_set("start").alias("starts"))
    )
    none = F.lit(None).cast("array<int>")
    every = near.withColumn("copy", F.lit(False)).unionByName(
        copies.distinct().select("doc_id", "who", none.alias("starts"), F.lit(True).alias("copy")))
    return steps.written(every.groupBy("doc_id", "who").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.max("copy").alias("copy")))


def cleaned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, the kept words joined by
    one blank, and the removed ranges of words."""
    steps.ship(docs.sparkSession)
    lost = removals(docs)
    rows = docs.select("doc_id", "text", low_bits(F.xxhash64("text")).alias("who"))
    kind = "struct<n_words:bigint,n_removed:bigint,kept:string,spans:array<struct<first:int,last:int>>>"
    keep = F.arrow_udf(kept_words, kind).asNondeterministic()
    return (
        rows.join(lost, ["doc_id", "who"], "left")
        .select("doc_id", keep("text", "starts", "copy").alias("k")).select("doc_id", "k.*")
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of ``docs``."""
    return cleaned(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
