"""Token ids of documents in a binary file format, and back.

The documents are put in order of doc_id by a range exchange, so no task holds more
than its range. Each task tokenises its documents, appends the end id to each, and
cuts the ids into chunks of about ``CHUNK_BYTES`` of text. A chunk is one row of a
Parquet folder, which any store that Spark writes to can hold and whose commit
survives a lost executor:

    part, chunk        order of the chunk
    doc_ids, counts    its documents and their numbers of ids
    n_tokens           ids in all
    frequencies        the order-0 table of the range coder
    blocks             array of (n_tokens, crc32 of the data, data), coded on their own

A null text is empty; documents with a null doc_id come first; equal doc_ids are
ordered by text, and each row is a document of its own. No rows make an empty folder.
"""

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from curfew.llm import range_coder, steps, words
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 1
CHUNK_BYTES = 6 << 20
#: Text that is tokenised at once; the ids of a chunk are gathered from several such pieces and batches.
PIECE_BYTES = 2 << 20
CACHED_WORDS = 2_000_000
#: Words that are found by the first bits of their hash alone.
NEAR_BITS = 20

FORMAT = (
    "part int, chunk int, doc_ids array<bigint>, counts array<bigint>, n_tokens bigint, frequencies binary, "
    "blocks array<struct<n_tokens:int,crc32:bigint,data:binary>>"
)
ARROW_FORMAT = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ("n_tokens", pa.int64()), ("frequencies", pa.binary()),
    ("blocks", pa.list_(pa.struct([("n_tokens", pa.int32()), ("crc32", pa.int64()), ("data", pa.binary())]))),
])

#: A word of letters with marks after it. Its two parts are tokenised apart, as the
#: tokenizer never joins a letter and a mark; an apostrophe may bind them.
LETTERS_THEN_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([!-&(-/:-@\[-`{-~]*)")

#: Bytes that are letters of ASCII (0), such marks (1), and others (2).
KIND = np.full(256, 2, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 0
KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 1


def kinds(raw: np.ndarray) -> np.ndarray:
    """``KIND`` of the bytes of whole words, with the two bytes of letters from À to ſ as letters: those of
    ``LETTERS_THEN_MARKS``, which are C3, C4 or C5 and one more, but for ×, ÷ and İ."""
    kind = KIND[raw]
    lead = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC5) & (raw[1:] >> 6 == 2))
    pair = (raw[lead].astype(np.uint16) << 8) | raw[lead + 1]
    lead = lead[(pair != 0xC397) & (pair != 0xC3B7) & (pair != 0xC4B0)]
    kind[lead] = kind[lead + 1] = 0
    return kind


class Table:
    """Entries of hashed words, in order of the hash."""

    def __init__(self):
        self.known, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def missing(self, distinct: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        return self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)

    def add(self, hashed: np.ndarray, entry: np.ndarray) -> None:
        at = np.searchsorted(self.known, hashed)
        self.known, self.entry = np.insert(self.known, at, hashed), np.insert(self.entry, at, entry)

    def of(self, hashed: np.ndarray) -> np.ndarray:
        return self.entry[np.searchsorted(self.known, hashed)]


class Growing:
    """An array that grows at its end, seldom copied."""

    def __init__(self, first: list[int], kind: type):
        self.held, self.size = np.array(first, kind), len(first)

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.held):
            held = np.empty(max(end, len(self.held) * 3 // 2), self.held.dtype)
            held[: self.size] = self.held[: self.size]
            self.held = held
        self.held[self.size : end] = more
        self.size = end


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all pieces in turn."""
    after = np.cumsum(size)
    return np.arange(int(after[-1]) if len(after) else 0) + np.repeat(start - after + size, size)


class WordIds:
    """Ids of words between white space, each tokenised once while it is kept.

    The tokenizer splits at white space first, so the ids of a text are those of its
    words in turn; most words are letters with marks after them, and these parts are
    kept too. All are known by 64-bit hash and kept per worker, up to a fixed number.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        """Entry 0 is the end of a document, entry 1 is empty."""
        self.words, self.parts = Table(), Table()
        self.near, self.near_entry = np.zeros(1 << NEAR_BITS, np.uint64), np.ones(1 << NEAR_BITS, np.int32)
        self.ids = Growing([END_ID], np.uint32)
        self.start, self.size = Growing([0, 1], np.int64), Growing([1, 0], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers for parts that the tokenizer never splits further: many at
        a time, cut after the ids that end a word."""
        ids, sizes = [], []
        for k in range(0, len(parts), 4096):
            some = parts[k : k + 4096]
            own = self.encode([" ".join(some)])
            size = np.diff(np.flatnonzero(self.is_end[own[0]]), prepend=-1)
            if len(size) != len(some) or size.sum() != len(own[0]):
                own = self.encode(some)
                size = np.fromiter(map(len, own), np.int64, len(own))
            ids += own
            sizes.append(size)
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate(sizes) if sizes else np.zeros(0, np.int64)

    def append(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        first = self.start.size
        self.start.add(self.ids.size + np.cumsum(size) - size)
        self.size.add(size)
        self.ids.add(ids)
        return first + np.arange(len(size))

    def entries_of_parts(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each part of ``raw``; the parts hold no white space."""
        hashed = words.hashes(raw, words.Words(start, end, start))
        distinct, where, back = np.unique(hashed, return_index=True, return_inverse=True)
        new = self.parts.missing(distinct)
        if new.any():
            own, at = raw.tobytes(), where[new]
            parts = [own[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist())]
            self.parts.add(distinct[new], self.append(*self.encode_parts(parts)))
        return self.parts.of(distinct)[back]

    def entries_of_pairs(self, raw: np.ndarray, start: np.ndarray, cut: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each word of ``raw`` that is letters up to ``cut`` and marks, if any, from there."""
        marked = np.flatnonzero(cut < end)
        found = self.entries_of_parts(raw, np.append(start, cut[marked]), np.append(cut, end[marked]))
        entry = found[: len(start)].copy()
        both = np.stack([entry[marked], found[len(start) :]], 1)
        size = self.size.held[both]
        entry[marked] = self.append(self.ids.held[ragged(self.start.held[both].ravel(), size.ravel())], size.sum(1))
        return entry

    def learn(self, hashed: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """New entries for words, given in order of their hashes."""
        size = end - start
        raw = data[ragged(start, size)]
        start = np.cumsum(size) - size
        kind = kinds(raw)
        letters = np.add.reduceat(kind == 0, start, dtype=np.int64)
        place = np.arange(len(raw)) - np.repeat(start, size)
        ahead = np.minimum.reduceat(np.where(kind == 0, len(raw), place), start)
        simple = (np.maximum.reduceat(kind, start) < 2) & (letters > 0) & (np.minimum(ahead, size) == letters)
        entry = np.zeros(len(size), np.int64)
        at = np.flatnonzero(simple)
        if len(at):
            entry[at] = self.entries_of_pairs(words.FOLDED_BYTES[raw], start[at], start[at] + letters[at], start[at] + size[at])
        left = np.flatnonzero(~simple)
        own = raw.tobytes()
        whole = [(k, own[a:b].decode("utf-8", "replace")) for k, a, b in zip(
            left.tolist(), start[left].tolist(), (start[left] + size[left]).tolist())]
        if whole:
            ids = self.encode([t for _, t in whole])
            entry[[k for k, _ in whole]] = self.append(np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
        self.words.add(hashed, entry)

    def entries(self, data: np.ndarray, found: words.Words, hashed: np.ndarray) -> np.ndarray:
        """The entry of each word: most are near, the others are sorted and looked up or learnt."""
        slot = (hashed >> np.uint64(64 - NEAR_BITS)).view(np.int64)
        entry = self.near_entry.take(slot).astype(np.int64)
        far = np.flatnonzero(self.near.take(slot) != hashed)
        distinct, where, back = np.unique(hashed[far], return_index=True, return_inverse=True)
        if len(self.words.known) + len(distinct) > CACHED_WORDS:
            self.clear()
            far = np.arange(len(hashed))
            distinct, where, back = np.unique(hashed, return_index=True, return_inverse=True)
        new = self.words.missing(distinct)
        if new.any():
            at = far[where[new]]
            self.learn(distinct[new], data, found.start[at], found.end[at])
        own = self.words.of(distinct)
        entry[far] = own[back]
        slot = (distinct >> np.uint64(64 - NEAR_BITS)).view(np.int64)
        # Of words with one slot the last is kept, in both arrays.
        last = np.append(slot[1:] != slot[:-1], True) if len(slot) else np.zeros(0, bool)
        self.near[slot[last]], self.near_entry[slot[last]] = distinct[last], own[last]
        return entry

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number for each, the end included."""
        found = words.find(data, offsets)
        hashed = words.hashes(data, found)
        entry = self.entries(data, found, hashed)
        entry = np.insert(entry, found.first[1:], 0)
        size = self.size.held[entry]
        ends = found.first[1:] + np.arange(len(offsets) - 1)
        return self.ids.held[ragged(self.start.held[entry], size)], np.diff(np.cumsum(size)[ends], prepend=0)


KEPT: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in KEPT:
        KEPT[path] = WordIds(path)
    return KEPT[path]


def chunks_of(batches, path: str):
    """The documents of each chunk in turn: their ids, how many tokens each has, and all of these. A chunk goes on over
    batches, so batches may be small."""
    held, total = [], 0

    def joined():
        doc_ids, counts, ids = zip(*held)
        held.clear()
        return sum(doc_ids, []), np.concatenate(counts), np.concatenate(ids)

    for batch in batches:
        data, offsets = steps.text_buffers(batch.column(1))
        for first, last in steps.pieces(offsets, PIECE_BYTES):
            size = int(offsets[last] - offsets[first])
            if held and total + size > CHUNK_BYTES:
                yield joined()
                total = 0
            ids, counts = word_ids(path).texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            held.append((batch.column(0).slice(first, last - first).to_pylist(), counts, ids))
            total += size
    if held:
        yield joined()


def encoder(path: str):
    def encode(batches):
        part = TaskContext.get().partitionId()
        steps.OnWorker.forget()
        for chunk, (doc_ids, counts, ids) in enumerate(chunks_of(batches, path)):
            steps.give_back()
            table, coded = range_coder.encode(ids)
            blocks = [
                {"n_tokens": int(n), "crc32": zlib.crc32(block), "data": block}
                for n, block in zip(range_coder.sizes(len(ids)), coded, strict=True)
            ]
            row = {
                "part": part, "chunk": chunk, "doc_ids": doc_ids, "counts": counts.tolist(), "n_tokens": len(ids),
                "frequencies": table, "blocks": blocks,
            }
            yield pa.RecordBatch.from_pylist([row], schema=ARROW_FORMAT)
        steps.give_back()

    return encode


def write(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Write the ids of ``docs`` (doc_id, text) to a new folder."""
    spark = docs.sparkSession
    steps.ship(spark)
    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    with steps.freed_shuffles(spark), steps.small_batches(spark):
        ordered.mapInArrow(encoder(tokenizer), FORMAT).write.parquet(folder)


def chunk_ids(frequencies: bytes, blocks: list[dict], n_tokens: int) -> np.ndarray:
    """The ids of a chunk, every block checked."""
    for block in blocks:
        if zlib.crc32(block["data"]) != block["crc32"]:
            raise ValueError("a block does not match its checksum")
    return range_coder.decode(frequencies, [b["data"] for b in blocks], n_tokens)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: doc_id, ids, and their place (part, chunk, offset)."""
    kind = "doc_id bigint, part int, chunk int, offset bigint, ids array<int>"
    return decoded(spark, folder, "ids", kind, lambda ids, ends: pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))


def decoded(spark: SparkSession, folder: str, name: str, kind: str, column) -> DataFrame:
    """One row per document, with ``column`` made from the ids of a chunk and where its
    documents end."""
    steps.ship(spark)

    def documents(batches):
        # What writing has kept is no longer used.
        KEPT.clear()
        steps.OnWorker.forget()
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = chunk_ids(row["frequencies"], row["blocks"], row["n_tokens"])
                ends = np.cumsum([0, *row["counts"]])
                many = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(np.full(many, row["part"]), pa.int32()),
                    pa.array(np.full(many, row["chunk"]), pa.int32()), pa.array(ends[:-1], pa.int64()), column(ids, ends),
                ], names=["doc_id", "part", "chunk", "offset", name])

    return chunks(spark, folder).mapInArrow(documents, kind)


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FORMAT).parquet(folder)


def chunk_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each chunk: sums within a part, and of the parts before it."""
    sizes = chunks(spark, folder).select("part", "chunk", "n_tokens")
    earlier = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = sizes.select("part", "chunk", earlier.alias("within"))
    return within.join(parts.select("part", before.alias("before")), "part").select(
        "part", "chunk", (F.col("before") + F.col("within")).alias("chunk_start"))


def digests(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    raw = ids.astype("<u4")
    sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
    return pa.StructArray.from_arrays([pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())], ["n_tokens", "crc32"])


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document as read from the files: doc_id, start, n_tokens, ids_crc32."""
    kind = "doc_id bigint, part int, chunk int, offset bigint, own struct<n_tokens:bigint,crc32:bigint>"
    slim = decoded(spark, folder, "own", kind, digests)
    return slim.join(chunk_starts(spark, folder), ["part", "chunk"]).select(
        "doc_id", (F.col("chunk_start") + F.col("offset")).alias("start"), F.col("own.n_tokens").alias("n_tokens"),
        F.col("own.crc32").alias("ids_crc32"))


def documents_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a folder of the shared one and list them from there."""
    folder = steps.shared_folder(docs.sparkSession)
    write(docs, folder, tokenizer)
    return listing(docs.sparkSession, folder)
