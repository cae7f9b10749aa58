"""Removal of lines that resemble an earlier line: an exact set-similarity join.

A line is the text between two line feeds, as the set of its words; lines are in order
of doc_id, then of their place. A line goes if the Jaccard similarity with any line
before it, removed or not, is ``THRESHOLD`` or more. Lines without words stay.

Documents are put in order and each is given the numbers of its lines, from ``base`` on, so
a line is one number from there on. Lines with equal sets are one node, known by its first
line; all later ones go. The
words of a set are ordered by the number of lines that hold them (its 20 leading bits), which the step that first
finds them counts, rarest first, then by hash: the ``COMMON_WORDS`` or fewer most frequent ones are told to the workers with their
counts, all others that are in several lines by 2 ** ``SLOT_BITS`` counters, where words
of one counter count together. Any order that is the same for all lines is right; a word
whose counter is 0 is in one node. Two similar sets share a word among their first ``size - least overlap
+ 1``. These prefixes, without the words of one line, are joined on the word under a
length filter, a positional filter, and a filter by a 64-bit map of the words, all of
which only drop pairs that cannot be similar. In the map each word flips a bit, so two
maps differ in no more bits than the sets in words, however long they are. What is left
is verified by the words themselves.

A line has only to find one earlier match. So it is first compared with the ``FEW``
earliest lines that pass the filters for each of its words, and of the pairs found the
one that shares most is verified first. Only lines without a match that have more of
them go on to all in the lists of those words, whose members come with the pairs: a large
group of alike lines makes few pairs. Entries are moved as arrays, packed as bytes, one row for a bucket of
words and blocks, and sorted where the bucket is read. The list of a word in over ``BLOCK`` nodes is dealt into blocks, so no task holds
it whole; a line of such a word that finds no match in its blocks goes on to all as well.

A null text has one line without words. Rows with a null doc_id come first; rows with
equal ids are ordered by a hash of their text. Rows that are equal in both are one
document and judged alike.
"""

import numpy as np
import pyarrow as pa
from curfew.llm import steps, words
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Similar means 4/5 or more; kept as integers so that no bound is rounded.
UP, DOWN = 4, 5
THRESHOLD = UP / DOWN
COMMON_WORDS = 1 << 19
SLOT_BITS, SLOT_BLOCK_BITS = 23, 12
BLOCK = 1 << 16
#: A number is that of a task, then so many bits for a line of its documents.
NUMBER_BITS = 40
COUNTED = 1 << 22
#: Entries that a task gathers before it sends them by bucket, and that it reads of whole buckets at least.
SENT, JOINED = 1 << 19, 1 << 18
#: How many earlier lines are tried for a line and word before all.
FEW = 2
#: Lists of ``SMALL`` members give all their pairs, those of ``STEPS`` are compared in step, longer ones one by one.
SMALL, STEPS, CELLS = 16, 128, 1 << 18

FOUND_SETS_SQL = ("doc_id bigint, own bigint, line binary, set binary, again binary, size binary, bucket bigint, word binary, "
                  "n binary")
FOUND_SETS = pa.schema([
    ("doc_id", pa.int64()), ("own", pa.int64()), *((c, pa.binary()) for c in ("line", "set", "again", "size")),
    ("bucket", pa.int64()), ("word", pa.binary()), ("n", pa.binary()),
])
NUMBERED_SQL = "doc_id bigint, own bigint, base bigint, line binary, set binary, again binary, size binary"


def packed(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """Arrays of numbers as bytes, which Spark copies whole: the values between each end and the next."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of such a column, and how many each row has."""
    raw, ends = steps.text_buffers(column)
    values = raw.view(kind)
    return values, np.diff(ends) // values.itemsize


def line_words(texts: pa.Array):
    """The distinct words of each line, a few rows at a time: row, line and word hash,
    sorted by row, line and hash; with the number of lines of each row."""
    data, offsets = steps.text_buffers(texts)
    for first, last in steps.pieces(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        found = words.find(part, cuts)
        hashed = words.hashes(part, found)
        feeds = np.flatnonzero(part == 10)
        in_row = np.searchsorted(feeds, cuts)
        row = found.row
        line = np.searchsorted(feeds, found.start) - in_row[row]
        place = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (line[1:] != line[:-1]))) if len(row) else row
        number = np.repeat(np.arange(len(place)), np.diff(np.append(place, len(row))))
        order = np.argsort((number.astype(np.uint64) << np.uint64(40)) | (hashed >> np.uint64(24)))
        row, line, hashed = row[order], line[order], hashed[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1]) | (hashed[1:] != hashed[:-1])
        yield first, row[new], line[new], hashed[new]


def groups(row: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Where each line begins."""
    if not len(row):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])))


def line_sets(bits: int):
    """From (doc_id, own, text): each document with words, its lines by two hashes of their sets; and rows by bucket that
    say in how many lines each word is, summed over about ``COUNTED`` words at a time. Lines too short to resemble another
    are not counted."""

    def counted(found):
        word, count = np.unique(np.concatenate(found), return_counts=True)
        rows = dealt(bits, word, word=word.view(np.int64), n=count.astype(np.int32))
        none = [pa.nulls(len(rows), f.type) for f in list(FOUND_SETS)[:6]]
        return pa.RecordBatch.from_arrays([*none, *rows.columns], schema=FOUND_SETS)

    def give(batches):
        found, total = [], 0
        for batch in batches:
            for first, row, line, hashed in line_words(batch.column(2)):
                start = groups(row, line)
                if not len(start):
                    continue
                size = np.diff(np.append(start, len(row))).astype(np.int32)
                found.append(hashed[np.repeat(size >= UP, size)])
                total += len(found[-1])
                one = np.add.reduceat(hashed, start).view(np.int64)
                two = np.add.reduceat(words.mix(hashed ^ words.BASE), start).view(np.int64)
                row = row[start]
                cut = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                ends, take = np.append(cut, len(row)), pa.array(first + row[cut])
                lists = [packed(ends, c) for c in (line[start].astype(np.int32), one, two, size)]
                none = [pa.nulls(len(cut), f.type) for f in list(FOUND_SETS)[6:]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), batch.column(1).take(take), *lists, *none], schema=FOUND_SETS)
                if total >= COUNTED:
                    yield counted(found)
                    found, total = [], 0
        if total:
            yield counted(found)

    return give


SET_KINDS = (np.int64, np.int64, np.int32)


def numbered(batches):
    """From documents in order: each with its first number, ``base``. A repeated document is left out."""
    following, before = TaskContext.get().partitionId() << NUMBER_BITS, None
    for batch in batches:
        if not len(batch):
            continue
        key = [batch.column(k).fill_null(0).to_numpy() for k in (0, 1)] + [batch.column(0).is_null().to_numpy(zero_copy_only=False)]
        new = np.append(before != tuple(c[0] for c in key), np.any([c[1:] != c[:-1] for c in key], 0))
        before = tuple(c[-1] for c in key)
        batch = batch.filter(pa.array(new))
        line, many = unpacked(batch.column(2), np.int32)
        lines = line[np.cumsum(many) - 1].astype(np.int64) + 1
        base = following + np.cumsum(lines) - lines
        following += int(lines.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(base), *batch.columns[2:]], names=[
            "doc_id", "own", "base", "line", "set", "again", "size"])


def single_sets(batches):
    """From (base, line, set, again, size) of documents: one row per line."""
    for batch in batches:
        line, many = unpacked(batch.column(1), np.int32)
        base = np.repeat(batch.column(0).to_numpy(), many)
        sets = [pa.array(unpacked(c, kind)[0]) for c, kind in zip(batch.columns[2:], SET_KINDS)]
        yield pa.RecordBatch.from_arrays([pa.array(base + line), pa.array(base), *sets], names=["number", "base", "set", "again", "size"])


SINGLE_SQL = "number bigint, base bigint, set bigint, again bigint, size int"


def by_document(batches):
    """From (base, number) in order: one row for each document, with its numbers."""

    def rows(base, number):
        cut = np.flatnonzero(np.append(True, base[1:] != base[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(base[cut]), packed(np.append(cut, len(base)), number)], names=["base", "numbers"])

    held = []
    for batch in batches:
        if len(batch):
            base, number = (c.to_numpy() for c in batch.columns)
            if held and base[-1] != held[0][0][0]:
                base, number = (np.concatenate([*c]) for c in zip(*held, (base, number)))
                held = []
            # The last document may go on in the next batch.
            last = 0 if held else int(np.searchsorted(base, base[-1]))
            if last:
                yield rows(base[:last], number[:last])
            held.append((base[last:].copy(), number[last:].copy()))
    if held:
        yield rows(*(np.concatenate(c) for c in zip(*held)))


def numbers_by_document(nodes: DataFrame) -> DataFrame:
    rows = nodes.select("base", "number").repartition("base").sortWithinPartitions("base", "number")
    return rows.mapInArrow(by_document, "base bigint, numbers binary")


def lines_gone(batches):
    """From (doc_id, own, base, line, numbers): the lines of each document that are not among the numbers to keep."""
    for batch in batches:
        line, many = unpacked(batch.column(3), np.int32)
        stays = np.isin(np.repeat(batch.column(2).to_numpy(), many) + line, unpacked(batch.column(4), np.int64)[0])
        doc = np.repeat(np.arange(len(many)), many)[~stays]
        cut = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else doc
        take = pa.array(doc[cut])
        gone = pa.ListArray.from_arrays(pa.array(np.append(cut, len(doc)).astype(np.int32)), pa.array(line[~stays]))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), gone], names=["doc_id", "own", "gone"])


HELD_SQL = "numbers binary, text string"


def node_texts(batches):
    """From (text, base, numbers): the numbers of a document's nodes, and their lines as one text."""
    for batch in batches:
        out = []
        flat, many = unpacked(batch.column(2), np.int64)
        flat, ends = (flat - np.repeat(batch.column(1).to_numpy(), many)).tolist(), np.cumsum(many).tolist()
        for text, end, count in zip(batch.column(0).to_pylist(), ends, many.tolist(), strict=True):
            own, lines = text.split("\n"), flat[end - count : end]
            out.append("\n".join([own[k] for k in lines]) if len(lines) < len(own) else text)
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.string())], names=["numbers", "text"])


def numbered_words(numbers: pa.Array, texts: pa.Array):
    """Of the rows of ``node_texts``, a few at a time: the distinct words of each node by
    hash, where each node begins, its number, and the rows read."""
    flat, many = unpacked(numbers, np.int64)
    cut = np.append(0, np.cumsum(many))
    for first, row, line, hashed in line_words(texts):
        start = groups(row, line)
        if len(start):
            yield hashed, start, flat[cut[first + row[start]] + line[start]], slice(first, first + row[-1] + 1)


def dealt(bits: int, key: np.ndarray, /, **columns: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket, the first ``bits`` of a key, with arrays of its entries: Spark moves a few long rows."""
    bucket = key >> np.uint64(64 - bits)
    order = np.argsort(bucket)
    bucket = bucket[order].view(np.int64)
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(start, len(bucket))
    lists = [packed(ends, c[order]) for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(bucket[start]), *lists], names=["bucket", *columns])


def whole_buckets(batches, kinds):
    """From rows of ``dealt`` sorted by bucket: the arrays of some whole buckets, about ``JOINED`` entries at a time."""
    held, many, last = [], 0, None

    def joined():
        return [np.concatenate([part[k] for part in held]) for k in range(len(held[0]))]

    for batch in batches:
        bucket = batch.column(0).to_numpy()
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for first, end in zip(start, np.append(start[1:], len(bucket)) if len(start) else []):
            if many >= JOINED and bucket[first] != last:
                yield joined()
                held, many = [], 0
            part = batch.slice(int(first), int(end - first))
            # Copies, so that a batch is not held for a few of its entries.
            held.append([unpacked(c, kind)[0].copy() for c, kind in zip(part.columns[1:], kinds)])
            many, last = many + len(held[-1][0]), bucket[first]
    if many:
        yield joined()


def summed_counts(batches):
    """From rows of counts sorted by bucket: the words that are in several lines, with their counts."""
    for word, n in whole_buckets(batches, (np.int64, np.int32)):
        order = np.argsort(word)
        word, n = word[order], n[order].astype(np.int64)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        total = np.add.reduceat(n, start)
        yield pa.RecordBatch.from_arrays([pa.array(word[start][total > 1]), pa.array(total[total > 1])], names=["word", "n"])


def by_hash(data):
    """The places of common words, the number of lines that hold each, and the counters of the others."""
    word = data[0].view(np.uint64)
    order = np.argsort(word)
    return steps.Places(word[order]), data[1][order], data[2]


def node_counts(hashed: np.ndarray, known: steps.Places, count: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The count of each word where it is known, else its counter; 1 for the words of one line."""
    at = known.of(hashed)
    out = count.take(at) if len(count) else np.ones(len(at), np.int64)
    other = np.flatnonzero(at < 0)
    out[other] = steps.counted(hashed[other], slots)
    return out


def by_rarity(group: np.ndarray, n: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """The order of the words of each line, which lie together: by count, then by hash. The 20 leading bits of a count
    decide, those of a float, which are exact up to 65,536; the rest of a hash only where its first bits are equal."""
    leading = (n.astype(np.float32).view(np.uint32) - np.float32(1).view(np.uint32)) >> np.uint32(8)
    if len(group) and group[-1] >= 1 << 24:
        return np.lexsort((hashed, leading, group))
    key = (group.astype(np.uint64) << np.uint64(40)) | (leading.astype(np.uint64) << np.uint64(20)) | (hashed >> np.uint64(44))
    order = np.argsort(key)
    key = key[order]
    tied = key[1:][key[1:] == key[:-1]] >> np.uint64(40)
    if len(tied):
        at = np.flatnonzero(np.isin(group, tied.view(np.int64)))
        order[at] = at[np.lexsort((hashed[at], leading[at], group[at]))]
    return order


def in_buckets(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def with_counts(counts: DataFrame) -> steps.OnWorker:
    """For the workers: the common words with their counts, and counters of the others in several lines; ``counts`` has them by
    bucket."""
    spark = counts.sparkSession
    with steps.small_batches(spark):
        counts = steps.written(in_buckets(counts).mapInArrow(summed_counts, "word bigint, n bigint"))
    by_size = counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()
    least, total = 2, sum(r["count"] for r in by_size)
    for r in sorted(by_size, key=lambda r: r["bits"]):
        if total <= COMMON_WORDS:
            break
        least, total = 1 << r["bits"], total - r["count"]
    common = counts.filter(F.col("n") >= least).toArrow()
    slots = np.zeros(0, np.uint32)
    if least > 2:
        slots = steps.counters(counts.filter(F.col("n") < least), SLOT_BITS, SLOT_BLOCK_BITS)
    steps.freed(counts)
    return steps.OnWorker(spark, (*(common.column(c).to_numpy() for c in ("word", "n")), slots), by_hash)


def least_overlap(size: np.ndarray) -> np.ndarray:
    """Words that a set of this size shares at least with any similar one."""
    return -(-UP * size // DOWN)


def prefixes(machine: steps.OnWorker, bits: int):
    """From (numbers, text): the first words, by rarity, of each node, by bucket of word and block."""

    def rows(found):
        word, block, number, size, pos, bit = (np.concatenate(c) for c in zip(*found))
        key = words.mix(word ^ words.mix(block.astype(np.uint64)))
        return dealt(bits, key, word=word.view(np.int64), block=block, number=number, size=size, pos=pos, bits=bit.view(np.int64))

    def find(batches):
        found, total = [], 0
        for batch in batches:
            for hashed, start, number, _ in numbered_words(batch.column(0), batch.column(1)):
                size = np.diff(np.append(start, len(hashed)))
                n = node_counts(hashed, *machine.get())
                group = np.repeat(np.arange(len(start)), size)
                bit = np.bitwise_xor.reduceat(np.uint64(1) << (hashed >> np.uint64(58)), start)
                order = by_rarity(group, n, hashed)
                pos = np.arange(len(hashed)) - np.repeat(start, size)
                first = np.flatnonzero(pos < np.repeat(size - least_overlap(size) + 1, size))
                order = order[first]
                several = n[order] > 1
                order, pos = order[several], pos[first][several]
                group, hashed, n = group[order], hashed[order], n[order]
                blocks = (n // BLOCK + 1).astype(np.uint64)
                block = (words.mix(number.view(np.uint64))[group] % blocks).astype(np.int32)
                found.append((hashed, np.where(blocks > 1, block, -1).astype(np.int32), number[group],
                              size[group].astype(np.int32), pos.astype(np.int32), bit[group]))
                total += len(hashed)
                if total >= SENT:
                    yield rows(found)
                    found, total = [], 0
        if total:
            yield rows(found)

    return find


#: Blocks are numbered from 0; a word that needs none has -1.
PREFIX_SQL = "bucket bigint, word binary, block binary, number binary, size binary, pos binary, bits binary"
PREFIX_KINDS = (np.int64, np.int32, np.int64, np.int32, np.int32, np.int64)


def bucket_bits(entries: int) -> int:
    """So many buckets that one holds a quarter of a million entries at most, but for chance."""
    return max(12, (entries >> 18).bit_length())


def possible(x: str, y: str) -> Column:
    """Not ruled out by length, position or bits: the words that can be shared are no
    fewer than the least overlap, ``UP / (UP + DOWN)`` of both sizes."""
    a, b = (lambda name: F.col(f"{x}{name}")), (lambda name: F.col(f"{y}{name}"))
    both = a("size") + b("size")
    shorter, longer = F.least(a("size"), b("size")), F.greatest(a("size"), b("size"))
    after = F.least(a("size") - a("pos"), b("size") - b("pos"))
    differ = F.bit_count(a("bits").bitwiseXOR(b("bits")))
    return (
        (shorter * DOWN >= longer * UP)
        & (after * (UP + DOWN) >= both * UP)
        & ((both - differ) * (UP + DOWN) >= both * (2 * UP))
    )


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether two lines are similar, by their words."""
    out = []
    for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
        x, y = set(a.encode().split()), set(b.encode().split())
        shared = len(x & y)
        out.append(shared * DOWN >= (len(x) + len(y) - shared) * UP)
    return pa.array(out, pa.bool_())


def single_lines(wanted: steps.OnWorker):
    """From (numbers, text): the numbers and lines of the nodes that pass a sieve."""

    def give(batches):
        for batch in batches:
            numbers, many = unpacked(batch.column(0), np.int64)
            passes = wanted.get().has(numbers)
            first, lines = np.cumsum(many) - many, []
            some = np.add.reduceat(passes, first, dtype=np.int64) > 0 if len(first) else np.zeros(0, bool)
            for k in np.flatnonzero(some).tolist():
                own = batch.column(1)[k].as_py().split("\n")
                lines += [own[j] for j in np.flatnonzero(passes[first[k] : first[k] + many[k]]).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(numbers[passes]), pa.array(lines, pa.string())], names=["number", "words"])

    return give


def same_document(prefix: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id")) & (F.col("own") == F.col(f"{prefix}own"))


def similar_of(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Of the pairs (x, y) of node numbers, those that are similar by their words."""
    a, b = renamed(lines, "a_"), renamed(lines, "b_")
    both = pairs.join(a, F.col("x") == F.col("a_number")).join(b, F.col("y") == F.col("b_number"))
    similar = F.arrow_udf(overlap, "boolean").asNondeterministic()("a_words", "b_words")
    return both.select("x", similar.alias("similar")).filter("similar").select("x").distinct()


def matched(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the pairs (x, y), the x that are similar to a y. The pair that shares most words
    of the prefixes is verified first, the others only where it fails."""
    pairs = steps.written(pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared")))
    wanted = steps.written(pairs.select(F.explode(F.array("x", "y")).alias("w")).distinct())
    passing = steps.sieve(wanted)
    lines = held.select("numbers", "text").mapInArrow(single_lines(passing), "number bigint, words string")
    lines = steps.written(lines.join(wanted, F.col("number") == F.col("w"), "left_semi").dropDuplicates(["number"]))
    best = steps.written(pairs.groupBy("x").agg(F.max(F.struct("shared", (-F.col("y")).alias("y"))).alias("best"))
                         .select("x", (-F.col("best.y")).alias("y")))
    found = steps.written(similar_of(best, lines))
    left = pairs.join(found, "x", "left_anti").join(best, ["x", "y"], "left_anti")
    rest = steps.written(left.select("x", "y"))
    out = found if rest.isEmpty() else steps.written(found.unionByName(similar_of(rest, lines)))
    steps.freed(pairs, wanted, lines, best, rest, *([found] if out is not found else []))
    passing.free()
    return out


def bits_allow(size: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The filter of ``possible`` by bits for places ``x`` and ``y`` of arrays."""
    differ = np.bitwise_count(bits[x] ^ bits[y]).astype(np.int64)
    both = size[x] + size[y]
    return (both - differ) * (UP + DOWN) >= both * (2 * UP)


def earlier_matches(start: np.ndarray, size: np.ndarray, pos: np.ndarray, bits: np.ndarray):
    """For the members of posting lists, which begin at ``start``: pairs (x, y) of a member
    and an earlier one that it may match, the ``FEW`` earliest for each at most, and the
    members that have more of them.

    The filters by length and position are one bound: ``need`` of the other is ``most`` of
    one at most, both ways. Where they fail the bits are not read."""
    many = np.diff(np.append(start, len(size)))
    kind = np.int32 if not len(size) or size.max() < 1 << 27 else np.int64
    need = (size * UP).astype(kind)
    most = np.minimum(size * DOWN, (size - pos) * (UP + DOWN) - size * UP).astype(kind)
    xs, ys, more = [], [], []
    own = np.repeat(many, many)
    rank = np.arange(len(size)) - np.repeat(start, many)
    at = np.flatnonzero(own <= STEPS)
    for back in range(1, STEPS):
        if not back & (back - 1):
            at = at[own[at] > back]
            if not len(at):
                break
            r, m, n = rank[at], most[at], need[at]
        k = np.flatnonzero((r[back:] >= back) & (m[back:] >= n[:-back]) & (m[:-back] >= n[back:])) + back
        x, y = at[k], at[k - back]
        allowed = bits_allow(size, bits, x, y)
        xs.append(x[allowed])
        ys.append(y[allowed])
    if xs:
        x, y = np.concatenate(xs), np.concatenate(ys)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        nth = np.arange(len(x)) - np.searchsorted(x, x)
        few = (nth < FEW) | (own[x] <= SMALL)
        more.append(x[~few])
        xs, ys = [x[few]], [y[few]]
    for first, count in zip(start[many > STEPS], many[many > STEPS]):
        left, found = np.arange(first + 1, first + count), np.zeros(count, np.int64)
        low, width = first, SMALL
        while low < first + count and len(left):
            high = min(first + count, low + width)
            step = max(1, CELLS // (high - low))
            behind = np.arange(low, high)
            for k in range(0, len(left), step):
                x = left[k : k + step]
                grid = (most[x][:, None] >= need[None, low:high]) & (most[None, low:high] >= need[x][:, None])
                if x[0] < high:
                    grid &= behind[None, :] < x[:, None]
                at, place = np.nonzero(grid)
                allowed = bits_allow(size, bits, x[at], low + place)
                at, place = at[allowed], place[allowed]
                here = np.bincount(at, minlength=len(x))
                before = found[x - first]
                order = np.arange(1, len(at) + 1) - (np.cumsum(here) - here)[at] + before[at]
                found[x - first] = before + here
                more.append(x[before + here > FEW])
                taken = order <= FEW
                xs.append(x[at[taken]])
                ys.append(low + place[taken])
            left = left[(found[left - first] <= FEW) & (left > high)]
            low, width = high, width * 4
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(xs), join(ys), np.unique(join(more))


FOUND = pa.schema([
    ("x", pa.int64()), ("y", pa.int64()), ("word", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()),
    ("bits", pa.int64()), ("asks", pa.bool_()),
])
FOUND_SQL = "x bigint, y bigint, word bigint, size int, pos int, bits bigint, asks boolean"


def candidates(batches):
    """From rows of ``prefixes`` sorted by bucket: pairs (x, y) of nodes that may match. Rows without y are members of
    lists; those that ask may match others of the list than those they are paired with, as all of a list in blocks may.
    Of a list without such members there are no rows, nor of members behind the last of them."""
    for word, block, number, size, pos, bits in whole_buckets(batches, PREFIX_KINDS):
        order = np.lexsort((number, block, word))
        word, block, number = word[order], block[order], number[order]
        # A repeated document brings its entries again, next to each other.
        new = np.append(True, (word[1:] != word[:-1]) | (number[1:] != number[:-1]))
        word, block, number = word[new], block[new], number[new]
        size, pos, bits = (c[order][new] for c in (size, pos, bits))
        start = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (block[1:] != block[:-1])))
        x, y, more = earlier_matches(start, size.astype(np.int64), pos.astype(np.int64), bits.view(np.uint64))
        asks = block >= 0
        asks[more] = True
        at = np.where(asks, np.arange(len(word)), -1)
        last = np.repeat(np.maximum.reduceat(at, start), np.diff(np.append(start, len(word))))
        listed = np.flatnonzero(np.arange(len(word)) <= last)
        none = lambda n, kind: pa.nulls(n, kind)
        yield pa.RecordBatch.from_arrays([
            pa.array(number[x]), pa.array(number[y]), *[none(len(x), f.type) for f in list(FOUND)[2:]]], schema=FOUND)
        yield pa.RecordBatch.from_arrays([
            pa.array(number[listed]), none(len(listed), pa.int64()),
            *[pa.array(c[listed]) for c in (word, size, pos, bits, asks)]], schema=FOUND)


def resembling(held: DataFrame, machine: steps.OnWorker, bits: int) -> DataFrame:
    """The numbers of the nodes that resemble an earlier node, as x."""
    with steps.small_batches(held.sparkSession):
        pairs = steps.written(in_buckets(held.mapInArrow(prefixes(machine, bits), PREFIX_SQL)).mapInArrow(candidates, FOUND_SQL))
    found = matched(held, pairs.filter("y IS NOT NULL").select("x", "y"))
    members = pairs.filter("y IS NULL").select(F.col("x").alias("number"), "word", "size", "pos", "bits", "asks")
    asked = members.filter("asks").join(found, F.col("number") == F.col("x"), "left_anti").drop("asks")
    asked = steps.written(asked)
    if asked.isEmpty():
        steps.freed(pairs, asked)
        return found
    right = renamed(members.drop("asks"), "y_")
    left = renamed(asked, "x_")
    rest = left.join(right, (F.col("x_word") == F.col("y_word")) & (F.col("y_number") < F.col("x_number"))
                     & possible("x_", "y_"))
    later = matched(held, rest.select(F.col("x_number").alias("x"), F.col("y_number").alias("y")))
    steps.freed(asked, pairs)
    return steps.written(found.unionByName(later))


def keep(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, lines in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
        own = (text or "").split("\n")
        drop = set(lines or ())
        kept = "\n".join(line for k, line in enumerate(own) if k not in drop) if drop else text or ""
        out.append({"n_lines": len(own), "n_removed": len(drop), "kept": kept})
    return pa.array(out, pa.struct([("n_lines", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))


def input_bytes(rows: DataFrame) -> int:
    """What Spark takes for the size of the input, a terabyte at most."""
    return min(1 << 40, int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, own (hash of the text) and the places of the lines to remove."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("own"), "text").filter("text IS NOT NULL")
    sets = steps.written(rows.mapInArrow(line_sets(bucket_bits(input_bytes(docs) >> 5)), FOUND_SETS_SQL))
    in_order = sets.filter("bucket IS NULL").drop("bucket", "word", "n").repartitionByRange("doc_id", "own").sortWithinPartitions(
        "doc_id", "own")
    own = steps.written(in_order.mapInArrow(numbered, NUMBERED_SQL))
    machine = with_counts(sets.filter("bucket IS NOT NULL").select("bucket", "word", "n"))
    steps.freed(sets)
    single = own.select("base", "line", "set", "again", "size").mapInArrow(single_sets, SINGLE_SQL)
    # Of one number there is one base.
    nodes = steps.written(single.groupBy("set", "again").agg(
        F.min("number").alias("number"), F.min_by("base", "number").alias("base"), F.min("size").alias("size"))
        .select("number", "base", "size"))
    # A smaller set has no similar one but itself: 4 of 5 words is the least.
    lists = own.select("doc_id", "own", "base").join(numbers_by_document(nodes.filter(F.col("size") >= UP)), "base")
    held = steps.written(
        rows.join(renamed(lists, "w_"), same_document("w_")).select("text", "w_base", "w_numbers").mapInArrow(node_texts, HELD_SQL))
    first_words = F.floor(F.col("size") / DOWN) + 1
    entries = nodes.agg(F.sum(first_words)).first()[0]
    alike = resembling(held, machine, bucket_bits(int(entries or 0)))
    kept = numbers_by_document(nodes.join(alike, F.col("number") == F.col("x"), "left_anti"))
    every = own.select("doc_id", "own", "base", "line").join(kept, "base", "left").select("doc_id", "own", "base", "line", "numbers")
    gone = steps.written(every.mapInArrow(lines_gone, "doc_id bigint, own bigint, gone array<int>"))
    steps.freed(own, nodes, held, alike)
    machine.free()
    return gone


def cleaned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed and the kept lines."""
    steps.ship(docs.sparkSession)
    gone = renamed(removed_lines(docs), "g_")
    rows = docs.select("doc_id", F.xxhash64("text").alias("own"), "text")
    out = F.arrow_udf(keep, "struct<n_lines:bigint,n_removed:bigint,kept:string>").asNondeterministic()
    return rows.join(gone, same_document("g_"), "left").select("doc_id", out("text", "g_gone").alias("k")).select("doc_id", "k.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 for each row of ``docs``."""
    return cleaned(docs).select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
