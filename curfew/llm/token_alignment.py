"""Alignment of the tokens of two tokenizers, and how well each linked pair of ids is
known in the whole corpus.

Tokens of a text are laid out by their bytes. Each token points to the token of the other
side that overlaps it and reaches farthest to the right, or to itself where both end
together (then the token of side A stands for both). Doubling these pointers over all
tokens of a chunk of texts brings each to the terminal token of its component, which
labels its group; a component ends where tokens of both sides end.

All A-B pairs of occurrences in a group are links. A row is tokenised once: its numbers,
the digest of its groups and its distinct linked pairs with their occurrences are written.
From those come the documents per pair of ids, summed over all rows. The workers know the
``COMMON_PAIRS`` or fewer pairs at or above the least power of two of documents that leaves
so few. A pair in one document needs no list. What lies between comes by a join.
The highest count of each A id is an array as long as the vocabulary.

A null or empty text has no tokens, nor has one whose joined token bytes of a side differ
from a space and the text: its numbers are 0 and its digest is ''. Each row counts as a
document of its own, whatever its doc_id. Other columns are not looked at. No rows give no
rows. The pairs of a group are made from its distinct ids, a bounded number at a time, so that a
long text without common token ends takes no more memory.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa
from curfew.llm import steps
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMMON_PAIRS = 1 << 20
#: Pairs that are made at once, and values that a worker folds before it sends counts.
PAIRS_AT_ONCE, FOLDED = 1 << 21, 1 << 22
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 bytes
    are themselves, all others follow from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Side A: ids and token bytes of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        entries = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if all(c in letters for c in token)}
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Where ids follow the order of merges, ranks alone give the same ids.
        if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(merged)):
            raise ValueError(f"{path}: the ids do not follow the order of the merges")
        import public_tokenizers
        import tiktoken

        ranks = {token: i for i, token in entries.items() if i < 256 + len(merged)}
        self.encoding = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [entries.get(i, b"") for i in range(max(model["vocab"].values()) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(text) for text in texts]


class Pieces:
    """Side B: ids and token bytes of a SentencePiece model, which adds the first space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            as_byte = self.model.is_byte(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if as_byte else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Sides:
    """Both tokenizers on a worker, with tables of their ids."""

    def __init__(self, paths: tuple[str, str]):
        self.a, self.b = ByteLevel(paths[0]), Pieces(paths[1])
        self.length = [np.array([len(x) for x in side.bytes]) for side in (self.a, self.b)]
        self.n_b = len(self.b.bytes)
        # An id in decimal with what may follow it.
        self.said = []
        for side, ends in ((self.a, ",|"), (self.b, ",;")):
            table = np.empty(2 * len(side.bytes), object)
            table[:] = [f"{i}{end}" for i in range(len(side.bytes)) for end in ends]
            self.said.append(table)

    def tokens(self, texts: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Of the texts that both sides give back unchanged: their places, ids of A, ids of B."""
        places, left, right = [], [], []
        some = [k for k, text in enumerate(texts) if text]
        chosen = [texts[k] for k in some]
        for k, text, a, b in zip(some, chosen, self.a.encode([" " + t for t in chosen]), self.b.encode(chosen)):
            whole = b" " + text.encode()
            if b"".join(map(self.a.bytes.__getitem__, a)) == whole == b"".join(map(self.b.bytes.__getitem__, b)):
                places.append(k)
                left.append(np.array(a, np.int64))
                right.append(np.array(b, np.int64))
        return places, left, right


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each A token and of each B token, in order, by pointer jumping.
    The last tokens of both must end together."""
    count = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)
    pointer = np.concatenate([
        np.where(b_ends[over] == a_ends, np.arange(count), count + over), np.searchsorted(a_ends, b_ends)])
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    terminal = pointer[:count] == np.arange(count)
    number = np.cumsum(terminal) - 1
    return number[pointer[:count]], number[pointer[count:]]


def ranges(size: np.ndarray) -> np.ndarray:
    """0, 1, .. of each size in turn."""
    after = np.cumsum(size)
    return np.arange(int(after[-1]) if len(after) else 0) - np.repeat(after - size, size)


def folded(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[start], np.add.reduceat(times, start) if len(start) else times


def side_counts(group: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group with their occurrences, and how many a group has."""
    key, times = folded(group * width + ids, np.ones(len(ids), np.int64))
    return key % width, times, np.bincount(key // width, minlength=int(group[-1]) + 1 if len(group) else 0)


def linked(a_group, a, b_group, b, doc, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, pair and links of the distinct linked pairs of each document, in order. ``doc``
    is the document of each group."""
    x, x_times, x_size = side_counts(a_group, a, n_a)
    y, y_times, y_size = side_counts(b_group, b, n_b)
    y_start = np.cumsum(y_size) - y_size
    x_group = np.repeat(np.arange(len(x_size)), x_size)
    fan, width = y_size[x_group], n_a * n_b
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    reach = np.cumsum(fan)
    first = 0
    while first < len(x):
        past = int(reach[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(reach, past + PAIRS_AT_ONCE, "right")))
        size = fan[first:last]
        at = np.repeat(y_start[x_group[first:last]], size) + ranges(size)
        key = np.repeat(doc[x_group[first:last]] * width + x[first:last] * n_b, size) + y[at]
        found = folded(key, np.repeat(x_times[first:last], size) * y_times[at])
        keys, counts = folded(np.append(keys, found[0]), np.append(counts, found[1])) if len(keys) else found
        first = last
    return keys // width, keys % width, counts


def aligned_chunk(sides: Sides, texts: list[str]) -> dict[str, np.ndarray | list]:
    """The columns of ``aligned`` for some texts."""
    rows = len(texts)
    out = {name: np.zeros(rows, np.int64) for name in NUMBERS}
    digests, size = [""] * rows, np.zeros(rows, np.int64)
    places, left, right = sides.tokens(texts)
    if not places:
        return out | {"groups_sha256": digests, "pair": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "size": size}
    at = np.array(places)
    a, b = np.concatenate(left), np.concatenate(right)
    out["n_a"][at], out["n_b"][at] = [len(x) for x in left], [len(x) for x in right]
    a_group, b_group = groups(np.cumsum(sides.length[0][a]), np.cumsum(sides.length[1][b]))
    m, n = np.bincount(a_group), np.bincount(b_group)
    a_doc = np.repeat(np.arange(len(at)), out["n_a"][at])
    doc = a_doc[np.cumsum(m) - 1]
    out["n_groups"][at] = np.bincount(doc, minlength=len(at))
    np.add.at(out["n_links"], at[doc], m * n)
    # Where each token comes when the groups are written one after the other.
    said = np.empty(len(a) + len(b), object)
    a_last, b_last = np.diff(a_group, append=len(m)) != 0, np.diff(b_group, append=len(n)) != 0
    said[np.arange(len(a)) + (np.cumsum(n) - n)[a_group]] = sides.said[0][2 * a + a_last]
    said[np.arange(len(b)) + np.cumsum(m)[b_group]] = sides.said[1][2 * b + b_last]
    end = 0
    for k, count in zip(places, (out["n_a"] + out["n_b"])[at].tolist()):
        digests[k] = hashlib.sha256("".join(said[end : end + count].tolist())[:-1].encode()).hexdigest()
        end += count
    owner, pair, links = linked(a_group, a, b_group, b, doc, len(sides.a.bytes), sides.n_b)
    size[at] = np.bincount(owner, minlength=len(at))
    return out | {"groups_sha256": digests, "pair": pair, "links": links, "size": size}


def aligner(machine: steps.OnWorker, pair_type: pa.DataType):
    def align(batches):
        for batch in batches:
            _, offsets = steps.text_buffers(batch.column(1))
            for first, last in steps.pieces(offsets):
                found = aligned_chunk(machine.get(), batch.column(1).slice(first, last - first).to_pylist())
                ends = pa.array(np.append(0, np.cumsum(found["size"])).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(found[c]).cast(kind))
                         for c, kind in (("pair", pair_type), ("links", pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *[pa.array(found[c]) for c in NUMBERS],
                     pa.array(found["groups_sha256"], pa.string()), *lists],
                    names=["doc_id", *NUMBERS, "groups_sha256", "pairs", "links"])

    return align


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: its number here, doc_id, the four numbers, the digest of its groups, its distinct linked
    pairs (A id times the ids of B, plus B id) and the links of each. Written."""
    spark = docs.sparkSession
    steps.ship(spark)
    sides = Sides((a_path, b_path))
    wide = len(sides.a.bytes) * sides.n_b >= 1 << 31
    machine = steps.OnWorker(spark, (a_path, b_path), Sides)
    kind = "bigint" if wide else "int"
    schema = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              f"pairs array<{kind}>, links array<int>")
    found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        aligner(machine, pa.int64() if wide else pa.int32()), schema)
    return steps.written(found.withColumn("row", F.monotonically_increasing_id()))


def flat(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def counted(batches):
    """Each pair and its rows, folded over many rows."""
    held, size = [], 0

    def fold():
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        held.append(flat(batch.column(0)))
        size += len(held[-1])
        if size >= FOLDED:
            yield fold()
            held, size = [], 0
    if size:
        yield fold()


class Known:
    """Counts of the common pairs, and the highest count of each A id."""

    def __init__(self, data):
        self.pair, self.n, self.best, self.n_b = data

    def of(self, pair: np.ndarray) -> np.ndarray:
        """The counts; 0 for what is not listed."""
        if not len(self.pair):
            return np.zeros(len(pair), np.int64)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        return np.where(self.pair[at] == pair, self.n[at], 0)


def scored(machine: steps.OnWorker, unlisted: int):
    """n_best and count_sum of the listed pairs of a row. Others have the count ``unlisted``."""

    def score(pairs: pa.Array, links: pa.Array) -> pa.Array:
        known, pair, times = machine.get(), flat(pairs), flat(links)
        n = known.of(pair)
        n[n == 0] = unlisted
        best = np.where(n == known.best[pair // known.n_b], times, 0)
        ends = np.append(0, np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False)))
        sums = [np.append(0, np.cumsum(x))[ends] for x in (best, n * times)]
        return pa.StructArray.from_arrays([pa.array(np.diff(x)) for x in sums], ["n_best", "count_sum"])

    return F.arrow_udf(score, "n_best bigint, count_sum bigint")


def unlisted_pairs(machine: steps.OnWorker):
    """From (row, pairs, links): the pairs that the workers do not know, and whether one document is the
    most that their A id has."""

    def give(batches):
        for batch in batches:
            known, pair, times = machine.get(), flat(batch.column(1)), flat(batch.column(2))
            row = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            keep = known.of(pair) == 0
            row, pair, times = row[keep], pair[keep], times[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(pair), pa.array(times), pa.array(known.best[pair // known.n_b] == 1)],
                names=["row", "pair", "times", "single"])

    return give


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    rows = aligned(docs, a_path, b_path)
    sides = Sides((a_path, b_path))
    counts = rows.select("pairs").mapInArrow(counted, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = steps.written(counts.filter("n > 1"))
    sizes = dict(counts.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*")).collect())
    bits = 2
    while sum(n for k, n in sizes.items() if k >= bits) > COMMON_PAIRS:
        bits += 1
    least = 1 << (bits - 1)
    listed = counts.filter(F.col("n") >= least).toArrow().sort_by("pair")
    best = np.ones(len(sides.a.bytes), np.int64)
    highest = counts.groupBy(F.expr(f"pair div {sides.n_b}").alias("a")).agg(F.max("n").alias("n"))
    for a, n in highest.collect():
        best[a] = n
    known = listed["pair"].to_numpy(), listed["n"].to_numpy(), best, sides.n_b
    machine = steps.OnWorker(spark, known, Known)
    some_between = min(sizes, default=bits) < bits
    own = scored(machine, 0 if some_between else 1)("pairs", "links")
    found = rows.select("row", "doc_id", *NUMBERS, own.alias("own"), "groups_sha256")
    sums = {name: F.col(f"own.{name}") for name in ("n_best", "count_sum")}
    if some_between:
        of_a = F.expr(f"pair div {sides.n_b}")
        rest = counts.filter(F.col("n") < least).withColumn("a", of_a).join(highest.withColumnRenamed("n", "most"), "a")
        rest = rest.select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))
        held = rows.select("row", "pairs", "links").mapInArrow(
            unlisted_pairs(machine), "row bigint, pair bigint, times bigint, single boolean").join(rest, "pair", "left")
        more = held.groupBy("row").agg(
            F.sum(F.when(F.coalesce("is_best", "single"), F.col("times")).otherwise(0)).alias("best_more"),
            F.sum(F.col("times") * F.coalesce("n", F.lit(1))).alias("sum_more"))
        found = found.join(more, "row", "left")
        sums = {name: value + F.coalesce(extra, F.lit(0))
                for (name, value), extra in zip(sums.items(), ("best_more", "sum_more"))}
    return found.select("doc_id", *NUMBERS, *[value.alias(name) for name, value in sums.items()], "groups_sha256")
