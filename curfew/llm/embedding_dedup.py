"""Near-duplicate embeddings: signs against random hyperplanes in several tables, exact
cosines, and connected components.

Only vectors of one label and length can be linked. Copies of a vector are one node. A node
has a signature of ``bits`` signs in each of ``tables``; nodes that agree in all bits of a
table share a bucket. ``bits`` grows with the logarithm of the largest label, so that
unrelated vectors rarely share one, and ``tables`` follows: the chance that a pair at the
threshold shares no bucket stays at ``MISS`` or less, at every size.

Every node is compared with the least node of each of its buckets. If the angle is at most
half the angle of the threshold, the least of these nodes is its centre. Two nodes of one
centre are similar for certain and need no comparison, so a group of close copies costs
no more than its rows. All other pairs of a bucket are compared: in blocks of about
``BLOCK`` nodes, every two blocks in a group of their own, and nodes of the centre that
holds most of the bucket meet the others only. A pair counts in the first table that it
shares. Signatures alone rule out nearly all unrelated pairs, by more than ``MOST_SIGMA``
deviations at the threshold; vectors are sent to the groups in which they have a partner
left. No pair is listed: a group gives the links of each node and its least partner.

A vector that is null, empty, zero or holds a null, NaN or infinite component, or whose label
is null, is linked with nothing and is a component of its own. Equal rows are linked
with each other. Null ids are passed over when the least id of a component is taken; a
row is kept if its id is that id, or if both are null. Other columns are not looked at.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from curfew.llm import steps, words
from curfew.llm.near_duplicates import components
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.93
MISS = 1e-4
MOST_SIGMA = 6
#: Unrelated vectors of the largest label in a bucket, on the mean.
LOAD = 2
LEAST_BITS = 8
BLOCK = 512
#: Rows that a worker compares at once, without and with vectors, and pairs of them.
ROWS_AT_ONCE, VECTORS_AT_ONCE, PAIRS_AT_ONCE = 1 << 16, 1 << 13, 1 << 22
ANGLE = math.acos(THRESHOLD)
#: Room for rounding where an angle makes a comparison needless.
SURE = 1e-6
SEED = 20240117


class Planes:
    """Random hyperplanes for each length of vectors, the same on every worker."""

    def __init__(self, data: tuple[int, int]):
        self.bits, self.tables = data
        self.width = -(-self.bits * self.tables // 64)
        self.of_length: dict[int, np.ndarray] = {}

    def signs(self, unit: np.ndarray) -> np.ndarray:
        length = unit.shape[1]
        if length not in self.of_length:
            draw = np.random.Generator(np.random.PCG64([SEED, length]))
            self.of_length[length] = draw.standard_normal((length, self.bits * self.tables))
        return unit @ self.of_length[length] > 0

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        """All signs of each vector, as 64-bit words."""
        signs = np.zeros((len(unit), 64 * self.width), bool)
        signs[:, : self.bits * self.tables] = self.signs(unit)
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64).reshape(len(unit), self.width)

    def codes(self, sketch: np.ndarray) -> np.ndarray:
        """The number of the bucket in each table."""
        out = np.zeros((len(sketch), self.tables), np.uint64)
        for first in range(0, len(sketch), 4096):
            part = np.ascontiguousarray(sketch[first : first + 4096])
            signs = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")[:, : self.bits * self.tables]
            padded = np.zeros((len(part), self.tables, 64), np.uint8)
            padded[:, :, : self.bits] = signs.reshape(len(part), self.tables, self.bits)
            out[first : first + 4096] = np.packbits(padded, axis=2, bitorder="little").view(np.uint64)[:, :, 0]
        return out

    @property
    def most_apart(self) -> int:
        """Signs in which a pair at the threshold differs, with ``MOST_SIGMA`` deviations."""
        share, all_signs = ANGLE / math.pi, self.bits * self.tables
        return int(all_signs * share + MOST_SIGMA * math.sqrt(all_signs * share * (1 - share))) + 1


def layout(largest: int) -> tuple[int, int]:
    """Bits and tables for so many vectors under one label."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, largest) / LOAD)))
    return bits, math.ceil(math.log(MISS) / math.log(1 - (1 - ANGLE / math.pi) ** bits))


def by_length(vectors: pa.Array):
    """Rows and double matrix of the usable vectors of each length, each of length 1."""
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    inner = vectors.flatten()
    value = inner.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for length in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == length)
        matrix = value[start[rows][:, None] + np.arange(length)]
        # Scaled first, so that neither tiny nor huge components are lost.
        top = np.abs(matrix).max(1)
        good = np.isfinite(top) & (top > 0)
        matrix = matrix[good] / top[good][:, None]
        yield rows[good], matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def names(space: pa.Array, vectors: pa.Array) -> pa.Array:
    """A name for each usable vector, the same for copies in one space; else null."""
    start = np.append(0, np.cumsum(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    value = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    within, out = space.to_numpy(zero_copy_only=False), [None] * len(vectors)
    for rows, _ in by_length(vectors):
        for k in rows.tolist():
            out[k] = hashlib.md5(within[k].tobytes() + value[start[k] : start[k + 1]].tobytes()).digest()
    return pa.array(out, pa.binary())


def signer(machine: steps.OnWorker):
    def sign(vectors: pa.Array) -> pa.Array:
        planes = machine.get()
        out = np.zeros((len(vectors), planes.width), np.uint64)
        for rows, unit in by_length(vectors):
            out[rows] = planes.sketches(unit)
        ends = np.arange(0, out.size + 1, planes.width, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel().view(np.int64)))

    return F.arrow_udf(sign, "array<bigint>")


def matrix_of(sketch: pa.Array, width: int) -> np.ndarray:
    return sketch.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, width)


def bucket_keys(machine: steps.OnWorker):
    """From (space, sketch): the key of the bucket of each table."""

    def give(space: pa.Array, sketch: pa.Array) -> pa.Array:
        planes = machine.get()
        code = planes.codes(matrix_of(sketch, planes.width))
        group = words.mix(space.to_numpy().view(np.uint64))
        table = np.arange(1, planes.tables + 1, dtype=np.uint64)
        key = words.mix(words.mix(group[:, None] + code * words.WINDOW_BASE) + table * words.BASE)
        ends = np.arange(0, key.size + 1, planes.tables, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(key.ravel().view(np.int64)))

    return F.arrow_udf(give, "array<bigint>")


def cosine(left: pa.Array, right: pa.Array) -> pa.Array:
    """Cosine in double precision; both sides hold usable vectors of equal length."""
    out = np.zeros(len(left))
    for (rows, x), (_, y) in zip(by_length(left), by_length(right)):
        out[rows] = np.einsum("ij,ij->i", x, y)
    return pa.array(out)


def apart(x: str, y: str, width: int):
    """Signs in which two sketches differ."""
    return sum(F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(width))


GROUP = ["key", "kind", "i", "j"]


def cut(batches, rows: int):
    """Arrow rows that come sorted by ``GROUP``, as chunks of whole groups, of about so many rows at most: the
    chunk, and the first row of each group with its end."""
    rest = None

    def pieces(table, whole):
        columns = [table.column(c).to_numpy() for c in GROUP]
        change = np.zeros(len(table), bool)
        change[:1] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        start = np.append(np.flatnonzero(change), len(table))
        last = len(start) - 1 if whole else len(start) - 2
        first = 0
        cost = np.append(0, np.cumsum(np.diff(start).astype(np.int64) ** 2))
        while first < last:
            to = min(int(np.searchsorted(cost, cost[first] + PAIRS_AT_ONCE, "right")) - 1,
                     int(np.searchsorted(start, start[first] + rows, "right")) - 1, last)
            to = max(to, first + 1)
            yield table.slice(start[first], start[to] - start[first]), start[first : to + 1] - start[first]
            first = to
        return table.slice(start[last])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        if len(rest) >= rows:
            rest = yield from pieces(rest.combine_chunks(), False)
    if rest is not None and len(rest):
        yield from pieces(rest.combine_chunks(), True)


def candidates(table: pa.Table, start: np.ndarray, planes: Planes):
    """Pairs of rows of one group that may be similar and count in it, some at a time."""
    size = np.diff(start)
    end = np.repeat(start[1:], size)
    sketch = matrix_of(table.column("sketch").combine_chunks(), planes.width)
    codes = planes.codes(sketch)
    space, ball, side, number, kind, i, j = (
        table.column(c).to_numpy() for c in ("space", "ball", "side", "number", "kind", "i", "j"))
    crossing = (kind == 1) | (i != j)
    for step in range(1, int(size.max()) if len(size) else 0):
        x = np.flatnonzero(np.arange(len(end)) + step < end)
        y = x + step
        keep = (ball[x] != ball[y]) & ~(crossing[x] & (side[x] == side[y])) & (space[x] == space[y])
        x, y = x[keep], y[keep]
        keep = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64) <= planes.most_apart
        x, y = x[keep], y[keep]
        if len(x):
            same = codes[x] == codes[y]
            keep = same.argmax(1) == number[x]
            yield x[keep], y[keep]


def with_partners(machine: steps.OnWorker):
    """Of each group the rows that have a candidate in it."""

    def give(batches):
        for table, start in cut(batches, ROWS_AT_ONCE):
            hit = np.zeros(len(table), bool)
            for x, y in candidates(table, start, machine.get()):
                hit[x] = hit[y] = True
            if hit.any():
                yield from table.filter(pa.array(hit)).to_batches()

    return give


def linked(machine: steps.OnWorker):
    """Of groups with vectors: for each node the rows linked with it there, and the least node that it
    reaches within the group."""

    def give(batches):
        for table, start in cut(batches, VECTORS_AT_ONCE):
            rows = len(table)
            copies = table.column("copies").to_numpy()
            links, label = np.zeros(rows, np.int64), np.arange(rows)
            # Nodes of a bucket have vectors of one length; groups of a chunk may differ in it.
            unit, place, found = {}, np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for at, matrix in by_length(table.column("vector").combine_chunks()):
                unit[matrix.shape[1]], place[at], found[at] = matrix, np.arange(len(at)), matrix.shape[1]
            pairs = []
            for x, y in candidates(table, start, machine.get()):
                for length, matrix in unit.items():
                    at = found[x] == length
                    a, b = x[at], y[at]
                    similar = np.einsum("ij,ij->i", matrix[place[a]], matrix[place[b]]) >= THRESHOLD
                    a, b = a[similar], b[similar]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    pairs.append((a, b))
            if not links.any():
                continue
            a, b = (np.concatenate(side) for side in zip(*pairs))
            while True:
                before = label.copy()
                least = np.minimum(label[a], label[b])
                np.minimum.at(label, a, least)
                np.minimum.at(label, b, least)
                label = label[label]
                if np.array_equal(label, before):
                    break
            hit = np.flatnonzero(links)
            nodes = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(hit)), pa.array(links[hit]), nodes.take(pa.array(label[hit]))],
                names=["node", "links", "reached"])

    return give


def in_groups(entries: DataFrame) -> DataFrame:
    """Entries of the buckets in which nodes of different centres meet, each once for every
    group of its bucket that it belongs to."""
    held = entries.groupBy("key", "ball").agg(F.count("*").alias("n"))
    held = held.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("balls"), F.max_by("ball", F.struct("n", "ball")).alias("main"),
                                   F.max("n").alias("n_main"))
    small = F.col("n") <= BLOCK
    held = held.filter("balls > 1").select(
        "key", F.when(small, 0).otherwise(F.ceil(F.col("n_main") / BLOCK)).alias("main_blocks"), "main",
        F.when(small, 1).otherwise(F.ceil((F.col("n") - F.col("n_main")) / BLOCK)).alias("blocks"))
    both = entries.join(held, "key")
    in_main = (F.col("ball") == F.col("main")) & (F.col("main_blocks") > 0)
    own = F.pmod(F.xxhash64("node"), F.when(in_main, F.col("main_blocks")).otherwise(F.col("blocks"))).cast("int")
    both = both.withColumn("own", own).withColumn("in_main", in_main)
    every = lambda n: F.sequence(F.lit(0), F.col(n).cast("int") - 1)
    # Kind 0: two blocks of the others, side tells them apart. Kind 1: a block of the main centre and one of the others.
    meets_main = F.transform(every("blocks"), lambda b: F.struct(
        F.lit(1).alias("kind"), F.col("own").alias("i"), b.alias("j"), F.lit(0).alias("side")))
    others = F.transform(every("blocks"), lambda b: F.struct(
        F.lit(0).alias("kind"), F.least(b, "own").alias("i"), F.greatest(b, "own").alias("j"),
        F.when(F.col("own") <= b, 0).otherwise(1).alias("side")))
    from_main = F.when(F.col("main_blocks") > 0, F.transform(every("main_blocks"), lambda b: F.struct(
        F.lit(1).alias("kind"), b.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))).otherwise(F.array())
    groups = F.when(F.col("in_main"), meets_main).otherwise(F.concat(others, from_main))
    names = [c for c in entries.columns if c != "key"]
    return both.select("key", *names, F.explode(groups).alias("g")).select("key", "g.*", *names)


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    steps.ship(spark)
    space = F.xxhash64("label", F.size("embedding"))
    node = F.when(F.col("label").isNotNull(), F.arrow_udf(names, "binary")(space, "embedding"))
    rows = vectors.select("vec_id", node.alias("node"), space.alias("space"), F.col("embedding").alias("vector"))
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("space").alias("space"), F.first("vector").alias("vector"))
    nodes = steps.written(nodes)
    largest = nodes.groupBy("space").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    machine = steps.OnWorker(spark, layout(largest), Planes)
    planes = Planes(layout(largest))
    signed = steps.written(nodes.select("node", "space", signer(machine)("vector").alias("sketch")))

    keys = F.posexplode(bucket_keys(machine)("space", "sketch")).alias("number", "key")
    entries = steps.written(signed.select("node", "space", "sketch", keys))
    least = F.min(F.struct("node", "space", "sketch")).alias("least")
    buckets = entries.groupBy("key").agg(least, F.count("*").alias("n")).filter("n > 1")
    stars = entries.join(buckets.select("key", "least"), "key").filter(
        (F.col("node") != F.col("least.node")) & (F.col("space") == F.col("least.space")))
    stars = stars.select("node", "sketch", F.col("least.node").alias("centre"), F.col("least.sketch").alias("other"))
    stars = stars.filter(apart("sketch", "other", planes.width) <= planes.most_apart).select("centre", "node").distinct()
    ends = nodes.select("node", "vector"), nodes.select(F.col("node").alias("centre"), F.col("vector").alias("other"))
    stars = stars.join(ends[0], "node").join(ends[1], "centre").select(
        "centre", "node", F.arrow_udf(cosine, "double")("vector", "other").alias("c"))
    stars = steps.written(stars.filter(F.col("c") >= THRESHOLD))

    near = stars.filter(F.col("c") >= math.cos(ANGLE / 2 - SURE)).groupBy("node").agg(F.min("centre").alias("centre"))
    balls = signed.join(near, "node", "left").select(
        "node", "space", "sketch", F.least("node", F.coalesce("centre", "node")).alias("ball"))
    balls = steps.written(balls)
    groups = in_groups(balls.select("node", "space", "ball", "sketch", keys))
    schema = "key bigint, kind int, i int, j int, side int, node binary, space bigint, ball binary, number int, sketch array<bigint>"
    ordered = groups.repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
    hits = ordered.select(*[c.split()[0] for c in schema.split(", ")]).mapInArrow(with_partners(machine), schema)
    hits = steps.written(hits)
    exact = hits.join(nodes.select("node", "copies", "vector"), "node")
    exact = exact.repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
    pairs = steps.written(exact.mapInArrow(linked(machine), "node binary, links bigint, reached binary"))

    edges = stars.select(F.col("centre").alias("a"), F.col("node").alias("b")).unionByName(
        pairs.filter("node <> reached").select(F.col("reached").alias("a"), F.col("node").alias("b"))).distinct()
    labels = components(edges)
    sizes = balls.join(nodes.select("node", "first", "copies"), "node")
    in_ball = sizes.groupBy("ball").agg(F.sum("copies").alias("near"))
    crossing = pairs.groupBy("node").agg(F.sum("links").alias("links"))
    known = sizes.join(in_ball, "ball").join(crossing, "node", "left").join(labels, "node", "left")
    known = steps.written(known.select(
        "node", "first", (F.col("near") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("label", "node").alias("component")))
    least = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(least, "component").select("node", "n_links", "component_id")
    alone = rows.filter("node is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = rows.filter("node is not null").select("vec_id", "node").join(known, "node").drop("node").unionByName(alone)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
