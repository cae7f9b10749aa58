"""The trie of conversation prefixes, and what sharing them saves, by an Euler tour.

Each conversation is rebuilt from a shared beginning and turns of its own. A node is a distinct
sequence of the first turns of rebuilt conversations. Its arcs are one that enters it and
one that leaves it; the tour runs through all of them, children in order of their least
conversation. Ranking this list gives the sum of weights from each arc to the end of the tour, and
the difference of a node's two arcs is the sum over its subtree, however deep.

The list is ranked in two steps. Arcs lie in order of the conversation that they belong to,
so most of the tour stays within a chunk: there pointer doubling brings each arc to the
first one outside. Only arcs that a chunk points to from outside are left; these are
ranked by doubling with joins, in as many rounds as the logarithm of their number.

Positions within a conversation, hashes of prefixes and next siblings are running sums and
neighbours in a range order. A key may run through many ranges; what its earlier ranges hold is
added from a table with a few rows for each range. So neither one conversation nor one node
with a third of all rows meets in a task.

Turns of equal number are ordered by the md5 of role and text; repeated rows are turns of their
own. A null turn comes first; a null role or text is empty. Rows of a null conv_id are no
conversation and are passed over. Other columns are not looked at. No conversations, no nodes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from curfew.llm import steps
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Conversations of a block share the beginning of its first one, of less than ``MOST_SHARED`` turns.
BLOCK, MOST_SHARED = 100, 6
LANES = [f"s{k}" for k in range(4)]
#: Arcs that a worker chains at once.
CHUNK = 1 << 20


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """The rows dealt by ranges of ``order`` and written, with ``part``, the number of the range."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return steps.written(rows.repartitionByRange(count, *order).withColumn("part", F.spark_partition_id()))


def split_keys(rows: DataFrame, key: str) -> DataFrame:
    """Of rows placed by ``key`` first: the keys that may run through several ranges. A range begins
    with its least key, so these are as many as ranges at most."""
    return rows.groupBy("part").agg(F.min(key).alias(key)).select(key).distinct()


def running(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows``, placed by ``key`` and ``order``, with running sums over each key up to the row itself."""
    own = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", *[F.sum(value).over(own).alias(name) for name, value in sums.items()])
    held = rows.join(split_keys(rows, key), key, "left_semi").groupBy(key, "part").agg(
        *[F.sum(value).alias(f"{name}_before") for name, value in sums.items()])
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(key, "part", *[F.sum(f"{name}_before").over(earlier).alias(f"{name}_before") for name in sums])
    return local.join(held, [key, "part"], "left").select(
        *rows.columns, *[(F.col(name) + F.coalesce(f"{name}_before", F.lit(0))).alias(name) for name in sums])


def shared_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv, i (from 0), digest and n_chars of the turns of rebuilt conversations; and conv and n, their number."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    slim = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", digest.alias("digest"), F.length(text).cast("bigint").alias("n_chars"))
    numbered = running(placed(slim, "conv", "turn", "digest"), "conv", ["turn", "digest"], {"j": F.lit(1).cast("bigint")})
    numbered = steps.written(numbered.select("conv", (F.col("j") - 1).alias("j"), "digest", "n_chars"))
    # Of a block's first conversation only the turns that can be shared are gathered, five at most.
    first = numbered.filter((F.col("conv") % BLOCK == 0) & (F.col("j") < MOST_SHARED - 1)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("j", "digest", "n_chars"))).alias("beginning"))
    convs = numbered.groupBy("conv").agg(F.count("*").alias("own")).withColumn("base", F.col("conv") - F.col("conv") % BLOCK)
    taken = F.slice(F.coalesce("beginning", F.array()), F.lit(1), F.col("h").cast("int"))
    convs = steps.written(convs.withColumn("h", shared_turns(F.col("conv"))).join(first, "base", "left").select(
        "conv", "own", "h", taken.alias("taken"), F.size(taken).cast("bigint").alias("m")))
    begun = convs.select("conv", F.explode("taken").alias("t")).select("conv", F.col("t.j").alias("i"), "t.digest", "t.n_chars")
    rest = numbered.join(convs.select("conv", "h", "m"), "conv").filter("j >= h").select(
        "conv", (F.col("m") + F.col("j") - F.col("h")).alias("i"), "digest", "n_chars")
    lengths = convs.select("conv", (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return begun.unionByName(rest), lengths


def lanes(digest: Column, at: Column) -> list[Column]:
    """Four numbers of 32 bits for a turn at a place; their sums name a sequence of turns."""
    mixed = F.md5(F.concat(F.hex(digest), F.lit("@"), at.cast("string")).cast("binary"))
    return [F.conv(F.substring(mixed, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def name_of(depth: Column, *sums: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", *[x.cast("string") for x in (depth, *sums)]).cast("binary")))


def nodes_and_ends(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, conv_id, depth, n_convs, saved) and, for each conversation, the node where it ends."""
    rows, lengths = rebuilt(turns)
    rows = rows.select("*", *[value.alias(f"own_{name}") for name, value in zip(LANES, lanes(F.col("digest"), F.col("i")))])
    rows = running(placed(rows, "conv", "i"), "conv", ["i"], {name: F.col(f"own_{name}") for name in LANES})
    depth = F.col("i") + 1
    parent = name_of(F.col("i"), *[F.col(s) - F.col(f"own_{s}") for s in LANES])
    rows = steps.written(rows.select(
        "conv", depth.alias("depth"), "n_chars", name_of(depth, *map(F.col, LANES)).alias("node"), parent.alias("parent")))
    root = name_of(F.lit(0), *[F.lit(0)] * len(LANES))
    saved = (F.count("*") - 1) * F.min("n_chars")
    inner = rows.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"), saved.alias("saved"))
    top = lengths.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("bigint").alias("depth"),
        "n_convs", F.lit(0).cast("bigint").alias("saved"))
    last = rows.join(lengths, (rows["conv"] == lengths["conv"]) & (rows["depth"] == lengths["n"])).select(rows["conv"], "node")
    turnless = lengths.filter("n = 0").select("conv", root.alias("node"))
    return inner.unionByName(top), last.unionByName(turnless)


def streamed_digests(batches):
    """From (node, part, ids) in order: the digest of each node's joined ids, in bounded memory."""
    node, hasher = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != node:
                if node is not None:
                    done.append((node, hasher.hexdigest()))
                node, hasher = own, hashlib.sha256(ids.encode())
            else:
                hasher.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([hasher.hexdigest()])], names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes where conversations end. A range's ids are joined by the range; only
    those of nodes in several ranges are hashed in turn."""
    rows = placed(ends, "node", "conv")
    joined = steps.written(rows.groupBy("node", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))
    several = split_keys(rows, "node")
    whole = joined.join(several, "node", "left_anti").select("node", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    dealt = joined.join(several, "node", "left_semi").repartition("node").sortWithinPartitions("node", "part")
    return whole.unionByName(dealt.select("node", "part", "ids").mapInArrow(streamed_digests, "node binary, ends_sha256 string"))


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs: arc, next (null at the end), leaves and saved (weights). A node of number k, from
    ``nodes`` (number, node, parent, conv_id, saved), has the arcs 2k and 2k + 1."""
    order = ["conv_id", "node"]
    siblings = placed(nodes.filter("parent is not null").select("parent", "number", *order), "parent", *order)
    own = Window.partitionBy("parent", "part").orderBy(*order)
    beside = siblings.select("parent", "part", "number", F.lead("number").over(own).alias("beside"))
    # The last child of a range is followed by the first one that a later range holds.
    firsts = siblings.join(split_keys(siblings, "parent"), "parent", "left_semi").groupBy("parent", "part").agg(
        F.min_by("number", F.struct(*order)).alias("number"))
    later = firsts.select("parent", "part", F.lead("number").over(Window.partitionBy("parent").orderBy("part")).alias("later"))
    beside = beside.join(later, ["parent", "part"], "left").select("number", F.coalesce("beside", "later").alias("beside"))
    children = siblings.groupBy("parent").agg(F.min_by("number", F.struct(*order)).alias("child"))
    up = nodes.select(F.col("node").alias("parent"), F.col("number").alias("up"))
    known = nodes.select("number", "node", "parent", "saved").join(beside, "number", "left").join(up, "parent", "left").join(
        children.withColumnRenamed("parent", "node"), "node", "left")
    enter, leave = F.col("number") * 2, F.col("number") * 2 + 1
    zero = F.lit(0).cast("bigint")
    arcs = F.array(
        F.struct(enter.alias("arc"), F.coalesce(F.col("child") * 2, leave).alias("next"),
                 F.col("child").isNull().cast("bigint").alias("leaves"), F.col("saved").alias("saved")),
        F.struct(leave.alias("arc"), F.coalesce(F.col("beside") * 2, F.col("up") * 2 + 1).alias("next"),
                 zero.alias("leaves"), zero.alias("saved")))
    return known.select(F.explode(arcs).alias("a")).select("a.*")


def chained(batches):
    """Arcs in chunks: each with the first arc outside its chunk that the list leads to, and the weights before that."""
    held, size = [], 0

    def chain():
        table = pa.Table.from_batches(held).combine_chunks().sort_by("arc")
        arc, leaves, saved = (table.column(c).to_numpy() for c in ("arc", "leaves", "saved"))
        following = table.column("next").fill_null(-1).to_numpy()
        at = np.minimum(np.searchsorted(arc, following), len(arc) - 1)
        inside = arc[at] == following
        # An arc whose next is outside points to itself, with nothing to add.
        pointer = np.where(inside, at, np.arange(len(arc)))
        sums = [np.where(inside, w, 0) for w in (leaves, saved)]
        while True:
            further = pointer[pointer]
            if np.array_equal(further, pointer):
                break
            sums = [s + s[pointer] for s in sums]
            pointer = further
        out = following[pointer]
        return pa.RecordBatch.from_arrays(
            [pa.array(arc), pa.array(out, mask=out < 0), pa.array(sums[0] + leaves[pointer]), pa.array(sums[1] + saved[pointer])],
            names=["arc", "next", "leaves", "saved"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= CHUNK:
            yield chain()
            held, size = [], 0
    if size:
        yield chain()


WEIGHTS = ["leaves", "saved"]


def ranked(arcs: DataFrame) -> DataFrame:
    """arc, and the weights from it to the end of the list."""
    count = int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = arcs.repartitionByRange(count, "arc").sortWithinPartitions("arc").mapInArrow(
        chained, "arc bigint, next bigint, leaves bigint, saved bigint")
    local = steps.written(local)
    heads = local.filter("next is not null").select(F.col("next").alias("arc")).distinct()
    left = steps.written(local.join(heads, "arc", "left_semi"))
    while not left.filter("next is not null").isEmpty():
        ahead = left.select(F.col("arc").alias("next"), F.col("next").alias("further"), *[F.col(w).alias(f"more_{w}") for w in WEIGHTS])
        left = steps.written(left.join(ahead, "next", "left").select(
            "arc", F.col("further").alias("next"), *[(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in WEIGHTS]))
    ahead = left.select(F.col("arc").alias("next"), *[F.col(w).alias(f"more_{w}") for w in WEIGHTS])
    return local.join(ahead, "next", "left").select(
        "arc", *[(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in WEIGHTS])


def report(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark: SparkSession = turns.sparkSession
    steps.ship(spark)
    found, ends = nodes_and_ends(turns)
    # Numbers in the order of conversations, so that a tour seldom leaves a chunk.
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = steps.written(found.repartitionByRange(count, "conv_id", "depth").sortWithinPartitions("conv_id", "depth").withColumn(
        "number", F.monotonically_increasing_id()))
    sums = ranked(steps.written(tour(nodes)))
    side = F.when(F.col("arc") % 2 == 0, 1).otherwise(-1)
    subtrees = sums.groupBy(F.floor(F.col("arc") / 2).alias("number")).agg(*[F.sum(F.col(w) * side).alias(f"all_{w}") for w in WEIGHTS])
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(subtrees, "number").join(children, "node", "left").join(end_digests(ends), "node", "left").join(
        above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("all_leaves").alias("n_leaves"), F.col("all_saved").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"))
