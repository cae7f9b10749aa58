"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded,
verified by weighted Jaccard similarity.

A shingle is ``SHINGLE`` words (all words of a shorter text), A-Z as a-z. Its weight in
a text is its count there times the mean idf of its words, ``log(1 + N / df)`` over
all documents. The workers know the ``COMMON_WORDS`` or fewer words at or above the least
power of two of documents that leaves so few. A word in one document needs no list. What
lies between comes with the texts that are compared, from a join of their words with the
counted ones; for samples of all texts counters will do, where such words of one slot
count together. They only choose the pairs, and every weight that decides is exact.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per text; two
texts agree in a sample with a chance equal to their weighted Jaccard similarity. Texts
that agree in all rows of a band are candidates. Copies of a whole text are one node
from the start. Every member of a band's bucket is compared with the least one;
links give classes. Then the buckets whose other members are of several classes are opened. What
two of these texts have in common is at most the weight of the shingles that each
shares with any other of them, which rules out most pairs. In each bucket all others
are compared with the text that shares most, and then all pairs that are still of two
classes, but for those whose samples tell them apart: among one bit per sample, more
than ``MOST_BITS`` differ (for similar texts the chance is below 1e-5).
No pair of one class is listed, and no group has a limit.

A null text is empty. A text without words is like no other text but its copies.
The class id is the least doc_id of a class; null ids are passed over, and a class of
null ids has a null id.
"""

import numpy as np
import pyarrow as pa
from curfew.llm import steps, words
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
THRESHOLD = 0.8
#: Sums of equal weights may differ by rounding.
LEAST = THRESHOLD * (1 - 1e-9)
BANDS, ROWS = 14, 4
SAMPLES = BANDS * ROWS
MOST_BITS = 17
COMMON_WORDS = 1 << 20
COUNTED = 1 << 21
SEEN = 1 << 16
TABLE = 1 << 16

NODE = "unhex(md5(coalesce(text, '')))"


def sampling_tables() -> tuple[np.ndarray, ...]:
    """For each of ``TABLE`` places: 1/r, r, beta, and ln c - r, with r and c of
    Gamma(2, 1) and beta uniform, from a fixed seed by inverting uniforms of the mixer."""
    bits = words.mix(np.arange(1, 5 * TABLE + 1, dtype=np.uint64) * words.BASE)
    u = ((bits >> np.uint64(11)).astype(float) + 0.5) / 2**53
    u = u.reshape(5, TABLE)
    r, c = -np.log(u[0] * u[1]), -np.log(u[2] * u[3])
    return tuple(x.astype(np.float32) for x in (1 / r, r, u[4], np.log(c) - r))


INVERSE_R, R, BETA, LOG_C = sampling_tables()
#: Odd multipliers, one for each sample.
SAMPLE_KEYS = words.mix(np.arange(7, 7 + SAMPLES, dtype=np.uint64) * words.WINDOW_BASE) | np.uint64(1)


class Idf:
    """idf of hashed words: of the common ones, of those listed beside texts, and of the
    rest, which are in one document."""

    def __init__(self, data: tuple[np.ndarray, np.ndarray, int, np.ndarray], listed=(np.zeros(0, np.uint64), np.zeros(0)), rough=False, places=None):
        self.data, self.listed, self.is_rough = data, listed, rough
        self.places = places or steps.Places(data[0])

    def rough(self) -> "Idf":
        """With the words that are not common by counters, which words share: for samples."""
        return Idf(self.data, rough=True, places=self.places)

    def beside(self, *columns: tuple[pa.Array, pa.Array]) -> "Idf":
        """With the words and counts of some columns of lists."""
        word, n = (np.concatenate([c[k].flatten().to_numpy(zero_copy_only=False) for c in columns]) for k in (0, 1))
        word, first = np.unique(word.astype(np.int64).view(np.uint64), return_index=True)
        return Idf(self.data, (word, np.log1p(self.data[2] / n[first].astype(float))), places=self.places)

    def of(self, hashed: np.ndarray) -> np.ndarray:
        at = self.places.of(hashed)
        out = self.data[1].take(at) if len(self.data[1]) else np.zeros(len(at))
        other = np.flatnonzero(at < 0)
        rest = hashed[other]
        out[other] = np.log1p(self.data[2] / steps.counted(rest, self.data[3] if self.is_rough else self.data[3][:0]))
        known, value = self.listed
        if len(known):
            at = np.minimum(np.searchsorted(known, rest), len(known) - 1)
            same = known[at] == rest
            out[other[same]] = value[at[same]]
        return out

    def is_common(self, hashed: np.ndarray) -> np.ndarray:
        return self.places.of(hashed) >= 0


def rows_of(texts: pa.Array):
    """Words and their hashes, a few rows at a time."""
    data, offsets = steps.text_buffers(texts)
    for first, last in steps.pieces(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        found = words.find(part, cuts)
        yield first, found, words.hashes(part, found, words.FOLDED_BYTES)


def shingles(found: words.Words, hashed: np.ndarray, idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and weight of the distinct shingles, by row."""
    value = idf.of(hashed)
    rows, keys, weights = [], [], []
    for length in range(1, SHINGLE + 1):
        at, row = words.window_rows(found, length)
        if length < SHINGLE:
            short = found.counts[row] == length
            at, row = at[short], row[short]
        if not len(at):
            continue
        keys.append(words.windows(hashed, length)[at])
        weights.append(sum(value[at + k] for k in range(length)) / length)
        rows.append(row)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    row, key, weight = np.concatenate(rows), np.concatenate(keys), np.concatenate(weights)
    if len(rows) > 1:
        order = np.argsort(row, kind="stable")
        row, key, weight = row[order], key[order], weight[order]
    pair = words.mix(key ^ words.mix(row.astype(np.uint64)))
    ordered = np.sort(pair)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        again = np.flatnonzero(np.isin(pair, twice))
        _, first, count = np.unique(pair[again], return_index=True, return_counts=True)
        weight[again[first]] *= count
        keep = np.ones(len(row), bool)
        keep[again] = False
        keep[again[first]] = True
        row, key, weight = row[keep], key[keep], weight[keep]
    return row, key, weight


def samples(row: np.ndarray, key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and their samples as 64-bit codes."""
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(row)))
    log_weight = np.log(weight).astype(np.float32)
    codes = np.zeros((len(start), SAMPLES), np.uint64)
    if not len(start):
        return row, codes
    for k in range(SAMPLES):
        place = ((key * SAMPLE_KEYS[k]) >> np.uint64(48)).view(np.int64)
        beta = BETA.take(place)
        t = np.floor(log_weight * INVERSE_R.take(place) + beta)
        score = LOG_C.take(place) - R.take(place) * (t - beta)
        least = np.minimum.reduceat(score, start)
        at = np.flatnonzero(score == np.repeat(least, size))
        if len(at) > len(start):
            at = at[np.lexsort((key[at], row[at]))]
            at = at[np.append(True, row[at][1:] != row[at][:-1])]
        codes[:, k] = words.mix(key[at] + t[at].astype(np.int64).view(np.uint64) * words.BASE)
    return row[start], codes


def sample_bits(codes: np.ndarray) -> np.ndarray:
    """One bit of each sample. The number of the sample is mixed in, so that the bits of
    samples that are one shingle are independent."""
    bits = (words.mix(codes ^ SAMPLE_KEYS) >> np.uint64(17)) & np.uint64(1)
    return np.bitwise_or.reduce(bits << np.arange(SAMPLES, dtype=np.uint64), 1)


def document_frequencies(batches):
    """Hash of each word and how many rows hold it, summed over about ``COUNTED`` words at a time."""

    def counted(found):
        word, count = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "n"])

    out, total = [], 0
    for batch in batches:
        for _, found, hashed in rows_of(batch.column(0)):
            pair = words.mix(hashed ^ words.mix(found.row.astype(np.uint64)))
            _, one = np.unique(pair, return_index=True)
            out.append(hashed[one])
            total += len(one)
            if total >= COUNTED:
                yield counted(out)
                out, total = [], 0
    if total:
        yield counted(out)


def counted_words(docs: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray, int, np.ndarray], DataFrame | None]:
    """For ``Idf``: hashes of the common words in order, their idf, the number of rows, and counters of the others.
    And word and n of the words that are not common but in several rows, if any."""
    total = docs.count()
    counts = docs.select("text").mapInArrow(steps.thrifty(document_frequencies), "word bigint, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))
    counts = steps.written(counts.filter("n > 1"))
    sizes = dict(counts.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*")).collect())
    bits = 2
    while sum(n for k, n in sizes.items() if k >= bits) > COMMON_WORDS:
        bits += 1
    least = 1 << (bits - 1)
    rows = counts.filter(F.col("n") >= least).toArrow()
    word, n = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(word)
    common = word[order], np.log1p(total / n[order]), total
    if min(sizes, default=bits) >= bits:
        steps.freed(counts)
        return (*common, np.zeros(0, np.uint32)), None
    rest = counts.filter(F.col("n") < least)
    rest._written_to = counts._written_to
    return (*common, steps.counters(rest)), rest


def uncommon_words(machine: steps.OnWorker, wanted: steps.OnWorker):
    """From (node, text, hash of the node): the distinct words that the workers do not know of the texts that pass a
    sieve. Sieved here, so that a task needs one worker and not two."""

    def give(batches):
        seen = set()
        for batch in batches:
            batch = batch.filter(pa.array(wanted.get().has(batch.column(2).to_numpy(zero_copy_only=False))))
            take = first_of_each(batch.column(0), seen)
            nodes = batch.column(0).take(take)
            for first, found, hashed in rows_of(batch.column(1).take(take)):
                other = ~machine.get().is_common(hashed)
                row, hashed = found.row[other], hashed[other]
                _, one = np.unique(words.mix(hashed ^ words.mix(row.astype(np.uint64))), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(first + row[one], pa.int64())), pa.array(hashed[one].view(np.int64))],
                    names=["node", "word"])

    return give


def listed_words(texts: DataFrame, machine: steps.OnWorker, wanted: steps.OnWorker, rest: DataFrame) -> DataFrame:
    """For each node of ``texts`` (node, text) that passes a sieve: its words that are in ``rest``, and their n."""
    hashed = texts.select("node", "text", F.xxhash64("node"))
    held = hashed.mapInArrow(steps.thrifty(uncommon_words(machine, wanted)), "node binary, word bigint").join(rest, "word")
    lists = held.groupBy("node").agg(F.collect_set(F.struct("word", "n")).alias("listed"))
    return lists.select("node", F.col("listed.word").alias("listed"), F.col("listed.n").alias("listed_n"))


def first_of_each(nodes: pa.Array, seen: set) -> pa.Array:
    """Where each node of a batch comes first, if it is not among those ``seen``, of which ``SEEN`` or so are held."""
    fresh = []
    if len(seen) > SEEN:
        seen.clear()
    for k, node in enumerate(nodes.to_pylist()):
        if node not in seen:
            seen.add(node)
            fresh.append(k)
    return pa.array(fresh, pa.int64())


def signer(machine: steps.OnWorker):
    def sign(batches):
        seen = set()
        for batch in batches:
            idf = machine.get().rough()
            take = first_of_each(batch.column(0), seen)
            nodes, texts = batch.column(0).take(take), batch.column(1).take(take)
            for first, found, hashed in rows_of(texts):
                row, codes = samples(*shingles(found, hashed, idf))
                band = np.zeros((len(row), BANDS), np.uint64)
                for k in range(ROWS):
                    band = words.mix(band * words.BASE + codes[:, k::ROWS])
                band ^= words.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
                ends = np.arange(0, band.size + 1, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    nodes.take(pa.array(first + row, pa.int64())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(band.ravel().view(np.int64))),
                    pa.array(sample_bits(codes).view(np.int64)),
                ], names=["node", "bands", "bits"])

    return sign


def similarities(left: pa.Array, right: pa.Array, idf: Idf) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 without words."""
    sides = []
    for texts in (left, right):
        parts = [(first, *shingles(found, hashed, idf)) for first, found, hashed in rows_of(texts)]
        row = np.concatenate([p[0] + p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        key = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint64)
        weight = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0)
        sides.append((row, key, weight))
    row, key, weight = (np.concatenate([a, b]) for a, b in zip(*sides))
    order = np.lexsort((key, row))
    row, key, weight = row[order], key[order], weight[order]
    total = np.bincount(row, weight, len(left))
    same = np.flatnonzero((row[1:] == row[:-1]) & (key[1:] == key[:-1]))
    shared = np.bincount(row[same], np.minimum(weight[same], weight[same + 1]), len(left))
    return np.where(total > 0, shared / np.maximum(total - shared, 1e-300), 0.0)


def shingle_rows(machine: steps.OnWorker, totals: bool):
    """From (id, text, listed, listed_n): each distinct shingle and its weight, or only their sum."""

    def give(batches):
        for batch in batches:
            idf = machine.get().beside((batch.column(2), batch.column(3)))
            for first, found, hashed in rows_of(batch.column(1)):
                row, key, weight = shingles(found, hashed, idf)
                if totals:
                    weight = np.bincount(row, weight, len(found.counts))
                    row, key = np.arange(len(weight)), np.zeros(len(weight), np.uint64)
                if len(row):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(first + row, pa.int64())), pa.array(key.view(np.int64)),
                        pa.array(weight)], names=["id", "key", "weight"])

    return give


def shared_weights(texts: DataFrame, machine: steps.OnWorker) -> DataFrame:
    """Of ``texts`` (id, text, listed, listed_n): their weight, and that of the shingles that another of them
    has too. No more than this can two texts have in common."""
    kind = "id bigint, key bigint, weight double"
    held = texts.mapInArrow(steps.thrifty(shingle_rows(machine, False)), kind)
    own = held.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("weight").alias("weight"))
    lost = own.filter("n = 1").groupBy("id").agg(F.sum("weight").alias("lost"))
    total = texts.mapInArrow(steps.thrifty(shingle_rows(machine, True)), kind).select("id", F.col("weight").alias("total"))
    common = F.col("total") - F.coalesce("lost", F.lit(0.0))
    return total.join(lost, "id", "left").select("id", "total", common.alias("common"))


def can_be_similar(x: str, y: str) -> Column:
    """By their weights: what they share is at most the lesser common weight."""
    most = F.least(F.col(f"{x}common"), F.col(f"{y}common")) * (1 + 1e-9)
    return most * (1 + THRESHOLD) >= (F.col(f"{x}total") + F.col(f"{y}total")) * THRESHOLD


def verifier(machine: steps.OnWorker):
    def verify(left: pa.Array, right: pa.Array, x: pa.Array, x_n: pa.Array, y: pa.Array, y_n: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for k in range(0, len(left), 512):
            part = [column.slice(k, 512) for column in (left, right, x, x_n, y, y_n)]
            out.append(similarities(*part[:2], machine.get().beside(part[2:4], part[4:])))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(verify, "double").asNondeterministic()


def verified(pairs: DataFrame, texts: DataFrame, machine: steps.OnWorker) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough, written."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"), F.col("listed").alias("x"), F.col("listed_n").alias("x_n"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"), F.col("listed").alias("y"), F.col("listed_n").alias("y_n"))
    both = pairs.join(left, "a").join(right, "b")
    similar = both.select("a", "b", verifier(machine)("left", "right", "x", "x_n", "y", "y_n").alias("similarity"))
    return steps.written(similar.filter(F.col("similarity") >= LEAST).select("a", "b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its class) for the nodes of ``edges`` (a, b):
    least labels of the neighbours and the label of the label, until none changes."""
    both = steps.written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = steps.written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy("b").agg(F.min("label").alias("near"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = steps.written(labels.join(ahead, "label", "left").join(near, F.col("node") == F.col("b"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label"), F.coalesce("further", "label")).alias("label")))
        steps.freed(labels)
        if new.filter("label <> old").isEmpty():
            steps.freed(both)
            return new.select("node", "label")
        labels = new.select("node", "label")
        labels._written_to = new._written_to


def texts_of(rows: DataFrame, held: DataFrame) -> DataFrame:
    """The text of each node of ``held`` (node, first, listed, listed_n), from its first row."""
    same = F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("own") == F.col("node"))
    return rows.join(held, same).select("node", "text", "listed", "listed_n")


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, node (hash of the text), label (least node of
    the class), class_id and class_size, the number of rows in the class."""
    steps.ship(docs.sparkSession)
    with steps.small_batches(docs.sparkSession):
        return found_classes(docs.select("doc_id", "text"))


def found_classes(docs: DataFrame) -> DataFrame:
    """``classes`` of (doc_id, text)."""
    spark = docs.sparkSession
    slim = steps.written(docs.select("doc_id", F.expr(NODE).alias("node")))
    firsts = slim.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    common, rest = counted_words(docs)
    machine = steps.OnWorker(spark, common, Idf)
    rows = docs.select("doc_id", "text", F.expr(NODE).alias("own"))
    plain = rows.select(F.col("own").alias("node"), "text")
    signed = plain.mapInArrow(steps.thrifty(signer(machine)), "node binary, bands array<bigint>, bits bigint")
    signed = signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    entries = signed.select("node", "bits", F.explode("bands").alias("key"))
    entries = steps.written(entries)
    # Only samples need the counters.
    machine.free()
    machine = steps.OnWorker(spark, (*common[:3], np.zeros(0, np.uint32)), Idf)
    buckets = entries.groupBy("key").agg(F.min(F.struct("node", "bits")).alias("rep"), F.count("*").alias("n"))
    shared = steps.written(entries.join(buckets.filter("n > 1").select("key", "rep", F.col("n").alias("many")), "key"))
    close = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= MOST_BITS
    stars = steps.written(
        shared.filter(F.col("node") != F.col("rep.node")).filter(close(F.col("bits"), F.col("rep.bits")))
        .select(F.col("rep.node").alias("a"), F.col("node").alias("b")).distinct())
    # All pairs with the least of a bucket are in stars or ruled out, so only the others may have more.
    others = shared.filter((F.col("many") > 2) & (F.col("node") != F.col("rep.node"))).select("key", "node", "bits")
    wanted = steps.written(others.select("node").union(stars.select("a")).union(stars.select("b")).distinct())
    near = steps.sieve(wanted.select(F.xxhash64("node")))
    near_rows = rows.filter(steps.may_be_in(near, F.xxhash64("own")))
    none = F.array().cast("array<bigint>")
    held = wanted.join(firsts, "node")
    if rest is None:
        held = held.select("node", "first", none.alias("listed"), none.alias("listed_n"))
    else:
        lists = listed_words(plain, machine, near, rest)
        held = steps.written(held.join(lists, "node", "left").select(
            "node", "first", *[F.coalesce(c, none).alias(c) for c in ("listed", "listed_n")]))
    texts = steps.written(texts_of(near_rows, held))
    steps.freed(entries, held, wanted, rest)
    near.free()
    edges = verified(stars, texts, machine)
    labels = components(edges)
    labelled = others.join(labels, "node", "left").select("key", "node", "bits", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    number = F.xxhash64("node").alias("id")
    opened = steps.written(labelled.join(mixed.select("key"), "key").withColumn("id", number))
    open_texts = texts.select(number, "text", "listed", "listed_n").join(opened.select("id").distinct(), "id").dropDuplicates(["id"])
    weights = steps.written(shared_weights(open_texts, machine))
    all_opened, opened = opened, steps.written(opened.drop("label").join(weights.filter(F.col("common") >= LEAST * F.col("total")), "id"))
    steps.freed(shared, all_opened, weights)
    shared_keys = opened.groupBy("id").agg(F.collect_set("key").alias("keys"))
    without_keys, opened = opened, steps.written(opened.join(shared_keys, "id"))
    steps.freed(without_keys)
    tried = stars
    for once in (True, False):
        entries = opened.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        left = entries.select([F.col(c).alias(f"x_{c}") for c in entries.columns])
        if once:
            best = F.min_by(F.struct(*entries.columns), F.struct(F.col("common") / -F.col("total"), "node"))
            right = entries.groupBy("key").agg(best.alias("e")).select(*[F.col(f"e.{c}").alias(f"y_{c}") for c in entries.columns])
            order = F.col("x_node") != F.col("y_node")
        else:
            right = entries.select([F.col(c).alias(f"y_{c}") for c in entries.columns])
            # A pair that meets in several buckets counts in the first of them.
            first = F.col("x_key") == F.array_min(F.array_intersect("x_keys", "y_keys"))
            order = (F.col("x_node") < F.col("y_node")) & first
        pairs = left.join(right, (left["x_key"] == right["y_key"]) & order & (F.col("x_label") != F.col("y_label"))
                          & close(F.col("x_bits"), F.col("y_bits")) & can_be_similar("x_", "y_"))
        pairs = pairs.select(
            F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
        more = verified(pairs.join(tried, ["a", "b"], "left_anti"), texts, machine)
        if once:
            before, tried = tried, steps.written(tried.unionByName(pairs))
            steps.freed(before)
        if not more.isEmpty():
            before, edges = edges, steps.written(edges.unionByName(more))
            steps.freed(before, more)
            labels = components(edges)
    joined = firsts.join(labels, "node", "left").select("node", "first", "n", F.coalesce("label", "node").alias("label"))
    joined = steps.written(joined)
    steps.freed(opened, texts, tried, edges)
    machine.free()
    sizes = joined.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    known = joined.select("node", "label").join(sizes, "label")
    return slim.join(known, "node").select("doc_id", "node", "label", "class_id", "class_size")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, and whether the row is the one that stays."""
    found = classes(docs).drop("node", "label")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each class: that of the least doc_id, of
    rows with this id that of the least hash, and of equal rows any."""
    found = steps.written(classes(docs))
    node, doc = (steps.fresh(x, docs.columns) for x in ("node", "doc"))
    stays = found.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(
        F.min("class_id").alias(doc), F.min("node").alias("least"), F.count("*").alias("n"))
    rows = docs.withColumn(node, F.expr(NODE))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(node) == F.col(f"{node}_least"))
    kept = rows.join(stays.select(doc, F.col("least").alias(f"{node}_least")), same, "left_semi")
    if not stays.filter("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", node])
    return kept.drop(node)
