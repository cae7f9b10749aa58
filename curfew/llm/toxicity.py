"""Toxicity by a weighted lexicon, learned from labelled rows.

Texts are folded first: compatibility forms and look-alike Greek and Cyrillic
letters become Latin ones, digits and signs that stand for a letter before another
letter become that letter, all is lower case, and all else parts words. At the end of a word
they may be meant as they are, so the word counts in both forms. Patterns are
whole words or beginnings of words. One Aho-Corasick automaton finds them in a text;
hits within an exception phrase do not count. The sum of the weights of the hits is
divided by a power of the number of words, and ``score = d / (d + scale)``.

Patterns, weights, the power and the scale come from labelled rows of the training
fold alone: at most ``MAX_TOXIC`` and ``MAX_CLEAN`` rows, chosen by a hash of the id. Of toxic rows that
are copies of each other one stays, so that no other word of a text that is copied gathers evidence.
A row counts once for a pattern. How much evidence a pattern needs follows from the sample: so much
that ``CHANCE`` of all words that could reach it would do so by chance.
Exception phrases (a pattern with the word before or after it) are learned from the
same rows: phrases that two clean rows or more hold and toxic ones do not.
"""

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from curfew.llm import steps, words
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOXIC, MAX_CLEAN = 8_000, 40_000
#: Words that may pass by chance, of all that are tried.
CHANCE = 1.0
#: Least weight of a pattern: how much more often toxic rows hold it, as a logarithm.
LIFT = math.log(32)
#: Rows that share one of so many least hashes of three words are copies.
SIGNATURE, SHINGLE = 8, 3
BEGINNINGS = (4, 5, 6, 7)
POWERS = (0.0, 0.25, 0.5, 0.75, 1.0)

# Letters that look like Latin ones, and what stands for a letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def folding() -> dict[int, str]:
    """ASCII marks part words; wide and mathematical letters, and look-alikes, are Latin."""
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    for first, last in ((0xFF01, 0xFF5F), (0x1D400, 0x1D800), (0x2460, 0x2500)):
        for c in range(first, last):
            plain = unicodedata.normalize("NFKC", chr(c)).lower()
            if plain != chr(c) and plain.isascii():
                table[c] = plain if plain.isalnum() else " "
    for letter, plain in LOOK_ALIKES.items():
        table[ord(letter)] = table[ord(letter.upper()[0])] = plain
    for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF):
        table[c] = ""
    return {k: v for k, v in table.items() if not (k < 128 and chr(k).isalpha())}


FOLD = folding()
INSTEAD = re.compile("[" + re.escape("".join(STANDS_FOR)) + r"]+(?=[^\W\d_])")
#: Digits and signs at the end of a word that may stand for letters; a mark of exclamation ends a sentence.
ENDING = re.compile(r"[013457@$]+(?![\w@$])")


def letters(marks: str) -> str:
    return "".join(STANDS_FOR[c] for c in marks)


def folded(text: str) -> list[str]:
    """The words of a text, folded."""
    text = INSTEAD.sub(lambda m: letters(m[0]), text.lower())
    parts, at = [], 0
    for match in ENDING.finditer(text):
        first = match.start()
        if not text[first - 1 : first].isalpha():
            continue
        while first > at and text[first - 1].isalnum():
            first -= 1
        parts += [text[at:first], text[first : match.start()], letters(match[0]), " "]
        at = first
    return "".join([*parts, text[at:]]).translate(FOLD).split()


def training_fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def signatures(batches):
    """For each row the least hashes of its runs of words, one for each of ``SIGNATURE`` hash functions."""
    salts = words.mix(np.arange(3, 3 + SIGNATURE, dtype=np.uint64) * words.WINDOW_BASE)
    for batch in batches:
        data, offsets = steps.text_buffers(batch.column(1))
        found = words.find(data, offsets)
        hashed = words.hashes(data, found, words.FOLDED_BYTES)
        at, row = words.window_rows(found, SHINGLE)
        runs = words.windows(hashed, SHINGLE)[at]
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        out = np.zeros((batch.num_rows, SIGNATURE), np.uint64)
        for k in range(SIGNATURE if len(start) else 0):
            out[row[start], k] = np.minimum.reduceat(words.mix(runs ^ salts[k]), start)
        ends = np.arange(0, out.size + 1, SIGNATURE, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel().view(np.int64)))], names=["doc_id", "least"])


def copies(rows: list[tuple[int, list[int]]]) -> list[int]:
    """Ids of rows that share a least hash with one of a smaller id, directly or by others."""
    top: dict[int, int] = {i: i for i, _ in rows}

    def least(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    seen: dict[tuple[int, int], int] = {}
    for i, hashes in sorted(rows):
        for key in enumerate(hashes):
            if key[1]:
                a, b = least(i), least(seen.setdefault(key, i))
                top[max(a, b)] = min(a, b)
    return [i for i in top if least(i) != i]


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """Texts and labels of the rows to learn from, and how many of either label there are. Of rows
    with one id that with the least text counts."""
    spark = docs.sparkSession
    known = (
        labels.filter(training_fold() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = steps.hash_sample(known.filter("toxic = 1"), "doc_id", MAX_TOXIC).unionAll(
        steps.hash_sample(known.filter("toxic = 0"), "doc_id", MAX_CLEAN))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    rows = steps.written(rows)
    signed = rows.filter("toxic = 1").select("doc_id", "text").mapInArrow(signatures, "doc_id bigint, least array<bigint>")
    again = copies([(row.doc_id, row.least) for row in signed.collect()])
    dropped = spark.createDataFrame([(i,) for i in again], "doc_id bigint")
    rows = steps.written(rows.join(F.broadcast(dropped), "doc_id", "left_anti").select("text", "toxic"))
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return rows, counts.get(1, 0), counts.get(0, 0)


def patterns_of(words: set[str]) -> set[str]:
    """A pattern begins with a blank; it ends with one if it is a whole word."""
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in BEGINNINGS if len(w) >= n}


def pattern_counts(batches):
    """Rows that hold a pattern, by label, summed over a batch."""
    for batch in batches:
        counts = Counter(), Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update(patterns_of(set(folded(text or ""))))
        found = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array(found, pa.string()), pa.array([counts[1][w] for w in found], pa.int64()),
            pa.array([counts[0][w] for w in found], pa.int64())], names=["pattern", "t", "c"])


def needed(sizes: dict[int, int], share: float) -> float:
    """The evidence that a pattern needs. A pattern in n rows has at most that of n toxic ones, which chance
    gives with share ** n; so patterns in too few rows are not tried and raise the bar for no other."""
    tried, n = sum(sizes.values()), 1
    while tried * share**n > CHANCE:
        tried -= sizes.get(n, 0)
        n += 1
    return -2 * n * math.log(share) - 1e-9


def lexicon(sample: DataFrame, toxic: int, clean: int) -> list[tuple[str, float]]:
    """Patterns and weights. One that begins like a stronger pattern is left out."""
    share = toxic / (toxic + clean)
    counts = sample.mapInArrow(pattern_counts, "pattern string, t bigint, c bigint").groupBy("pattern").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"))
    counts = steps.written(counts)
    both = F.col("t") + F.col("c")
    # Beginnings go with their words, so the words alone are counted as tries.
    words_alone = counts.filter(F.endswith("pattern", F.lit(" ")))
    least = needed(dict(words_alone.groupBy(both.alias("n")).agg(F.count("*")).collect()), share)
    term = lambda n, p: F.when(n > 0, n * F.log(n / (both * p))).otherwise(0.0)
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    evidence = 2 * (term(F.col("t"), share) + term(F.col("c"), 1 - share))
    strong = counts.select("pattern", weight.alias("weight"), evidence.alias("evidence")).filter(
        (F.col("weight") >= LIFT) & (F.col("evidence") >= least))
    kept: list[tuple[str, float]] = []
    # No more than the bounded sample has patterns.
    for row in strong.orderBy(F.desc("evidence"), F.desc(F.length("pattern")), "pattern").collect():
        if not any(row.pattern.startswith(p) or p.startswith(row.pattern) for p, _ in kept):
            kept.append((row.pattern, float(row.weight)))
    return kept


def automaton(data: tuple[list[tuple[str, float]], list[str]]) -> ahocorasick.Automaton:
    patterns, exceptions = data
    machine = ahocorasick.Automaton()
    for pattern, weight in patterns:
        machine.add_word(pattern, (len(pattern), weight))
    for phrase in exceptions:
        machine.add_word(phrase, (len(phrase), None))
    machine.make_automaton()
    return machine


def hits(machine: ahocorasick.Automaton, words: list[str]) -> list[tuple[int, int, float]]:
    """Where patterns begin and end in the joined words, and their weights, but for
    those within an exception phrase."""
    if not words or not len(machine):
        return []
    found, excepted = [], []
    for end, (size, weight) in machine.iter(" " + " ".join(words) + " "):
        (excepted if weight is None else found).append((end - size + 1, end + 1, weight))
    return [h for h in found if not any(a <= h[0] and h[1] <= b for a, b, _ in excepted)]


def weigher(machine: steps.OnWorker):
    def weigh(texts: pa.Array) -> pa.Array:
        built = machine.get()
        counts, sums, numbers = [], [], []
        for text in texts.to_pylist():
            own = folded(text or "")
            found = hits(built, own)
            counts.append(len(own))
            sums.append(sum(h[2] for h in found))
            numbers.append(len(found))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(sums, pa.float64()), pa.array(numbers, pa.int64())],
            ["n_words", "weight", "n_matches"])

    return F.arrow_udf(weigh, "struct<n_words:bigint,weight:double,n_matches:bigint>").asNondeterministic()


def phrase_counts(machine: steps.OnWorker):
    """Rows that hold a hit with the word before or after it, by label."""

    def count(batches):
        for batch in batches:
            counts = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = folded(text or "")
                line, phrases = " " + " ".join(own) + " ", set()
                for first, last, _ in hits(machine.get(), own):
                    stop = line.index(" ", max(first + 1, last - 1))
                    before = line.rfind(" ", 0, first) if first else -1
                    after = line.find(" ", stop + 1)
                    phrases |= {line[before : stop + 1]} if before >= 0 else set()
                    phrases |= {line[first : after + 1]} if after >= 0 else set()
                counts.update((phrase, toxic) for phrase in phrases)
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([counts[k] for k in keys], pa.int64())], names=["phrase", "toxic", "n"])

    return count


def exceptions(sample: DataFrame, patterns: list[tuple[str, float]]) -> list[str]:
    """Phrases around a pattern that two clean rows or more hold, and no toxic one. There are no more than
    the bounded sample has hits in clean rows."""
    machine = steps.OnWorker(sample.sparkSession, (patterns, []), automaton)
    counts = sample.mapInArrow(phrase_counts(machine), "phrase string, toxic int, n bigint")
    clean, toxic = F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.sum(F.when(F.col("toxic") == 1, F.col("n")))
    rows = (
        counts.groupBy("phrase").agg(clean.alias("c"), toxic.alias("t"))
        .filter("c >= 2 AND t IS NULL").orderBy("phrase").collect()
    )
    return [row.phrase for row in rows]


def fitted_scale(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """The power of the length and the scale that part the labels best, each label
    counted as often as it occurs. Of equals, the greatest power."""
    best = (-1.0, 0.0, 1.0)
    each = np.where(toxic == 1, n_toxic / max(1, (toxic == 1).sum()), n_clean / max(1, (toxic == 0).sum()))
    for power in POWERS:
        density = weight / np.maximum(words, 1) ** power
        order = np.argsort(-density, kind="stable")
        gain = np.cumsum(np.where(toxic[order] == 1, each[order], -each[order]))
        ends = np.flatnonzero(np.append(np.diff(density[order]) != 0, True) & (density[order] > 0))
        if not len(ends):
            continue
        at = ends[np.argmax(gain[ends])]
        following = density[order][at + 1] if at + 1 < len(order) else 0.0
        if gain[at] >= best[0]:
            best = (float(gain[at]), power, float((density[order][at] + following) / 2))
    return best[1], best[2]


class Model:
    def __init__(self, patterns, phrases, power, scale):
        self.patterns, self.phrases, self.power, self.scale = patterns, phrases, power, scale


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows; without both labels it finds nothing toxic."""
    spark = docs.sparkSession
    steps.ship(spark)
    sample, toxic, clean = labelled_sample(docs, labels)
    if not toxic or not clean:
        return Model([], [], 0.0, 1.0)
    patterns = lexicon(sample, toxic, clean)
    phrases = exceptions(sample, patterns)
    weigh = weigher(steps.OnWorker(spark, (patterns, phrases), automaton))
    rows = sample.select("toxic", weigh("text").alias("w")).select("toxic", "w.weight", "w.n_words").collect()
    if not rows:
        return Model([], [], 0.0, 1.0)
    label, weight, size = (np.array(x, float) for x in zip(*rows))
    return Model(patterns, phrases, *fitted_scale(weight, size, label, toxic, clean))


def scored(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """``docs`` with a column ``into``: score, n_words, n_matches. A null or empty text
    has no words and scores 0."""
    steps.ship(docs.sparkSession)
    weigh = weigher(steps.OnWorker(docs.sparkSession, (model.patterns, model.phrases), automaton))
    out = docs.withColumn(into, weigh("text"))
    found = F.col(into)
    density = found["weight"] / F.pow(F.greatest(found["n_words"], F.lit(1)), F.lit(model.power))
    score = F.greatest(F.lit(0.0), density / (density + F.lit(model.scale)))
    return out.withColumn(into, F.struct(
        score.alias("score"), found["n_words"].alias("n_words"), found["n_matches"].alias("n_matches")))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_words, n_matches.
    A null id is not held out."""
    found = scored(docs.select("doc_id", "text"), learn(docs, labels), "found")
    return found.select(
        "doc_id",
        F.coalesce(~training_fold(), F.lit(False)).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_matches").alias("n_matches"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that do not score as toxic."""
    name = steps.fresh("found", docs.columns)
    return scored(docs, learn(docs, labels), name).filter(F.col(f"{name}.score") < 0.5).drop(name)
