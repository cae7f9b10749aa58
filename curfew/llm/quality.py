"""Quality rules: boosted trees over statistics of a text.

The statistics are taken in one pass over the whole texts and written; the trees are
fitted on the statistics of at most ``SAMPLE`` labelled rows, chosen by a hash of the
id from the training fold, and score the written statistics as flat node arrays. More
symbols, repeats, marks and capitals per word never raise the score.

A null or empty text has no words, so its base rules fail. Rows with equal ids are
judged one by one. Without both labels every row that passes the base rules is kept.
"""

import numpy as np
import pyarrow as pa
from curfew.llm import boosting, steps, words
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 40_000
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3

SYMBOLS = b"#*$%&|<>"
CLASSES = {"symbols": SYMBOLS, "capitals": bytes(range(65, 91)), "small": bytes(range(97, 123)),
           "digits": b"0123456789", "marks": b"!?.,;:\"'()[]{}=+/\\^~`@_-"}
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_small",
         "n_digits", "n_marks", "n_distinct", "n_chars"]

#: Each feature, and whether the score may only rise (1) or fall (-1) with it.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "words_per_line": 0,
    "capitals": -1, "digits": -1, "marks": -1, "distinct": 0, "small": 0,
}


def class_of_bytes() -> np.ndarray:
    """0 to 4 the classes, 5 space, 6 later bytes of a character, 7 the rest."""
    table = np.full(256, 7, np.int64)
    table[0x80:0xC0] = 6
    table[words.SPACE] = 5
    for k, members in enumerate(CLASSES.values()):
        table[list(members)] = k
    return table


CLASS = class_of_bytes()


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those equal to an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def marked_in_row(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which values occur twice or more in their row."""
    keys = words.mix(values ^ words.mix(row.astype(np.uint64)))
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)


def statistics(texts: pa.Array) -> np.ndarray:
    """The numbers of ``STATS`` for each text."""
    data, offsets = steps.text_buffers(texts)
    rows = len(offsets) - 1
    out = np.zeros((rows, len(STATS)), np.int64)
    for first, last in steps.pieces(offsets):
        part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        many = last - first
        owner = np.repeat(np.arange(many), np.diff(cuts))
        count = np.bincount(owner * 8 + CLASS[part], minlength=8 * many).reshape(many, 8)
        found = words.find(part, cuts)
        hashed, row = words.hashes(part, found), found.row
        at, at_row = words.window_rows(found, WINDOW)
        repeated = at[marked_in_row(words.windows(hashed, WINDOW)[at], at_row)]
        covered = np.zeros(len(hashed) + WINDOW, bool)
        for k in range(WINDOW):
            covered[repeated + k] = True
        pairs = words.mix(hashed ^ words.mix(row.astype(np.uint64)))
        _, one = np.unique(pairs, return_index=True)
        raw = part.tobytes()
        lines = [duplicate_lines(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
        out[first:last] = np.stack([
            found.counts, count[:, [0, 1, 2, 3, 4, 7]].sum(1), count[:, 0], [d for _, d in lines],
            np.bincount(row[covered[: len(row)]], minlength=many), [n for n, _ in lines], count[:, 1], count[:, 2],
            count[:, 3], count[:, 4], np.bincount(row[one], minlength=many), count.sum(1) - count[:, 6],
        ], 1)
    return out


def features(stats: np.ndarray) -> np.ndarray:
    """Columns of ``FEATURES`` from columns of ``STATS``."""
    s = dict(zip(STATS, stats.T.astype(float), strict=True))
    per_word, per_char = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / per_word, s["n_symbols"] / per_word,
        s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_repeat_words"] / per_word,
        s["n_words"] / np.maximum(s["n_lines"], 1), s["n_capitals"] / per_char, s["n_digits"] / per_char,
        s["n_marks"] / per_word, s["n_distinct"] / per_word, s["n_small"] / per_char,
    ], 1)


def measure(texts: pa.Array) -> pa.Array:
    stats = statistics(texts)
    return pa.StructArray.from_arrays([pa.array(column) for column in stats.T], STATS)


def training_fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row, written."""
    steps.ship(docs.sparkSession)
    fields = ",".join(f"{name}:bigint" for name in STATS)
    stats = docs.select("doc_id", F.arrow_udf(measure, f"struct<{fields}>").asNondeterministic()("text").alias("s"))
    return steps.written(stats.select("doc_id", "s.*"))


def learn(stats: DataFrame, labels: DataFrame) -> boosting.Trees | None:
    """Trees for quality 1, from a bounded sample; None without both labels."""
    known = labels.filter(training_fold() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    rows = stats.join(F.broadcast(steps.hash_sample(known, "doc_id", SAMPLE)), "doc_id").select("quality", *STATS).toPandas()
    y = rows["quality"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return None
    return boosting.fit(features(rows[STATS].to_numpy()), y, list(FEATURES.values()))


def judged(stats: DataFrame, trees: boosting.Trees | None) -> DataFrame:
    """The statistics with base_failed, score and kept."""
    spark = stats.sparkSession
    machine = steps.OnWorker(spark, trees, same)

    def score(*columns: pa.Array) -> pa.Array:
        model = machine.get()
        x = features(np.stack([np.asarray(c) for c in columns], 1))
        return pa.array(np.ones(len(x)) if model is None else model.probability(x))

    def score_all(stats: pa.Array) -> pa.Array:
        return score(*stats.flatten())

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    scored = stats.withColumn("score", F.arrow_udf(score_all, "double").asNondeterministic()(F.struct(*STATS)))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= 0.5))


def same(model):
    return model


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score."""
    stats = measured(docs)
    found = judged(stats, learn(stats, labels))
    return found.select("doc_id", *STATS[:5], "base_failed", "kept", "score")
