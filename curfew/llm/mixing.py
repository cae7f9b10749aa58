"""Mixing to target weights with soft membership; DataFrame functions alone.

A labelled table names the domain of some rows. A classifier learns from at most
``SAMPLE`` of them and gives each row of the corpus a posterior over the domains: a
naive Bayes model on binned features, two kinds of them:

* statistics of a text, each cut into bins at quantiles of the sample;
* how many of a short list of telling words it holds, for each domain. The list, at
  most ``LIST`` words per domain, comes from the sample by log-odds.

A row of ``n`` words counts ``n * posterior`` expected words in each domain. The rates
(copies per row, 0 or more) minimise the weighted squares of the gaps between the
expected words of the mix and the targets by projected gradient steps: in each, one
aggregation over the slim table of rows gives the gaps, and every row moves against
them and is cut at 0. The metric makes the step 1 safe at any size. The start is one
copy of each row, so rows keep near it unless the targets move them.

Copies are ``floor(rate)`` and one more with the chance of the rest, decided by a hash of
the id and the text. A null text has no words and keeps a rate of 1, as it counts in
no domain. Labels of null are passed over; a row with two labels counts with the
greater. Without labels all rows are of one domain.
"""

from functools import reduce
from math import log, sqrt

from curfew.llm import steps
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
LIST = 64
BINS = 8
ROUNDS, EVERY = 100, 6
TOLERANCE = 1e-4
FLOOR = 1e-3


def split_words(text: Column) -> Column:
    """Words without the empty strings at the ends."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def statistics(text: Column) -> dict[str, Column]:
    """Numbers of a text that tell junk from prose, each by word or by character."""
    filled = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(filled), F.lit(1))
    count = lambda pattern: F.regexp_count(filled, F.lit(pattern)) / chars
    return {
        "words": F.log1p(F.col("n_words")),
        "word_length": chars / F.greatest(F.col("n_words"), F.lit(1)),
        "symbols": count(r"[#*$%&|<>!]"),
        "capitals": count(r"[A-Z]{2}"),
        "digits": count(r"[0-9]"),
        "foreign": count(r"[^\x00-\x7F]"),
    }


def bare(words: Column) -> Column:
    """Distinct words in small letters, without marks at their ends."""
    return F.array_distinct(F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?*#$%&|")))))


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """doc_id and domain from quality and toxic: poor, toxic or clean."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    domain = F.when(F.col("quality") == 0, "poor").when(F.col("toxic") == 1, "toxic").otherwise("clean")
    return known.groupBy("doc_id").agg(F.max(domain).alias("domain"))


def quality_of_labels(labels: DataFrame) -> DataFrame:
    """doc_id and domain from quality alone: poor or clean."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 0, "poor").otherwise("clean")).alias("domain"))


class Classifier:
    """Lists of telling words, cuts of the statistics, and log chances by domain."""

    def __init__(self, domains, lists, cuts, prior, chances):
        self.domains, self.lists, self.cuts, self.prior, self.chances = domains, lists, cuts, prior, chances


def listed_features(lists: dict[str, list[str]]) -> dict[str, Column]:
    """Distinct words of a text that are on the list of a domain."""
    return {
        f"list_{k}": F.size(F.array_intersect("w", F.array(*[F.lit(w) for w in words]))).cast("double")
        for k, (_, words) in enumerate(sorted(lists.items())) if words
    }


def bin_of(value: Column, cuts: list[float]) -> Column:
    return reduce(lambda total, cut: total + F.when(value > cut, 1).otherwise(0), cuts, F.lit(0))


def with_features(docs: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """The columns given, the number of words, and all features."""
    own = docs.columns
    split = docs.withColumn("w", split_words(F.col("text"))).withColumn("n_words", F.size("w").cast("long"))
    split = split.withColumn("w", bare(F.col("w")))
    features = {**statistics(F.col("text")), **listed_features(lists)}
    return split.select(*[c for c in own if c != "text"], "n_words", *[c.alias(n) for n, c in features.items()])


def telling_words(sample: DataFrame, counts: dict[str, int]) -> dict[str, list[str]]:
    """For each domain, words whose rows lie in it far beyond its share."""
    total = sum(counts.values())
    held = sample.select("domain", F.explode(bare(split_words(F.col("text")))).alias("word")).filter("word <> ''")
    by_domain = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(counts)]
    words = steps.written(held.groupBy("word").agg(F.count("*").alias("n"), *by_domain).filter("n >= 5"))
    out = {}
    for k, (domain, size) in enumerate(counts.items()):
        share = size / total
        inside = F.col(f"n{k}")
        lift = F.log((inside + 0.5) / (F.col("n") + 1) / share)
        strength = inside * lift
        rows = words.filter((lift > F.log(F.lit(2.0))) & (strength > 10)).orderBy(F.desc(strength), "word").limit(LIST)
        out[domain] = [r.word for r in rows.select("word").collect()]
    steps.freed(words)
    return out


def learn(docs: DataFrame, labelled: DataFrame) -> Classifier:
    """From ``docs`` (doc_id, text) and ``labelled`` (doc_id, domain)."""
    chosen = steps.hash_sample(labelled, "doc_id", SAMPLE)
    sample = steps.written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("domain", "text"))
    counts = {r.domain: r.n for r in sample.groupBy("domain").agg(F.count("*").alias("n")).orderBy("domain").collect()}
    steps.freed(chosen)
    if len(counts) < 2:
        steps.freed(sample)
        return Classifier(list(counts) or ["all"], {}, {}, {}, {})
    lists = telling_words(sample, counts)
    rows = steps.written(with_features(sample, lists))
    names = [c for c in rows.columns if c not in ("domain", "n_words")]
    shares = [k / BINS for k in range(1, BINS)]
    cuts = {}
    row = rows.select([F.percentile(n, F.array(*[F.lit(s) for s in [*shares, 0.95, 0.99]])).alias(n) for n in names]).first()
    for n in names:
        cuts[n] = [0.5, 1.5, 3.5] if n.startswith("list_") else sorted(set(row[n]))
    binned = rows.select("domain", F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), bin_of(F.col(n), cuts[n]).alias("bin")) for n in names])).alias("b"))
    seen = {(r.domain, r.feature, r.bin): r.n for r in binned.groupBy("domain", "b.feature", "b.bin").agg(
        F.count("*").alias("n")).collect()}
    steps.freed(sample, rows)
    total = sum(counts.values())
    prior = {d: n / total for d, n in counts.items()}
    chances = {
        (d, n, k): (seen.get((d, n, k), 0) + 0.5) / (counts[d] + 0.5 * (len(cuts[n]) + 1))
        for d in counts for n in names for k in range(len(cuts[n]) + 1)
    }
    return Classifier(list(counts), lists, cuts, prior, chances)


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """All columns but the text, n_words, and ``p``: an array in the order of the domains."""
    if len(model.domains) < 2:
        out = docs.withColumn("n_words", F.size(split_words(F.col("text"))).cast("long"))
        return out.drop("text").withColumn("p", F.array(F.lit(1.0)))
    rows = with_features(docs, model.lists)
    names = list(model.cuts)
    binned = rows.select(
        *[c for c in rows.columns if c not in names],
        *[(bin_of(F.col(n), model.cuts[n]) + 1).alias(n) for n in names])
    scores = []
    for d in model.domains:
        parts = [
            F.element_at(F.expr("array(" + ",".join(
                f"{log(model.chances[d, n, k])}D" for k in range(len(model.cuts[n]) + 1)) + ")"), F.col(n))
            for n in names
        ]
        scores.append(reduce(lambda a, b: a + b, parts, F.lit(log(model.prior[d]))))
    scored = binned.select(*[c for c in binned.columns if c not in names], F.array(*scores).alias("score"))
    raised = scored.withColumn("score", F.transform("score", lambda s: F.exp(s - F.array_max("score"))))
    total = F.aggregate("score", F.lit(0.0), lambda a, b: a + b)
    return raised.withColumn("p", F.transform("score", lambda s: s / total)).drop("score")


def fitted(rows: DataFrame, targets: list[float], target_words: float | None = None) -> tuple[DataFrame, list[float], list[float]]:
    """``rows`` (n_words, p) with a column ``rate``; the words wanted and those reached.

    ``targets`` are weights of the domains, in the order of ``p``; ``target_words`` is the
    size of the mix, that of the rows unless given. The gap of a domain is measured
    against its present words (at least a small share of all).
    """
    k = range(len(targets))
    expected = lambda rate: [F.sum(F.col("n_words") * F.col("p")[j] * rate).alias(f"e{j}") for j in k]
    now = [x or 0.0 for x in rows.agg(*expected(F.lit(1.0))).first()]
    total = sum(now)
    wanted = [w / sum(targets) * (target_words or total) for w in targets]
    scale = [max(x, FLOOR * total, 1e-9) for x in now]
    state = rows.withColumn("rate", F.lit(1.0)).withColumn("past", F.lit(1.0))
    reached, before, pace, last = now, now, 1.0, None
    miss = lambda e: sum(((wanted[j] - e[j]) ** 2) / scale[j] for j in k)
    for step in range(1, ROUNDS + 1):
        if max(abs(wanted[j] - reached[j]) for j in k) <= TOLERANCE * max(total, 1e-9):
            break
        # The words expected are linear in the rates, so those ahead need no pass.
        pace = pace if miss(reached) <= miss(before) else 1.0
        next_pace = (1 + sqrt(1 + 4 * pace**2)) / 2
        push = (pace - 1) / next_pace
        pace = next_pace
        gaps = [(wanted[j] - reached[j] - push * (reached[j] - before[j])) / scale[j] for j in k]
        move = reduce(lambda a, b: a + b, [F.col("p")[j] * F.lit(gaps[j]) for j in k])
        ahead = F.col("rate") + F.lit(push) * (F.col("rate") - F.col("past"))
        new = F.when(F.col("n_words") > 0, F.greatest(F.lit(0.0), ahead + move)).otherwise(F.col("rate"))
        state = state.select(*rows.columns, new.alias("rate"), F.col("rate").alias("past"))
        if step % EVERY == 0:
            state = steps.written(state)
            steps.freed(last)
            last = state
        before, reached = reached, [x or 0.0 for x in state.agg(*expected(F.col("rate"))).first()]
        if max(abs(x - y) for x, y in zip(before, reached)) <= TOLERANCE / 100 * total:
            break
    return state.drop("past"), wanted, reached


def rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], target_words: float | None = None) -> tuple[DataFrame, Classifier]:
    """doc_id, own (hash of the text), n_words, p and rate for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    model = learn(docs, labelled)
    rows = steps.written(posteriors(docs.withColumn("own", F.xxhash64("text")), model))
    targets = [weights.get(d, 0.0) for d in model.domains]
    if not sum(targets):
        targets = [1.0] * len(targets)
    state, _, _ = fitted(rows, targets, target_words)
    return state, model


def copies(rate: Column) -> Column:
    """Whole copies, and one more with the chance of the rest by a hash."""
    chance = F.pmod(F.xxhash64("doc_id", "own", F.lit("copy")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def report(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, the posteriors as ``p_<domain>``,
    rate and copies."""
    state, model = rates(docs, domain_of_labels(labels), weights)
    names = [F.col("p")[j].alias(f"p_{d}") for j, d in enumerate(model.domains)]
    return state.select("doc_id", "n_words", *names, "rate", copies(F.col("rate")).alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], target_words: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its copies."""
    state, _ = rates(docs, labelled, weights, target_words)
    n, own, doc = (steps.fresh(x, docs.columns) for x in ("copies", "own", "doc"))
    counts = state.select(F.col("doc_id").alias(doc), F.col("own").alias(own), copies(F.col("rate")).alias(n)).distinct()
    held = docs.join(counts, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(own)))
    each = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return held.filter(F.col(n) > 0).select(*docs.columns, each.alias(n)).select(*docs.columns)
