"""URL filters: listed rules first, boosted trees on lexical features for the rest.

All is done by DataFrame functions and Spark's own tree learner; no Python runs on
the executors. Labelled URLs are those that a rule decides. The others take part as
allowed ones of little weight, so that what the labels do not speak about is not
blocked. Training takes at most ``SAMPLE`` URLs, chosen by a hash, outside the held-out
fold; the statistics of host suffixes are taken over all URLs.

A null URL, or one without ``://``, has an empty host and path; no rule fits it.
Without a blocked and an allowed URL to learn from, what no rule blocks is allowed.
"""

from dataclasses import dataclass

from curfew.llm import steps
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
UNLABELLED_WEIGHT = 0.3
TREES, DEPTH = 15, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and a beginning of the path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
)

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "host_entropy",
    "path_entropy", "parameters", "query_length", "hyphens", "longest_label", "has_fragment", "is_secure",
    "suffix_share", "site_share", "suffix_blocked", "section_blocked", "extension_length",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lowered, and the path up to a query or fragment."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))
    return host & F.startswith("path", F.lit(rule.path))


def ruled(rules: tuple[Rule, ...], value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(fits(rule), F.lit(value(rule))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character, from the runs of the sorted characters."""
    size = F.greatest(F.length(text), F.lit(1))
    bits = lambda n: F.when(n > 0, -(n / size) * F.log2(n / size)).otherwise(0.0)
    start = F.struct(F.lit("").alias("char"), F.lit(0).alias("n"), F.lit(0.0).alias("bits"))

    def add(run: Column, char: Column) -> Column:
        same = run["char"] == char
        ended = F.when(same, run["bits"]).otherwise(run["bits"] + bits(run["n"]))
        return F.struct(char.alias("char"), F.when(same, run["n"] + 1).otherwise(1).alias("n"), ended.alias("bits"))

    total = F.aggregate(F.sort_array(F.split(text, "")), start, add, lambda run: run["bits"] + bits(run["n"]))
    return F.when(F.length(text) > 0, total).otherwise(0.0)


def ratio(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def lexical(urls: DataFrame) -> DataFrame:
    """The features of a URL alone, and the suffix and site of its host."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return urls.select(
        "*",
        F.length(url).alias("url_length"), F.length(host).alias("host_length"), F.length(path).alias("path_length"),
        F.size(F.filter(F.split(path, "/"), lambda p: p != "")).alias("depth"),
        F.size(labels).alias("labels"),
        ratio(url, "[0-9]").alias("digit_ratio"), ratio(host, "[0-9]").alias("host_digit_ratio"),
        entropy(host).alias("host_entropy"), entropy(path).alias("path_entropy"),
        F.when(query != "", F.size(F.split(query, "&"))).otherwise(0).alias("parameters"),
        F.length(query).alias("query_length"),
        F.regexp_count(url, F.lit("-")).alias("hyphens"),
        F.array_max(F.transform(labels, F.length)).alias("longest_label"),
        F.contains(url, F.lit("#")).cast("int").alias("has_fragment"),
        F.startswith(url, F.lit("https:")).cast("int").alias("is_secure"),
        F.length(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).alias("extension_length"),
        F.element_at(labels, -1).alias("suffix"),
        F.element_at(F.split(F.concat(path, F.lit("//")), "/"), 2).alias("section"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("site"),
    )


def featured(urls: DataFrame) -> DataFrame:
    """With the share of URLs that have the suffix or site, and the share of blocked ones
    among the labelled URLs of the training fold, by suffix and by suffix and first part
    of the path. All counts come from one folded table; equal keys meet as counts."""
    plain = lexical(urls)
    blocked = F.col("trains") & (F.col("label") == 1)
    counts = steps.written(plain.groupBy("suffix", "site", "section").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("trains"), F.col("label"))).alias("n_label"),
        F.count(F.when(blocked, 1)).alias("n_blocked")))
    total = F.lit(max(1, counts.agg(F.sum("n")).first()[0] or 0))
    share = (F.sum("n_blocked") + 1) / (F.sum("n_label") + 2)
    known = (
        counts.select("suffix", "site", "section")
        .join(counts.groupBy("suffix").agg((F.sum("n") / total).alias("suffix_share"), share.alias("suffix_blocked")), "suffix")
        .join(counts.groupBy("suffix", "site").agg((F.sum("n") / total).alias("site_share")), ["suffix", "site"])
        .join(counts.groupBy("suffix", "section").agg(share.alias("section_blocked")), ["suffix", "section"])
    )
    return plain.join(known, ["suffix", "site", "section"])


def classified(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score, held_out.

    ``score`` is the trees' chance of a block; a rule's verdict stands above it.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    urls = urls.select(
        "*", ruled(rules, lambda r: r.name).alias("rule"), ruled(rules, lambda r: r.verdict).alias("ruling"),
        F.coalesce(F.crc32(F.col("url")) % 5 != 0, F.lit(False)).alias("trains"))
    urls = urls.withColumn("label", F.when(F.col("rule").isNotNull(), (F.col("ruling") == "block").cast("double")))
    rows = steps.written(featured(urls).drop("suffix", "site", "section"))
    sample = steps.hash_sample(rows.filter("trains").withColumn("key", F.struct("url", "page_id")), "key", SAMPLE).select(
        F.coalesce("label", F.lit(0.0)).alias("label"),
        F.when(F.col("label").isNull(), UNLABELLED_WEIGHT).otherwise(1.0).alias("weight"), *FEATURES)
    if sample.select("label").distinct().count() < 2:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
        learner = GBTClassifier(
            labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3)
        model = learner.fit(vector.transform(sample))
        scored = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce("ruling", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", (~F.col("trains")).alias("held_out"))
